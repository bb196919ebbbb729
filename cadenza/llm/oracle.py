"""The same results in SQL that DuckDB runs over the same tables."""

from __future__ import annotations

_MIX_STREAMS = ", ".join(
    ["(0, 'src0', 10)", *[f"({i}, 'src{i}', 4)" for i in range(1, 11)], "(11, NULL, 50)"]
)

OP1 = f"""
WITH RECURSIVE streams(i, source, w) AS (VALUES {_MIX_STREAMS}),
blocks AS (
    SELECT i, k, (k * 100) // w AS released, ((k + 1) * 100 + w - 1) // w AS due
    FROM streams, range(100) r(k) WHERE k < w),
listed AS (SELECT list({{'due': due, 'i': i, 'k': k, 'released': released}}) AS every FROM blocks),
edf AS (
    SELECT -1::BIGINT AS slot, NULL::INTEGER AS i, NULL::BIGINT AS k, every AS left_over FROM listed
    UNION ALL
    SELECT slot + 1, pick.i, pick.k, list_filter(left_over, lambda b: b <> pick)
    FROM (SELECT *, list_min(list_filter(left_over, lambda b: b.released <= slot + 1)) AS pick
          FROM edf WHERE slot < 99)),
numbered AS (
    SELECT d.*, s.i AS stream, s.w,
        row_number() OVER (PARTITION BY s.i ORDER BY md5(d.doc_id::VARCHAR), d.doc_id) - 1 AS n
    FROM documents d JOIN streams s
        ON s.i = coalesce((SELECT i FROM streams t WHERE t.source = d.source), 11)),
placed AS (
    SELECT n.*, ((n // 64) // w) * 100 + e.slot AS mix_slot
    FROM numbered n JOIN edf e ON e.i = n.stream AND e.k = (n // 64) % w)
SELECT doc_id, text, lang, source, n_chars, mix_slot::BIGINT AS mix_slot,
    (mix_slot * 64 + n % 64)::BIGINT AS mix_order
FROM placed
"""

# Documents with equal sets are one class. Two classes that are similar enough share one of the
# rarest shingles of each, so those name the pairs whose sets are then compared in full.
OP4 = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM doc, LATERAL unnest(range(1, greatest(len(w) - 4, 1) + 1)) r(i) WHERE len(w) > 0),
sets AS (
    SELECT doc.doc_id, coalesce(s, []) AS s
    FROM doc LEFT JOIN (SELECT doc_id, list(shingle ORDER BY shingle) AS s FROM grams GROUP BY doc_id) g
        USING (doc_id)),
classes AS (
    SELECT min(doc_id) AS node, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
parts AS (SELECT node, n, unnest(s) AS shingle FROM classes),
ranked AS (
    SELECT node, n, shingle, row_number() OVER (PARTITION BY node ORDER BY held, shingle) AS r
    FROM parts JOIN (SELECT shingle, count(*) AS held FROM parts GROUP BY shingle) USING (shingle)),
rare AS (SELECT * FROM ranked WHERE r <= n - (85 * n + 99) // 100 + 1),
pairs AS (
    SELECT DISTINCT x.node AS a, y.node AS b
    FROM rare x JOIN rare y ON x.shingle = y.shingle AND x.node < y.node
        AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)),
compared AS (
    SELECT a, b, x.n + y.n AS total, len(list_intersect(x.s, y.s)) AS common
    FROM pairs JOIN classes x ON x.node = a JOIN classes y ON y.node = b),
links AS (SELECT a, b FROM compared WHERE 100 * common >= 85 * (total - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT node AS root, node FROM classes
    UNION
    SELECT root, b FROM reached JOIN ways ON a = node WHERE b > root),
groups AS (SELECT node, min(root) AS component FROM reached GROUP BY node)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles,
    coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN groups USING (node)
"""

OP6 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
part AS (SELECT vec_id, unnest(e) AS w, generate_subscripts(e, 1) AS i FROM v),
score AS (
    SELECT q.vec_id AS query_id, r.vec_id, sum(q.w * r.w)::BIGINT AS score
    FROM part q JOIN part r USING (i) WHERE q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
    GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id, score
FROM score
QUALIFY rank <= 5
"""

_REPEATS = r"""
WITH doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + {n} - 1], ' ')) AS h
    FROM doc, LATERAL unnest(range(1, len(w) - {n} + 2)) r(i)),
judged AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again
    FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS p FROM judged WHERE again),
gone_list AS (SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    sha256(array_to_string(
        CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, p: NOT list_contains(gone, p)) END,
        ' ')) AS kept_sha256
FROM doc LEFT JOIN gone_list USING (doc_id)
"""

OP5 = _REPEATS.replace("{n}", "50")
OP7 = _REPEATS.replace("{n}", "20")

OP8 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
whole AS (
    SELECT conv_id, count(*)::BIGINT AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text)
            FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(14 + length(replace(replace(replace(role || text, '&', '12345'), '<', '1234'),
            '#', '12345')))::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""

OP9 = r"""
WITH doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
item AS (
    SELECT item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
item_window AS (
    SELECT DISTINCT item_id, w[i:i + 12] AS phrase, least(len(w), 13) AS n
    FROM item, LATERAL unnest(range(1, greatest(len(w) - 12, 1) + 1)) r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM item_window),
doc_window AS (
    SELECT doc_id, i, n, w[i:i + n - 1] AS phrase
    FROM doc, sizes, LATERAL unnest(range(1, len(w) - n + 2)) r(i)),
hit AS (SELECT doc_id, i, d.n, item_id FROM doc_window d JOIN item_window t USING (phrase)),
place AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
places AS (SELECT doc_id, count(*) AS n_hit FROM place GROUP BY doc_id),
ids AS (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit WHERE item_id IS NOT NULL),
names AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM ids GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)
"""

OP10 = r"""
WITH line AS (
    SELECT doc_id, n - 1 AS line, parts[n] AS part
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
        LATERAL unnest(range(1, len(parts) + 1)) r(n)),
worded AS (
    SELECT doc_id, line, part, list_filter(regexp_split_to_array(part, '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w FROM line),
content AS (
    SELECT w, min({'d': doc_id, 'l': line}) AS place FROM worded WHERE len(w) > 0 GROUP BY w),
short AS (
    SELECT w, place, i, w[1:i - 1] || w[i + 1:] AS v
    FROM content, LATERAL unnest(range(1, len(w) + 1)) r(i) WHERE len(w) >= 8),
near AS (
    SELECT a.w, min(b.place) AS place
    FROM short a JOIN short b ON a.v = b.v AND a.i = b.i GROUP BY a.w
    UNION ALL
    SELECT a.w, min(b.place) FROM short a JOIN content b ON a.v = b.w WHERE len(b.w) >= 8 GROUP BY a.w
    UNION ALL
    SELECT b.w, min(a.place) FROM short a JOIN content b ON a.v = b.w WHERE len(b.w) >= 8 GROUP BY b.w
    UNION ALL
    SELECT w, place FROM content),
earliest AS (SELECT w, min(place) AS place FROM near GROUP BY w),
judged AS (
    SELECT l.*, len(l.w) > 0 AS has_words,
        len(l.w) > 0 AND {'d': l.doc_id, 'l': l.line} > e.place AS gone
    FROM worded l LEFT JOIN earliest e ON l.w = e.w),
kept AS (
    SELECT doc_id, count(*) FILTER (WHERE has_words) AS n_lines,
        count(*) FILTER (WHERE gone) AS n_removed,
        coalesce(string_agg(part, chr(10) ORDER BY line) FILTER (WHERE NOT coalesce(gone, false)), '')
            AS text
    FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
    length(k.text)::BIGINT AS kept_chars, sha256(k.text) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""



def _lloyd() -> str:
    """Four rounds and a last assignment, written out."""
    ctes = [
        """kept AS (
    SELECT vec_id, label,
        list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
part AS (
    SELECT vec_id, p, x[p * len(x) // 4 + 1:(p + 1) * len(x) // 4] AS x
    FROM kept, range(4) r(p)),
book0 AS (
    SELECT p, (row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1) AS e, x AS c
    FROM part WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256))"""
    ]
    for i in range(5):
        ctes.append(
            f"""near{i} AS (
    SELECT vec_id, p, x, min({{'d': d, 'e': e}}) AS b
    FROM (SELECT vec_id, p, x, e,
            list_sum(list_transform(x, lambda v, k: (v - c[k]) * (v - c[k])))::BIGINT AS d
        FROM part JOIN book{i} USING (p))
    GROUP BY ALL)"""
        )
        if i < 4:
            ctes.append(
                f"""mean{i} AS (
    SELECT p, e, list(m ORDER BY k) AS c
    FROM (SELECT p, e, k, (s - ((s % n) + n) % n) // n AS m
        FROM (SELECT p, b.e AS e, k, sum(x[k])::BIGINT AS s, count(*) AS n
            FROM near{i}, LATERAL unnest(range(1, len(x) + 1)) r(k) GROUP BY ALL))
    GROUP BY ALL),
book{i + 1} AS (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN mean{i} m USING (p, e))"""
            )
    return (
        "WITH "
        + ",\n".join(ctes)
        + """,
coded AS (
    SELECT vec_id, string_agg(printf('%02x', b.e::INTEGER), '' ORDER BY p) AS code,
        sum(b.d)::BIGINT AS error
    FROM near4 GROUP BY vec_id),
flat AS (
    SELECT string_agg(c[k]::VARCHAR, ',' ORDER BY p, e, k) AS every
    FROM book4, LATERAL unnest(range(1, len(c) + 1)) r(k))
SELECT vec_id, code, error,
    sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, sha256(every) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), flat
"""
    )


OP12 = _lloyd()


def _part(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_part(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b:
        list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z:
            CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))"""

_RUNS = """list_transform(range(0, len(nodes), 16),
        lambda i: sha256(array_to_string(nodes[i + 1:i + 16], '')))"""

OP13 = f"""
WITH RECURSIVE leaf AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
        CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN {_leaf(
            "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
        ELSE {_leaf('text')} END AS shown,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place
    FROM documents),
up AS (
    SELECT source, 0 AS lvl, list(leaf ORDER BY place) AS nodes FROM leaf GROUP BY source
    UNION ALL
    SELECT source, lvl + 1, {_RUNS} FROM up WHERE len(nodes) > 1),
sub AS (
    SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
    FROM up WHERE len(nodes) = 1),
over AS (
    SELECT 0 AS lvl, list(subroot ORDER BY place) AS nodes FROM sub
    UNION ALL
    SELECT lvl + 1, {_RUNS} FROM over WHERE len(nodes) > 1),
way AS (
    SELECT doc_id, lvl, nodes, place // (16 ** lvl)::BIGINT AS i
    FROM leaf JOIN up ON leaf.source IS NOT DISTINCT FROM up.source WHERE len(nodes) > 1
    UNION ALL
    SELECT doc_id, 100 + lvl, nodes, sub.place // (16 ** lvl)::BIGINT
    FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source, over WHERE len(nodes) > 1),
step AS (
    SELECT doc_id, lvl, array_to_string(nodes[i // 16 * 16 + 1:i], '') AS b,
        array_to_string(nodes[i + 2:i // 16 * 16 + 16], '') AS a FROM way),
proof AS (
    SELECT doc_id, string_agg(b || a, '' ORDER BY lvl) AS proof,
        list(b || '|' || a ORDER BY lvl) AS steps FROM step GROUP BY doc_id),
folded AS (
    SELECT leaf.*, coalesce(proof, '') AS proof, list_reduce(
        list_prepend(shown, coalesce(steps, [])),
        lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
    FROM leaf LEFT JOIN proof USING (doc_id)),
top AS (SELECT nodes[1] AS root FROM over WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root,
    folded_root = root AS verified
FROM folded JOIN sub ON folded.source IS NOT DISTINCT FROM sub.source, top
"""

ORACLE_SQL = {
    "op1_pfair_mixing": OP1,
    "op4_setsketch_dedup": OP4,
    "op5_suffix_passage_dedup": OP5,
    "op6_term_at_a_time_topk": OP6,
    "op7_block_substring_dedup": OP7,
    "op8_reply_chat": OP8,
    "op9_inverted_decontamination": OP9,
    "op10_deletion_line_dedup": OP10,
    "op12_active_lloyd_codes": OP12,
    "op13_merkle_manifest": OP13,
}
