"""Operators on small fixtures: awkward rows, brute force, and their general interfaces."""

from __future__ import annotations

import collections
import math
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import (
    anchors,
    blocks,
    cotraining,
    disclosure,
    inverted,
    lines,
    mixing,
    replies,
    setsketch,
    suffixes,
    topk,
    words,
)
from cadenza.llm.components import components
from llm_brute import contaminated, kept_lines, near_groups, without_repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


PASSAGE = prose(70)
ITEM = prose(20)
MESSY = [
    (1, PASSAGE + "\n" + prose(30), "en", "a", 9),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "en", "b", 4),
    (5, prose(7) + " " + PASSAGE, "de", "a", 5),
    (6, PASSAGE + "\n" + prose(30), "en", "c", 9),
    (7, "short", "en", "a", 5),
    (7, "short", "en", "a", 5),
    (None, prose(25) + " " + ITEM, "en", "a", 3),
    (8, "same " * 60, "en", "a", 300),
    (9, "é " * 40 + ITEM.upper() + " x@y.zz +1 (234) 555-6789", "fr", "a", 1),
    (10, prose(30_000), "en", "a", 1),
    (11, "x" * 300_000, "en", "a", 1),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = spark.createDataFrame(MESSY, DOCS)
    clash = ("stream", "Places", "masks", "of", "todo", "drops", "terms", "kept", "N_WORDS")
    return rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)]).withColumns(
        {"mix_order": F.lit("old"), "quality_score": F.lit("old"), "found": F.map_from_arrays(
            F.array(F.lit("k")), F.array("doc_id"))}
    )


ITEMS = [(1, ITEM), (2, None), (3, "never seen anywhere at all"), (None, PASSAGE), (1, ITEM)]


def run(name, docs):
    spark = docs.sparkSession
    if name == "mix":
        return mixing.mix_sources(docs, {"a": 3, "b": 1}, rest=2, block=2)
    if name == "quality":
        labels = spark.createDataFrame(
            [(1, 1), (3, 0), (5, 1), (7, 0), (None, 1), (9, None), (1, 1)],
            "doc_id long, quality int",
        )
        return cotraining.score(docs, cotraining.fit(docs, labels))
    if name == "pii":
        return disclosure.sanitise(docs)
    if name == "near":
        return setsketch.near_duplicates(docs, 80)
    if name == "passages":
        return suffixes.dedup_passages(docs)
    if name == "substrings":
        return blocks.dedup_substrings(docs)
    if name == "lines":
        return lines.dedup_lines(docs)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return inverted.contamination(docs, items)


WHOLE = ["mix", "quality", "pii", "passages", "substrings", "lines", "benchmark"]


@pytest.mark.parametrize("name", [*WHOLE, "near"])
def test_awkward_rows(messy, name):
    found = run(name, messy)
    rows = found.collect()
    if name == "near":
        assert sorted(r.doc_id for r in rows) == list(range(1, 12))
        return
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(
        r[0] for r in MESSY
    )
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    assert {r.stream for r in rows} == {0}


@pytest.mark.parametrize("name", [*WHOLE, "near"])
def test_empty_tables(spark, name):
    assert run(name, spark.createDataFrame([], DOCS)).collect() == []


def by_rows(spark, rows, size):
    """What is left of each row, as documents in the order of id (null first) and text hash."""
    plain = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    hashed = plain.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    ordered = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    left = without_repeats({i: r.text for i, r in enumerate(ordered)}, size)
    return sorted(((r.doc_id, *left[i]) for i, r in enumerate(ordered)), key=str)


def left_of(found):
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("name, size", [("passages", 50), ("substrings", 20)])
def test_removal_of_repeats_on_awkward_rows(spark, messy, name, size):
    assert left_of(run(name, messy)) == by_rows(spark, MESSY, size)


@pytest.mark.parametrize("name, size", [("passages", 50), ("substrings", 20)])
def test_rows_that_share_an_id_keep_their_own_words(spark, name, size):
    """Text is removed where it repeats, and from no other row of the same id."""
    passage, a, b = prose(60), prose(80), prose(80)
    cases = [
        [(1, passage), (7, f"{passage} {a}"), (7, b)],
        [(1, passage), (None, f"{passage} {a}"), (None, f"{b} {passage}")],
        [(None, a), (None, a), (3, a), (3, None), (3, "")],
    ]
    for rows in cases:
        docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], DOCS)
        docs = docs.withColumns({"own": F.lit("x"), "id_of_row": F.lit("y"), "_id": F.lit("z")})
        found = run(name, docs)
        assert found.columns[: len(docs.columns)] == docs.columns
        assert left_of(found) == by_rows(spark, rows, size)
        assert {(r.own, r.id_of_row, r["_id"]) for r in found.collect()} == {("x", "y", "z")}


def test_items_without_an_id_are_hits(spark):
    docs = spark.createDataFrame(
        [(1, f"{prose(5)} {ITEM}", "en", "a", 1), (2, PASSAGE, "en", "a", 1), (3, prose(40), "en", "a", 1)],
        DOCS,
    )
    items = spark.createDataFrame(
        [(None, ITEM), (None, PASSAGE), (4, PASSAGE), (None, None)], "item_id long, text string"
    )
    found = {r.doc_id: r for r in inverted.contamination(docs, items).collect()}
    assert [found[i].contaminated for i in (1, 2, 3)] == [True, True, False]
    assert [found[i].n_items for i in (1, 2, 3)] == [0, 1, 0]
    assert found[1].n_hit == 20 and found[2].n_hit == 70


def test_long_runs_of_zeros_in_an_address(spark):
    zeros = "0" * 5000
    texts = [f"{zeros}.1.2.3", f"x {zeros}1.2.{zeros}255.4 y", f"{zeros}256.1.2.3", "1.2.3.0004"]
    got = [len(disclosure.base_spans(t)["ip"]) for t in texts]
    assert got == [1, 1, 0, 1]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    assert [r.n_ip for r in disclosure.sanitise(docs).orderBy("doc_id").collect()] == got


def noisy(n, seed):
    """Documents that share passages at all offsets, and copies with single words changed."""
    local = random.Random(seed)
    bits = [" ".join(local.choice("abcdefgh") * 3 + str(local.randint(0, 99)) for _ in range(k))
            for k in (8, 19, 20, 21, 49, 50, 51, 90)]
    texts = {}
    for key in range(n):
        parts = [local.choice(bits) if local.random() < 0.6 else
                 " ".join(str(local.random()) for _ in range(local.randint(1, 30)))
                 for _ in range(local.randint(1, 5))]
        text = "\n".join(parts) if local.random() < 0.5 else " ".join(parts)
        if key and local.random() < 0.3:
            w = texts[local.randrange(key)].split(" ")
            for _ in range(local.randint(0, 2)):
                w[local.randrange(len(w))] = "changed"
            text = " ".join(w)
        texts[key] = text
    return texts


@pytest.mark.parametrize("slice_bytes", [words.SLICE_BYTES, 3000])
def test_operators_equal_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(words, "SLICE_BYTES", slice_bytes)
    texts = noisy(120, 11)
    rows = [(k, t, "en", "a", len(t)) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    for name, size in (("passages", 50), ("substrings", 20)):
        found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in run(name, docs).collect()}
        assert found == without_repeats(texts, size)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in run("lines", docs).collect()}
    assert got == kept_lines(texts)
    near = setsketch.near_duplicates(docs, 80).collect()
    assert {r.doc_id: tuple(r)[1:] for r in near} == near_groups(texts, 80)
    items = {i: " ".join(texts[i].split()[3:30]) for i in range(0, 120, 10)} | {500: "abc", 501: ""}
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    bad = inverted.contamination(docs, table).where("contaminated").collect()
    assert {r.doc_id for r in bad} == contaminated(texts, items)


@pytest.mark.parametrize("name, size, shared", [("substrings", 20, 15), ("passages", 50, 40)])
def test_a_shared_phrase_is_spread_over_all_buckets(spark, monkeypatch, name, size, shared):
    """Each document has the phrase between words of its own; no window repeats, but some do
    in the two documents that are equal."""
    local, phrase = random.Random(8), [f"p{i}" for i in range(shared)]
    def own():
        return [str(local.random()) for _ in range(size)]

    texts = {i: " ".join([*own(), *phrase, *own()]) for i in range(600)}
    texts[600] = texts[3]
    seen, plain = [], anchors.in_buckets

    def watched(packed, total):
        entries = F.sum(F.octet_length("ids") / 8).alias("n")
        seen.append([r.n for r in packed.groupBy("bucket").agg(entries).collect()])
        return plain(packed, total)

    monkeypatch.setattr(anchors, "in_buckets", watched)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in run(name, docs).collect()}
    assert found == without_repeats(texts, size)
    assert max(seen[-1]) < sum(seen[-1]) / 50


def test_near_copies_by_row(spark, messy):
    """Shared and missing ids: each row is a document, and the smallest id names its group."""
    found = setsketch.duplicates_by_row(messy, 80).collect()
    hashed = messy.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    ordered = sorted(hashed, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    groups = near_groups({i: r.text for i, r in enumerate(ordered)}, 80)
    wanted = [(r.doc_id, groups[i][0], ordered[groups[i][1]].doc_id, groups[i][2])
              for i, r in enumerate(ordered)]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    copies = spark.createDataFrame(
        [(None, PASSAGE), (None, PASSAGE), (9, PASSAGE), (4, prose(30)), (None, prose(20))],
        "doc_id long, text string",
    )
    got = setsketch.duplicates_by_row(copies, 80).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(9, 9, True), (None, 9, False), (None, 9, False), (4, 4, True), (None, None, True)], key=str
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert setsketch.duplicates_by_row(empty, 80).collect() == []


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_suffixes_reach_as_far_as_any_other_one(spark, adaptive):
    """In one task, and cut into several whose ends must be compared."""
    texts = noisy(80, 5)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    batches = docs.toArrow().to_batches()
    kept = [r for b in suffixes._suffixes(batches) for r in b.to_pylist()]
    plain = {}
    for r in kept:
        run_ = texts[r["doc_id"]].split()[r["place"] : r["place"] + suffixes.PASSAGE]
        assert len(r["suffix"].rstrip(b"\0")) == len(run_)
        plain[r["doc_id"], r["place"]] = run_

    def shared(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    wanted = {k: max(shared(a, b) for o, b in plain.items() if o != k) for k, a in plain.items()}
    wanted = {k: n for k, n in wanted.items() if n >= suffixes.PREFIX}
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        found = suffixes.repeated_suffixes(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    got = collections.defaultdict(int)
    for r in found:
        for place, reach in zip(r.places, r.reach, strict=True):
            got[r.doc_id, place] = max(reach, got[r.doc_id, place])
    assert set(got) == set(wanted)
    # A letter shared by unlike words may lengthen a reach, never shorten it.
    assert all(got[k] >= n for k, n in wanted.items())
    assert sum(got[k] > n for k, n in wanted.items()) < len(wanted) / 20


def test_tasks_grow_with_the_buckets():
    sizes = [anchors.task_count(1 << bits, 200) for bits in (10, 12, 15, 20, 40)]
    assert sizes == [200, 256, 2048, 65536, 65536]


def test_near_lines_go_and_distant_stay(spark):
    base = [f"a{i}" for i in range(10)]
    cases = [base, base[:4] + ["new"] + base[5:], base[1:], [*base, "end"], base[2:],
             ["front", *base[:-1]], base[:7], base[:6] + ["x"]]
    rows = [(i, " ".join(c), "en", "a", 1) for i, c in enumerate(cases)]
    got = {r.doc_id: r.n_removed for r in run("lines", spark.createDataFrame(rows, DOCS)).collect()}
    # base[2:] is one edit from base[1:]; lines of under eight words must be equal.
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0, 7: 0}
    assert lines.within_one_edit([1, 2, 3], [1, 3]) and not lines.within_one_edit([1, 2], [2, 1])


def test_word_hashes_equal_split_words(monkeypatch):
    monkeypatch.setattr(words, "_PIECE", 40)
    texts = [None, "", " ", "a", "A b\tc", "é\x85x\x0by  z", *noisy(20, 3).values()]
    found = words.Words(*words.bytes_of(pa.array(texts)))
    seen = {}
    for i, text in enumerate(texts):
        plain = (text or "").encode().split()
        assert found.counts()[i] == len(plain)
        for word, at in zip(plain, range(found.first[i], found.first[i + 1]), strict=True):
            assert seen.setdefault(word, found.hash[at]) == found.hash[at]
    assert len(set(seen.values())) == len(seen)


def test_sketches_merge_and_estimate():
    local = np.random.default_rng(1)
    both, a, b = (local.integers(0, 1 << 63, k, dtype=np.uint64) for k in (850, 75, 75))
    x, y = np.concatenate([both, a]), np.concatenate([both, b])
    kx, ky = setsketch.registers_of(x), setsketch.registers_of(y)
    assert (np.maximum(kx, ky) == setsketch.registers_of(np.union1d(x, y))).all()
    sizes = [np.array([float(len(s))]) for s in (x, y)]
    assert setsketch.joint_loss(*sizes, kx[None], ky[None], 0.8)[0] < setsketch.MAX_RATIO
    far = setsketch.registers_of(local.integers(0, 1 << 63, 925, dtype=np.uint64))
    assert setsketch.joint_loss(*sizes, kx[None], far[None], 0.8)[0] > setsketch.MAX_RATIO


def test_a_star_of_copies_that_are_not_alike_is_one_group(spark):
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 40):
        copy = list(base)
        for j in range(3):
            copy[(k * 5 + j * 60) % 200] = f"c{k}-{j}"
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = setsketch.near_duplicates(docs, 85).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == near_groups(dict(rows), 85)


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(100, 150)] + [(k, 7) for k in range(200, 260)] + [(9, 8)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    got = dict(map(tuple, found))
    assert len(found) == len(got)
    assert got == (
        {i: 100 for i in range(100, 151)} | {k: 7 for k in range(200, 260)} | {7: 7, 8: 8, 9: 8}
    )


@pytest.mark.parametrize("weights", [[1], [3, 2, 1], [10, *[4] * 10, 50], [7, 11, 13, 1, 1]])
def test_schedule_keeps_within_one_block(spark, weights):
    rows, period = mixing.schedule(spark, weights).collect(), sum(weights)
    slots = {r.slot: r.stream for r in rows}
    assert sorted(slots) == list(range(period))
    done = [0] * len(weights)
    for slot in range(period):
        for i, weight in enumerate(weights):
            assert abs(done[i] - Fraction(weight * slot, period)) < 1
        done[slots[slot]] += 1


def test_prefixes_of_the_mix_hold_their_weights(spark):
    rows = [(i, "t", "en", "a" if i % 3 else ("b" if i % 2 else None), 1) for i in range(900)]
    found = mixing.mix_sources(spark.createDataFrame(rows, DOCS), {"a": 2, "b": 1}, 1, block=5)
    placed = sorted(found.collect(), key=lambda r: r.mix_order)
    assert [r.doc_id for r in found.collect()] == [r.doc_id for r in placed]
    left, done = collections.Counter(r.source for r in placed), collections.Counter()
    for n, row in enumerate(placed):
        if any(done[s] == left[s] for s in left):
            break
        for source, weight in (("a", 2), ("b", 1), (None, 1)):
            assert abs(done[source] - n * weight / 4) < 2 * 5
        done[row.source] += 1


def test_labels_of_one_kind_reject_nothing(spark, messy):
    labels = spark.createDataFrame([(1, 1), (5, 1)], "doc_id long, quality int")
    model = cotraining.fit(messy, labels)
    scores = [r.quality_score for r in cotraining.score(messy, model).collect()]
    assert set(scores) == {1.0}


def test_a_repeated_id_pushes_no_labels_out(spark, monkeypatch):
    monkeypatch.setattr(cotraining, "MAX_LABELLED", 60)
    monkeypatch.setattr(cotraining, "MAX_POOL", 40, raising=False)
    rows = [(i, "good text here" if i % 2 else "BAD !!! 99", "en", "a", 9) for i in range(60)]
    rows += [(500, f"copy {i}", "en", "a", 9) for i in range(3000)]
    seen, plain = [], cotraining.co_train

    def watched(text, meta, label, *more):
        seen.append(label.tolist())
        return plain(text, meta, label, *more)

    monkeypatch.setattr(cotraining, "co_train", watched)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows[::-1], DOCS)
    assert cotraining.fit(docs, labels).views
    assert [seen[0].count(k) for k in (0, 1)] == [30, 30] and seen[0].count(-1) <= 1


def test_all_documents_without_a_label_take_part(spark, monkeypatch):
    monkeypatch.setattr(cotraining, "MAX_POOL", 50, raising=False)
    local = random.Random(9)
    kinds = ("Plain words of a calm text here. ", "!!! 99 $$ WIN |||| 77 ")
    rows = [(i, kinds[i % 2] * local.randint(1, 9), "en", f"s{(i % 2) ^ (i % 9 == 0)}", i % 50)
            for i in range(900)]
    seen, plain = [], cotraining.co_train

    def watched(text, meta, label, *pool):
        seen.append(pool[0].count if pool else (label < 0).sum())
        return plain(text, meta, label, *pool)

    monkeypatch.setattr(cotraining, "co_train", watched)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    model = cotraining.fit(docs, labels)
    assert seen == [700]
    scored = cotraining.score(docs, model).collect()
    assert all((r.quality_score >= 0.5) == (r.doc_id % 2 == 0) for r in scored)
    # What the pool stores gives both views back.
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("d", "text", "lang", "source", "n"))})
    text = cotraining.text_view(table["text"].combine_chunks())
    meta = cotraining.meta_view(*(table[c].combine_chunks() for c in ("lang", "source", "n")))
    assert (cotraining.meta_of(cotraining.cells_of(meta)) == meta).all()
    assert (cotraining.widened(text[:, :14]) == text).all()


def test_views_teach_each_other():
    """The metadata view is given few labels that say anything; the text view's help it."""
    local = np.random.default_rng(2)
    truth = local.integers(0, 2, 3000)
    text = np.column_stack([truth + local.normal(0, 0.2, 3000), np.ones(3000)])
    meta = np.column_stack([truth * 0.5 + local.normal(0, 0.4, 3000), np.ones(3000)])
    label = np.where(np.arange(3000) < 60, truth, -1)
    model = cotraining.co_train(text, meta, label)
    for z, least in zip(model.scores(text, meta), (0.97, 0.66, 0.97), strict=True):
        assert ((z > 0.5) == truth).mean() > least


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = {}
    for kind, pattern in PATTERNS.items():
        found[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                found[kind].append(m.span())
    return found


def test_base_spans_equal_the_patterns():
    local = random.Random(3)
    cases = ["".join(local.choice("a.@-%1259 +()é") for _ in range(local.randint(0, 40)))
             for _ in range(5000)]
    cases += ["4111 1111 1111 1111 a@b.c.d@e.f 1.2.3.4.5 300.1.1.1 +1 (234) 555-6789)", "0001.2.3.4"]
    for text in cases:
        assert disclosure.base_spans(text) == plain_spans(text)
    assert disclosure.base_spans("a" * 200_000 + "1" * 200_000)["email"] == []


def test_terms_that_give_an_entity_away(spark):
    local = random.Random(4)
    rows = [(i, " ".join(local.choice(["the", "of", "and", "to"]) for _ in range(30)))
            for i in range(200)]
    rows[10] = (10, "the Zorblax of Quend mail me at joe@x.org and to the of")
    rows[20] = (20, "to zorblax and joe@x.org the of")
    rows[30] = (30, "plain zorblax here")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in disclosure.sanitise(docs).collect()}
    assert found[10].n_terms == found[20].n_terms == 1
    assert "quend" in found[10].sanitised.lower()  # seen with the entity only once
    assert found[10].spans == "email:32:41,term:4:11"
    share = math.log(200 * 2 / (2 * 3)) / math.log(200 / 2)
    assert disclosure.GENERALISE <= share < disclosure.REMOVE
    assert found[10].sanitised == "the [TERM] of Quend mail me at [EMAIL] and to the of"
    assert found[30].sanitised == rows[30][1] and found[30].n_terms == 0


def test_top_k_equals_brute_force(spark):
    local = np.random.default_rng(6)
    vectors = [(i, [float(x) for x in local.integers(-2, 3, 6) / 8]) for i in range(300)]
    vectors += [(300, None), (301, [None, 1.0]), (302, [float("nan")]), (303, [float("inf")]),
                (350, []), (400, [0.5] * 9), (None, [1.0]), (17, [0.25] * 6)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    wanted = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i)
                            for i, b in good if i != q)[:5]
            wanted += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    found = topk.top_k(table, 50, 5).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert topk.top_k(table.limit(0), 50, 5).collect() == []
    assert topk.top_k(table.where("vec_id = 1"), 50, 5).collect() == []


NODES = "tree long, node string, parent string, role string, text string, score double"


def test_reply_trees(spark):
    nodes = [
        (1, "a", None, "user", "hi", 0.0), (1, "b", "a", "assistant", "x <turn> & #", 1.0),
        (1, "c", "a", "assistant", "worse", 0.5), (1, "d", "b", None, None, None),
        (1, "e", "c", "user", "best end", 9.0), (2, "f", "gone", "user", "", 1.0),
        (3, "g", "h", "user", "cycle", 1.0), (3, "h", "g", "user", "cycle", 1.0),
        (None, "i", None, "user", "no tree", 1.0),
    ]
    table = spark.createDataFrame(nodes, NODES)
    path = replies.reply_paths(table, 2).collect()
    by = collections.defaultdict(dict)
    for r in path:
        by[r.tree, r.branch][r.height] = r.node
    chains = {k: [v[h] for h in sorted(v, reverse=True)] for k, v in by.items()}
    assert chains == {
        (1, 1): ["a", "c", "e"], (1, 2): ["a", "b", "d"], (2, 1): ["f"], (None, 1): ["i"]
    }
    done = replies.format_conversations(table, 2)
    read = done.select(
        "tree", "branch", replies.read_turns(F.col("formatted")).alias("turns"),
        replies.read_loss(F.col("formatted"), F.col("loss")).alias("learned"),
    ).collect()
    got = {(r.tree, r.branch): ([tuple(t) for t in r.turns], r.learned) for r in read}
    assert got[1, 2] == ([("user", "hi"), ("assistant", "x <turn> & #"), ("", "")], "x <turn> & #")
    assert replies.format_conversations(table.limit(0)).collect() == []


def test_long_and_awkward_conversations(spark):
    texts = ["&amp;lt;", "</turn>", "<turn>user#", "\\### Assistant:", "", None, "é#&"] * 20
    turns = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    turns += [(2, None, None, None), (2, None, None, None), (None, 0, "user", "x")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = replies.format_conversations(replies.stored(replies.turns_as_tree(table), "test"))
    read = done.select("tree", replies.read_turns(F.col("formatted")).alias("turns"),
                       replies.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    got = {r.tree: r for r in read.collect()}
    assert [t.text for t in got[1].turns] == [t or "" for t in texts]
    assert got[1].learned == "".join(t or "" for t in texts[1::2])
    assert len(got[2].turns) == 2 and len(got[None].turns) == 1


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f g h i j k l m n"), (2, "a b c x d e f g h i j k l m"), (3, "a m")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "A b c d e f g h i j k l m")], "item_id long, text string")
    hit = {r.doc_id: (r.n_hit, r.n_items) for r in inverted.contamination(docs, items).collect()}
    assert hit == {1: (13, 1), 2: (0, 0), 3: (0, 0)}
    near = inverted.proximity_matches(docs, items, slack=2).collect()
    assert {r.doc_id for r in near} == {1, 2}
    assert inverted.contamination(docs, items.limit(0)).where("n_hit > 0").collect() == []


def test_native_operators_use_no_python(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "a", 1)], DOCS).where("doc_id > 0")
    docs = replies.stored(docs, "native")
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    for df in (mixing.mix_sources(docs, {"a": 1}, 1), inverted.contamination(docs, items)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
