"""The numbered queries against their SQL, and what SQL cannot express against brute force."""

from __future__ import annotations

import hashlib
import re

import pytest
from oracle_compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from cadenza.llm import cotraining
from cadenza.llm.common import stored, table
from cadenza.llm.queries import MIX_WEIGHTS, ORACLE_SQL, QUERIES
from cadenza.sources.versions import Files
from llm_brute import contaminated, kept_lines, near_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    found, wanted = compare(spark, name, QUERIES[name], ORACLE_SQL[name], FOLDER)
    assert found[0] == wanted[0]
    assert wanted[1]
    assert found[1] == wanted[1]


def test_all_are_registered():
    names = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def texts(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def test_near_duplicates_equal_brute_force(spark):
    found = QUERIES["op4_setsketch_dedup"](spark, FOLDER).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert got == near_groups(texts(spark), 85)


# The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = [int(c) for c in text if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        twice = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def test_base_spans_equal_the_patterns(spark):
    """The query's counts, digest and first spans against plain regular expressions."""
    found = {r.doc_id: r for r in QUERIES["op3_disclosure_pii"](spark, FOLDER).collect()}
    every = texts(spark)
    assert set(found) == set(every)
    total = 0
    for key, text in every.items():
        spans = {
            kind: [m.span() for m in re.finditer(p, text or "") if holds(kind, m[0])]
            for kind, p in PATTERNS.items()
        }
        row = found[key]
        assert [row[f"n_{kind}"] for kind in PATTERNS] == [len(spans[kind]) for kind in PATTERNS]
        listed = ",".join(f"{kind}:{s}:{e}" for kind in PATTERNS for s, e in spans[kind])
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.spans.startswith(listed)
        total += len(listed)
    assert total > 0


def test_quality_of_rows_not_fitted(spark):
    """Held-out accuracy: fitted without every third label."""
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = cotraining.fit(docs, labels.where("doc_id % 3 <> 0"))
    scored = cotraining.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id")
    rows = scored.select("quality", "quality_score").collect()
    right = sum((r.quality_score >= cotraining.KEEP_FROM) == bool(r.quality) for r in rows)
    assert len(rows) > 50
    assert right >= 0.97 * len(rows)


def test_pipeline_stages_equal_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        after = {r.doc_id: r for r in docs.collect()}
        kept[name] = (before, after)
        if name != "mix":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    wrong = [d for d in before if d in labels and (d in after) != bool(labels[d])]
    assert len(wrong) <= 0.03 * len(labels)
    before, after = kept["line_dedup"]
    lines = kept_lines({d: r.text for d, r in before.items()})
    assert {d: r.text for d, r in after.items()} == {
        d: text for d, (text, n, gone) in lines.items() if not n or gone < n
    }
    assert all(r.n_chars == len(r.text) for r in after.values())
    before, after = kept["near_dedup"]
    groups = near_groups({d: r.text for d, r in before.items()}, 80)
    assert set(after) == {d for d, (_, _, first) in groups.items() if first}
    before, after = kept["decontamination"]
    items = {r.item_id: r.text for r in table(spark, FOLDER, "benchmark").collect()}
    bad = contaminated({d: r.text for d, r in before.items()}, items)
    assert set(after) == set(before) - bad
    before, after = kept["mix"]
    assert set(before) == set(after)
    placed = sorted(after.values(), key=lambda r: r.mix_order)
    assert len({r.mix_order for r in placed}) == len(placed)
    assert len(MIX_WEIGHTS) == 11


def test_run_equals_its_stages(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns[-2:] == ["mix_slot", "mix_order"]
    assert found.count() > 0


AWKWARD = [
    (1, "One line of eight words that comes again.\nAnother line here.", "en", "src0", 9),
    (2, None, None, None, None), (3, "", "en", "src1", 0), (4, " \n\t ", "en", "src1", 4),
    (5, "One line of eight words that comes again.\nAnother line here.", "en", "src2", 9),
    (7, "short", "en", "src0", 5), (7, "short", "en", "src0", 5), (7, "other words", "en", None, 5),
    (None, "a text of no id " * 8, "en", "src3", 3), (None, "a text of no id " * 8, "en", "src3", 3),
    (10, "long " * 60_000, "en", "src0", 1), (11, "x" * 300_000, "en", "none", 1),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def awkward(spark):
    clash = ("stream", "own", "of", "todo", "row", "terms", "kept", "n", "QUALITY_SCORE")
    docs = spark.createDataFrame(AWKWARD, DOCS)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_rows(spark, awkward, name, stage):
    """Nulls, empty and long texts, repeated rows and ids, and columns of clashing names."""
    kept = [c for c in awkward.columns if name != "quality" or c != "QUALITY_SCORE"]
    found = stored(stage(spark, awkward.select(*kept), FOLDER), f"awkward-{name}")
    assert found.columns[: len(kept)] == kept
    rows = [tuple(r)[:5] for r in found.collect()]
    if name == "mix":
        assert sorted(rows, key=str) == sorted(AWKWARD, key=str)
    elif name == "near_dedup":
        # One of each group of equal texts; texts without shingles stay alone.
        wanted = {1, 2, 3, 4, 7, 10, 11, None}
        assert {r[0] for r in rows} == wanted and len(rows) == 9
        assert sorted(r[1] for r in rows if r[0] == 7) == ["other words", "short"]
    elif name == "decontamination":
        assert len(rows) == len(AWKWARD)
    else:
        ids = [r[0] for r in AWKWARD]
        assert all(r[0] in ids for r in rows) and len(rows) <= len(ids)
    empty = stored(stage(spark, awkward.select(*kept).limit(0), FOLDER), f"empty-{name}")
    assert empty.collect() == []


def test_a_stage_deletes_the_scratch_of_the_one_before(spark):
    docs = table(spark, FOLDER, "documents")
    found = stored(corpus_pipeline.line_dedup(spark, docs, FOLDER), "lines")
    before = list(corpus_pipeline._left)
    assert before and all(Files(spark, path).exists(path) for path in before)
    stored(corpus_pipeline.near_dedup(spark, found, FOLDER), "near")
    assert not any(Files(spark, path).exists(path) for path in before)
    assert Files(spark, corpus_pipeline._left[0]).exists(corpus_pipeline._left[0])
