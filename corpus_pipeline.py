"""A training corpus from the documents: quality, lines, near copies, benchmarks, mix."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import cotraining, inverted, lines, mixing, setsketch
from cadenza.llm.common import discard, recorded, stored, table, with_own_ids
from cadenza.llm.queries import MIX_REST, MIX_WEIGHTS

SIMILAR = 80  # per cent

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: list[str] = []  # scratch of the stage before


def _stage(function: Stage) -> Stage:
    """A stage reads what the one before has written, so that one's scratch is deleted when it
    begins. A stage's result must be written before the next stage is called."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left)
        _left.clear()
        with recorded() as paths:
            found = function(spark, docs, sf_dir)
        _left.extend(paths)
        return found

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    scored = cotraining.score(docs, model)
    return scored.where(F.col("quality_score") >= cotraining.KEEP_FROM).select(*docs.columns)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated lines; those of which no line is left go."""
    found = lines.dedup_lines(docs).where("n_lines = 0 or n_removed < n_lines")
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    found = found.withColumn("n_chars", F.coalesce(size, F.col("n_chars").cast("long")))
    return found.select(*docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies. Rows that share an id or have none are
    documents of their own."""

    def first_of_groups(rows: DataFrame) -> DataFrame:
        gone = setsketch.near_duplicates(rows, SIMILAR).where("not kept").select("doc_id")
        return rows.join(gone, "doc_id", "left_anti").select(*rows.columns)

    return with_own_ids(docs, first_of_groups)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no notable part of the benchmark."""
    found = inverted.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select(*docs.columns)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, MIX_REST)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
]

# The classifier is fitted, so SQL cannot express the rows that stay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on what the one before has written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with recorded() as written:
            docs = stored(stage(spark, docs, sf_dir), name)
        discard(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
