"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.ranking import full_rank
from cadenza.session import remove_path, scratch_path

_scopes: list[list[str]] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so a lost executor costs only the tasks it ran. The files go when
    the session's JVM ends, or earlier where a ``recorded`` block has listed them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that ``stored`` writes inside the block, for ``discard`` when they have been
    read for the last time."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.pop()
        if _scopes:
            _scopes[-1].extend(paths)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch that nothing will read again."""
    for path in paths:
        remove_path(spark, path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Helper column names that no column of ``df`` has, for any case of letters."""
    taken = {name.lower() for name in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def with_own_ids(docs: DataFrame, operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operate`` on rows whose ``doc_id`` is theirs alone, for operators that find rows again
    by it.

    Unique ids are left as they are. Where an id is null or shared, all rows are numbered by
    doc_id (null first), then by the hash of their text, and the numbers stand in as ids;
    ``operate`` must return rows with the columns of ``docs``, and may add others.
    """
    times = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if times.where("n > 1 or doc_id is null").isEmpty():
        return operate(docs)
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("at"),
        F.xxhash64("text").alias("hash"),
    )
    order = [F.asc_nulls_first("at"), F.col("hash")]
    ranked = full_rank(rows, [], order, "own")
    (kept,) = free_names(docs, "id_of_row")
    others = [F.col(f"row.{c}").alias(c) for c in docs.columns if c != "doc_id"]
    numbered = ranked.select(
        F.col("own").alias("doc_id"), F.col("row.doc_id").alias(kept), *others
    )
    found = operate(numbered)
    added = [c for c in found.columns if c not in numbered.columns]
    back = [F.col(kept).alias("doc_id") if c == "doc_id" else F.col(c) for c in docs.columns]
    there = [c for c, name in zip(back, docs.columns, strict=True) if name in found.columns]
    return found.select(*there, *added)
