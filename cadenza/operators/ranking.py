"""Top-n and full ranks that do not hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import checkpointed

# Measured size up to which the offset table is broadcast, and its fixed bytes per row.
MAX_BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 64
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def top_n(
    df: DataFrame,
    n: int,
    group: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group, ranked 1..n.

    Each map task trims a group to ``n`` rows before the shuffle, so a hot group sends
    at most n rows per task. ``order`` must be total for a repeatable result.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def _measured_bytes(offsets: DataFrame, group: Sequence[str]) -> int:
    texts = [F.octet_length(F.col(f"_of_{name}").cast("string")) for name in group]
    row = sum((F.coalesce(text, F.lit(0)) for text in texts), F.lit(_ROW_BYTES))
    return offsets.agg(F.sum(row)).first()[0] or 0


def full_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """``row_number`` over whole groups of any size.

    A range shuffle on (group, order) spreads a large group over many tasks in rank
    order. Rows are numbered inside each partition and the result is written once to the
    shared folder, so numbers and offsets come from the same rows. A row's rank is its
    place in its partition plus the group's rows in earlier partitions. ``order`` must be
    total.
    """
    keys = [F.col(name) for name in group]
    spread = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    row_id = F.monotonically_increasing_id()
    placed = checkpointed(
        spread.withColumn("_id", row_id).select(
            "*",
            F.shiftright("_id", _ROW_BITS).alias("_part"),
            F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_pos"),
        )
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most (partitions + groups) rows.
    offsets = checkpointed(
        placed.groupBy("_part", *group)
        .agg(F.count("*").alias("_rows"), F.min("_pos").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(
            *[F.col(name).alias(f"_of_{name}") for name in ("_part", *group)],
            (F.col("_before") - F.col("_first") + 1).alias("_shift"),
        )
    )
    if _measured_bytes(offsets, group) <= MAX_BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in ("_part", *group)]
    return placed.join(offsets, same).select(
        *df.columns, (F.col("_pos") + F.col("_shift")).cast("bigint").alias(rank)
    )
