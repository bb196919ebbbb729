"""Exact counts over nested windows that stay spread under hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nested_window_counts(
    df: DataFrame,
    key: str,
    values: dict[str, str],
    level: Column,
    prefixes: dict[int, str],
    rows: str,
) -> DataFrame:
    """Row counts and distinct counts per ``key`` for windows nested in each other.

    ``level`` gives each row the innermost window it lies in as an integer; a row of
    level n also lies in every window with a lower number. Because the windows nest, a
    value is in a window exactly when its highest level reaches it, so one pass keeps the
    highest level per (key, value) instead of one distinct set per window. That first
    grouping also spreads a hot key over all its values.

    ``values`` maps result names to source columns, ``prefixes`` level numbers to the
    prefix of the result columns, ``rows`` names the row counts.
    """
    slots = [str(number) for number in range(len(values))]
    per_value = (
        df.select(
            F.col(key),
            level.alias("_level"),
            *[F.col(c).cast("string").alias(s) for s, c in zip(slots, values.values())],
        )
        .unpivot([key, "_level"], slots, "_slot", "_value")
        .groupBy(key, F.col("_slot").cast("tinyint").alias("_slot"), "_value")
        .agg(
            F.max("_level").alias("_top"),
            *[F.count_if(F.col("_level") >= n).alias(f"_n{n}") for n in prefixes],
        )
    )
    results = []
    for n, prefix in prefixes.items():
        in_first_slot = F.when(F.col("_slot") == 0, F.col(f"_n{n}")).otherwise(0)
        results.append(F.sum(in_first_slot).alias(f"{prefix}{rows}"))
        for number, name in enumerate(values):
            seen = (
                (F.col("_slot") == number) & F.col("_value").isNotNull() & (F.col("_top") >= n)
            )
            results.append(F.count_if(seen).alias(f"{prefix}{name}"))
    return per_value.groupBy(key).agg(*results)
