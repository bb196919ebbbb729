"""Row counts and exact distinct counts over trailing windows, kept up day by day.

A day keeps two things: the distinct values it saw, and a small table of how long ago each of
them had been seen before (its gap), counted per key. In any window a value is counted on its
first day there, the one whose gap reaches back beyond the window's start. So a window's
distinct counts are sums over the small table, for windows of any length up to ``far`` days, and a
new day compares only its own values with those of the days before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.sources.tables import DAY

SLOT, VALUE, GAP, COUNT = "slot", "value", "gap", "n"
ROWS_SLOT = -1  # counts rows instead of values
_DAY_TEXT = "yyyyMMdd"


def _date(day: Column) -> Column:
    return F.to_date(day, _DAY_TEXT)


def day_values(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, slot, value, data_dt``: the distinct values of each column, numbered as slots;
    missing values are none."""
    slots = [str(n) for n in range(len(columns))]
    named = [F.col(c).cast("string").alias(s) for s, c in zip(slots, columns, strict=True)]
    values = rows.select(key, DAY, *named).unpivot([key, DAY], slots, SLOT, VALUE)
    values = values.where(F.col(VALUE).isNotNull() & F.col(key).isNotNull())
    return values.select(key, F.col(SLOT).cast("int").alias(SLOT), VALUE, DAY).distinct()


def _row_counts(rows: DataFrame, key: str) -> DataFrame:
    counts = rows.where(F.col(key).isNotNull()).groupBy(key, DAY).agg(F.count("*").alias(COUNT))
    return counts.select(key, F.lit(ROWS_SLOT).alias(SLOT), F.lit(0).alias(GAP), COUNT, DAY)


def _counted(gaps: DataFrame, key: str) -> DataFrame:
    found = gaps.groupBy(key, SLOT, GAP, DAY).agg(F.count("*").alias(COUNT))
    return found.select(key, SLOT, GAP, COUNT, DAY)


def day_gaps(rows: DataFrame, seen: DataFrame, earlier: DataFrame, key: str, day: str) -> DataFrame:
    """``key, slot, gap, n, data_dt`` of one day: how many values had been seen last ``gap``
    days ago, 0 for those that ``earlier`` (the kept values of the days before) lacks.

    The join is on (key, slot, value), so a hot key is spread over its values.
    """
    same = [key, SLOT, VALUE]
    last = earlier.select(*same, F.col(DAY).alias("last"))
    found = seen.select(*same).join(last, same, "left").groupBy(*same).agg(F.max("last").alias("last"))
    gap = F.coalesce(F.datediff(_date(F.lit(day)), _date(F.col("last"))), F.lit(0))
    dated = found.select(key, SLOT, gap.alias(GAP), F.lit(day).alias(DAY))
    return _counted(dated, key).unionByName(_row_counts(rows, key))


def many_gaps(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The same for many days at once, as a first load: gaps reach back to the first of them."""
    before = F.lag(DAY).over(Window.partitionBy(key, SLOT, VALUE).orderBy(DAY))
    gap = F.coalesce(F.datediff(_date(F.col(DAY)), _date(before)), F.lit(0))
    return _counted(seen.withColumn(GAP, gap), key).unionByName(_row_counts(rows, key))


def trailing_counts(
    gaps: DataFrame, key: str, names: list[str], day: str, windows: dict[int, str], rows: str
) -> DataFrame:
    """Row counts and distinct counts per ``key`` for windows that end with ``day``.

    ``windows`` maps the days a window reaches back to the prefix of its columns, ``names`` are
    the distinct counts by slot, ``rows`` names the row counts. ``gaps`` holds the days of the
    longest window.
    """
    age = F.datediff(_date(F.lit(day)), _date(F.col(DAY)))
    results = []
    for back, prefix in windows.items():
        inside = F.col("age") <= back
        first = (F.col(GAP) == 0) | (F.col("age") + F.col(GAP) > back)
        for slot, name in enumerate([rows, *names], ROWS_SLOT):
            counted = inside & (F.col(SLOT) == slot) & (F.lit(True) if slot == ROWS_SLOT else first)
            total = F.sum(F.when(counted, F.col(COUNT)).otherwise(0))
            results.append(total.alias(f"{prefix}{name}"))
    return gaps.withColumn("age", age).groupBy(key).agg(*results)
