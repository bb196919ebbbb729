"""One text folder per record type."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_by_table(routed: DataFrame, path: str, gather: bool = True) -> None:
    """Write ``value`` below ``path/table_name=<name>``, values only.

    Gathering rebalances by record type, so a rare type is one file and a frequent one is
    split over many tasks. Without it nothing is shuffled, but each task writes a file
    for every type it holds.
    """
    rows = routed.select("table_name", "value")
    if gather:
        rows = rows.hint("rebalance", "table_name")
    rows.write.mode("overwrite").partitionBy("table_name").text(path)
