"""Raw client log: text lines, six fields joined by ``&``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.projection import computed_once

FIELDS = 6
TABLE_FIELD, BODY_FIELD = 2, 3


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Log lines as ``value``.

    A gzip file is one scan task. With fewer scan tasks than cores the lines are spread
    before they are parsed; deliver the day as many files to need no shuffle.
    """
    lines, cores = spark.read.text(path), spark.sparkContext.defaultParallelism
    return lines.repartition(cores) if lines.rdd.getNumPartitions() < cores else lines


def split_lines(lines: DataFrame) -> DataFrame:
    """(table_name, body) of the lines with exactly six fields.

    Empty fields at the end of a line do not count, so such a line is dropped.
    """
    fields = lines.select(F.split(F.regexp_replace("value", "&+$", ""), "&").alias("fields"))
    parts = F.struct(
        F.size("fields").alias("n_fields"),
        F.get("fields", F.lit(TABLE_FIELD)).alias("table_name"),
        F.get("fields", F.lit(BODY_FIELD)).alias("body"),
    )
    return computed_once(fields, parts).where(F.col("n_fields") == FIELDS).drop("n_fields")
