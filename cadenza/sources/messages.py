"""Play-log messages, live from a broker or replayed from files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.projection import computed_once

TOPIC = "userlog"
RATE = 5_000_000  # messages of a micro-batch
_BODY = "mid string, uid string, songid string, songname string"
_LOG = "value string, timestamp timestamp"


def kafka_options(
    servers: str,
    topic: str = TOPIC,
    offsets: dict[int, int] | None = None,
    rate: int | None = RATE,
) -> dict[str, str]:
    """Where a first start begins: the first message kept of every partition, or the given
    offsets (-2 is the first kept). All partitions are subscribed to, so the source refuses
    a list that leaves one out, and reads partitions added later. At most ``rate`` messages
    come in one micro-batch; the rest follow in the next ones. A restart takes its
    checkpoint's positions."""
    start = "earliest"
    if offsets is not None:
        start = json.dumps({topic: {str(part): at for part, at in sorted(offsets.items())}})
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start
    }
    return options if rate is None else options | {"maxOffsetsPerTrigger": str(rate)}


def from_kafka(spark: SparkSession, servers: str, **where) -> DataFrame:
    """(value, timestamp) of the topic; needs the spark-sql-kafka package."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, **where))
        .load()
        .select(F.col("value").cast("string").alias("value"), "timestamp")
    )


def from_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(value, timestamp) replayed from Parquet files."""
    return spark.readStream.schema(_LOG).options(**options).parquet(path)


def parse(messages: DataFrame) -> DataFrame:
    """mid, uid, songid, songname and ``ts``; text that is not JSON gives NULL fields."""
    timed = messages.withColumnRenamed("timestamp", "ts")
    return computed_once(timed, F.from_json("value", _BODY), "ts")
