"""Play records and pass-through records out of the raw client log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.projection import computed_once
from cadenza.sources.client_log import split_lines

# The routed table and its fields.
PLAY_TABLE = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
PLAY_FIELDS = (
    "songid",
    "mid",
    "optrate_type",
    "uid",
    "consume_type",
    "dur_time",
    "session_id",
    "songname",
    "pkg_id",
    "order_id",
)
PLAY, UNREADABLE, OTHER = "play", "unreadable", "other"

_SCHEMA = "array<struct<{}>>".format(", ".join(f"{name}: string" for name in PLAY_FIELDS))


def parse_records(lines: DataFrame) -> DataFrame:
    """Records with their ``kind`` and, for play records, the fields in ``play``.

    Each body is parsed once, as the only element of an array: text before or after the
    object, or a second object, does not give one element. A play record whose body is not
    exactly one JSON object is unreadable.
    """
    records = split_lines(lines)
    is_play = F.col("table_name") == PLAY_TABLE
    body = F.when(is_play, F.concat(F.lit("["), F.col("body"), F.lit("]")))
    plays = F.from_json(body, _SCHEMA)
    parsed = computed_once(records, F.struct(plays.alias("plays")), "table_name", "body")
    play = F.when(F.size("plays") == 1, F.get("plays", F.lit(0)))
    parsed = parsed.withColumn("play", play).drop("plays")
    kind = F.when(~is_play, OTHER).when(F.col("play").isNull(), UNREADABLE).otherwise(PLAY)
    return parsed.withColumn("kind", kind)


def play_records(records: DataFrame) -> DataFrame:
    """Fields of the play records; a field missing in the JSON is NULL."""
    return records.where(F.col("kind") == PLAY).select(
        *[F.col(f"play.{name}").alias(name.upper()) for name in PLAY_FIELDS]
    )


def unreadable_records(records: DataFrame) -> DataFrame:
    """Unreadable play records as they came, for quarantine."""
    return records.where(F.col("kind") == UNREADABLE).select("table_name", "body")


def routed_text(records: DataFrame) -> DataFrame:
    """(table_name, value) of every readable record: tab-joined fields for plays, the
    JSON as it came for other tables."""
    # The text form writes NULL as the word null.
    joined = F.concat_ws("\t", *[F.coalesce(f"play.{n}", F.lit("null")) for n in PLAY_FIELDS])
    return records.where(F.col("kind") != UNREADABLE).select(
        "table_name",
        F.when(F.col("kind") == PLAY, joined).otherwise(F.col("body")).alias("value"),
    )
