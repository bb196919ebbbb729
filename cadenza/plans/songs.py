"""Song dimension, song features, and heat rankings of songs and singers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import catalog
from cadenza.functions.dates import normalise_time, shift_day
from cadenza.functions.heat import heat_index
from cadenza.operators.counting import nested_window_counts
from cadenza.operators.ranking import full_rank, top_n
from cadenza.operators.trailing import (
    COUNT,
    ROWS_SLOT,
    SLOT,
    day_gaps,
    day_values,
    many_gaps,
    trailing_counts,
)
from cadenza.sources.tables import DAY, between_days, on_day

NEAR_DAYS, FAR_DAYS = 7, 30
TOP = 30
COUNTED = {"USR_CNT": "UID", "ORDR_CNT": "ORDER_ID"}  # distinct counts and their columns
PREFIXES = {0: "", NEAR_DAYS: "RCT_7_", FAR_DAYS: "RCT_30_"}

# Catalog columns passed through unchanged.
PLAIN_HEAD = ("SOURCE",)
PLAIN_MIDDLE = ("PRDCT", "LANG", "VIDEO_FORMAT", "DUR")
PLAIN_TAIL = (
    "PINYIN_FST", "PINYIN", "SING_TYPE", "ORI_SINGER", "LYRICIST", "COMPOSER", "BPM_VAL",
    "STAR_LEVEL", "VIDEO_QLTY", "VIDEO_MK", "VIDEO_FTUR", "LYRIC_FTUR", "IMG_QLTY",
    "SUBTITLES_TYPE", "AUDIO_FMT", "ORI_SOUND_QLTY", "ORI_TRK", "ORI_TRK_VOL", "ACC_VER",
    "ACC_QLTY", "ACC_TRK_VOL", "ACC_TRK", "WIDTH", "HEIGHT", "VIDEO_RSVL", "SONG_VER",
)
# Dimension columns kept in the features.
FEATURE_DIMENSIONS = (
    "NAME", "SOURCE", "ALBUM", "PRDCT", "LANG", "VIDEO_FORMAT", "DUR", "SINGER1", "SINGER2",
    "SINGER1ID", "SINGER2ID", "MAC_TIME",
)
RANKED_COUNTS = (
    "SING_CNT", "SUPP_CNT",
    "RCT_7_SING_CNT", "RCT_7_SUPP_CNT", "RCT_7_TOP_SING_CNT", "RCT_7_TOP_SUPP_CNT",
    "RCT_30_SING_CNT", "RCT_30_SUPP_CNT", "RCT_30_TOP_SING_CNT", "RCT_30_TOP_SUPP_CNT",
)


def song_dimension(catalog_rows: DataFrame) -> DataFrame:
    """One cleaned row per catalog row with a song number."""
    singers = F.col("SINGER_INFO")
    types = catalog.product_types(F.col("PRDCT_TYPE"))
    return catalog_rows.where(F.col("NBR") != "").select(
        "NBR",
        F.coalesce("NAME", "OTHER_NAME").alias("NAME"),
        *PLAIN_HEAD,
        catalog.album_name(F.col("ALBUM")).alias("ALBUM"),
        *PLAIN_MIDDLE,
        catalog.singer_field(singers, 0, "name").alias("SINGER1"),
        catalog.singer_field(singers, 1, "name").alias("SINGER2"),
        catalog.singer_field(singers, 0, "id").alias("SINGER1ID"),
        catalog.singer_field(singers, 1, "id").alias("SINGER2ID"),
        F.lit(0).alias("MAC_TIME"),
        normalise_time(F.col("POST_TIME")).alias("POST_TIME"),
        *PLAIN_TAIL,
        catalog.company_name(F.col("AUTH_CO")).alias("AUTH_CO"),
        "STATE",
        F.when(F.size(types) > 0, types).alias("PRDCT_TYPE"),
    )


def song_features(
    plays: DataFrame,
    songs: DataFrame,
    history: DataFrame,
    day: str,
    near_days: int = NEAR_DAYS,
    far_days: int = FAR_DAYS,
) -> DataFrame:
    """Play, user and order counts of the songs played on ``day``, from the plays of the
    whole period.

    The trailing windows hold both end days (``near_days + 1`` dates). Peaks come from
    the earlier output of this job in ``history`` and never from ``day`` itself, so a
    rerun repeats the first run. Likes have no source and are 0.
    """
    near, far = shift_day(day, -near_days), shift_day(day, -far_days)
    level = (
        F.when(F.col(DAY) == day, 2).when(F.col(DAY) >= near, 1).otherwise(0)
    )
    counts = nested_window_counts(
        between_days(plays, far, day).withColumnRenamed("SONGID", "NBR"),
        key="NBR",
        values=COUNTED,
        level=level,
        prefixes={2: "", 1: "RCT_7_", 0: "RCT_30_"},
        rows="SING_CNT",
    ).where(F.col("SING_CNT") > 0)
    return _features(counts, songs, history, day, near_days, far_days)


def play_values(plays: DataFrame) -> DataFrame:
    """The distinct users and orders of each song and day, to be kept for later days."""
    return day_values(plays.withColumnRenamed("SONGID", "NBR"), "NBR", list(COUNTED.values()))


def play_gaps(
    plays: DataFrame, seen: DataFrame, earlier: DataFrame | None = None, day: str | None = None
) -> DataFrame:
    """How long ago the values ``seen`` had been seen before, to be kept: of one ``day``, compared
    with the kept values of ``FAR_DAYS`` ``earlier`` days, or of many days among themselves."""
    rows = plays.withColumnRenamed("SONGID", "NBR")
    if earlier is None:
        return many_gaps(rows, seen, "NBR")
    return day_gaps(rows, seen, earlier, "NBR", day)


def song_features_from(gaps: DataFrame, songs: DataFrame, history: DataFrame, day: str) -> DataFrame:
    """The same features from the kept gaps of the last ``FAR_DAYS`` days and ``day``'s own; no
    plays are read."""
    kept = between_days(gaps, shift_day(day, -FAR_DAYS), day)
    counts = trailing_counts(kept, "NBR", list(COUNTED), day, PREFIXES, "SING_CNT")
    counts = counts.where(F.col("SING_CNT") > 0)
    return _features(counts, songs, history, day, NEAR_DAYS, FAR_DAYS)


def _features(
    counts: DataFrame,
    songs: DataFrame,
    history: DataFrame,
    day: str,
    near_days: int,
    far_days: int,
) -> DataFrame:
    """Counts with their songs' columns and the peaks of the days before."""
    near, far = shift_day(day, -near_days), shift_day(day, -far_days)
    in_near = F.col(DAY) >= near
    peaks = (
        between_days(history, far, shift_day(day, -1))
        .groupBy("NBR")
        .agg(
            F.max(F.when(in_near, F.col("SING_CNT")).otherwise(0)).alias("RCT_7_TOP_SING_CNT"),
            F.max(F.when(in_near, F.col("SUPP_CNT")).otherwise(0)).alias("RCT_7_TOP_SUPP_CNT"),
            F.max("SING_CNT").alias("RCT_30_TOP_SING_CNT"),
            F.max("SUPP_CNT").alias("RCT_30_TOP_SUPP_CNT"),
        )
    )
    likes = F.lit(0).cast("bigint")

    def peak(name: str):
        return F.coalesce(name, F.lit(0)).cast("bigint").alias(name)

    return (
        counts.join(songs.select("NBR", *FEATURE_DIMENSIONS), "NBR")
        .join(peaks, "NBR", "left")
        .select(
            "NBR",
            *FEATURE_DIMENSIONS,
            "SING_CNT",
            likes.alias("SUPP_CNT"),
            "USR_CNT",
            "ORDR_CNT",
            "RCT_7_SING_CNT",
            likes.alias("RCT_7_SUPP_CNT"),
            peak("RCT_7_TOP_SING_CNT"),
            peak("RCT_7_TOP_SUPP_CNT"),
            "RCT_7_USR_CNT",
            "RCT_7_ORDR_CNT",
            "RCT_30_SING_CNT",
            likes.alias("RCT_30_SUPP_CNT"),
            peak("RCT_30_TOP_SING_CNT"),
            peak("RCT_30_TOP_SUPP_CNT"),
            "RCT_30_USR_CNT",
            "RCT_30_ORDR_CNT",
        )
    )


def daily_counts(plays: DataFrame, songs: DataFrame, first: str, last: str) -> DataFrame:
    """(NBR, data_dt, SING_CNT, SUPP_CNT) of many days at once: the part of the features
    that later runs read back, for a first load without earlier output."""
    return (
        between_days(plays, first, last)
        .groupBy(F.col("SONGID").alias("NBR"), DAY)
        .agg(F.count("*").alias("SING_CNT"))
        .join(songs.select("NBR"), "NBR", "left_semi")
        .withColumn("SUPP_CNT", F.lit(0).cast("bigint"))
    )


def kept_daily_counts(gaps: DataFrame, songs: DataFrame, first: str, last: str) -> DataFrame:
    """The same from the row counts that days keep beside their gaps; no plays are read."""
    return (
        between_days(gaps, first, last)
        .where(F.col(SLOT) == ROWS_SLOT)
        .select("NBR", DAY, F.col(COUNT).alias("SING_CNT"))
        .join(songs.select("NBR"), "NBR", "left_semi")
        .withColumn("SUPP_CNT", F.lit(0).cast("bigint"))
    )


def _heat_periods(counts: DataFrame, *identity: str) -> DataFrame:
    """One row per period '1', '7', '30' with its index as RSI."""

    def recent(days: int):
        volume, peak = f"RCT_{days}_", f"RCT_{days}_TOP_"
        return heat_index(
            F.col(f"{volume}SING_CNT"),
            F.col(f"{volume}SUPP_CNT"),
            days,
            F.col(f"{peak}SING_CNT"),
            F.col(f"{peak}SUPP_CNT"),
        )

    indexed = counts.select(
        DAY,
        *identity,
        heat_index(F.col("SING_CNT"), F.col("SUPP_CNT")).alias("1"),
        recent(7).alias("7"),
        recent(30).alias("30"),
    )
    return indexed.unpivot([DAY, *identity], ["1", "7", "30"], "PERIOD", "RSI")


def _singer_counts(features: DataFrame, day: str) -> DataFrame:
    """Counts summed by first singer; a second singer gets no credit."""
    return (
        on_day(features, day)
        .groupBy(DAY, "SINGER1ID", "SINGER1")
        .agg(*[F.sum(name).alias(name) for name in RANKED_COUNTS])
    )


def _ranked(periods: DataFrame, identity: tuple[str, ...], top: int | None) -> DataFrame:
    group, order = [DAY, "PERIOD"], [F.desc("RSI"), *[F.asc(name) for name in identity]]
    if top is None:
        ranked = full_rank(periods, group, order, "RSI_RANK")
    else:
        ranked = top_n(periods, top, group, order, "RSI_RANK")
    return ranked.select(DAY, "PERIOD", *identity, "RSI", "RSI_RANK")


def song_heat_rank(features: DataFrame, day: str, top: int | None = None) -> DataFrame:
    """Songs ranked by heat index in each period; all of them, or the first ``top``.

    Equal values rank by song number.
    """
    periods = _heat_periods(on_day(features, day), "NBR", "NAME")
    return _ranked(periods, ("NBR", "NAME"), top)


def singer_heat_rank(features: DataFrame, day: str, top: int | None = None) -> DataFrame:
    """First singers ranked by heat index in each period, like ``song_heat_rank``."""
    periods = _heat_periods(_singer_counts(features, day), "SINGER1ID", "SINGER1")
    return _ranked(periods, ("SINGER1ID", "SINGER1"), top)
