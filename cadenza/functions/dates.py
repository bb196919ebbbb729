"""Run dates and timestamps held as text."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "%Y%m%d"
EPOCH_DAY_TEXT = "19700101000000"
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"

_LOOSE_TIME = r"^(\d{1,4})-(\d{1,4})-(\d{1,4}) (\d{1,4}):(\d{1,4}):(\d{1,4})"
_LAST_MILLI_OF_YEAR_9999 = 253402300799999


def shift_day(day: str, days: int) -> str:
    """``day`` (yyyyMMdd) moved by ``days``; computed once per run, not per row."""
    return (datetime.strptime(day, DAY_FORMAT) + timedelta(days=days)).strftime(DAY_FORMAT)


def normalise_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text from time text or epoch milliseconds, else ''.

    Time text may have a tail (``.0``), one-digit fields, and fields past their range,
    which roll over (month 13 is January). Milliseconds may use exponent notation.
    """
    year, month, dom, hour, minute, second = (
        F.regexp_extract(text, _LOOSE_TIME, group).try_cast("int") for group in range(1, 7)
    )
    rolled = F.make_timestamp(year, *map(F.lit, (1, 1, 0, 0, 0))) + F.make_interval(
        months=month - 1, days=dom - 1, hours=hour, mins=minute, secs=second
    )
    stamp = F.when(text.rlike(_LOOSE_TIME), rolled)
    millis = text.try_cast("decimal(38,6)").try_cast("bigint")
    instant = F.when(
        F.abs(millis) <= _LAST_MILLI_OF_YEAR_9999, F.timestamp_millis(millis)
    )
    return F.coalesce(
        F.date_format(F.coalesce(stamp, instant), TIME_PATTERN), F.lit("")
    )


def pad_time(text: Column) -> Column:
    """``yyyyMMddHHmmss``: 14 characters stay, a bare day gets midnight, the rest
    becomes the epoch."""
    size = F.length(text)
    return (
        F.when(size == 14, text)
        .when(size == 8, F.concat(text, F.lit("000000")))
        .otherwise(F.lit(EPOCH_DAY_TEXT))
    )
