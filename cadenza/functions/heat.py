"""Heat index of a song or singer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the index.
VOLUME_WEIGHT = 0.63
PEAK_WEIGHT = 0.37
PLAY_WEIGHT = 0.8
LIKE_WEIGHT = 0.2
SCALE = 10


def _damped(value: Column) -> Column:
    return F.log(value + 1)


def heat_index(
    plays: Column,
    likes: Column,
    days: int = 1,
    peak_plays: Column | None = None,
    peak_likes: Column | None = None,
) -> Column:
    """Squared blend of log daily volume and, when given, log daily peak."""

    def strength(total: Column, peak: Column | None) -> Column:
        volume = _damped(total / days) * VOLUME_WEIGHT
        return volume if peak is None else volume + _damped(peak) * PEAK_WEIGHT

    blend = strength(plays, peak_plays) * PLAY_WEIGHT + strength(likes, peak_likes) * LIKE_WEIGHT
    return F.pow(blend, F.lit(2)) * SCALE
