"""Sliding-window counts; the same functions serve streams and static tables.

Windows run on event time. Messages are counted per slide-wide bucket first, and only the
buckets' counts are spread over the windows, so a stream's first state and shuffle hold one row
per bucket and key. Streams use append mode: a window comes out once, complete, after the
watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.ranking import top_n

# Fixed values.
WINDOW = "60 seconds"
VISITOR_SLIDE = "5 seconds"
SONG_SLIDE = "20 seconds"
TOP_SONGS = 30

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(span: str) -> int:
    """The length of a span such as ``60 seconds`` or ``6 hours``."""
    number, unit = span.split()
    return int(number) * _SECONDS[unit.lower().rstrip("s")]


def check_span(window: str, slide: str) -> None:
    if seconds(window) % seconds(slide):
        raise ValueError("a window must be a whole number of slides")


def _buckets(messages: DataFrame, slide: str, window: str, delay: str | None, *keys: str):
    """Messages per bucket of one slide and ``keys``."""
    check_span(window, slide)
    if messages.isStreaming:
        if delay is None:
            raise ValueError("a stream on event time needs the delay of its messages")
        messages = messages.withWatermark("ts", delay)
    return (
        messages.where(F.col(keys[0]).isNotNull())
        .groupBy(F.window("ts", slide), *keys)
        .agg(F.count("*").alias("n"))
    )


def _spread(buckets: DataFrame, slide: str, window: str, *keys: str) -> DataFrame:
    """The buckets' counts summed over every window they lie in."""
    windows = F.window(F.window_time("window"), window, slide)
    return buckets.groupBy(windows, *keys).agg(F.sum("n").alias("n"))


def _with_bounds(counts: DataFrame, *columns) -> DataFrame:
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *columns,
    )


def page_views(
    messages: DataFrame,
    window: str = WINDOW,
    slide: str = VISITOR_SLIDE,
    delay: str | None = None,
) -> DataFrame:
    """Messages per machine and window. Partial counts precede the shuffle, so a busy
    machine sends one row per task and bucket."""
    counts = _spread(_buckets(messages, slide, window, delay, "mid"), slide, window, "mid")
    return _with_bounds(counts, "mid", F.col("n").alias("pv"))


def visitors(
    messages: DataFrame,
    window: str = WINDOW,
    slide: str = VISITOR_SLIDE,
    delay: str | None = None,
) -> DataFrame:
    """Messages and exact distinct users per machine and window, from one state; a missing
    user is not counted as a user.

    Chained groupings: state is one small row per (bucket or window, machine, user), spread
    by user, never a growing set per machine.
    """
    buckets = _buckets(messages, slide, window, delay, "mid", "uid")
    visits = _spread(buckets, slide, window, "mid", "uid")
    counts = visits.groupBy("window", "mid").agg(
        F.sum("n").alias("pv"), F.count("uid").alias("uv")
    )
    return _with_bounds(counts, "mid", "pv", "uv")


def unique_users(
    messages: DataFrame,
    window: str = WINDOW,
    slide: str = VISITOR_SLIDE,
    delay: str | None = None,
) -> DataFrame:
    """The users of ``visitors``."""
    return visitors(messages, window, slide, delay).drop("pv")


def song_counts(
    messages: DataFrame,
    window: str = WINDOW,
    slide: str = SONG_SLIDE,
    delay: str | None = None,
) -> DataFrame:
    """Plays per song name and window."""
    buckets = _buckets(messages, slide, window, delay, "songname")
    counts = _spread(buckets, slide, window, "songname")
    return _with_bounds(counts, "songname", F.col("n").alias("times"))


def hot_songs(counts: DataFrame, top: int = TOP_SONGS) -> DataFrame:
    """The ``top`` songs of each window; equal counts rank by name.

    For a static table or one micro-batch, in which a window's counts are all present.
    """
    return top_n(
        counts, top, ["window_start", "window_end"], [F.desc("times"), F.asc("songname")]
    )
