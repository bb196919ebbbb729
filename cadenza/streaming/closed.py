"""Sliding windows of event time, made of closed buckets.

A stream's state holds one row per slide-wide bucket and key, however many windows a bucket lies in.
A bucket comes out once, when the watermark has passed it, and the micro-batch makes the windows
that have closed. Buckets that open windows still need are kept as files. A window's counts change
only where a bucket enters or leaves it, or a user's last visit before it does, so a bucket sends
three changes instead of a row per window, and running sums over them give the counts. The sums
start anew every ``STRETCH`` windows, so that a key's history is spread over tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.sources.versions import Files
from cadenza.streaming.counts import check_span, seconds

Emit = Callable[[DataFrame, int], None]
STRETCH = 64  # windows' lengths of a key that one running sum goes over


@dataclass(frozen=True)
class Counted:
    """What is counted per window: messages per ``key`` as ``rows``, and the distinct values of
    ``user`` as ``users``, a missing one not among them."""

    key: str
    rows: str
    user: str | None = None
    users: str | None = None

    def keys(self) -> list[str]:
        return [self.key] + ([self.user] if self.user else [])

    def columns(self) -> list[str]:
        return [self.key, self.rows] + ([self.users] if self.users else [])

    def stored(self) -> str:
        """The schema of kept buckets."""
        return ", ".join(["at bigint", *[f"{key} string" for key in self.keys()], "n bigint"])

    def empty(self, spark: SparkSession) -> DataFrame:
        numbers = "".join(f", {name} bigint" for name in self.columns()[1:])
        bounds = "window_start timestamp, window_end timestamp"
        return spark.createDataFrame([], f"{bounds}, {self.key} string{numbers}")


VIEWS = Counted("mid", "pv")
VISITORS = Counted("mid", "pv", "uid", "uv")
SONGS = Counted("songname", "times")


def buckets(
    messages: DataFrame, counted: Counted, window: str, slide: str, delay: str
) -> DataFrame:
    """``at, key, user, n`` of the buckets that close, and rows without a key at the last bucket of
    each message's last window: windows go on closing when no message follows.

    Those rows are later than their messages by a fixed span, which the delay makes up for.
    """
    check_span(window, slide)
    span = seconds(window) - seconds(slide)
    none = [F.lit(None).cast("string").alias(key) for key in counted.keys()]
    ending = F.struct((F.col("ts") + F.expr(f"INTERVAL {span} SECONDS")).alias("ts"), *none)
    rows = messages.where(F.col(counted.key).isNotNull()).select(
        F.inline(F.array(F.struct("ts", *counted.keys()), ending))
    )
    closed = rows.withWatermark("ts", f"{delay} {span} seconds").groupBy(
        F.window("ts", slide), *counted.keys()
    )
    return closed.agg(F.count("*").alias("n")).select(
        F.unix_seconds("window.start").alias("at"), *counted.keys(), "n"
    )


def windows(
    closed: DataFrame, counted: Counted, window: str, slide: str, after: int | None, upto: int
) -> DataFrame:
    """The counts of the windows that end later than second ``after`` and by ``upto``.

    Visits are compared with the same user's last ones before, spread by user; a key's changes are
    summed before they meet, so a busy key has one row per slide. A bucket whose windows start in
    two stretches leaves the one and enters the other where they touch.
    """
    length, step = seconds(window), seconds(slide)
    stretch = F.lit(STRETCH * length).cast("bigint")
    past = F.lit(upto - length + step)  # the first start that is not asked for
    start = F.col("at") - (length - step)
    if after is not None:
        start = F.greatest(start, F.lit(after - length + step))
        closed = closed.where(F.col("at") > after - length)
    found = closed.where(F.col("at") - (length - step) < past).withColumn("start", start)
    end = F.least(F.col("at") + step, past)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    users = again = zero

    def stretch_of(point):
        return point - F.pmod(point, stretch)

    def change(part, point, rows, seen):
        return F.struct(
            part.alias("part"), point.alias("point"), rows.alias("rows"), seen.alias("users")
        )

    # The windows' starts from the first to the one before ``end``: one stretch, or two.
    enters, leaves = stretch_of(F.col("start")), stretch_of(end - 1)
    changes = []
    if counted.user:
        before = Window.partitionBy(*counted.keys()).orderBy("at")
        found = found.withColumn("last", F.lag("at").over(before))
        first = F.least(F.greatest("start", F.coalesce(F.col("last") + step, "start")), past)
        users = F.when(F.col(counted.user).isNotNull(), one).otherwise(zero)
        again = F.when(first < leaves, users).otherwise(zero)
        changes = [change(F.least(stretch_of(first), leaves), first, zero, users)]
    n = F.col("n")
    changes += [change(enters, F.col("start"), n, zero), change(leaves, end, -n, -users)]
    touching = [change(enters, leaves, -n, -again), change(leaves, leaves, n, again)]
    every = F.when(enters < leaves, F.array(*changes, *touching)).otherwise(F.array(*changes))
    summed = (
        found.select(counted.key, F.inline(every))
        .groupBy(counted.key, "part", "point")
        .agg(F.sum("rows").alias("rows"), F.sum("users").alias("users"))
    )
    order = Window.partitionBy(counted.key, "part").orderBy("point")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = summed.select(
        counted.key,
        "point",
        F.lead("point").over(order).alias("next"),
        F.sum("rows").over(running).alias("rows"),
        F.sum("users").over(running).alias("users"),
    ).where("rows > 0")
    starts = F.sequence("point", F.col("next") - step, F.lit(step).cast("bigint"))
    each = held.select(F.explode(starts).alias("start"), counted.key, "rows", "users")
    return each.select(
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + length).alias("window_end"),
        counted.key,
        F.col("rows").alias(counted.rows),
        *([F.col("users").alias(counted.users)] if counted.users else []),
    )


@dataclass
class Held:
    """What the store holds after a batch: the end of the last window given out, and the folders
    of buckets with their last bucket."""

    upto: int | None = None
    parts: list[tuple[str, int]] = field(default_factory=list)

    def folders(self) -> set[str]:
        return {folder for folder, _ in self.parts}


class ClosedWindows:
    """foreachBatch function that gives ``emit`` the windows a micro-batch has closed. A batch that
    is repeated starts from what the one before it had left, which stays until the next one
    has begun. The windows are made in ``spark``, whose shuffles may differ from the state's."""

    def __init__(
        self, spark: SparkSession, store: str, counted: Counted, window: str, slide: str, emit: Emit
    ):
        self.spark, self.store, self.counted, self.emit = spark, store, counted, emit
        self.window, self.slide = window, slide

    def _index(self, batch_id: int) -> str:
        return f"{self.store}/index/{batch_id:012d}.json"

    def _held(self, files: Files, batch_id: int) -> Held:
        if batch_id < 0 or not files.exists(self._index(batch_id)):
            return Held()
        kept = json.loads(files.text(self._index(batch_id)))
        return Held(kept["upto"], [tuple(part) for part in kept["parts"]])

    def _store(self, batch: DataFrame, folder: str) -> tuple[int | None, int | None]:
        """Keep the batch's buckets of messages; the end of its last bucket, and their last."""
        seen, bucket = Observation(), F.col(self.counted.key).isNotNull()
        upto = F.max(F.col("at") + seconds(self.slide)).alias("upto")
        last = F.max(F.when(bucket, F.col("at"))).alias("last")
        rows = batch.observe(seen, upto, last).where(bucket)
        rows.write.mode("overwrite").parquet(f"{self.store}/{folder}")
        return seen.get["upto"], seen.get["last"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        files, folder = Files(self.spark, self.store), f"closed-{batch_id}"
        before = self._held(files, batch_id - 1)
        upto, last = self._store(batch, folder)
        parts = before.parts + ([(folder, last)] if last is not None else [])
        rows = self.counted.empty(self.spark)
        if upto is not None and parts:
            paths = [f"{self.store}/{part}" for part, _ in parts]
            closed = self.spark.read.schema(self.counted.stored()).parquet(*paths)
            rows = windows(closed, self.counted, self.window, self.slide, before.upto, upto)
        self.emit(rows, batch_id)
        done = before.upto if upto is None else upto
        if done is not None:
            parts = [part for part in parts if part[1] > done - seconds(self.window)]
        held = Held(done, parts)
        files.remove(self._index(batch_id))
        files.create(self._index(batch_id), json.dumps(vars(held)))
        older = self._held(files, batch_id - 2)
        unused = older.folders() - before.folders() - held.folders()
        unused |= {folder} - held.folders()
        for name in unused:
            files.remove(f"{self.store}/{name}")
        files.remove(self._index(batch_id - 2))


def start(
    messages: DataFrame,
    counted: Counted,
    emit: Emit,
    folder: str,
    window: str,
    slide: str,
    delay: str,
    spark: SparkSession | None = None,
    **trigger,
) -> StreamingQuery:
    """Give ``emit`` each window once, complete, after the watermark has passed its end. Progress
    and kept buckets live in ``folder``, one per query; ``spark`` makes the windows, by default
    the messages' own session."""
    spark = spark or messages.sparkSession
    handle = ClosedWindows(spark, f"{folder}/windows", counted, window, slide, emit)
    return (
        buckets(messages, counted, window, slide, delay)
        .writeStream.outputMode("append")
        .foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(**trigger)
        .start()
    )
