"""Windows by the time at which messages are read: nothing can be late.

Each micro-batch stores its counts as a pane and brings a running total up to date: the last total,
plus the new pane, less the panes that have left the window. So a batch reads the last total and
the few panes that leave, however many panes the window holds, and every pane is read twice in
its life. Counts are whole numbers, so nothing drifts. A heartbeat keeps batches coming when
traffic stops, so the table empties in time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.operators.ranking import top_n
from cadenza.sources.versions import Files
from cadenza.streaming.counts import TOP_SONGS, WINDOW, seconds

Write = Callable[[DataFrame], None]
Clock = Callable[[int], datetime]

KEYS = ("mid", "uid", "songname")
_STORED = "mid string, uid string, songname string, n bigint"


def now(_batch_id: int) -> datetime:
    return datetime.now(timezone.utc)


def visitors(window: DataFrame) -> DataFrame:
    """mid, pv, uv of the running window: users first, so a busy machine is spread."""
    users = window.where("mid is not null").groupBy("mid", "uid").agg(F.sum("n").alias("n"))
    return users.groupBy("mid").agg(F.sum("n").alias("pv"), F.count("uid").alias("uv"))


def songs(window: DataFrame, top: int = TOP_SONGS) -> DataFrame:
    """songname, times, rank of the running window."""
    counts = window.where("songname is not null").groupBy("songname").agg(F.sum("n").alias("times"))
    ranked = top_n(
        counts.withColumn("_all", F.lit(1)), top, ["_all"], [F.desc("times"), F.asc("songname")]
    )
    return ranked.drop("_all")


@dataclass
class Held:
    """What the store holds after a batch: the second it was read, the folder of the running
    total, and the panes inside the window as (folder, second)."""

    at: float = float("-inf")
    total: str | None = None
    panes: list[tuple[str, float]] = field(default_factory=list)

    def folders(self) -> set[str]:
        return {folder for folder, _ in self.panes} | ({self.total} - {None})


class RunningWindow:
    """foreachBatch function. A batch that is repeated starts from what the one before it had
    left, which stays until the next one has begun. ``read`` counts the folders it read."""

    def __init__(self, store: str, keys: tuple[str, ...], window: str, write: Write, clock: Clock):
        self.store, self.keys, self.write, self.clock = store, keys, write, clock
        self.length = timedelta(seconds=seconds(window)).total_seconds()
        self.read = 0

    def _index(self, batch_id: int) -> str:
        return f"{self.store}/index/{batch_id:012d}.json"

    def _held(self, files: Files, batch_id: int) -> Held:
        if batch_id < 0 or not files.exists(self._index(batch_id)):
            return Held()
        kept = json.loads(files.text(self._index(batch_id)))
        return Held(kept["at"], kept["total"], [tuple(pane) for pane in kept["panes"]])

    def _pane(self, batch: DataFrame, folder: str) -> int:
        """Store the batch's counts; the number of rows."""
        kept = [F.col(key) if key in self.keys else F.lit(None).cast("string").alias(key)
                for key in KEYS]
        counts = batch.where(F.col(self.keys[0]).isNotNull()).select(*kept)
        counts = counts.groupBy(*KEYS).agg(F.count("*").alias("n"))
        written = Observation()
        counted = counts.observe(written, F.count("*").alias("rows")).hint("rebalance")
        counted.write.mode("overwrite").parquet(f"{self.store}/{folder}")
        return written.get["rows"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = Files(spark, self.store)
        last = self._held(files, batch_id - 1)
        at = max(self.clock(batch_id).timestamp(), last.at)
        rows = self._pane(batch, f"pane-{batch_id}")
        live = [pane for pane in last.panes if pane[1] > at - self.length]
        gone = [pane for pane in last.panes if pane not in live]
        if rows:
            live.append((f"pane-{batch_id}", at))

        def stored(folder: str, sign: int) -> DataFrame:
            found = spark.read.schema(_STORED).parquet(f"{self.store}/{folder}")
            return found.withColumn("n", F.col("n") * sign)

        parts = [(last.total, 1)] if last.total else []
        parts += [(folder, -1) for folder, _ in gone]
        parts += [(f"pane-{batch_id}", 1)] if rows else []
        self.read, total = len(parts), last.total
        if rows or gone:
            every = reduce(DataFrame.unionByName, [stored(*part) for part in parts])
            sums = every.groupBy(*KEYS).agg(F.sum("n").alias("n")).where("n > 0")
            total = f"total-{batch_id}"
            sums.hint("rebalance").write.mode("overwrite").parquet(f"{self.store}/{total}")
        shown = spark.createDataFrame([], _STORED) if total is None else stored(total, 1)
        self.write(shown)
        held = Held(at, total, live)
        files.remove(self._index(batch_id))
        files.create(self._index(batch_id), json.dumps(vars(held)))
        before = self._held(files, batch_id - 2)
        unused = before.folders() - last.folders() - held.folders()
        unused |= {f"pane-{batch_id}"} if not rows else set()
        for folder in unused:
            files.remove(f"{self.store}/{folder}")
        files.remove(self._index(batch_id - 2))


def start(
    messages: DataFrame,
    keys: tuple[str, ...],
    write: Write,
    folder: str,
    window: str = WINDOW,
    clock: Clock = now,
    **trigger,
) -> StreamingQuery:
    """Give ``write`` the rows of the running window after every micro-batch of the messages
    (and their heartbeat, whose rows have no keys). Progress and the window's panes live in
    ``folder``, one per query."""
    handle = RunningWindow(f"{folder}/window", keys, window, write, clock)
    return (
        messages.select(*KEYS)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(**trigger)
        .start()
    )
