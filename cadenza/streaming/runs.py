"""Starting the streams and writing what they emit."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cadenza.sinks.jdbc import replace_table
from cadenza.streaming import closed, counts

Write = Callable[[DataFrame], None]
Shape = Callable[[DataFrame], DataFrame]

# Triggers and result tables.
VISITOR_TRIGGER = "5 seconds"
SONG_TRIGGER = "20 seconds"
BEAT = "\x00beat"
PV_TABLE, UV_TABLE, SONG_TABLE = "tw_pv", "tw_uv", "hotsong"


def jdbc_writer(url: str, table: str, properties: dict[str, str] | None = None) -> Write:
    return lambda df: replace_table(df, url, table, properties)


def latest_window(batch: DataFrame) -> DataFrame:
    """Rows of the last window in a micro-batch."""
    last = batch.agg(F.max("window_end")).first()[0]
    return batch.where(F.col("window_end") == F.lit(last))


def replace_with_latest(write: Write, shape: Shape):
    """foreachBatch function: give ``write`` the last window, shaped; skip empty batches,
    so the table keeps the last window that had rows. Rows of the heartbeat are left out."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        for key in ("mid", "songname"):
            if key in batch.columns:
                batch = batch.where(F.col(key) != BEAT)
        batch.persist()
        try:
            if not batch.isEmpty():
                write(shape(latest_window(batch)))
        finally:
            batch.unpersist()

    return handle


def with_heartbeat(messages: DataFrame, muted: bool = False, marked: bool = True) -> DataFrame:
    """The messages and a second source with one row a micro-batch, stamped with its time.

    Marked rows move the watermark on when traffic stops, so that the last windows come out; blank
    ones only keep batches coming. The source is always there, so a checkpoint fits a restart
    with or without ``muted``, which drops its rows: a backlog older than the delay would
    count as late beside them.
    """
    source = messages.sparkSession.readStream.format("rate-micro-batch")
    beats = source.options(rowsPerBatch="1", numPartitions="1").load()
    # The source counts from 0.
    beats = beats.where(F.col("value") >= (F.lit((1 << 63) - 1) if muted else F.lit(0)))
    mark = F.lit(BEAT) if marked else F.lit(None).cast("string")
    names = [mark.alias(name) for name in ("mid", "uid", "songid", "songname")]
    return messages.unionByName(beats.select(F.current_timestamp().alias("ts"), *names))


def _start(rows: DataFrame, handle, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Progress and state live in ``checkpoint``; give each query its own."""
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_visitors(
    messages: DataFrame,
    write_views: Write,
    write_users: Write,
    checkpoint: str,
    delay: str,
    window: str = counts.WINDOW,
    slide: str = counts.VISITOR_SLIDE,
    **trigger,
) -> StreamingQuery:
    """Keep two tables, mid, pv and mid, uv, at the last complete window, from one state."""

    def write(df: DataFrame) -> None:
        write_views(df.select("mid", "pv"))
        write_users(df.select("mid", "uv"))

    trigger = trigger or {"processingTime": VISITOR_TRIGGER}
    handle = replace_with_latest(write, lambda df: df)
    return closed.start(
        messages, closed.VISITORS, handle, checkpoint, window, slide, delay, **trigger
    )


def start_hot_songs(
    messages: DataFrame,
    write: Write,
    checkpoint: str,
    delay: str,
    window: str = counts.WINDOW,
    slide: str = counts.SONG_SLIDE,
    top: int = counts.TOP_SONGS,
    **trigger,
) -> StreamingQuery:
    """Keep ``write``'s table at songname, times, rank of the last complete window."""

    def shape(df: DataFrame) -> DataFrame:
        return counts.hot_songs(df, top).select("songname", "times", "rank")

    trigger = trigger or {"processingTime": SONG_TRIGGER}
    handle = replace_with_latest(write, shape)
    return closed.start(messages, closed.SONGS, handle, checkpoint, window, slide, delay, **trigger)


def late_rows(progress) -> int:
    """Rows that came after their window had been given out, in one progress report.

    Counted after partial aggregation, so it is 0 exactly when no message was dropped.
    """
    report = json.loads(progress.json)
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in report["stateOperators"])


class LateReport(StreamingQueryListener):
    """Tells ``say`` of every micro-batch that dropped late rows, and keeps the total."""

    def __init__(self, say: Callable[[str], None] = print):
        self.say, self.total = say, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = late_rows(event.progress)
        if late:
            self.total += late
            self.say(f"batch {event.progress.batchId}: {late} rows later than the delay")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _to_files(path: str, shape: Shape | None) -> Callable[[DataFrame, int], None]:
    """Each micro-batch owns one folder and replaces it when it is repeated, so a retry adds
    nothing twice."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        shaped = shape(batch) if shape else batch
        shaped.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return handle


def replay_to_files(
    rows: DataFrame, path: str, checkpoint: str, shape: Shape | None = None
) -> str:
    """Run a stream over all input present and keep every row it emits, as Parquet."""
    _start(rows, _to_files(path, shape), checkpoint, {"availableNow": True}).awaitTermination()
    return path


def replay_windows(
    messages: DataFrame,
    counted: closed.Counted,
    path: str,
    checkpoint: str,
    window: str,
    slide: str,
    delay: str,
    shape: Shape | None = None,
    spark: SparkSession | None = None,
) -> str:
    """Run a stream over all input present and keep every closed window, as Parquet."""
    closed.start(
        messages, counted, _to_files(path, shape), checkpoint, window, slide, delay, spark,
        availableNow=True,
    ).awaitTermination()
    return path
