"""Windows made of closed buckets: state, restarts, repeats, and what stays stored."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from cadenza.checks import queries as catalog
from cadenza.sources import messages, samples
from cadenza.streaming import closed, counts, runs
from test_streaming import END, LOG, collected, message, write

FOLDER = "/root/testdata/sf0.001"


class StateWrites(StreamingQueryListener):
    """State rows written by the queries of a session."""

    def __init__(self):
        self.rows, self.running = 0, True

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows += sum(op.numRowsUpdated for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.running = False


@pytest.mark.parametrize("name", ["stream_uv", "stream_uv_wide", "stream_last_window", "stream_pv"])
def test_state_has_no_row_per_window(spark, monkeypatch, name):
    """Twelve windows a message: its bucket and its last window's end are all that is kept."""
    seen, make = StateWrites(), catalog._stream_session

    def session(spark):
        made = make(spark)
        made.streams.addListener(seen)
        return made

    monkeypatch.setattr(catalog, "_stream_session", session)
    assert catalog.QUERIES[name](spark, FOLDER).count() > 0
    # Events of a listener come on their way, in order.
    for _ in range(600):
        if not seen.running:
            break
        spark.sparkContext._jvm.Thread.sleep(100)
    total = samples.messages(spark, FOLDER).count()
    assert not seen.running and 0 < seen.rows <= 2 * (total + 1)


def visits(n=300):
    """Users who come back within a window, after one, and after a long time; busy buckets."""
    found = []
    for i in range(n):
        at = i * 2.3 + (i // 60) * 200
        user = None if i % 11 == 0 else f"u{i * i % 7}"
        found.append(message(at, "hot" if i % 3 else f"m{i % 4}", user, f"s{i % 5}"))
        if i % 10 == 0:
            found.append(message(at, None, "u1", None))
    return found


WHAT = {
    "views": (closed.VIEWS, counts.page_views),
    "visitors": (closed.VISITORS, counts.visitors),
    "songs": (closed.SONGS, counts.song_counts),
}


@pytest.mark.parametrize("name", list(WHAT))
@pytest.mark.parametrize("slide", ["5 seconds", "60 seconds"])
def test_closed_windows_equal_the_batch_counts(spark, tmp_path, name, slide):
    """One file a micro-batch, a restart between the second and the third, and no message but the
    last one behind the gaps."""
    counted, static = WHAT[name]
    log, out, place = (str(tmp_path / part) for part in ("log", "out", "place"))
    rows = visits()
    groups = [rows[k : k + 70] for k in range(0, len(rows), 70)]

    def run():
        source = messages.parse(messages.from_files(spark, log, maxFilesPerTrigger="1"))
        runs.replay_windows(source, counted, out, place, "60 seconds", slide, "30 seconds")

    for k, group in enumerate([*groups, [END]]):
        write(spark, group, log)
        if k == 1:
            run()
    run()
    found = spark.read.parquet(out).drop("batch")
    wanted = static(messages.parse(spark.createDataFrame(rows, LOG)), "60 seconds", slide)
    assert found.columns == wanted.columns
    assert collected(found) == collected(wanted)
    held = {p.name for p in (tmp_path / "place" / "windows").iterdir() if p.is_dir()}
    assert len(held) <= 3  # the index, and buckets that open windows or a repeat may need


def test_a_repeated_batch_gives_the_same_windows(spark, tmp_path):
    shown = {}

    def emit(rows, batch_id):
        shown.setdefault(batch_id, []).append(collected(rows))

    handle = closed.ClosedWindows(
        spark, str(tmp_path), closed.VISITORS, "20 seconds", "5 seconds", emit
    )
    stored = closed.VISITORS.stored()
    batches = [
        [(0, "m", "u", 2), (5, "m", "v", 1), (15, None, None, 2)],
        [(20, "m", "u", 1), (20, "m", None, 4), (20, None, None, 1)],
        [],
        [(35, None, None, 1)],
    ]
    for k, rows in enumerate(batches):
        for _ in range(2):
            handle(spark.createDataFrame(rows, stored), k)
    assert all(first == again for first, again in shown.values())
    every = [(int(w.timestamp()), m, pv, uv) for k in shown for w, _, m, pv, uv in shown[k][0]]
    assert sorted(every) == [
        (-15, "m", 2, 1), (-10, "m", 3, 2), (-5, "m", 3, 2), (0, "m", 3, 2),
        (5, "m", 6, 2), (10, "m", 5, 1), (15, "m", 5, 1), (20, "m", 5, 1),
    ]
    assert shown[2][0] == []


def test_changes_are_summed_before_a_key_meets(spark):
    """A busy machine is spread over its users, and no row is made per window before that."""
    rows = spark.createDataFrame([(0, "m", "u", 1)], closed.VISITORS.stored())
    found = closed.windows(rows, closed.VISITORS, "6 hours", "30 minutes", None, 86400)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("inline")  # upper operators come first
    assert plan.count("explode(sequence(") == 1 == plan.count("inline(")
    assert "lag(" in plan


@pytest.mark.parametrize("stretch", [1, 2, 64])
@pytest.mark.parametrize("name", ["views", "visitors"])
def test_windows_across_stretches_equal_the_batch_counts(spark, monkeypatch, name, stretch):
    """Some windows given out before, some not asked for, and buckets that two stretches share."""
    monkeypatch.setattr(closed, "STRETCH", stretch)
    counted, static = WHAT[name]
    rows = messages.parse(spark.createDataFrame(visits(), LOG))
    keys = counted.keys()
    stored = rows.where("mid IS NOT NULL").groupBy(F.window("ts", "5 seconds"), *keys)
    stored = stored.agg(F.count("*").alias("n"))
    stored = stored.select(F.unix_seconds("window.start").alias("at"), *keys, "n").persist()
    wanted = static(rows, "60 seconds", "5 seconds").persist()
    ends = sorted(int(r[0]) for r in wanted.select(F.unix_seconds("window_end")).distinct().collect())
    for after, upto in [(None, ends[-1]), (ends[40], ends[150]), (ends[41], ends[41] + 5)]:
        found = closed.windows(stored, counted, "60 seconds", "5 seconds", after, upto)
        end = F.unix_seconds("window_end")
        kept = wanted.where((end > (after or 0)) & (end <= upto))
        assert collected(found) == collected(kept)


@pytest.mark.parametrize("name", ["views", "visitors", "songs"])
def test_a_key_with_a_long_history_is_spread_over_tasks(spark, name):
    """One machine's windows used to be made by one task, however long it had been seen."""
    counted = WHAT[name][0]
    columns = ["'m'"] + ["CAST(id % 7 AS STRING)"] * (len(counted.keys()) - 1)
    rows = spark.range(20000).selectExpr("id * 5 AS at", *columns, "1L AS n")
    rows = rows.toDF(*[column.split()[0] for column in counted.stored().split(", ")])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = closed.windows(rows, counted, "60 seconds", "5 seconds", None, 100000)
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [size["count"] for size in sizes]
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2
