"""Streams against the batch form of the same counts, restarts, and result tables."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cadenza import live
from cadenza.sources import messages
from cadenza.streaming import arrivals, counts, runs

START = datetime(2024, 1, 1)
LOG = "value string, timestamp timestamp"


def message(seconds, mid, uid, song):
    body = {k: v for k, v in (("mid", mid), ("uid", uid), ("songname", song)) if v is not None}
    return json.dumps(body), START + timedelta(seconds=seconds)


def sample(n=400):
    """Machine 'hot' sends most messages; some fields are missing."""
    found = []
    for i in range(n):
        mid = "hot" if i % 4 else (f"m{i % 3}" if i % 5 else None)
        found.append(message(i * 1.7, mid, None if i % 9 == 0 else f"u{i % 23}", f"s{i * i % 41}"))
    return [*found, ("not json", START)]


END = message(100_000, "end", "end", "end")


def write(spark, rows, path):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


STREAMS = {
    "pv": (counts.page_views, None),
    "uv": (counts.unique_users, None),
    "songs": (counts.song_counts, counts.hot_songs),
}


@pytest.mark.parametrize("name", list(STREAMS))
def test_stream_equals_batch_across_a_restart(spark, tmp_path, name):
    build, shape = STREAMS[name]
    log, out, progress = (str(tmp_path / part) for part in ("log", "out", "progress"))
    rows, parts = sample(), []
    for start in (0, 200):
        write(spark, rows[start : start + 200] + rows[400:] * (start > 0), log)
        stream = build(messages.parse(messages.from_files(spark, log)), delay="1 hour")
        runs.replay_to_files(stream, out, progress, shape)
        parts.append(spark.read.parquet(out).count())
    write(spark, [END], log)
    stream = build(messages.parse(messages.from_files(spark, log)), delay="1 hour")
    runs.replay_to_files(stream, out, progress, shape)
    static = build(messages.parse(spark.createDataFrame(rows, LOG)))
    wanted = collected(shape(static) if shape else static)
    assert parts[0] == 0  # nothing comes out before the watermark passes
    assert collected(spark.read.parquet(out).drop("batch")) == wanted


def test_batch_counts_match_brute_force(spark):
    rows = sample()
    parsed = messages.parse(spark.createDataFrame(rows, LOG))
    pv = {(r.window_start, r.mid): r.pv for r in counts.page_views(parsed).collect()}
    uv = {(r.window_start, r.mid): r.uv for r in counts.unique_users(parsed).collect()}
    wanted_pv, wanted_uv = {}, {}
    for body, ts in rows[:-1]:
        fields = json.loads(body)
        if "mid" not in fields:
            continue
        last = START + timedelta(seconds=int((ts - START).total_seconds() // 5 * 5))
        for step in range(12):
            key = (last - timedelta(seconds=5 * step), fields["mid"])
            wanted_pv[key] = wanted_pv.get(key, 0) + 1
            wanted_uv.setdefault(key, set()).add(fields.get("uid"))
    assert pv == wanted_pv
    assert uv == {key: len(users - {None}) for key, users in wanted_uv.items()}


def test_hot_songs_are_ranked_per_window(spark):
    parsed = messages.parse(spark.createDataFrame(sample(), LOG))
    found = counts.hot_songs(counts.song_counts(parsed), top=3).collect()
    windows = {}
    for row in found:
        windows.setdefault(row.window_start, []).append((row["rank"], -row.times, row.songname))
    for ranked in windows.values():
        ranked.sort()
        assert [r for r, _, _ in ranked] == list(range(1, len(ranked) + 1))
        assert [r[1:] for r in ranked] == sorted(r[1:] for r in ranked)


def test_result_tables_hold_the_last_window(spark, tmp_path):
    log = str(tmp_path / "log")
    write(spark, [*sample()[:-1], END], log)
    tables = {}

    def writer_for(table):
        return lambda df: tables.__setitem__(table, (df.columns, df.collect()))

    for stream in ("visitors", "songs"):
        source = messages.from_files(spark, log)
        started = live.start(
            spark, stream, source, str(tmp_path / stream), writer_for, "10 minutes",
            availableNow=True,
        )
        for query in started:
            query.awaitTermination()
    parsed = messages.parse(spark.createDataFrame(sample()[:-1], LOG))

    def last(df):
        return df.where(F.col("window_end") == df.agg(F.max("window_end")).first()[0])

    assert tables["tw_pv"][0] == ["mid", "pv"] and tables["tw_uv"][0] == ["mid", "uv"]
    pv, uv = last(counts.page_views(parsed)), last(counts.unique_users(parsed))
    assert sorted(tables["tw_pv"][1]) == collected(pv.select("mid", "pv"))
    assert sorted(tables["tw_uv"][1]) == collected(uv.select("mid", "uv"))
    hot = counts.hot_songs(last(counts.song_counts(parsed))).select("songname", "times", "rank")
    assert tables["hotsong"][0] == ["songname", "times", "rank"]
    assert sorted(tables["hotsong"][1], key=str) == collected(hot)


def test_late_messages_are_counted_or_reported(spark, tmp_path):
    """Forty messages older than the delay, in a batch after newer ones have closed windows."""
    log, first = str(tmp_path / "log"), [message(5000 + i, "m", f"u{i}", "s") for i in range(60)]
    late = [message(i, "late", f"u{i}", "s") for i in range(40)]
    second = [message(6000 + i, "m", f"u{i}", "s") for i in range(60)]
    for rows in (first, second, late):
        write(spark, rows, log)
    tables = {}

    def writer_for(table):
        return lambda df: tables.__setitem__(table, collected(df))

    def run(name, **how):
        source = messages.from_files(spark, log, maxFilesPerTrigger="1")
        for query in live.start(spark, "visitors", source, str(tmp_path / name), writer_for,
                                availableNow=True, **how):
            query.awaitTermination()
            return [runs.late_rows(p) for p in query.recentProgress]

    run("arrival")
    assert tables["tw_pv"] == [("late", 40), ("m", 120)]
    assert tables["tw_uv"] == [("late", 40), ("m", 60)]
    assert sum(run("event", delay="10 seconds")) > 0
    tables.clear()
    assert sum(run("patient", delay="2 hours")) == 0
    with pytest.raises(ValueError, match="delay"):
        counts.page_views(messages.parse(messages.from_files(spark, log)))


def test_arrival_window_moves_on_and_forgets(spark, tmp_path):
    log, shown = str(tmp_path / "log"), []
    for k in range(4):
        write(spark, [message(0, f"m{k}", "u", f"s{k}")], log)

    def show(rows):
        shown.append((collected(arrivals.visitors(rows)), collected(arrivals.songs(rows, 1))))

    source = messages.parse(messages.from_files(spark, log, maxFilesPerTrigger="1"))
    place = str(tmp_path / "place")
    arrivals.start(
        source, ("mid", "uid"), show, place, "60 seconds", availableNow=True,
        clock=lambda n: START + timedelta(seconds=40 * n),
    ).awaitTermination()
    assert [[row[0] for row in visitors] for visitors, _ in shown] == [
        ["m0"], ["m0", "m1"], ["m1", "m2"], ["m2", "m3"]
    ]
    assert all(songs == [] for _, songs in shown)  # the store keeps the asked keys only
    held = {p.name for p in (tmp_path / "place" / "window").iterdir() if p.is_dir()}
    # What the last two batches hold, and what the last but one had let go.
    assert held == {"index", "pane-1", "pane-2", "pane-3", "total-2", "total-3"}


def arrival_rows(spark, n):
    return spark.createDataFrame(
        [(f"m{n % 3}", f"u{n % 5}", None), ("hot", f"u{n % 7}", None), (None, "u", None)],
        "mid string, uid string, songname string",
    )


@pytest.mark.parametrize("slide", [1, 5])
def test_a_trigger_reads_few_panes_whatever_the_window_holds(spark, tmp_path, slide):
    """Twenty and four panes in the window; every tenth batch is repeated, every ninth empty."""
    shown, read, n = [], [], 28 if slide == 1 else 12
    handle = arrivals.RunningWindow(
        str(tmp_path / "w"), ("mid", "uid"), "20 seconds",
        lambda rows: shown.append(collected(rows.select("mid", "uid", "n"))),
        lambda k: START + timedelta(seconds=slide * k),
    )
    for k in range(n):
        batch = arrival_rows(spark, k)
        batch = batch.limit(0) if k % 9 == 8 else batch
        for _ in range(2 if k % 10 == 0 else 1):
            handle(batch, k)
        read.append(handle.read)
    assert max(read) <= 3
    for k in (0, 8, n // 2, n - 1):
        seen = {}
        for j in range(max(0, k - 20 // slide + 1), k + 1):
            if j % 9 != 8:
                for key in ((f"m{j % 3}", f"u{j % 5}"), ("hot", f"u{j % 7}")):
                    seen[key] = seen.get(key, 0) + 1
        at = k + sum(1 for j in range(k + 1) if j % 10 == 0)
        assert shown[at] == sorted((*key, m) for key, m in seen.items())
    stored = [p for p in (tmp_path / "w").iterdir() if p.is_dir()]
    assert len(stored) <= 20 // slide + 5


def test_timed_triggers_show_the_window_every_interval(spark, tmp_path):
    log, shown = str(tmp_path / "log"), []
    write(spark, [message(0, "m", f"u{i}", f"s{i % 3}") for i in range(9)], log)

    def writer_for(table):
        return lambda df: shown.append((time.time(), table, collected(df)))

    source = messages.from_files(spark, log)
    (query,) = live.start(
        spark, "songs", source, str(tmp_path / "p"), writer_for, beats=True, window="4 seconds",
        processingTime="2 seconds",
    )
    try:
        end = time.time() + 120
        while len(shown) < 5 and time.time() < end and query.isActive:
            time.sleep(0.2)
    finally:
        query.stop()
    assert query.exception() is None and len(shown) >= 5
    assert {table for _, table, _ in shown} == {"hotsong"}
    assert [rows for _, _, rows in shown][0] == [("s0", 3, 1), ("s1", 3, 2), ("s2", 3, 3)]
    assert shown[-1][2] == []  # the heartbeat goes on, and the messages have left the window
    apart = [b[0] - a[0] for a, b in zip(shown[1:], shown[2:], strict=False)]
    assert min(apart) > 0.5


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_a_stream_goes_on_live_after_its_backlog(spark, tmp_path, delay):
    """The same checkpoint, with the heartbeat muted and then not."""
    log, tables = str(tmp_path / "log"), {}
    write(spark, sample()[:-1], log)

    def writer_for(table):
        return lambda df: tables.__setitem__(table, collected(df))

    def run(beats):
        source = messages.from_files(spark, log)
        (query,) = live.start(spark, "visitors", source, str(tmp_path / "p"), writer_for, delay,
                              beats=beats, availableNow=True)
        query.awaitTermination()

    run(False)
    before = dict(tables)
    run(True)
    if delay is None:
        assert before and tables["tw_pv"]
    else:  # only the heartbeat closes the last window
        parsed = messages.parse(spark.createDataFrame(sample()[:-1], LOG))
        views = counts.page_views(parsed)
        last = views.where(F.col("window_end") == views.agg(F.max("window_end")).first()[0])
        assert tables["tw_pv"] == collected(last.select("mid", "pv"))


def test_buckets_are_counted_before_they_are_spread(spark):
    rows = messages.parse(spark.createDataFrame(sample(20), LOG))
    for build in (counts.page_views, counts.visitors, counts.song_counts):
        plan = build(rows)._jdf.queryExecution().optimizedPlan().toString()
        spread = plan.index("Expand") if "Expand" in plan else plan.index("Generate")
        assert "Aggregate" in plan[:spread] and "Aggregate" in plan[spread:]
    with pytest.raises(ValueError, match="slides"):
        counts.page_views(rows, "60 seconds", "7 seconds")


def test_start_positions():
    first = messages.kafka_options("h:1")
    assert first == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "userlog", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(messages.RATE),
    }
    given = messages.kafka_options("h:1", "t", {2: 0, 1: 7}, rate=None)
    assert json.loads(given["startingOffsets"]) == {"t": {"1": 7, "2": 0}}
    # A subscription with positions for some partitions only is refused by the source.
    assert given["subscribe"] == "t" and "assign" not in given
    assert "maxOffsetsPerTrigger" not in given
