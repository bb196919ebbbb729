"""Callables (spark, folder) -> DataFrame, one per job or operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import lru_cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import jobs
from cadenza.functions import address, catalog
from cadenza.functions.dates import normalise_time, shift_day
from cadenza.operators.snapshot import carry_forward
from cadenza.plans import client_log, machines, revenue, songs, users
from cadenza.plans import ledger as ledger_plan
from cadenza.session import STREAM_SETTINGS, scratch, scratch_path, size_of, sized_session
from cadenza.sinks.text import write_by_table
from cadenza.sources import messages, samples
from cadenza.sources.client_log import read_lines
from cadenza.sources.samples import RUN_DAY as DAY
from cadenza.sources.tables import Warehouse, on_day
from cadenza.sources.versions import Files
from cadenza.streaming import arrivals, closed, counts, runs

CATALOG = "cadenza_checks"
WIDE_WINDOW, WIDE_SLIDE = "6 hours", "30 minutes"
ARRIVAL = datetime(2024, 2, 1, tzinfo=timezone.utc)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("data_dt", F.lit(DAY))


# Tables whose size sets the number of shuffle partitions.
SIZED = ("customer", "supplier", "part", "orders", "lineitem", "events")


@lru_cache(maxsize=None)
def _session(spark: SparkSession, folder: str, _partitions: str) -> SparkSession:
    paths = [f"{folder}/{name}.parquet" for name in SIZED]
    return sized_session(spark, size_of(spark, paths))


def _sized(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
    """The query in a session with shuffles of the input's size, one per folder."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(_session(spark, folder, spark.conf.get("spark.sql.shuffle.partitions")), folder)

    return run


# Source tables by day, and what fills them.
DATED = {
    jobs.PLAYS: samples.plays,
    jobs.CONSUMPTION: samples.consumption,
    jobs.LOGINS: samples.logins,
}


@lru_cache(maxsize=None)
def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, root=scratch_path(spark, "sources"))


def _days_of(spark: SparkSession, folder: str, table: str) -> Warehouse:
    """The warehouse of a session's queries with a source table in its day folders, which the
    first query that asks for it fills."""
    store = _warehouse(spark, folder)
    if not store.exists(table):
        store.load_days(DATED[table](spark, folder), table)
    return store


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return client_log.parse_records(samples.log_lines(spark, folder))


def log_demux(spark: SparkSession, folder: str) -> DataFrame:
    return client_log.play_records(_records(spark, folder))


def log_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return client_log.unreadable_records(_records(spark, folder))


def log_demux_text(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "routed")
    write_by_table(client_log.routed_text(_records(spark, folder)), path)
    return spark.read.text(path).select("table_name", "value")


def partition_store(spark: SparkSession, folder: str) -> DataFrame:
    """All days of the play log loaded, then one of them replaced by the same rows."""
    store = Warehouse(spark, root=scratch_path(spark, "store"))
    plays = samples.plays(spark, folder)
    store.load_days(plays, "plays")
    store.replace_day(on_day(plays, DAY), "plays", DAY)
    return store.read("plays")


def catalog_store(spark: SparkSession, folder: str) -> DataFrame:
    """The same in the session's catalog."""
    place = scratch_path(spark, "catalog")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {CATALOG} LOCATION '{place}'")
    store = Warehouse(spark, database=CATALOG, external=place)
    name = f"plays_{uuid.uuid4().hex}"
    plays = samples.plays(spark, folder)
    store.load_days(plays, name)
    store.replace_day(on_day(plays, DAY), name, DAY)
    return store.read(name)


def table_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table without days, written twice; the second content stays."""
    store = Warehouse(spark, root=scratch_path(spark, "store"))
    songs_now = song_dim(spark, folder)
    store.replace(songs_now.limit(1), "songs")
    store.replace(songs_now, "songs")
    return store.read("songs")


def log_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The log written as compressed text files, read, and split into plays. A gzip file is one
    scan task, so there are as many files as tasks that make the lines: more for more input."""
    path = scratch_path(spark, "raw")
    samples.log_lines(spark, folder).write.option("compression", "gzip").text(path)
    return client_log.play_records(client_log.parse_records(read_lines(spark, path)))


def song_dim(spark: SparkSession, folder: str) -> DataFrame:
    dimension = songs.song_dimension(samples.song_catalog(spark, folder))
    types = F.array_join(F.transform("PRDCT_TYPE", lambda n: n.cast("string")), ",")
    return dimension.withColumn("PRDCT_TYPE", types)


def json_singers(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("SINGER_INFO")
    return samples.song_catalog(spark, folder).groupBy(
        catalog.singer_field(text, 0, "name").alias("name1"),
        catalog.singer_field(text, 0, "id").alias("id1"),
        catalog.singer_field(text, 1, "name").alias("name2"),
        catalog.singer_field(text, 1, "id").alias("id2"),
    ).agg(F.count("*").alias("n_songs"))


def time_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return samples.song_catalog(spark, folder).select(
        "NBR", normalise_time(F.col("POST_TIME")).alias("POST_TIME")
    )


def _features(spark: SparkSession, folder: str) -> DataFrame:
    plays = samples.plays(spark, folder)
    # The catalog's dimension, cut by Catalyst to the columns in use.
    dimension = songs.song_dimension(samples.song_catalog(spark, folder))
    history = songs.daily_counts(
        plays, dimension, shift_day(DAY, -songs.FAR_DAYS), shift_day(DAY, -1)
    )
    return songs.song_features(plays, dimension, history, DAY)


def song_features_first_load(spark: SparkSession, folder: str) -> DataFrame:
    """The features from the plays of the whole period."""
    return _features(spark, folder)


def song_features(spark: SparkSession, folder: str) -> DataFrame:
    """The features from the day's plays and what was kept of the days before."""
    store = _days_of(spark, folder, jobs.PLAYS)
    first, before = shift_day(DAY, -songs.FAR_DAYS), shift_day(DAY, -1)
    jobs.keep_song_days(store, DAY)
    dimension = songs.song_dimension(samples.song_catalog(spark, folder))
    gaps = store.read_days(jobs.SONG_GAPS, first, DAY)
    history = songs.kept_daily_counts(gaps, dimension, first, before)
    return songs.song_features_from(gaps, dimension, history, DAY)


def _rounded(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn("RSI", F.round("RSI", 6))


def song_heat_rank(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(songs.song_heat_rank(_dated(_features(spark, folder)), DAY))


def song_heat_top(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(songs.song_heat_rank(_dated(_features(spark, folder)), DAY, songs.TOP))


def singer_heat_rank(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(songs.singer_heat_rank(_dated(_features(spark, folder)), DAY))


def singer_heat_top(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(songs.singer_heat_rank(_dated(_features(spark, folder)), DAY, songs.TOP))


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    store = _days_of(spark, folder, jobs.CONSUMPTION)
    return ledger_plan.ledger(store.read_days(jobs.CONSUMPTION, DAY), DAY)


def active_users(spark: SparkSession, folder: str) -> DataFrame:
    logins = _days_of(spark, folder, jobs.LOGINS).read_days(jobs.LOGINS, DAY)
    return users.active_users(samples.channel_tables(spark, folder), logins, DAY)


def active_7d(spark: SparkSession, folder: str) -> DataFrame:
    first = shift_day(DAY, -7)
    logins = _days_of(spark, folder, jobs.LOGINS).read_days(jobs.LOGINS, first, DAY)
    channels = samples.channel_tables(spark, folder)
    week = users.active_users_by_day(channels, logins, first, DAY)
    return users.week_activity(week, DAY)


def address_repair(spark: SparkSession, folder: str) -> DataFrame:
    located = samples.machine_tables(spark, folder)["locations"]
    return located.select(
        "MID",
        address.province(F.col("ADDR")).alias("province"),
        address.city(F.col("ADDR")).alias("city"),
    )


def machine_dim(spark: SparkSession, folder: str) -> DataFrame:
    return machines.machine_dimension(**samples.machine_tables(spark, folder))


def machine_positions(spark: SparkSession, folder: str) -> DataFrame:
    return machines.busiest_positions(samples.user_positions(spark, folder), DAY)


def machine_location(spark: SparkSession, folder: str) -> DataFrame:
    return machines.machine_locations(
        samples.user_positions(spark, folder),
        samples.geocoder_answers(spark, folder),
        samples.installed_locations(spark, folder),
        DAY,
    )


def carried_forward(spark: SparkSession, folder: str) -> DataFrame:
    today = machines.busiest_positions(samples.user_positions(spark, folder), DAY)
    yesterday = samples.installed_locations(spark, folder).select(*today.columns)
    return carry_forward(today, yesterday, "MID")


def machine_stat(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.machine_stat(
        machine_dim(spark, folder),
        machine_location(spark, folder),
        ledger(spark, folder),
        active_users(spark, folder),
    )


def merchant_share(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.merchant_share(_dated(machine_stat(spark, folder)), DAY)


def region_totals(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.region_totals(_dated(machine_stat(spark, folder)), DAY)


def _in_batches(
    session: SparkSession, folder: str, log: str, then=None, ending: bool = True
) -> str:
    """The message log in the order of arrival: ``samples.BATCHES`` of the messages, then the
    end message alone. ``then`` runs when the first batch is there. Returns the files of a
    batch, one per core, so that no task writes or reads a batch alone.

    The messages are made once, by all tasks also where the events lie in the order of their times,
    and dealt out by a hash, which needs no sort."""
    files = session.sparkContext.defaultParallelism
    sent = samples.messages(session, folder).withColumn("part", samples.arrival_part())
    none = session.createDataFrame([], sent.drop("part").schema).coalesce(1)
    with scratch(session, "sent") as staged:
        sent.write.partitionBy("part").parquet(staged)
        kept = session.read.schema(sent.schema).parquet(staged)
        for part in range(samples.BATCHES):
            rows = kept.where(F.col("part") == part).drop("part")
            dealt = rows.repartition(files, "timestamp", "value")
            dealt.write.mode("append").parquet(log)
            # A task without rows writes no file; every batch has the same number.
            names = [n for n, _ in Files(session, log).children(log) if n.startswith("part-")]
            for _ in range((part + 1) * files - len(names)):
                none.write.mode("append").parquet(log)
            if then and not part:
                then(str(files))
    if ending:
        samples.end_message(session, folder).coalesce(1).write.mode("append").parquet(log)
    return str(files)


def _stream_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    for key, value in STREAM_SETTINGS.items():
        session.conf.set(key, value)
    # State partitions are fixed for a stream's life; size them by the cluster's cores.
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def _stamped(found: DataFrame, *names: str) -> DataFrame:
    return found.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


def _replayed(
    spark: SparkSession, folder: str, counted: closed.Counted, window: str, slide: str, shape=None
) -> DataFrame:
    """Write the events as a message log, out of order by less than the delay, run a stream
    over it batch by batch, and read back every window it emitted."""
    session = _stream_session(spark)
    log, out = scratch_path(spark, "log"), scratch_path(spark, "windows")
    progress = scratch_path(spark, "progress")
    files = _in_batches(session, folder, log)
    source = messages.parse(messages.from_files(session, log, maxFilesPerTrigger=files))
    runs.replay_windows(
        source, counted, out, progress, window, slide, samples.DELAY, shape, spark
    )
    return _stamped(spark.read.parquet(out).drop("batch"), "window_start", "window_end")


def stream_pv(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, closed.VIEWS, counts.WINDOW, counts.VISITOR_SLIDE)


def stream_uv(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(
        spark, folder, closed.VISITORS, counts.WINDOW, counts.VISITOR_SLIDE
    ).drop("pv")


def stream_hot_songs(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(
        spark, folder, closed.SONGS, counts.WINDOW, counts.SONG_SLIDE, counts.hot_songs
    )


def stream_uv_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, closed.VISITORS, WIDE_WINDOW, WIDE_SLIDE).drop("pv")


def stream_hot_songs_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(
        spark, folder, closed.SONGS, WIDE_WINDOW, WIDE_SLIDE, counts.hot_songs
    )


def stream_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Page views of a stream that is stopped after the first batch and started again."""
    session = _stream_session(spark)
    log, out = scratch_path(spark, "log"), scratch_path(spark, "windows")
    progress = scratch_path(spark, "progress")

    def run(files: str) -> None:
        source = messages.from_files(session, log, maxFilesPerTrigger=files)
        runs.replay_windows(
            messages.parse(source), closed.VIEWS, out, progress, WIDE_WINDOW, WIDE_SLIDE,
            samples.DELAY, spark=spark,
        )

    run(_in_batches(session, folder, log, run))
    return _stamped(spark.read.parquet(out).drop("batch"), "window_start", "window_end")


def stream_last_window(spark: SparkSession, folder: str) -> DataFrame:
    """What the table of page views holds when the stream has read everything."""
    session = _stream_session(spark)
    log, place = scratch_path(spark, "log"), scratch_path(spark, "table")
    files = _in_batches(session, folder, log)
    shown = []

    def write(df: DataFrame) -> None:
        path = f"{place}/{len(shown)}"
        df.write.parquet(path)
        shown.append(path)

    source = messages.parse(messages.from_files(session, log, maxFilesPerTrigger=files))
    runs.start_visitors(
        source, write, lambda df: None, scratch_path(spark, "progress"), samples.DELAY,
        WIDE_WINDOW, WIDE_SLIDE, availableNow=True,
    ).awaitTermination()
    return spark.read.parquet(shown[-1])


def _arrival_windows(spark: SparkSession, folder: str, keys: tuple[str, ...], shape) -> DataFrame:
    """Windows by arrival over the same log: messages count when they are read, however old
    they are. Batches arrive 30 seconds apart; the running window is kept after each."""
    session = _stream_session(spark)
    log, place = scratch_path(spark, "log"), scratch_path(spark, "arrivals")
    files = _in_batches(session, folder, log)
    shown = []

    def clock(batch_id: int) -> datetime:
        return ARRIVAL + timedelta(seconds=30 * batch_id)

    def write(rows: DataFrame) -> None:
        path = f"{place}/shown-{len(shown)}"
        found = shape(rows).withColumn("shown", F.lit(len(shown)))
        found.write.mode("overwrite").parquet(path)
        shown.append(path)

    source = messages.parse(messages.from_files(session, log, maxFilesPerTrigger=files))
    arrivals.start(source, keys, write, place, clock=clock, availableNow=True).awaitTermination()
    return spark.read.parquet(*shown)


def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Page views and users by arrival."""
    return _arrival_windows(spark, folder, ("mid", "uid"), arrivals.visitors)


def stream_songs_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """Hot songs by arrival."""
    return _arrival_windows(spark, folder, ("songname",), arrivals.songs)


def stream_catch_up(spark: SparkSession, folder: str) -> DataFrame:
    """Page views of a stream that reads a backlog with its heartbeat muted, is stopped, and goes
    on live from the same checkpoint: no message follows, so the heartbeat alone closes the
    last windows."""
    session = _stream_session(spark)
    log, out = scratch_path(spark, "log"), scratch_path(spark, "windows")
    progress = scratch_path(spark, "progress")
    files = _in_batches(session, folder, log, ending=False)
    for muted in (True, False):
        source = messages.parse(messages.from_files(session, log, maxFilesPerTrigger=files))
        beating = runs.with_heartbeat(source, muted)
        runs.replay_windows(
            beating, closed.VIEWS, out, progress, WIDE_WINDOW, WIDE_SLIDE, samples.DELAY,
            spark=spark,
        )
    found = spark.read.parquet(out).where(F.col("mid") != runs.BEAT).drop("batch")
    return _stamped(found, "window_start", "window_end")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _sized(query)
    for query in (
        log_demux,
        log_quarantine,
        log_demux_text,
        log_scan,
        partition_store,
        catalog_store,
        table_overwrite,
        song_dim,
        json_singers,
        time_normalise,
        song_features,
        song_features_first_load,
        song_heat_rank,
        song_heat_top,
        singer_heat_rank,
        singer_heat_top,
        ledger,
        active_users,
        active_7d,
        address_repair,
        machine_dim,
        machine_positions,
        machine_location,
        carried_forward,
        machine_stat,
        merchant_share,
        region_totals,
        stream_pv,
        stream_uv,
        stream_hot_songs,
        stream_uv_wide,
        stream_hot_songs_wide,
        stream_late,
        stream_songs_arrival,
        stream_catch_up,
        stream_resume,
        stream_last_window,
    )
}
