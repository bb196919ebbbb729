"""Shuffles, state and files whose number follows the input."""

from __future__ import annotations

import shutil

import pytest

from cadenza import jobs
from cadenza import session as sessions
from cadenza.checks import queries as catalog
from cadenza.functions.dates import shift_day
from cadenza.plans import songs
from cadenza.sources import samples
from cadenza.sources.versions import Files

FOLDER = "/root/testdata/sf0.001"
PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture
def tiny_parts(monkeypatch):
    """As if the small tables were many partitions large."""
    catalog._session.cache_clear()
    monkeypatch.setattr(sessions, "PARTITION_BYTES", 1 << 12)
    yield
    catalog._session.cache_clear()


def test_shuffle_partitions_follow_the_input(spark):
    before = spark.conf.get(PARTITIONS)
    small = sessions.sized_session(spark, 1)
    large = sessions.sized_session(spark, 1000 * sessions.PARTITION_BYTES)
    assert small.conf.get(PARTITIONS) == before == spark.conf.get(PARTITIONS)
    assert large.conf.get(PARTITIONS) == "1000"
    assert large.conf.get("spark.sql.session.timeZone") == "UTC"


@pytest.mark.parametrize("name", ["song_features_first_load", "singer_heat_top", "machine_stat"])
def test_queries_shuffle_by_their_input(spark, tiny_parts, name):
    found = catalog.QUERIES[name](spark, FOLDER)
    assert int(found.sparkSession.conf.get(PARTITIONS)) >= 40
    assert found.count() > 0


def test_a_larger_log_is_more_files(spark, tiny_parts, monkeypatch):
    """A gzip file is read by one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    read, seen = catalog.read_lines, []
    monkeypatch.setattr(
        catalog, "read_lines", lambda session, path: seen.append(path) or read(session, path)
    )
    try:
        assert catalog.QUERIES["log_scan"](spark, FOLDER).count() > 0
    finally:
        for key in settings:
            spark.conf.unset(key)
    names = [name for name, _ in Files(spark, seen[0]).children(seen[0])]
    assert len([name for name in names if name.endswith(".gz")]) >= 40


def test_kept_song_days_serve_the_features(spark):
    """Peaks too come from what days keep, and a first load writes its day with the others."""
    found = catalog.QUERIES["song_features"](spark, FOLDER)
    files = found.inputFiles()
    assert any(jobs.SONG_GAPS in name for name in files)
    assert not any(jobs.PLAYS in name for name in files)
    session = catalog._session(spark, FOLDER, spark.conf.get(PARTITIONS))
    store = catalog._warehouse(session, FOLDER)
    first = shift_day(catalog.DAY, -songs.FAR_DAYS)
    days = {day for day in store.days(jobs.PLAYS) if first <= day <= catalog.DAY}
    assert days <= store.days(jobs.SONG_GAPS)
    plays = store.read_days(jobs.PLAYS, first, catalog.DAY)
    gaps = store.read_days(jobs.SONG_GAPS, first, catalog.DAY)
    dimension = songs.song_dimension(samples.song_catalog(spark, FOLDER))
    before = shift_day(catalog.DAY, -1)
    wanted = songs.daily_counts(plays, dimension, first, before)
    kept = songs.kept_daily_counts(gaps, dimension, first, before).select(*wanted.columns)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, wanted.collect()))


def test_the_message_log_is_made_in_one_pass(spark, tmp_path):
    """Its batches used to read and parse the events once each."""
    folder, log = tmp_path / "tables", str(tmp_path / "log")
    folder.mkdir()
    shutil.copy(f"{FOLDER}/events.parquet", folder)
    events = folder / "events.parquet"
    wanted = samples.messages(spark, FOLDER).collect()
    first = []

    def then(files):
        first.append(len(Files(spark, log).children(log)))
        events.unlink()

    files = int(catalog._in_batches(spark, str(folder), log, then, ending=False))
    kept = Files(spark, log).children(log)
    names = [name for name, _ in kept if name.startswith("part-")]
    assert len(names) == samples.BATCHES * files and first[0] < len(kept)
    assert sorted(map(str, spark.read.parquet(log).collect())) == sorted(map(str, wanted))
