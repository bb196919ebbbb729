"""The daily jobs as commands over a warehouse.

``spark-submit cadenza/jobs.py <job> --date 20240130 --root /warehouse``

A job reads its input tables, writes its day once, and copies the written rows to the
result database when one is given, so nothing is computed twice.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.dates import shift_day
from cadenza.plans import client_log, ledger, machines, revenue, songs, users
from cadenza.session import build_session, scratch
from cadenza.sinks.jdbc import CONNECTIONS, dated, replace_table
from cadenza.sinks.text import write_by_table
from cadenza.sources.client_log import read_lines
from cadenza.sources.tables import Warehouse, between_days, on_day

# Table names of the warehouse.
PLAYS = "to_client_song_play_operate_req_d"
SONG_INFO = "to_song_info_d"
SONGS = "tw_song_baseinfo_d"
FEATURES = "tw_song_ftur_d"
SONG_SEEN = "tw_song_seen_d"  # kept for later days: values, and their gaps
SONG_GAPS = "tw_song_gaps_d"
SONG_RANK = "tw_song_rsi_d"
SINGER_RANK = "tw_singer_rsi_d"
MACHINES = "tw_mac_baseinfo_d"
LOCATIONS = "tw_mac_loc_d"
LEDGER = "tw_cnsm_brief_d"
USERS = "tw_usr_baseinfo_d"
STAT = "tw_mac_stat_d"
MERCHANTS = "tm_usr_mrchnt_stat_d"
REGIONS = "tm_mac_region_stat_d"
MACHINE_SOURCES = {
    "machines": "to_ycak_mac_d",
    "locations": "to_ycak_mac_loc_d",
    "admin_map": "to_ycbk_mac_admin_map_d",
    "provinces": "to_ycbk_prvc_d",
    "cities": "to_ycbk_city_d",
    "areas": "to_ycbk_area_d",
    "store_map": "to_ycbk_mac_store_map_d",
    "stores": "to_ycbk_store_d",
}
CHANNEL_SOURCES = {
    "wechat": "to_ycak_usr_d",
    "alipay": "to_ycak_usr_ali_d",
    "qq": "to_ycak_usr_qq_d",
    "app": "to_ycak_usr_app_d",
}
CONSUMPTION = "to_ycak_cnsm_d"
POSITIONS = "to_ycak_usr_loc_d"
LOGINS = "to_ycak_usr_login_d"
ANSWERS = "geocoder_answers"

SHUFFLE_PARTITIONS = 4000

Plan = Callable[[Warehouse, str], DataFrame]


@dataclass(frozen=True)
class Job:
    """``plan`` fills ``output``; ``copy`` names the result table in the database and
    ``copied`` picks its rows out of the written day."""

    plan: Plan
    output: str
    by_day: bool = True
    copy: str | None = None
    copied: Callable[[DataFrame], DataFrame] = lambda df: df
    with_day: bool = True
    before: Callable[[Warehouse, str], None] | None = None


def _digest(df: DataFrame) -> tuple:
    """Count and hash sum of the rows, whatever their order."""
    each = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(each)).first())


def keep_song_days(store: Warehouse, day: str) -> None:
    """Bring the kept song values and gaps up to ``day``, from that day's plays alone.

    Days that were never kept, as before the first run, are loaded from their plays, and with
    them the days after, whose gaps may lack them. A rerun of an old day whose plays have
    changed drops what was kept of later days, so that their next run loads it again.
    """
    first, before = shift_day(day, -songs.FAR_DAYS), shift_day(day, -1)
    kept = store.days(SONG_SEEN) & store.days(SONG_GAPS)
    missing = [d for d in store.days(PLAYS) if first <= d <= before and d not in kept]
    plays = on_day(store.read_days(PLAYS, day), day)
    seen = songs.play_values(plays)
    later = {d for d in store.days(SONG_SEEN) | store.days(SONG_GAPS) if d > day}
    if later and _changed(store, seen, day):
        store.drop_days(SONG_GAPS, later)
        store.drop_days(SONG_SEEN, later)
    if missing:
        _load_song_days(store, min(missing), day, kept)
        return
    store.replace_day(seen, SONG_SEEN, day)
    seen = store.read_days(SONG_SEEN, day)
    if kept:
        earlier = store.read_days(SONG_SEEN, first, before)
        gaps = songs.play_gaps(plays, seen, between_days(earlier, first, before), day)
    else:
        gaps = songs.play_gaps(plays, seen)
    store.replace_day(gaps, SONG_GAPS, day)


def _load_song_days(store: Warehouse, start: str, day: str, kept: set[str]) -> None:
    """Keep the days from ``start`` to ``day`` at once. Gaps come from the values that were just
    written, and from the days before ``start``, kept or not: they reach back a whole window,
    so that they hold for reruns of old days too."""
    late = {d for d in store.days(PLAYS) | kept if start <= d <= day} | {day}
    reach, last = shift_day(start, -songs.FAR_DAYS), shift_day(start, -1)
    plays = between_days(store.read_days(PLAYS, start, day), start, day)
    store.replace_days(songs.play_values(plays), SONG_SEEN, late)
    seen = between_days(store.read_days(SONG_SEEN, start, day), start, day)
    if any(reach <= d <= last for d in store.days(PLAYS)):
        before = songs.play_values(between_days(store.read_days(PLAYS, reach, last), reach, last))
        seen = seen.unionByName(before.select(*seen.columns))
    gaps = between_days(songs.play_gaps(plays, seen), start, day)
    store.replace_days(gaps, SONG_GAPS, late)


def _changed(store: Warehouse, seen: DataFrame, day: str) -> bool:
    """Whether a day's values are not those that were kept. Its row counts concern no other
    day, for later windows read them from its own gaps."""
    if day not in store.days(SONG_SEEN):
        return True
    return _digest(on_day(store.read_days(SONG_SEEN, day), day)) != _digest(seen)


def _features(store: Warehouse, day: str) -> DataFrame:
    """Without earlier output, as on the first day, all peaks are 0."""
    first, before = shift_day(day, -songs.FAR_DAYS), shift_day(day, -1)
    if store.exists(FEATURES):
        history = store.read_days(FEATURES, first, before)
    else:
        history = store.spark.createDataFrame(
            [], "NBR string, SING_CNT bigint, SUPP_CNT bigint, data_dt string"
        )
    gaps = store.read_days(SONG_GAPS, first, day)
    return songs.song_features_from(gaps, store.read(SONGS), history, day)


def _locations(store: Warehouse, day: str) -> DataFrame:
    yesterday = None
    if store.exists(LOCATIONS):
        yesterday = store.read_days(LOCATIONS, shift_day(day, -1))
    positions = store.read_days(POSITIONS, shift_day(day, -machines.LOCATION_DAYS), day)
    return machines.machine_locations(positions, store.read(ANSWERS), yesterday, day)


def _channels(store: Warehouse) -> dict[str, DataFrame]:
    return {name: store.read(source) for name, source in CHANNEL_SOURCES.items()}


def _stat(store: Warehouse, day: str) -> DataFrame:
    inputs = (MACHINES, LOCATIONS, LEDGER, USERS)
    return revenue.machine_stat(*[store.read_days(name, day) for name in inputs])


def _top(df: DataFrame) -> DataFrame:
    return df.where(F.col("RSI_RANK") <= songs.TOP)


JOBS: dict[str, Job] = {
    "song_dimension": Job(
        lambda store, day: songs.song_dimension(store.read(SONG_INFO)), SONGS, by_day=False
    ),
    "song_features": Job(_features, FEATURES, before=keep_song_days),
    "song_heat": Job(
        lambda store, day: songs.song_heat_rank(store.read_days(FEATURES, day), day),
        SONG_RANK,
        copy="tm_song_rsi",
        copied=_top,
    ),
    "singer_heat": Job(
        lambda store, day: songs.singer_heat_rank(store.read_days(FEATURES, day), day),
        SINGER_RANK,
        copy="tm_singer_rsi",
        copied=_top,
    ),
    "machine_dimension": Job(
        lambda store, day: machines.machine_dimension(
            **{name: store.read(source) for name, source in MACHINE_SOURCES.items()}
        ),
        MACHINES,
        copy="tm_mac_baseinfo",
    ),
    "machine_locations": Job(_locations, LOCATIONS, copy="tw_mac_loc_d", with_day=False),
    "ledger": Job(
        lambda store, day: ledger.ledger(store.read_days(CONSUMPTION, day), day),
        LEDGER,
        copy="TW_CNSM_BRIEF_D",
    ),
    "active_users": Job(
        lambda store, day: users.active_users(
            _channels(store), store.read_days(LOGINS, day), day
        ),
        USERS,
    ),
    "machine_stat": Job(_stat, STAT, copy="tm_machine_rev_infos"),
    "merchant_share": Job(
        lambda store, day: revenue.merchant_share(store.read_days(STAT, day), day),
        MERCHANTS,
        copy="tm_usr_mrchnt_stat_d",
    ),
    "region_totals": Job(
        lambda store, day: revenue.region_totals(store.read_days(STAT, day), day),
        REGIONS,
        copy="tm_mac_region_stat_d",
    ),
}

Copy = Callable[[DataFrame, str], None]


def run_job(name: str, store: Warehouse, day: str, copy: Copy | None = None) -> None:
    """Run one table job for ``day``; ``copy`` writes rows to a named result table."""
    job = JOBS[name]
    if job.before is not None:
        job.before(store, day)
    result = job.plan(store, day)
    if not job.by_day:
        store.replace(result, job.output)
        return
    store.replace_day(result, job.output, day)
    if copy is not None and job.copy is not None:
        written = store.read_days(job.output, day)
        rows = dated(written, day) if job.with_day else written.drop("data_dt")
        copy(job.copied(rows), job.copy)


def run_client_log(
    store: Warehouse, lines: DataFrame, day: str, routed: str, gather: bool = True
) -> None:
    """Route the raw log: text per record type below ``routed/<day>``, plays into their
    day, unreadable plays into ``routed/<day>-unreadable``.

    The log is read and parsed once, into scratch that the three outputs share and that
    goes when they are written. ``gather`` as for ``write_by_table``.
    """
    parsed = client_log.parse_records(lines)
    with scratch(store.spark, "records") as staged:
        parsed.write.partitionBy("kind").parquet(staged)
        records = store.spark.read.schema(parsed.schema).parquet(staged)
        write_by_table(client_log.routed_text(records), f"{routed}/{day}", gather)
        unreadable = client_log.unreadable_records(records)
        unreadable.write.mode("overwrite").json(f"{routed}/{day}-unreadable")
        store.replace_day(client_log.play_records(records), PLAYS, day)


def run_week_activity(store: Warehouse, day: str, copy: Copy, active_days: int = 1) -> None:
    """Copy the week's activity to the result database; it has no warehouse table.

    The result is written to scratch first: the few connections read rows that are ready
    and do not narrow the join.
    """
    week = store.read_days(USERS, shift_day(day, -7), day)
    result = users.week_activity(week, day, active_days)
    with scratch(store.spark, "week") as staged:
        result.write.parquet(staged)
        copy(store.spark.read.schema(result.schema).parquet(staged), "user_7days_active")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one daily job.")
    parser.add_argument("job", choices=[*JOBS, "client_log", "week_activity"])
    parser.add_argument("--date", required=True, help="yyyyMMdd")
    place = parser.add_mutually_exclusive_group(required=True)
    place.add_argument("--root", help="folder of the warehouse tables")
    place.add_argument("--database", help="catalog database of the warehouse tables")
    parser.add_argument("--external", help="folder for new external tables of --database")
    parser.add_argument("--log", help="raw log files (client_log)")
    parser.add_argument("--routed", help="folder for routed records (client_log)")
    parser.add_argument(
        "--partitions", default=str(SHUFFLE_PARTITIONS),
        help="shuffle partitions before adaptive coalescing; raise with the input",
    )
    parser.add_argument(
        "--active-days", type=int, default=1, help="days a user must be seen (week_activity)"
    )
    parser.add_argument(
        "--scatter", action="store_true",
        help="write routed text without gathering each type's rows first (client_log)",
    )
    parser.add_argument("--jdbc-url", help="result database")
    parser.add_argument(
        "--connections", type=int, default=CONNECTIONS, help="parallel database writers"
    )
    parser.add_argument(
        "--jdbc-property", action="append", default=[], metavar="KEY=VALUE",
        help="connection property, such as user or driver",
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    spark = spark or build_session(
        f"cadenza-{args.job}", spark__sql__shuffle__partitions=args.partitions
    )
    store = Warehouse(spark, args.root, args.database, args.external)
    copy = None
    if args.jdbc_url:
        properties = dict(item.split("=", 1) for item in args.jdbc_property)

        def copy(df: DataFrame, table: str) -> None:
            replace_table(df, args.jdbc_url, table, properties, args.connections)

    if args.job == "client_log":
        lines = read_lines(spark, args.log)
        run_client_log(store, lines, args.date, args.routed, not args.scatter)
    elif args.job == "week_activity":
        if copy is None:
            raise SystemExit("week_activity needs --jdbc-url")
        run_week_activity(store, args.date, copy, args.active_days)
    else:
        run_job(args.job, store, args.date, copy)


if __name__ == "__main__":
    main()
