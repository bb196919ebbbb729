"""Physical plans: what reaches the scan, what is shuffled, and what must not appear."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cadenza.checks import queries as catalog
from cadenza.operators.snapshot import carry_forward
from cadenza.plans import client_log, ledger, machines, songs
from cadenza.sources import samples
from cadenza.sources.tables import Warehouse, between_days, on_day

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    samples.plays(spark, FOLDER).write.partitionBy("data_dt").parquet(f"{root}/plays")
    return Warehouse(spark, root=root)


BATCH = [name for name in contract.queries() if not name.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_product(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_day_filters_prune_partitions(store):
    for df in (on_day(store.read("plays"), "20240130"),
               between_days(store.read("plays"), "20240101", "20240130")):
        plan = plan_of(df)
        filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
        assert "data_dt" in filters and "cast" not in filters.lower()


def test_days_are_read_without_listing_the_others(store):
    wanted = {"20240129", "20240130"}
    df = store.read_days("plays", "20240129", "20240130")
    assert {path.split("data_dt=")[1][:8] for path in df.inputFiles()} == wanted
    assert dict(df.dtypes)["data_dt"] == "string"
    assert {r[0] for r in df.select("data_dt").distinct().collect()} == wanted
    assert store.read_days("plays", "20300101").count() == 0


def test_day_stays_text_when_the_session_infers_types(spark, store):
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        for df in (store.read("plays"), store.read_days("plays", "20240130")):
            assert dict(df.dtypes)["data_dt"] == "string"
            assert on_day(df, "20240130").count() > 0
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


@pytest.mark.parametrize(
    "name, table, days",
    [
        ("ledger", "to_ycak_cnsm_d", 1),
        ("active_users", "to_ycak_usr_login_d", 1),
        ("active_7d", "to_ycak_usr_login_d", 8),
        ("song_features", "tw_song_gaps_d", 31),
    ],
)
def test_queries_read_the_days_they_need(spark, name, table, days):
    """Day folders of a warehouse that holds all days of the sample."""
    files = [f for f in catalog.QUERIES[name](spark, FOLDER).inputFiles() if f"/{table}/" in f]
    read = {f.split("data_dt=")[1][:8] for f in files}
    first = (datetime.strptime("20240130", "%Y%m%d") - timedelta(days=days - 1)).strftime("%Y%m%d")
    assert read and min(read) >= first and max(read) == "20240130"
    if name == "song_features":
        plays = [f for f in catalog.QUERIES[name](spark, FOLDER).inputFiles() if "/to_client" in f]
        assert not any("data_dt=20240130" in f for f in plays)  # only the peaks of days before


def test_yesterdays_wide_rows_are_neither_shuffled_nor_sorted(spark, tmp_path):
    wide = spark.range(1000).select("id", *[F.lit("x").alias(f"c{n}") for n in range(30)])
    wide.write.parquet(f"{tmp_path}/old")
    today = wide.where("id % 3 = 0")
    old = spark.read.parquet(f"{tmp_path}/old")
    plan = plan_of(carry_forward(today, old, "id"))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    for node in ("Exchange hashpartitioning", "Sort ", "Window"):
        assert node not in plan
    # Beyond what may be broadcast both sides are hashed, still unsorted.
    beyond = plan_of(carry_forward(today, old, "id", broadcast_bytes=0))
    assert "ShuffledHashJoin" in beyond and "Sort " not in beyond and "Broadcast" not in beyond


def test_replayed_batches_are_spread_over_the_cores(spark, tmp_path):
    session, log = catalog._stream_session(spark), f"{tmp_path}/log"
    files = int(catalog._in_batches(session, FOLDER, log))
    assert files == spark.sparkContext.defaultParallelism > 1
    found = spark.read.parquet(log).select(F.input_file_name().alias("f")).groupBy("f").count()
    sizes = [r["count"] for r in found.collect()]
    names = [f for f in spark.read.parquet(log).inputFiles()]
    assert len(names) == samples.BATCHES * files + 1
    assert max(sizes) < sum(sizes) / files


def test_features_read_only_their_columns(store, spark):
    plays = store.read("plays")
    dimension = songs.song_dimension(samples.song_catalog(spark, FOLDER))
    history = songs.daily_counts(plays, dimension, "20231231", "20240129")
    plan = plan_of(songs.song_features(plays, dimension, history, "20240130"))
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    fact = [s for s in schemas if "SONGID" in s]
    assert sorted(fact) == ["SONGID:string", "SONGID:string,UID:string,ORDER_ID:string"]


def test_features_expand_twice_not_per_window(store, spark):
    """Six distinct counts and three windows cost two rows per play."""
    plays = store.read("plays")
    dimension = songs.song_dimension(samples.song_catalog(spark, FOLDER))
    history = songs.daily_counts(plays, dimension, "20231231", "20240129")
    plan = plan_of(songs.song_features(plays, dimension, history, "20240130"))
    expand = [line for line in plan.splitlines() if "Expand [[" in line]
    assert len(expand) == 1
    assert expand[0].count("], [") == 2  # two projections and the output list
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_top_ranks_are_trimmed_before_the_shuffle(spark):
    for name in ("song_heat_top", "singer_heat_top", "machine_positions"):
        plan = plan_of(contract.queries()[name](spark, FOLDER))
        assert plan.count("WindowGroupLimit") == 2


def test_full_rank_has_no_window_over_the_rows(spark):
    plan = plan_of(catalog.song_heat_rank(spark, FOLDER))
    assert "Window" not in plan and "BroadcastHashJoin" in plan


@pytest.fixture
def no_broadcast(spark):
    """Joins as with inputs too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(plan: str, key: str) -> int:
    return plan.split("Initial Plan")[0].count(f"Exchange hashpartitioning({key}#")


def test_machine_joins_share_one_partitioning(spark, no_broadcast, tmp_path):
    inputs = {}
    for name, df in samples.machine_tables(spark, FOLDER).items():
        df.write.parquet(f"{tmp_path}/{name}")
        inputs[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = plan_of(machines.machine_dimension(**inputs))
    assert plan.count("SortMergeJoin") == 8
    assert shuffles(plan, "MID") == 5  # the key universe and one per joined table


def test_feature_joins_reuse_the_aggregate_partitioning(spark, no_broadcast, store):
    plays = store.read("plays")
    dimension = songs.song_dimension(samples.song_catalog(spark, FOLDER))
    history = plays.select("SONGID", "data_dt").groupBy("SONGID", "data_dt").count().selectExpr(
        "SONGID AS NBR", "count AS SING_CNT", "0L AS SUPP_CNT", "data_dt"
    )
    plan = plan_of(songs.song_features(plays, dimension, history, "20240130"))
    assert plan.count("SortMergeJoin") == 2
    # Two groupings of plays, two of the history (one above), and the dimension.
    assert shuffles(plan, "NBR") + shuffles(plan, "SONGID") == 5


def test_map_only_jobs_do_not_shuffle(spark):
    day = F.lit("20240130").alias("data_dt")
    raw = spark.read.parquet(f"{FOLDER}/part.parquet")
    orders = spark.range(5).select(
        *[F.lit("1").alias(c) for c in ("ID", "TRD_ID", "UID", "MID", "PRDCD_TYPE", "PAY_TYPE",
          "ACT_TM", "PKG_ID", "ORDR_ID", "ACTV_NM", "PKG_PRC", "PKG_DSCNT", "CPN_TYPE")],
        F.lit(-1).alias("AMT"), F.lit(1).alias("ORDR_TYPE"), day,
    )
    lines = raw.select(F.col("p_name").alias("value"))
    plays = client_log.play_records(client_log.parse_records(lines))
    dimension = songs.song_dimension(samples.song_catalog(spark, FOLDER))
    for df in (ledger.ledger(orders, "20240130"), plays, dimension):
        assert "Exchange" not in plan_of(df)


def test_log_bodies_are_parsed_once(spark):
    lines = spark.createDataFrame([("a",)], "value string")
    plan = plan_of(client_log.play_records(client_log.parse_records(lines)))
    assert plan.lower().count("from_json") == 1
    assert plan.count("split(") == 1
