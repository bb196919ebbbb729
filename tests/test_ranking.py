"""Ranks against brute force, with hot groups and many ties."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from cadenza.operators import ranking
from cadenza.operators.counting import nested_window_counts
from cadenza.operators.ranking import full_rank, top_n
from cadenza.operators.snapshot import carry_forward


def scores(spark):
    """Group 'hot' has most rows, and a third of all rows share one value."""
    key = F.xxhash64("id")
    return spark.range(30_000, numPartitions=8).select(
        F.when(F.pmod(key, F.lit(10)) < 8, "hot").when(F.pmod(key, F.lit(10)) == 8, "b")
        .alias("g"),
        F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.pmod(key, F.lit(1000)) / 7).alias("v"),
        F.format_string("%06d", F.col("id")).alias("k"),
    )


def brute_force(rows):
    ordered = sorted(rows, key=lambda r: (-r.v, r.k))
    seen, ranks = Counter(), {}
    for row in ordered:
        seen[row.g] += 1
        ranks[row.k] = seen[row.g]
    return ranks


def test_full_rank_matches_brute_force(spark):
    df = scores(spark)
    ranked = full_rank(df, ["g"], [F.desc("v"), F.asc("k")]).collect()
    assert {row.k: row.rank for row in ranked} == brute_force(df.collect())


def test_full_rank_spreads_one_group(spark):
    df = scores(spark).withColumn("g", F.lit("one"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = full_rank(df, ["g"], [F.desc("v"), F.asc("k")])
        sizes = ranked.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 30_000 / 4
    assert sorted(r.rank for r in ranked.select("rank").collect()) == list(range(1, 30_001))


def test_full_rank_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MAX_BROADCAST_BYTES", 0)
    df = scores(spark)
    ranked = full_rank(df, ["g"], [F.desc("v"), F.asc("k")])
    hints = ranked._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in hints.lower()
    assert {row.k: row.rank for row in ranked.collect()} == brute_force(df.collect())


def test_full_rank_of_nothing(spark):
    assert full_rank(scores(spark).limit(0), ["g"], [F.desc("v"), F.asc("k")]).count() == 0


def test_top_n_is_the_head_of_the_full_rank(spark):
    df = scores(spark)
    top = {(r.k, r.rank) for r in top_n(df, 30, ["g"], [F.desc("v"), F.asc("k")]).collect()}
    assert top == {(k, n) for k, n in brute_force(df.collect()).items() if n <= 30}


def test_nested_counts_match_brute_force(spark):
    """One key has a third of the rows; values are missing, repeated and shared."""
    rows = [
        ("hot" if i % 3 == 0 else f"k{i % 5}", None if i % 11 == 0 else f"u{i * 7 % 40}",
         f"o{i // 2}", i * 13 % 3)
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, u string, o string, l int")
    found = nested_window_counts(
        df, "k", {"USERS": "u", "ORDERS": "o"}, F.col("l"), {2: "A_", 1: "B_", 0: "C_"}, "ROWS"
    ).collect()
    assert len(found) == 6
    for row in found:
        for level, prefix in ((2, "A_"), (1, "B_"), (0, "C_")):
            inside = [r for r in rows if r[0] == row.k and r[3] >= level]
            assert row[f"{prefix}ROWS"] == len(inside)
            assert row[f"{prefix}USERS"] == len({r[1] for r in inside} - {None})
            assert row[f"{prefix}ORDERS"] == len({r[2] for r in inside})


def test_carry_forward(spark):
    today = spark.createDataFrame([(2, "t"), (4, "t")], "MID int, w string")
    yesterday = spark.createDataFrame([(1, "y", "d"), (2, "y", "d"), (3, "y", "d")],
                                      "MID int, w string, data_dt string")
    found = {tuple(r) for r in carry_forward(today, yesterday, "MID").collect()}
    assert found == {(1, "y"), (3, "y"), (2, "t"), (4, "t")}
