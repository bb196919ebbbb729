"""The daily jobs end to end over a warehouse, and small fixtures of their rules."""

from __future__ import annotations

import random
import tarfile
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cadenza import jobs
from cadenza.functions.dates import shift_day
from cadenza.plans import client_log, ledger, machines, revenue, songs, users
from cadenza.operators.snapshot import carry_forward
from cadenza.operators.trailing import trailing_counts
from cadenza.session import scratch
from cadenza.sinks import jdbc
from cadenza.sources import gazetteer, samples
from cadenza.sources.client_log import read_lines
from cadenza.sources.tables import Warehouse, on_day

FOLDER = "/root/testdata/sf0.001"
DAY = samples.RUN_DAY


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=str)


def fill(store, spark):
    """The source systems' tables."""
    store.replace(samples.song_catalog(spark, FOLDER), jobs.SONG_INFO)
    for name, df in samples.machine_tables(spark, FOLDER).items():
        store.replace(df, jobs.MACHINE_SOURCES[name])
    for name, df in samples.channel_tables(spark, FOLDER).items():
        store.replace(df, jobs.CHANNEL_SOURCES[name])
    store.replace(samples.geocoder_answers(spark, FOLDER), jobs.ANSWERS)
    dated = {
        jobs.CONSUMPTION: samples.consumption(spark, FOLDER),
        jobs.LOGINS: samples.logins(spark, FOLDER),
        jobs.POSITIONS: samples.user_positions(spark, FOLDER),
    }
    for name, df in dated.items():
        df.write.partitionBy("data_dt").parquet(f"{store.root}/{name}")


@pytest.fixture(scope="module")
def copied():
    return {}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory, copied):
    folder = tmp_path_factory.mktemp("daily")
    store = Warehouse(spark, root=str(folder / "warehouse"))
    fill(store, spark)
    lines = samples.log_lines(spark, FOLDER)
    jobs.run_client_log(store, lines, DAY, str(folder / "routed"))

    def copy(df, table):
        copied[table] = (df.columns, df.collect())

    for name in jobs.JOBS:
        for _ in range(2):  # a rerun leaves the same tables
            jobs.run_job(name, store, DAY, copy)
    jobs.run_week_activity(store, DAY, copy)
    return store


def test_all_results_are_copied(store, copied):
    assert set(copied) == {
        "tm_song_rsi", "tm_singer_rsi", "tm_mac_baseinfo", "tw_mac_loc_d", "TW_CNSM_BRIEF_D",
        "user_7days_active", "tm_machine_rev_infos", "tm_usr_mrchnt_stat_d",
        "tm_mac_region_stat_d",
    }
    for table, (columns, found) in copied.items():
        assert found, table
        if table not in ("tw_mac_loc_d", "user_7days_active"):
            assert columns[0] == "data_dt" and found[0][0] == DAY
    assert max(row.RSI_RANK for row in copied["tm_song_rsi"][1]) == 30


def test_output_columns(store):
    widths = {
        jobs.SONGS: 43, jobs.FEATURES: 29, jobs.MACHINES: 32, jobs.LOCATIONS: 22,
        jobs.LEDGER: 17, jobs.USERS: 17, jobs.STAT: 29, jobs.MERCHANTS: 10, jobs.REGIONS: 9,
        jobs.SONG_RANK: 5, jobs.SINGER_RANK: 5,
    }
    for table, width in widths.items():
        columns = [c for c in store.read(table).columns if c != "data_dt"]
        assert len(columns) == width, table


def test_ranks_have_no_gaps(store):
    for table in (jobs.SONG_RANK, jobs.SINGER_RANK):
        found = store.read(table).groupBy("PERIOD").agg(
            F.sort_array(F.collect_list("RSI_RANK")).alias("ranks")
        )
        periods = {row.PERIOD: row.ranks for row in found.collect()}
        assert set(periods) == {"1", "7", "30"}
        for ranks in periods.values():
            assert ranks == list(range(1, len(ranks) + 1))


def test_first_run_has_no_peaks_and_rerun_is_equal(store):
    peaks = store.read(jobs.FEATURES).agg(F.sum("RCT_30_TOP_SING_CNT")).first()[0]
    assert peaks == 0


def test_next_day_takes_peaks_from_history(store, spark):
    following = shift_day(DAY, 1)
    plays = store.read(jobs.PLAYS).where(F.col("data_dt") == DAY)
    store.replace_day(plays.where("pmod(hash(SONGID), 2) = 0"), jobs.PLAYS, following)
    jobs.run_job("song_features", store, following)
    features = store.read(jobs.FEATURES)
    before = {r.NBR: r.SING_CNT for r in on_day(features, DAY).collect()}
    after = on_day(features, following).collect()
    assert after
    for row in after:
        assert row.RCT_7_TOP_SING_CNT == row.RCT_30_TOP_SING_CNT == before[row.NBR]


def test_empty_day_replaces_a_full_one(spark, tmp_path):
    plays = samples.plays(spark, FOLDER)
    stores = [Warehouse(spark, root=str(tmp_path / "w"))]
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    stores.append(Warehouse(spark, database="shop"))
    spark.sql("CREATE DATABASE IF NOT EXISTS outside")
    stores.append(Warehouse(spark, database="outside", external=str(tmp_path / "ext")))
    for store in stores:
        for day in ("20240129", DAY):
            store.replace_day(on_day(plays, day), "plays", day)
        full = rows(store.read("plays").groupBy("data_dt").count())
        store.replace_day(on_day(plays, DAY), "plays", DAY)
        assert rows(store.read("plays").groupBy("data_dt").count()) == full
        assert len(full) == 2
        store.replace_day(on_day(plays, DAY).limit(0), "plays", DAY)
        assert rows(store.read("plays").groupBy("data_dt").count()) == full[:1]
        assert store.exists("plays") and not store.exists("other")
    kinds = [spark.catalog.getTable(f"{name}.plays").tableType for name in ("shop", "outside")]
    assert kinds == ["MANAGED", "EXTERNAL"] and (tmp_path / "ext" / "plays").is_dir()


def test_failed_write_leaves_the_old_day(spark, tmp_path):
    store = Warehouse(spark, root=str(tmp_path / "w"))
    good = spark.range(5).withColumn("data_dt", F.lit(DAY))
    store.replace_day(good, "t", DAY)
    broken = good.withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        store.replace_day(broken, "t", DAY)
    assert store.read("t").count() == 5
    assert len([p for p in (tmp_path / "w" / "t").iterdir() if "version" in p.name]) == 1
    store.replace_day(good.limit(2), "t", DAY)
    assert store.read("t").count() == 2


def test_scratch_goes_after_a_failure(spark):
    with pytest.raises(ValueError), scratch(spark, "test") as path:
        spark.range(3).write.parquet(path)
        raise ValueError
    assert not Path(path).exists()


def test_only_single_objects_are_plays(spark):
    bodies = ['{"songid":"1"}', ' {"songid":"2","mid":5} ', '{"songid":"1"} junk', "", "\t", "[]",
              '{"songid":"1"}{"songid":"2"}', '{"songid":"1"},{"songid":"2"}', "null", "7", "{}"]
    lines = [(f"a&b&{client_log.PLAY_TABLE}&{body}&e&f",) for body in bodies]
    records = client_log.parse_records(spark.createDataFrame(lines, "value string"))
    plays = client_log.play_records(records).select("SONGID", "MID").collect()
    assert sorted(map(tuple, plays), key=str) == [("1", None), ("2", "5"), (None, None)]
    assert client_log.unreadable_records(records).count() == len(bodies) - 3


def test_catalog_job_reads_its_own_history(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS own")
    store = Warehouse(spark, database="own")
    store.replace(samples.song_catalog(spark, FOLDER), jobs.SONG_INFO)
    plays = samples.plays(spark, FOLDER)
    jobs.run_job("song_dimension", store, DAY)
    for day in (shift_day(DAY, -1), DAY):
        store.replace_day(on_day(plays, day), jobs.PLAYS, day)
        jobs.run_job("song_features", store, day)
        jobs.run_job("song_features", store, day)
    peaks = on_day(store.read(jobs.FEATURES), DAY).agg(F.max("RCT_7_TOP_SING_CNT")).first()[0]
    assert peaks > 0


P = client_log.PLAY_TABLE


def test_log_lines(spark):
    lines = spark.createDataFrame(
        [(f'a&b&{P}&{{"songid":"1","mid":5}}&e&f',), ('a&b&OTHER&{"x":1}&e&f',), ("a&b&c",),
         (f"a&b&{P}&{{}}&e&",), (f"a&b&{P}&bad&e&f",), (f"a&b&{P}&&e&f",)],
        "value string",
    )
    records = client_log.parse_records(lines)
    plays = client_log.play_records(records)
    assert plays.columns == [name.upper() for name in client_log.PLAY_FIELDS]
    assert rows(plays) == [("1", "5", *[None] * 8)]
    assert rows(client_log.unreadable_records(records), "body") == [("",), ("bad",)]
    text = "\t".join(["1", "5", *["null"] * 8])
    assert rows(client_log.routed_text(records)) == [(P, text), ("OTHER", '{"x":1}')]


def test_log_archive(spark, tmp_path):
    """An archive read as compressed text: its header and padding cost no record."""
    log = tmp_path / "day.log"
    log.write_text("".join(f'1&2&{P}&{{"songid":"{n}"}}&e&f\n' for n in range(50)))
    with tarfile.open(tmp_path / "day.tar.gz", "w:gz") as archive:
        archive.add(log, "day.log")
    found = client_log.play_records(
        client_log.parse_records(read_lines(spark, str(tmp_path / "day.tar.gz")))
    )
    assert rows(found, "SONGID") == sorted((str(n),) for n in range(50))


def test_ledger_states(spark):
    names = [c for c in ("ID", "TRD_ID", "UID", "MID", "PRDCD_TYPE", "PAY_TYPE", "ACT_TM", "PKG_ID",
                         "ORDR_ID", "ACTV_NM", "PKG_PRC", "PKG_DSCNT", "CPN_TYPE")]
    kinds = spark.createDataFrame([(k, Decimal(-5)) for k in (1, 2, 3, 4, 9, None)],
                                  "ORDR_TYPE int, AMT decimal(18,2)")
    found = ledger.ledger(
        kinds.select("*", *[F.lit("7").alias(n) for n in names], F.lit(DAY).alias("data_dt")), DAY
    )
    assert [r.ABN_TYP for r in found.collect()] == [0, 1, 2, 2, None, None]
    assert {r.COIN_PRC for r in found.collect()} == {Decimal(5)}


def test_business_mode(spark):
    admin = samples.machine_tables(spark, FOLDER)["admin_map"]
    pairs = [("联营版", 100), ("x", 60), ("x", 100), ("x", None)]
    cases = spark.createDataFrame([(str(i), *p) for i, p in enumerate(pairs)],
                                  "MID string, PKG_NM string, INV_RATE int")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in admin.schema
              if f.name not in cases.columns]
    inputs = samples.machine_tables(spark, FOLDER)
    inputs |= {"admin_map": cases.select("*", *others)}
    found = {r.MID: r.BUS_MODE for r in machines.machine_dimension(**inputs).collect()}
    assert [found[str(i)] for i in range(4)] == ["联营", "联营", "卖断", "卖断"]


def test_blank_first_position_drops_the_machine(spark):
    seen = [(u, "1", "", "") for u in range(5)] + [(u, "1", "30", "120") for u in range(3)]
    seen += [(u, "2", "30", "120") for u in range(2)] + [(9, "2", "31", "121")]
    seen += [(1, "2", "31", "121")] * 0 + [(0, "2", "30", "120")] * 4  # repeats count once
    seen += [(1, "x", "30", "120")]
    df = spark.createDataFrame(seen, "UID int, MID string, LAT string, LNG string")
    dated = df.withColumn("data_dt", F.lit(DAY))
    outside = dated.where("MID = '2'").limit(1).withColumns(
        {"data_dt": F.lit(shift_day(DAY, -31)), "MID": F.lit("7")}
    )
    edge = outside.withColumns({"data_dt": F.lit(shift_day(DAY, -30)), "MID": F.lit("8")})
    found = machines.busiest_positions(dated.unionByName(outside).unionByName(edge), DAY)
    assert rows(found) == [(2, "30", "120", 2), (8, "30", "120", 1)]


def test_positions_match_brute_force(spark):
    """A third of the reports come from one machine; ties, blanks and repeats are common."""
    draw = random.Random(3)
    reports = [
        (draw.choice([None, *range(12)]), "1" if i % 3 == 0 else str(draw.randrange(2, 30)),
         draw.choice(["", "30", "31", None]), draw.choice(["120", "121", ""]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(reports, "UID int, MID string, LAT string, LNG string")
    found = rows(machines.busiest_positions(df.withColumn("data_dt", F.lit(DAY)), DAY))
    counts = Counter((mid, lat, lng) for _, mid, lat, lng in set(reports))
    wanted = []
    for machine in {mid for mid, _, _ in counts}:
        places = [(-n, lat is not None, lat or "", lng)  # a missing latitude sorts first
                  for (mid, lat, lng), n in counts.items() if mid == machine]
        n, _, lat, lng = min(places)
        if lat and lng:
            wanted.append((int(machine), lat, lng, -n))
    assert found == sorted(wanted, key=str) and len(found) > 5


def test_geocoder_answers(spark):
    body = ('{"formatted_address":"F","addressComponent":{"province":"P","city":[],'
            '"building":{"name":"B"},"businessAreas":[{"id":1}]}}')
    answers = [("20.14", "100.25", body), ("20.13", "100.25", "bad"), ("1", "2", "bad"),
               ("3", "4", "{}")]
    df = spark.createDataFrame(answers, "lat string, lng string, answer string")
    found = gazetteer.parse_answers(df).collect()
    assert len(found) == 1
    row = found[0].asDict()
    assert (row["lat"], row["lng"]) == ("20.14", "100.25")
    assert (row["ADDR"], row["PRVC"], row["BD_NM"], row["STREET"]) == ("F", "P", "B", "")
    assert (row["CTY"], row["BUS_INFO"]) == ("[]", '[{"id":1}]')


def answer(name):
    return f'{{"formatted_address":"{name}","addressComponent":{{}}}}'


def test_nearest_answers_equal_brute_force(spark):
    """Random places, many on edges of cells and equally far, some failed, some far away."""
    draw = random.Random(11)

    def place():
        return f"{draw.choice([0, -1, 30])}.{draw.choice(['', '0', '00', '09', '1'])}{draw.randrange(30)}"

    known = [(place(), place(), answer(n) if n % 7 else "bad") for n in range(500)]
    asked = sorted({(place(), place()) for _ in range(300)}) + [("", "1"), ("x", "1"), (None, "2")]
    answers = spark.createDataFrame(known, "lat string, lng string, answer string")
    positions = spark.createDataFrame(asked, "X string, Y string")
    found = gazetteer.nearest_answers(positions, answers, (3, 2, 1))
    got = {(r.X, r.Y): r.ADDR for r in found.collect()}
    wanted = {}
    for x, y in asked:
        if not x or x == "x":
            continue
        near = [
            ((Decimal(a) - Decimal(x)) ** 2 + (Decimal(b) - Decimal(y)) ** 2, Decimal(a), Decimal(b), text)
            for a, b, text in known if text != "bad"
        ]
        least = min(near)
        if least[0] <= Decimal("0.01"):
            wanted[x, y] = least[3].split('"')[3]
    assert got == wanted and 30 < len(wanted) < len(asked)


def test_carry_forward_keeps_absent_and_unnamed_machines(spark):
    today = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    old = spark.createDataFrame([(2, "x"), (3, "y"), (3, "y"), (None, "z")], "k int, v string")
    wanted = rows(spark.createDataFrame(
        [(1, "a"), (2, "b"), (None, "n"), (3, "y"), (3, "y"), (None, "z")], "k int, v string"
    ))
    for limit in (1 << 20, 0):
        assert rows(carry_forward(today, old, "k", limit)) == wanted
    assert rows(carry_forward(today.limit(0), old, "k")) == rows(old)


def test_refunds_need_revenue_of_the_same_key(spark):
    ledger_rows = [
        # MID, PKG_ID, PAY_TYPE, UID, ABN_TYP, ORDR_ID, COIN_PRC
        ("1", 1, 1, "u1", 0, "a", 10), ("1", 1, 1, "u1", 0, None, 5), ("1", 1, 1, None, 0, "b", 1),
        ("1", 1, 1, "u2", 2, "c", 3), ("1", 1, 1, "u1", 2, "d", 4), ("1", 1, 1, "u3", 1, "e", 99),
        ("1", 2, 1, "u1", 2, "f", 7),
        ("1", 1, None, "u1", 0, "g", 2), ("1", 1, None, "u1", 2, "h", 2),
    ]
    df = spark.createDataFrame(
        [(*r, 1) for r in ledger_rows],
        "MID string, PKG_ID int, PAY_TYPE int, UID string, ABN_TYP int, ORDR_ID string, "
        "COIN_PRC int, COIN_CNT int",
    )
    found = rows(revenue.machine_turnover(df), "PAY_TYPE", "CNSM_USR_CNT", "REV_ORDR_CNT",
                 "TOT_REV", "REF_USR_CNT", "REF_ORDR_CNT", "TOT_REF")
    assert found == [
        (1, 1, 2, Decimal(16), 2, 2, Decimal(7)),
        (None, 1, 1, Decimal(2), 0, 0, Decimal(0)),
    ]


def test_turnover_equals_plain_counts(spark):
    """Random ledger with one busy machine and missing keys, counted row by row."""
    draw = random.Random(7)
    ledger_rows = [
        ("hot" if i % 3 == 0 else f"m{draw.randrange(8)}", draw.choice([1, 2, None]),
         draw.choice([1, 2, None]), draw.choice([None, *(f"u{n}" for n in range(25))]),
         draw.choice([0, 1, 2, None]), draw.choice([None, "o"]), draw.choice([None, 1, 5]), 1)
        for i in range(1500)
    ]
    df = spark.createDataFrame(
        ledger_rows,
        "MID string, PKG_ID int, PAY_TYPE int, UID string, ABN_TYP int, ORDR_ID string, "
        "COIN_PRC int, COIN_CNT int",
    )
    seen: dict = {}
    for mid, package, payment, uid, state, order, price, count in ledger_rows:
        if state in (0, 2):
            people, orders, money = seen.setdefault((mid, package, payment), {}).setdefault(
                state, (set(), [], [])
            )
            people.update({uid} - {None})
            orders.extend([order] if order else [])
            money.extend([price * count] if price is not None else [])
    wanted = []
    for key, states in seen.items():
        if 0 in states:
            refund = states.get(2) if None not in key[1:] else None
            sides = (states[0], refund or (set(), [], []))
            wanted.append([*key, *(x for u, o, m in sides for x in (len(u), len(o), sum(m)))])
    found = rows(revenue.machine_turnover(df), "MID", "PKG_ID", "PAY_TYPE", "CNSM_USR_CNT",
                 "REV_ORDR_CNT", "TOT_REV", "REF_USR_CNT", "REF_ORDR_CNT", "TOT_REF")
    assert len(found) > 50

    def plain(records):
        return sorted([[str(v) for v in r[:3]] + [float(v) for v in r[3:]] for r in records])

    assert plain(found) == plain(wanted)


def test_week_activity_counts_rows(spark):
    base = dict.fromkeys(("REF_UID", "BIRTHDAY", "MSISDN", "REG_DT", "LEVEL"), "v")
    days = {"in": [DAY], "twice": [DAY, shift_day(DAY, -7)], "old": [shift_day(DAY, -1)],
            "outside": [DAY, shift_day(DAY, -8)], "doubled": [DAY, DAY]}
    base |= {"REG_CHNL": "2", "GDR": "2"}
    df = spark.createDataFrame([dict(base, UID=u, data_dt=d) for u in days for d in days[u]])
    assert [r[0] for r in rows(users.week_activity(df, DAY), "UID")] == ["in", "outside"]
    twice = [r[0] for r in rows(users.week_activity(df, DAY, 2), "UID")]
    assert twice == ["doubled", "doubled", "twice"]
    assert rows(users.week_activity(df, DAY), "REG_CHNL", "GDR")[0] == ("支付宝", "女")


PLAYED = "SONGID string, UID string, ORDER_ID string, data_dt string"


def random_plays(spark, days, seed, n=1500):
    """One song with a third of the plays, users that come again, missing values."""
    draw = random.Random(seed)
    return [
        ("hot" if i % 3 == 0 else f"s{draw.randrange(6)}",
         draw.choice([None, *(f"u{k}" for k in range(40))]), draw.choice([None, f"o{i // 4}"]),
         shift_day(DAY, -draw.choice(days)))
        for i in range(n)
    ]


def windows_of(store, day):
    counts = trailing_counts(
        store.read_days(jobs.SONG_GAPS, shift_day(day, -30), day), "NBR", list(songs.COUNTED),
        day, songs.PREFIXES, "SING_CNT",
    ).where("SING_CNT > 0")
    return {r["NBR"]: r.asDict() for r in counts.collect()}


def plain_windows(plays, day):
    found = {}
    for back, prefix in songs.PREFIXES.items():
        inside = [p for p in plays if shift_day(day, -back) <= p[3] <= day]
        for song in {p[0] for p in plays if p[3] == day}:
            of = [p for p in inside if p[0] == song]
            found.setdefault(song, {"NBR": song}).update({
                f"{prefix}SING_CNT": len(of),
                f"{prefix}USR_CNT": len({p[1] for p in of} - {None}),
                f"{prefix}ORDR_CNT": len({p[2] for p in of} - {None}),
            })
    return found


@pytest.fixture
def kept(spark, tmp_path):
    def made(plays):
        store = Warehouse(spark, root=str(tmp_path / "kept"))
        store.load_days(spark.createDataFrame(plays, PLAYED), jobs.PLAYS)
        return store

    return made


def test_kept_counts_equal_plain_counts_day_by_day(spark, kept):
    plays = random_plays(spark, [0, 1, 2, 5, 7, 8, 9, 29, 30, 31, 37, 45], 1)
    store = kept(plays)
    for back in (5, 2, 1, 0):  # days between are loaded when they are needed
        day = shift_day(DAY, -back)
        jobs.keep_song_days(store, day)
        assert windows_of(store, day) == plain_windows(plays, day)


def test_a_day_reads_only_its_own_plays(spark, kept, monkeypatch):
    store = kept(random_plays(spark, range(40), 2))
    jobs.keep_song_days(store, shift_day(DAY, -1))
    read, plain = [], Warehouse.read_days

    def noted(self, table, first, last=None):
        if table == jobs.PLAYS:
            read.append((first, last))
        return plain(self, table, first, last)

    monkeypatch.setattr(Warehouse, "read_days", noted)
    jobs.keep_song_days(store, DAY)
    assert read == [(DAY, None)]


def test_a_late_rerun_of_an_old_day_gives_the_same(spark, kept):
    plays = random_plays(spark, range(50), 3, 4000)
    store = kept(plays)
    jobs.keep_song_days(store, DAY)
    wanted = windows_of(store, DAY)
    for back in (12, 20, 3):
        day = shift_day(DAY, -back)
        jobs.keep_song_days(store, day)
        assert windows_of(store, day) == plain_windows(plays, day)
    assert shift_day(DAY, -1) in store.days(jobs.SONG_GAPS)  # nothing had changed
    assert windows_of(store, DAY) == wanted == plain_windows(plays, DAY)


def test_late_plays_of_an_old_day_are_counted(spark, kept):
    plays = random_plays(spark, range(35), 4)
    store, old = kept(plays), shift_day(DAY, -6)
    jobs.keep_song_days(store, DAY)
    more = [("hot", f"late{n}", "late", old) for n in range(5)]
    day_rows = [p for p in plays if p[3] == old] + more
    store.replace_day(spark.createDataFrame(day_rows, PLAYED), jobs.PLAYS, old)
    jobs.keep_song_days(store, old)
    assert shift_day(DAY, -5) not in store.days(jobs.SONG_GAPS)  # may lack the new values
    jobs.keep_song_days(store, DAY)
    assert windows_of(store, DAY) == plain_windows(plays + more, DAY)


def test_kept_counts_in_a_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept_days")
    plays = random_plays(spark, [0, 1, 4, 30, 31], 5, 300)
    store = Warehouse(spark, database="kept_days")
    store.load_days(spark.createDataFrame(plays, PLAYED), jobs.PLAYS)
    for back in (1, 0):
        jobs.keep_song_days(store, shift_day(DAY, -back))
    assert windows_of(store, DAY) == plain_windows(plays, DAY)


def test_trailing_windows_hold_both_ends(spark):
    plays = spark.createDataFrame(
        [("5", "u", "o", shift_day(DAY, -n)) for n in (0, 7, 8, 30, 31)],
        "SONGID string, UID string, ORDER_ID string, data_dt string",
    )
    dimension = songs.song_dimension(samples.song_catalog(spark, FOLDER))
    history = spark.createDataFrame(
        [("5", n, 0, shift_day(DAY, -n)) for n in (0, 7, 30, 31)],
        "NBR string, SING_CNT bigint, SUPP_CNT bigint, data_dt string",
    )
    row = songs.song_features(plays, dimension, history, DAY).first()
    assert (row.SING_CNT, row.RCT_7_SING_CNT, row.RCT_30_SING_CNT) == (1, 2, 4)
    assert (row.USR_CNT, row.RCT_30_USR_CNT, row.RCT_30_ORDR_CNT) == (1, 1, 1)
    assert (row.RCT_7_TOP_SING_CNT, row.RCT_30_TOP_SING_CNT) == (7, 30)


class Writer:
    """Stands in for a DataFrame's JDBC writer; no database is started."""

    def __init__(self, log, fails):
        self.log, self.fails, self.set = log, fails, {}

    def format(self, kind):
        self.set["format"] = kind
        return self

    def mode(self, mode):
        self.set["mode"] = mode
        return self

    def options(self, **given):
        self.set |= given
        return self

    def save(self):
        self.log.append(("load", self.set["dbtable"], self.set["mode"], self.set))
        if self.fails == self.set["dbtable"]:
            raise OSError("lost")


class Rows:
    columns, sparkSession = ["a", "b"], None

    def __init__(self, log, fails=None):
        self.log, self.fails = log, fails

    write = property(lambda self: Writer(self.log, self.fails))

    def limit(self, n):
        return self


def connection(log, fails=None):
    class Opened:
        def quoted(self, column):
            return f"`{column}`"

        def run(self, statements):
            log.append(("together", statements))
            if fails:
                raise OSError("lost")

        def close(self):
            log.append(("closed",))

    return lambda *given: log.append(("open", *given[1:])) or Opened()


def test_results_are_loaded_beside_and_published_in_one_transaction():
    log = []
    jdbc.replace_table(Rows(log), "jdbc:x", "t", {"user": "u"}, connect=connection(log))
    assert [entry[:3] for entry in log[:2]] == [("load", "t_load", "overwrite"), ("load", "t", "append")]
    assert log[0][3] == {"format": "jdbc", "mode": "overwrite", "user": "u", "url": "jdbc:x",
                         "dbtable": "t_load", "numPartitions": "8"}
    assert log[2:] == [
        ("open", "jdbc:x", "t", {"user": "u"}),
        ("together", ["DELETE FROM t", "INSERT INTO t (`a`, `b`) SELECT `a`, `b` FROM t_load"]),
        ("together", ["DROP TABLE t_load"]),
        ("closed",),
    ]


@pytest.mark.parametrize("fails", ["t_load", "publish"])
def test_a_failed_load_or_publication_leaves_the_table(fails):
    log = []
    with pytest.raises(OSError, match="lost"):
        jdbc.replace_table(
            Rows(log, fails), "jdbc:x", "t", connect=connection(log, fails == "publish")
        )
    touched = [entry for entry in log if entry[0] == "load" and entry[1:3] == ("t", "overwrite")]
    assert not touched
    if fails == "t_load":
        assert len(log) == 1
    else:
        assert log[-1] == ("closed",) and [e[0] for e in log].count("together") == 1


class Database:
    """A connection that notes what is called."""

    def __init__(self, fails):
        self.calls, self.fails = [], fails

    def __getattr__(self, name):
        def call(*given):
            self.calls.append((name, *given))
            if given and given[0] == self.fails:
                raise OSError("lost")
            return self

        return call


@pytest.mark.parametrize("fails", [None, "two"])
def test_statements_are_one_transaction(fails):
    opened = jdbc.Connection.__new__(jdbc.Connection)
    opened._open = database = Database(fails)
    if fails:
        with pytest.raises(OSError):
            opened.run(["one", "two"])
    else:
        opened.run(["one", "two"])
    assert database.calls == [
        ("setAutoCommit", False), ("createStatement",), ("executeUpdate", "one"),
        ("executeUpdate", "two"), ("rollback",) if fails else ("commit",), ("close",),
    ]


def test_command_line(store, spark):
    before = rows(store.read(jobs.LEDGER))
    jobs.main(["ledger", "--date", DAY, "--root", store.root], spark)
    assert rows(store.read(jobs.LEDGER)) == before
    with pytest.raises(SystemExit):
        jobs.main(["ledger", "--root", store.root], spark)
