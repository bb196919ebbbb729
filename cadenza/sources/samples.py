"""The source systems' tables, derived from the sample star schema.

Every sample row takes part. Keys keep their range, so work grows with the tables; ship
dates fold into 35 days so that each day holds a steady share of all rows.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadenza.functions.dates import shift_day
from cadenza.plans.client_log import PLAY_FIELDS, PLAY_TABLE
from cadenza.plans.machines import LOCATION_COLUMNS
from cadenza.plans.songs import PLAIN_TAIL
from cadenza.sources.tables import DAY

RUN_DAY = "20240130"
CALENDAR_START = "20231227"
FIRST_SHIP_DAY = "1995-01-02"
CALENDAR_DAYS = 35
MINUTES = {"click": ".10", "view": ".20", "purchase": ".30"}  # latitude by event type
# Further decimals of the latitude by nation: on the answer, beside it (and with its longitude
# across a cell's edge), in a wider grid only, on the answer (its longitude is moved), nearer to a
# second answer, half-way between two.
BESIDE = ("", "00006", "7", "", "15", "1")
SECOND = "2"  # decimal of the second answer

# Addresses for the repair rules; {} takes the nation's name.
ADDRESSES = (
    "内蒙古自治区{}市新城区",
    "宁夏回族自治区{}市兴庆区",
    "广西壮族自治区{}市青秀区",
    "西藏自治区{}市城关区",
    "新疆维吾尔自治区{}市天山区",
    "新疆维吾尔自治区{}自治州霍城县",
    "新疆维吾尔自治区{}地区温宿县",
    "北京市{}区",
    "重庆市{}区解放碑",
    "重庆市{}县",
    "湖南省{}市岳麓区",
    "云南省{}自治州祥云县",
    "内蒙古自治区{}盟",
)


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _pick(key: Column, *choices) -> Column:
    """Choice number ``key``; the last one for any other key."""
    columns = [c if isinstance(c, Column) else F.lit(c).cast("string") for c in choices]
    cases = list(enumerate(columns[:-1]))

    def choose(rest: Column, case: tuple[int, Column]) -> Column:
        return F.when(key == case[0], case[1]).otherwise(rest)

    return reduce(choose, cases, columns[-1])


@lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> StructType:
    """Read from the file footers once per session."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _fact(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A large table, spread over the cores when its scan has fewer tasks than that;
    with enough of them nothing is shuffled."""
    rows, cores = table(spark, folder, name), spark.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def _ship_day() -> Column:
    offset = F.pmod(F.datediff("l_shipdate", F.lit(FIRST_SHIP_DAY)), F.lit(CALENDAR_DAYS))
    days = [shift_day(CALENDAR_START, n) for n in range(CALENDAR_DAYS)]
    return F.get(F.array(*map(F.lit, days)), offset)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = _fact(spark, folder, "lineitem", "l_orderkey"), table(spark, folder, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def plays(spark: SparkSession, folder: str) -> DataFrame:
    """Play log; anonymous plays have no user."""
    return _lines(spark, folder).select(
        _text("l_partkey").alias("SONGID"),
        _text("l_suppkey").alias("MID"),
        F.col("l_returnflag").alias("OPTRATE_TYPE"),
        F.when(F.col("l_linenumber") != 7, _text("o_custkey")).alias("UID"),
        F.col("l_linestatus").alias("CONSUME_TYPE"),
        _text(F.col("l_quantity").cast("int")).alias("DUR_TIME"),
        _text("l_orderkey").alias("SESSION_ID"),
        F.concat(F.lit("song "), _text("l_partkey")).alias("SONGNAME"),
        _text("l_linenumber").alias("PKG_ID"),
        F.concat(F.lit("O"), _text(F.floor(F.col("l_orderkey") / 8))).alias("ORDER_ID"),
        _ship_day().alias(DAY),
    )


def _broken_body(body: Column, number: Column) -> Column:
    """A body cut short, with text behind it, given twice, or blank."""
    return _pick(
        F.floor(number / 10) % 4,
        F.substring(body, 1, 20),
        F.concat(body, F.lit(" junk")),
        F.concat(body, body),
        "\t",
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw log text of all plays, with other tables and broken lines among them."""
    rows = plays(spark, folder)
    body = F.to_json(F.struct(*[F.col(name.upper()).alias(name) for name in PLAY_FIELDS]))
    kind = F.col("SESSION_ID").cast("bigint") % 10
    name = F.when(kind == 0, F.concat(F.lit("OTHER_"), F.col("OPTRATE_TYPE"))).otherwise(PLAY_TABLE)
    content = (
        F.when(kind == 0, F.concat(F.lit('{"x":'), F.col("DUR_TIME"), F.lit("}")))
        .when(kind == 3, _broken_body(body, F.col("SESSION_ID").cast("bigint")))
        .otherwise(body)
    )
    tail = F.when(kind == 2, F.lit("e&")).otherwise(F.lit("e&f"))
    full = F.concat_ws("&", F.lit("1.0"), F.col("SESSION_ID"), name, content, tail)
    return rows.select(F.when(kind == 1, F.lit("a&b&c")).otherwise(full).alias("value"))


def song_catalog(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    brand = F.substring_index("p_brand", "#", -1).cast("int")
    singer = brand * 100 + size
    one = F.concat(
        F.lit('{"name":"Singer '), _text(singer), F.lit('","id":'), _text(singer), F.lit("}")
    )
    two = F.concat(F.lit('{"name":"Guest '), _text(size), F.lit('","id":'), _text(size), F.lit("}"))
    released = F.date_add(F.lit("2010-01-01").cast("date"), (key % 3000).cast("int"))
    day = F.date_format(released, "yyyy-MM-dd")
    album = F.concat(F.lit('[{"name":"Album '), F.col("p_brand"), F.lit('","id":1}]'))
    single = F.concat(F.lit("["), one, F.lit("]"))
    company = F.concat(F.lit('{"name":"Co '), F.col("p_brand"), F.lit('"}'))
    kinds = [F.concat(F.lit("["), _text(size), F.lit(end)) for end in (".0,9.5]", ".7]")]
    return table(spark, folder, "part").select(
        F.when(key % 31 == 30, F.lit("")).otherwise(_text(key)).alias("NBR"),
        F.when(size != 1, F.col("p_name")).alias("NAME"),
        F.concat(F.lit("other "), F.col("p_name")).alias("OTHER_NAME"),
        F.col("p_type").alias("SOURCE"),
        _pick(key % 6, album, F.concat(F.lit("live 《"), F.col("p_name"), F.lit("》 disc")),
              "single", "", '[{"id":1}]', None).alias("ALBUM"),
        F.col("p_brand").alias("PRDCT"),
        F.concat(F.lit("L"), _text(size % 5)).alias("LANG"),
        F.col("p_type").alias("VIDEO_FORMAT"),
        size.alias("DUR"),
        _pick(key % 5, F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")), single, single,
              "[]", "bad").alias("SINGER_INFO"),
        _pick(key % 4, F.concat(day, F.lit(" 03:04:05")), _text(F.lit(1577934245000) + key * 1000),
              "x", None).alias("POST_TIME"),
        *[_text(key % (place + 2)).alias(name) for place, name in enumerate(PLAIN_TAIL)],
        _pick((key / 4).cast("bigint") % 4, company, "{}", "bad", None).alias("AUTH_CO"),
        _text(key % 2).alias("STATE"),
        _pick((key / 2).cast("bigint") % 4, kinds[0], " ", "[]", kinds[1]).alias("PRDCT_TYPE"),
    )


def consumption(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of all types; returned items have negative amounts."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    kind = (
        F.when(flag == "N", 1).when(flag == "R", 4).when(status == "F", 2).otherwise(3)
    )
    day = _ship_day()
    return _lines(spark, folder).select(
        _text(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"),
        F.concat(F.lit("T"), _text("l_orderkey")).alias("TRD_ID"),
        F.col("o_custkey").alias("UID"),
        _text("l_suppkey").alias("MID"),
        F.lit(2).alias("PRDCD_TYPE"),
        F.when(F.col("l_linenumber") != 6, (F.col("o_orderkey") % 2).cast("int")).alias("PAY_TYPE"),
        F.concat(day, F.lit("120000")).alias("ACT_TM"),
        (F.col("l_linenumber") % 2).alias("PKG_ID"),
        F.when(flag == "R", -price).otherwise(price).cast("decimal(18,2)").alias("AMT"),
        F.when(F.col("o_orderstatus") != "P", _text("o_orderkey")).alias("ORDR_ID"),
        F.col("o_orderpriority").alias("ACTV_NM"),
        price.alias("PKG_PRC"),
        F.col("l_discount").cast("decimal(4,2)").alias("PKG_DSCNT"),
        F.col("o_orderstatus").alias("CPN_TYPE"),
        kind.alias("ORDR_TYPE"),
        day.alias(DAY),
    )


def machine_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Arguments of ``machine_dimension``: some machines are known to one system only."""
    suppliers, nations = table(spark, folder, "supplier"), table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    mid = _text(key).alias("MID")
    version = F.concat(F.lit("v"), _text(key % 3))
    placed = suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).join(
        regions, nations["n_regionkey"] == regions["r_regionkey"]
    )
    before, after = zip(*(form.split("{}") for form in ADDRESSES))
    form = (key % len(ADDRESSES)).cast("int")
    opening, closing = (F.get(F.array(*map(F.lit, part)), form) for part in (before, after))
    address = F.concat(opening, "n_name", closing)
    return {
        "machines": suppliers.where(nation != 3).select(
            mid,
            F.concat(F.lit("H"), _text(key)).alias("HARD_ID"),
            version.alias("SONG_WHSE_VER"),
            version.alias("EXEC_VER"),
            version.alias("UI_VER"),
            F.when(key % 4 != 0, (key % 2).cast("int")).alias("STS"),
            F.concat(F.lit("2024012"), _text(key % 10), F.lit("101010")).alias("CUR_LOGIN_TM"),
            F.when(key % 3 != 0, (key % 2).cast("int")).alias("PAY_SW"),
        ),
        "locations": placed.select(
            mid,
            F.when(key % 4 == 0, F.col("r_name")).otherwise("null").alias("PRVC"),
            F.when(key % 4 == 3, F.lit("null")).when(key % 4 == 0, F.col("n_name"))
            .when(key % 8 == 5, F.lit("half")).otherwise("null").alias("CTY"),
            F.when(key % 9 != 8, address).alias("ADDR"),
            F.when(key % 5 != 0, address).alias("ADDR_FMT"),
            _pick(key % 3, "20200101", "20200101123000", "2020").alias("REV_TM"),
            _pick(key % 4, "20190101", "20190101010203", "", None).alias("SALE_TM"),
        ),
        "admin_map": placed.where(nation != 5).select(
            mid,
            F.col("s_name").alias("MAC_NM"),
            F.when(key % 5 == 0, F.lit("联营版")).otherwise("std").alias("PKG_NM"),
            F.when(key % 7 != 0, (key % 80 + 40).cast("int")).alias("INV_RATE"),
            (key % 30).cast("int").alias("AGE_RATE"),
            (key % 20).cast("int").alias("COM_RATE"),
            F.when(key % 6 != 0, (key % 10).cast("int")).alias("PAR_RATE"),
            (key % 2).cast("int").alias("IS_ACTV"),
            _pick(key % 3, "20210101", "20210101000001", "x").alias("ACTV_TM"),
            (key % 2).cast("int").alias("HAD_MPAY_FUNC"),
            F.col("n_regionkey").alias("SCENE_PRVC_ID"),
            nation.alias("SCENE_CTY_ID"),
            (nation * 10 + (key % 3).cast("int")).alias("SCENE_AREA_ID"),
            F.concat(F.lit("scene "), _text(key)).alias("SCENE_ADDR"),
            F.when(key % 6 != 0, F.concat(F.lit(" ground "), _text(key))).alias("GROUND_NM"),
        ),
        "provinces": regions.select(
            F.col("r_regionkey").alias("PRVC_ID"), F.col("r_name").alias("PRVC")
        ),
        "cities": nations.select(
            F.col("n_nationkey").alias("CTY_ID"), F.col("n_name").alias("CTY")
        ),
        "areas": nations.select(
            "n_name", F.col("n_nationkey"), F.explode(F.array(F.lit(0), F.lit(1))).alias("part")
        ).select(
            (F.col("n_nationkey") * 10 + F.col("part")).alias("AREA_ID"),
            F.concat("n_name", F.lit(" area "), _text("part")).alias("AREA"),
        ),
        "store_map": suppliers.where(nation != 11).select(
            mid, F.concat(F.lit("S"), _text(F.floor(key / 5))).alias("STORE_ID")
        ),
        "stores": suppliers.select(
            F.concat(F.lit("S"), _text(key)).alias("ID"),
            F.concat(F.lit("store "), _text(key)).alias("GROUND_NM"),
            F.concat(F.lit("tag "), _text(key % 4)).alias("TAG_NM"),
            F.concat(F.lit("subtag "), _text(key % 5)).alias("SUB_TAG_NM"),
            F.concat(F.lit("subcat "), _text(key % 6)).alias("SUB_SCENE_CATGY_NM"),
            F.concat(F.lit("subscene "), _text(key % 7)).alias("SUB_SCENE_NM"),
            F.concat(F.lit("brand "), _text(key % 8)).alias("BRND_NM"),
            F.concat(F.lit("subbrand "), _text(key % 9)).alias("SUB_BRND_NM"),
        ),
    }


def channel_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Users of the four channels; some are in two."""
    key = F.col("c_custkey")
    day = F.date_format(
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int")), "yyyyMMdd"
    )
    common = table(spark, folder, "customer").select(
        key.alias("UID"),
        _text(F.floor(key / 15)).alias("REG_MID"),
        F.concat(F.lit("acct"), _text(key)).alias("account"),
        _pick(key % 5, "0", "1", "2", "9", None).alias("GDR"),
        F.concat(F.lit("1990-01-"), F.lpad(_text(key % 28 + 1), 2, "0")).alias("BIRTHDAY"),
        F.concat(F.lit("139"), _text(key)).alias("MSISDN"),
        F.col("c_nationkey").alias("LOC_ID"),
        _text(key % 3).alias("LOG_MDE"),
        F.concat(day, F.lit("1530"), F.lpad(_text(key % 60), 2, "0")).alias("REG_TM"),
        (key % 500).alias("USR_EXP"),
        (key % 70).alias("SCORE"),
        (key % 9).cast("int").alias("LEVEL"),
        F.when(key % 2 == 0, F.lit("1")).alias("USR_TYPE"),
        _text(key % 2).alias("IS_CERT"),
        _text(key % 3).alias("IS_STDNT"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    segment = F.col("segment")
    own_types = ("USR_TYPE", "IS_CERT", "IS_STDNT")

    def channel(rows: Column, account: str, *absent: str) -> DataFrame:
        return common.where(rows).withColumnRenamed("account", account).drop(
            "segment", "nation", *absent
        )

    return {
        "wechat": channel(segment.isin("AUTOMOBILE", "BUILDING"), "WX_ID", *own_types),
        "alipay": channel(segment == "FURNITURE", "ALY_ID"),
        "qq": channel(segment == "HOUSEHOLD", "QQID", *own_types),
        "app": channel(
            (segment == "MACHINERY") | (F.col("nation") == 7),
            "APP_ID",
            *own_types,
            "LOG_MDE",
            "SCORE",
        ),
    }


def _events(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    return _fact(spark, folder, "events", "event_id").select(
        "user_id", "event_type", ts.alias("ts"), k.alias("k"),
        (F.col("user_id") * 10 + k % 10).alias("UID"),
        F.date_format(ts, "yyyyMMdd").alias(DAY),
    )


def logins(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("UID", DAY)


def user_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Positions users reported at machines; some blank or missing."""
    nation = F.col("user_id") % 25
    kind = F.col("event_type")
    minutes = F.try_element_at(F.create_map(*[F.lit(t) for m in MINUTES.items() for t in m]), kind)
    near = F.get(F.array(*map(F.lit, BESIDE)), (nation % 6).cast("int"))
    east = F.when(nation % 6 == 3, ".2503").when(nation % 6 == 1, ".2499996").otherwise(".25")
    lat = F.when(kind == "error", "").otherwise(F.concat(_text(nation + 20), minutes, near))
    lng = F.when(kind == "error", "").otherwise(F.concat(_text(nation + 100), east))
    return _events(spark, folder).select(
        "UID", _text(F.col("user_id") + 5).alias("MID"), lat.alias("LAT"), lng.alias("LNG"), DAY
    )


def geocoder_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Stored answers at the positions of each nation, a second one beside some; those of two
    nations are failures."""
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    key, name, second = F.col("n_nationkey"), F.col("n_name"), F.col("second")
    street = F.when(second, "Side Street").otherwise("Main Street")
    number = F.when(second, "2").otherwise("1")
    answer = F.to_json(
        F.struct(
            F.concat(number, F.lit(" "), street, F.lit(", "), name).alias("formatted_address"),
            F.struct(
                F.col("r_name").alias("province"),
                name.alias("city"),
                _text(key).alias("citycode"),
                F.concat(name, F.lit(" district")).alias("district"),
                F.struct(F.concat(name, F.lit(" quarter")).alias("name")).alias("neighborhood"),
                F.struct(street.alias("street"), number.alias("number")).alias("streetNumber"),
            ).alias("addressComponent"),
        )
    )
    failed = F.when(key == 24, F.lit("bad")).when(key == 23, F.lit('{"formatted_address":"?"}'))
    minutes = F.explode(F.array(*map(F.lit, MINUTES.values())))
    return (
        nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"])
        .select("*", minutes.alias("minutes"))
        .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("second"))
        .where(~second | (key % 6 >= 4))
        .select(
            F.concat(
                _text(key + 20), F.col("minutes"), F.when(second, SECOND).otherwise("")
            ).alias("lat"),
            F.concat(_text(key + 100), F.lit(".25")).alias("lng"),
            F.coalesce(failed, answer).alias("answer"),
        )
    )


def installed_locations(spark: SparkSession, folder: str) -> DataFrame:
    """Yesterday's snapshot: each machine where it was installed."""
    key = F.col("s_suppkey")
    known = {
        "MID": key.cast("int"),
        "X": F.lit("10.5"),
        "Y": F.lit("20.5"),
        "CNT": F.lit(1),
        "ADDR": F.concat(F.lit("site "), F.col("s_name")),
        "PRVC": F.lit("old province"),
        "CTY": F.concat(F.lit("old city "), _text("s_nationkey")),
        "DISTRICT": F.lit("old district"),
    }
    return table(spark, folder, "supplier").select(
        *[known.get(name, F.lit("")).alias(name) for name in LOCATION_COLUMNS]
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """(value, timestamp) of all events; some lack a field or are broken."""
    body = F.to_json(
        F.struct(
            F.when(F.col("k") != 99, _text("k")).alias("mid"),
            F.when(F.col("event_type") != "error", _text("user_id")).alias("uid"),
            _text(F.col("user_id") % 97).alias("songid"),
            F.concat(F.lit("song "), _text(F.col("user_id") % 97)).alias("songname"),
        )
    )
    return _events(spark, folder).select(
        F.when(F.col("k") == 98, F.lit("broken")).otherwise(body).alias("value"),
        F.col("ts").alias("timestamp"),
    )


# The replayed log: so many files of messages, which come out of order by less than DELAY.
BATCHES, DELAY = 3, "2 hours"
_EVENTS_FROM, _SPAN_DAYS, _JITTER = "2024-01-01", 10, 3000


def arrival_part() -> Column:
    """The file in which a message comes: by its time, moved by up to 50 minutes."""
    at = F.unix_timestamp("timestamp") - F.unix_timestamp(F.lit(_EVENTS_FROM).cast("timestamp"))
    moved = at + F.pmod(at * 7919, F.lit(2 * _JITTER)) - _JITTER
    part = F.floor(moved / (_SPAN_DAYS * 86400))
    return F.greatest(F.lit(0), F.least(F.lit(BATCHES - 1), part)).cast("int")


def end_message(spark: SparkSession, folder: str) -> DataFrame:
    """A message late enough to close all windows but its own, which stay open."""
    last = F.max(F.col("ts").cast("timestamp")) + F.expr("INTERVAL 120 DAYS")
    body = '{"mid":"end","uid":"end","songid":"end","songname":"end"}'
    return table(spark, folder, "events").agg(last.alias("timestamp")).select(
        F.lit(body).alias("value"), "timestamp"
    )
