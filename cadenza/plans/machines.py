"""Machine dimension from two source systems, and the daily location snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.address import MISSING, repair_city, repair_province
from cadenza.functions.dates import pad_time, shift_day
from cadenza.operators.ranking import top_n
from cadenza.operators.snapshot import carry_forward
from cadenza.session import checkpointed
from cadenza.sources.gazetteer import ADDRESS_FIELDS, nearest_answers
from cadenza.sources.tables import between_days

# Fixed values.
PRODUCT_TYPE = 2
JOINT_PACKAGE = "联营版"
JOINT_MODE, SOLD_MODE = "联营", "卖断"
FULL_RATE = 100
LOCATION_DAYS = 30
GRIDS = (4, 3, 2)  # decimals of the grids in which the nearest answer is sought

LOCATION_COLUMNS = ("MID", "X", "Y", "CNT", *ADDRESS_FIELDS)


def repaired_locations(locations: DataFrame) -> DataFrame:
    """Locations with province and city, read from the address where both are missing.

    A row with just one of them missing is dropped, as is a row left without either.
    """
    no_province, no_city = F.col("PRVC") == MISSING, F.col("CTY") == MISSING
    return (
        locations.where((no_province & no_city) | (~no_province & ~no_city))
        .withColumns(
            {
                "PRVC": repair_province(F.col("PRVC"), F.col("ADDR")),
                "CTY": repair_city(F.col("CTY"), F.col("ADDR")),
                "REV_TM": pad_time(F.col("REV_TM")),
                "SALE_TM": pad_time(F.col("SALE_TM")),
            }
        )
        .where((F.col("PRVC") != "") & (F.col("CTY") != ""))
    )


def machine_dimension(
    machines: DataFrame,
    locations: DataFrame,
    admin_map: DataFrame,
    provinces: DataFrame,
    cities: DataFrame,
    areas: DataFrame,
    store_map: DataFrame,
    stores: DataFrame,
) -> DataFrame:
    """One row per machine known to either system, the first system's values preferred.

    All joins on the machine come first and share one hash partitioning. The lookups
    carry no hint: Catalyst broadcasts a side only when its measured size is below the
    session's threshold.
    """
    everyone = machines.select("MID").union(admin_map.select("MID")).distinct()
    own = machines.select(
        "MID", "HARD_ID", "SONG_WHSE_VER", "EXEC_VER", "UI_VER", "STS", "CUR_LOGIN_TM",
        F.col("PAY_SW").alias("own_pay"),
    )
    placed = repaired_locations(locations).select(
        "MID", F.col("PRVC").alias("own_prvc"), F.col("CTY").alias("own_cty"), "ADDR_FMT",
        "REV_TM", "SALE_TM",
    )
    managed = admin_map.select(
        "MID", "MAC_NM", "PKG_NM", "INV_RATE", "AGE_RATE", "COM_RATE", "PAR_RATE",
        F.col("IS_ACTV").alias("admin_actv"),
        pad_time(F.col("ACTV_TM")).alias("ACTV_TM"),
        F.col("HAD_MPAY_FUNC").alias("admin_pay"),
        F.concat("SCENE_ADDR", "GROUND_NM").alias("admin_addr"),
        F.col("SCENE_PRVC_ID").alias("PRVC_ID"),
        F.col("SCENE_CTY_ID").alias("CTY_ID"),
        F.col("SCENE_AREA_ID").alias("AREA_ID"),
    )
    shops = stores.select(
        F.col("ID").alias("STORE_ID"),
        F.col("GROUND_NM").alias("STORE_NM"),
        F.col("TAG_NM").alias("SCENCE_CATGY"),
        F.col("SUB_SCENE_CATGY_NM").alias("SUB_SCENCE_CATGY"),
        F.col("SUB_TAG_NM").alias("SCENE"),
        F.col("SUB_SCENE_NM").alias("SUB_SCENE"),
        F.col("BRND_NM").alias("BRND"),
        F.col("SUB_BRND_NM").alias("SUB_BRND"),
    )
    joined = (
        everyone.join(own, "MID", "left")
        .join(placed, "MID", "left")
        .join(managed, "MID", "left")
        .join(store_map.select("MID", "STORE_ID"), "MID", "left")
        .join(shops, "STORE_ID", "left")
        .join(provinces.select("PRVC_ID", F.col("PRVC").alias("admin_prvc")), "PRVC_ID", "left")
        .join(cities.select("CTY_ID", F.col("CTY").alias("admin_cty")), "CTY_ID", "left")
        .join(areas.select("AREA_ID", "AREA"), "AREA_ID", "left")
    )
    joint = (F.col("PKG_NM") == JOINT_PACKAGE) | (F.col("INV_RATE") < FULL_RATE)
    return joined.select(
        "MID",
        "MAC_NM",
        "SONG_WHSE_VER",
        "EXEC_VER",
        "UI_VER",
        "HARD_ID",
        "SALE_TM",
        "REV_TM",
        F.col("STORE_NM").alias("OPER_NM"),
        F.coalesce("own_prvc", "admin_prvc").alias("PRVC"),
        F.coalesce("own_cty", "admin_cty").alias("CTY"),
        "AREA",
        F.coalesce("ADDR_FMT", "admin_addr").alias("ADDR"),
        "STORE_NM",
        "SCENCE_CATGY",
        "SUB_SCENCE_CATGY",
        "SCENE",
        "SUB_SCENE",
        "BRND",
        "SUB_BRND",
        F.col("PKG_NM").alias("PRDCT_NM"),
        F.lit(PRODUCT_TYPE).alias("PRDCT_TYP"),
        F.when(joint, JOINT_MODE).otherwise(SOLD_MODE).alias("BUS_MODE"),
        "INV_RATE",
        "AGE_RATE",
        "COM_RATE",
        "PAR_RATE",
        F.coalesce("STS", "admin_actv").alias("IS_ACTV"),
        "ACTV_TM",
        F.coalesce("own_pay", "admin_pay").alias("PAY_SW"),
        F.col("STORE_NM").alias("PRTN_NM"),
        "CUR_LOGIN_TM",
    )


def busiest_positions(
    positions: DataFrame, day: str, days: int = LOCATION_DAYS
) -> DataFrame:
    """(MID, X, Y, CNT): each machine's position with the most users since ``days`` ago.

    Equal positions rank by coordinates. A machine whose first position is blank gets no
    row rather than its second. A missing user counts as one user.
    """
    users = (
        between_days(positions, shift_day(day, -days), day)
        .select("UID", "MID", F.col("LAT").alias("X"), F.col("LNG").alias("Y"))
        .distinct()
        .groupBy("MID", "X", "Y")
        .agg(F.count("*").alias("CNT"))
    )
    first = top_n(users, 1, ["MID"], [F.desc("CNT"), F.asc("X"), F.asc("Y")])
    return first.where((F.col("X") != "") & (F.col("Y") != "")).select(
        F.col("MID").try_cast("int").alias("MID"), "X", "Y", F.col("CNT").cast("int").alias("CNT")
    ).where(F.col("MID").isNotNull())


def machine_locations(
    positions: DataFrame,
    answers: DataFrame,
    yesterday: DataFrame | None,
    day: str,
    days: int = LOCATION_DAYS,
    grids: tuple[int, ...] = GRIDS,
) -> DataFrame:
    """Addressed position of every machine, yesterday's row where today gives none.

    A position takes the nearest of the stored ``answers`` (lat, lng, answer) within the width of
    the last grid; one without any counts as unanswered.
    """
    # One row per machine.
    placed = checkpointed(busiest_positions(positions, day, days))
    found = nearest_answers(placed.select("X", "Y").distinct(), answers, grids)
    today = placed.join(found, ["X", "Y"]).select(*LOCATION_COLUMNS)
    return today if yesterday is None else carry_forward(today, yesterday, "MID")
