"""Revenue facts by machine, and their totals by merchant and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.sources.tables import on_day

REVENUE, REFUND = 0, 2  # ledger states
MONEY = "decimal(38,4)"

_GROUP = ("MID", "PKG_ID", "PAY_TYPE")
_DIMENSIONS = (
    "MAC_NM", "PRDCT_TYP", "STORE_NM", "BUS_MODE", "PAY_SW", "SCENCE_CATGY", "SUB_SCENCE_CATGY",
    "SCENE", "SUB_SCENE", "BRND", "SUB_BRND",
)
_RATES = ("INV_RATE", "AGE_RATE", "COM_RATE", "PAR_RATE")


def machine_turnover(ledger: DataFrame) -> DataFrame:
    """Revenue and refund measures per (machine, package, payment type) with revenue.

    One pass over the ledger. Grouping by user first makes the user counts exact without
    a distinct per state, and spreads a busy machine over its users. Refunds count only
    where the same key has revenue; a NULL package or payment type matches no refund.
    """
    sold, refunded = F.col("ABN_TYP") == REVENUE, F.col("ABN_TYP") == REFUND
    amount = F.col("COIN_CNT") * F.col("COIN_PRC")

    def measures(state, prefix):
        return [
            F.count_if(state).alias(f"{prefix}_rows"),
            F.sum(F.when(state, amount)).alias(f"{prefix}_sum"),
            F.count(F.when(state, F.col("ORDR_ID"))).alias(f"{prefix}_orders"),
        ]

    per_user = (
        ledger.where(sold | refunded)
        .groupBy(*_GROUP, "UID")
        .agg(*measures(sold, "rev"), *measures(refunded, "ref"))
    )

    def totals(prefix, users, orders, money):
        present = F.col("UID").isNotNull() & (F.col(f"{prefix}_rows") > 0)
        return [
            F.count_if(present).alias(users),
            F.sum(f"{prefix}_orders").alias(orders),
            F.coalesce(F.sum(f"{prefix}_sum").cast(MONEY), F.lit(0).cast(MONEY)).alias(money),
        ]

    grouped = (
        per_user.groupBy(*_GROUP)
        .agg(
            F.sum("rev_rows").alias("rev_rows"),
            *totals("rev", "CNSM_USR_CNT", "REV_ORDR_CNT", "TOT_REV"),
            *totals("ref", "REF_USR_CNT", "REF_ORDR_CNT", "TOT_REF"),
        )
        .where(F.col("rev_rows") > 0)
    )
    matches = F.col("PKG_ID").isNotNull() & F.col("PAY_TYPE").isNotNull()
    refunds = {
        name: F.when(matches, F.col(name)).otherwise(F.lit(0))
        for name in ("REF_USR_CNT", "REF_ORDR_CNT", "TOT_REF")
    }
    return grouped.drop("rev_rows").withColumns(refunds)


def machine_stat(
    machines: DataFrame, locations: DataFrame, ledger: DataFrame, users: DataFrame
) -> DataFrame:
    """Every machine with its turnover, one row per package and payment type.

    Inputs are one day's tables. The location snapshot's address is preferred. Active
    users by registration machine repeat on each of its rows. The snapshot's machine
    number is an integer, so its join comes first, before rows multiply by package.
    """
    new_users = users.groupBy(F.col("REG_MID").alias("MID")).agg(
        F.count("UID").alias("NEW_USR_CNT")
    )
    placed = locations.select(
        F.col("MID").alias("_mid"),
        F.col("PRVC").alias("_prvc"),
        F.col("CTY").alias("_cty"),
        F.col("DISTRICT").alias("_district"),
    )

    def count(name: str):
        return F.coalesce(name, F.lit(0)).alias(name)

    def money(name: str):
        return F.coalesce(F.col(name), F.lit(0).cast(MONEY)).cast(MONEY).alias(name)

    return (
        machines.join(placed, F.col("MID").try_cast("int") == F.col("_mid"), "left")
        .join(new_users, "MID", "left")
        .join(machine_turnover(ledger), "MID", "left")
        .select(
            "MID",
            *_DIMENSIONS,
            F.coalesce("_prvc", "PRVC").alias("PRVC"),
            F.coalesce("_cty", "CTY").alias("CTY"),
            F.coalesce("_district", "AREA").alias("AREA"),
            F.col("PRTN_NM").alias("AGE_ID"),
            *_RATES,
            "PKG_ID",
            "PAY_TYPE",
            count("CNSM_USR_CNT"),
            count("REF_USR_CNT"),
            count("NEW_USR_CNT"),
            count("REV_ORDR_CNT"),
            count("REF_ORDR_CNT"),
            money("TOT_REV"),
            money("TOT_REF"),
        )
    )


def merchant_share(stat: DataFrame, day: str) -> DataFrame:
    """Totals by merchant and payment type with each party's share.

    Shares multiply by the rates as stored (percentages) and are not divided by 100.
    """

    def share(rate: str):
        part = F.col("TOT_REV") * F.coalesce(rate, F.lit(0))
        return F.sum(part).cast(MONEY)

    return on_day(stat, day).groupBy(F.col("AGE_ID").alias("ADMIN_ID"), "PAY_TYPE").agg(
        F.sum("REV_ORDR_CNT").alias("REV_ORDR_CNT"),
        F.sum("REF_ORDR_CNT").alias("REF_ORDR_CNT"),
        F.sum("TOT_REV").cast("double").alias("TOT_REV"),
        F.sum("TOT_REF").cast("double").alias("TOT_REF"),
        share("INV_RATE").alias("TOT_INV_REV"),
        share("AGE_RATE").alias("TOT_AGE_REV"),
        share("COM_RATE").alias("TOT_COM_REV"),
        share("PAR_RATE").alias("TOT_PAR_REV"),
    )


def region_totals(stat: DataFrame, day: str) -> DataFrame:
    """Totals by province and city. MAC_CNT counts rows of the machine facts, so a
    machine counts once per package and payment type."""
    return on_day(stat, day).groupBy("PRVC", "CTY").agg(
        F.count("MID").alias("MAC_CNT"),
        F.sum("TOT_REV").cast(MONEY).alias("MAC_REV"),
        F.sum("TOT_REF").cast(MONEY).alias("MAC_REF"),
        F.sum("REV_ORDR_CNT").alias("MAC_REV_ORDR_CNT"),
        F.sum("REF_ORDR_CNT").alias("MAC_REF_ORDR_CNT"),
        F.sum("CNSM_USR_CNT").alias("MAC_CNSM_USR_CNT"),
        F.sum("REF_USR_CNT").alias("MAC_REF_USR_CNT"),
    )
