"""Consumption ledger of one day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.sources.tables import on_day

# Order type to state (0 normal, 1 abnormal, 2 refund).
ORDER_STATES = {1: 0, 2: 1, 3: 2, 4: 2}


def ledger(consumption: DataFrame, day: str) -> DataFrame:
    """Ledger rows of ``day``; a map-only job. Other order types have a NULL state."""
    states = F.create_map(*[F.lit(code) for pair in ORDER_STATES.items() for code in pair])
    return on_day(consumption, day).select(
        "ID",
        "TRD_ID",
        F.col("UID").cast("string").alias("UID"),
        "MID",
        "PRDCD_TYPE",
        "PAY_TYPE",
        "ACT_TM",
        "PKG_ID",
        F.abs("AMT").alias("COIN_PRC"),
        F.lit(1).alias("COIN_CNT"),
        F.col("ACT_TM").alias("UPDATE_TM"),
        "ORDR_ID",
        "ACTV_NM",
        "PKG_PRC",
        "PKG_DSCNT",
        "CPN_TYPE",
        F.try_element_at(states, F.col("ORDR_TYPE").cast("int")).alias("ABN_TYP"),
    )
