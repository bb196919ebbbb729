"""Active users of a day, and users by their activity over a week."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import shift_day
from cadenza.sources.tables import DAY, between_days, on_day

# Registration channels (code, account column) and display labels.
CHANNELS = {
    "wechat": ("1", "WX_ID"),
    "alipay": ("2", "ALY_ID"),
    "qq": ("3", "QQID"),
    "app": ("4", "APP_ID"),
}
CHANNEL_LABELS = {"1": "微信", "2": "支付宝", "3": "QQ", "4": "APP"}
UNKNOWN_CHANNEL = "未知"
GENDER_LABELS = {"0": "不明", "1": "男", "2": "女"}
UNKNOWN_GENDER = "不明"
PERSONAL = "2"

USER_COLUMNS = (
    "UID", "REG_MID", "REG_CHNL", "REF_UID", "GDR", "BIRTHDAY", "MSISDN", "LOC_ID", "LOG_MDE",
    "REG_DT", "REG_TM", "USR_EXP", "SCORE", "LEVEL", "USR_TYPE", "IS_CERT", "IS_STDNT",
)


def _label(code: Column, labels: Mapping[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(text) for pair in labels.items() for text in pair])
    return F.coalesce(F.try_element_at(pairs, code), F.lit(default))


def channel_users(users: DataFrame, channel: str) -> DataFrame:
    """One channel's users in the common shape; what a channel lacks is NULL, a score
    it lacks is 0."""
    code, account = CHANNELS[channel]
    unknown = F.lit(None).cast("string")
    own = {
        "REG_CHNL": F.lit(code),
        "REF_UID": F.col(account),
        "REG_DT": F.substring("REG_TM", 1, 8),
        "REG_TM": F.substring("REG_TM", 9, 6),
        "USR_TYPE": F.lit(PERSONAL),
        "IS_CERT": unknown,
        "IS_STDNT": unknown,
    }
    if channel == "alipay":
        own["USR_TYPE"] = F.coalesce("USR_TYPE", F.lit(PERSONAL))
        del own["IS_CERT"], own["IS_STDNT"]
    if channel == "app":
        own["LOG_MDE"] = unknown
        own["SCORE"] = F.lit(0)
    return users.select(*[own.get(name, F.col(name)).alias(name) for name in USER_COLUMNS])


def all_users(channels: Mapping[str, DataFrame]) -> DataFrame:
    """Users of all channels; a user registered in two has two rows."""
    first, *rest = [channel_users(df, name) for name, df in channels.items()]
    for other in rest:
        first = first.unionByName(other)
    return first


def active_users(channels: Mapping[str, DataFrame], logins: DataFrame, day: str) -> DataFrame:
    """Profile rows of everyone who logged in on ``day``; users without a profile stay."""
    return active_users_by_day(channels, logins, day, day).select(*USER_COLUMNS)


def active_users_by_day(
    channels: Mapping[str, DataFrame], logins: DataFrame, first: str, last: str
) -> DataFrame:
    """``active_users`` of many days in one pass, with the day, for a first load."""
    seen = between_days(logins, first, last).select("UID", DAY).distinct()
    return seen.join(all_users(channels), "UID", "left").select(*USER_COLUMNS, DAY)


def week_activity(
    users: DataFrame, day: str, active_days: int = 1, days: int = 7
) -> DataFrame:
    """Rows of ``day`` of the users with ``active_days`` rows from ``days`` earlier on.

    The window holds both end days. It counts rows, so a user registered in two channels
    counts twice a day.
    """
    chosen = (
        between_days(users, shift_day(day, -days), day)
        .groupBy("UID")
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") == active_days)
    )
    return on_day(users, day).join(chosen, "UID", "left_semi").select(
        "UID",
        _label(F.col("REG_CHNL"), CHANNEL_LABELS, UNKNOWN_CHANNEL).alias("REG_CHNL"),
        "REF_UID",
        _label(F.col("GDR"), GENDER_LABELS, UNKNOWN_GENDER).alias("GDR"),
        "BIRTHDAY",
        "MSISDN",
        "REG_DT",
        "LEVEL",
    )
