"""Daily full snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.ranking import MAX_BROADCAST_BYTES
from cadenza.session import checkpointed

_KEY_BYTES = 64  # of a broadcast row beside its value


def carry_forward(
    today: DataFrame, yesterday: DataFrame, key: str, broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``today`` plus yesterday's rows whose key is absent today.

    Only today's keys meet yesterday's rows. Up to ``broadcast_bytes`` as measured they go to the
    tasks that scan yesterday's snapshot, whose wide rows are then neither shuffled nor
    sorted; beyond that both sides are hashed and yesterday's rows probe a table of keys. A
    NULL key counts as absent.
    """
    today = checkpointed(today)
    keys = checkpointed(today.select(key).where(F.col(key).isNotNull()).distinct())
    size = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + _KEY_BYTES
    measured = keys.agg(F.sum(size)).first()[0] or 0
    keys = F.broadcast(keys) if measured <= broadcast_bytes else keys.hint("shuffle_hash")
    return today.unionByName(yesterday.select(*today.columns).join(keys, key, "left_anti"))
