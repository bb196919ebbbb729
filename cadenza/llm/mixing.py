"""Mixing sources to target weights by a proportionate-fair (Pfair) schedule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import free_names

MAX_PERIOD = 10_000  # sum of the weights, and so the rows of the broadcast schedule
SLOT, ORDER = "mix_slot", "mix_order"
_PREFIX, _SUPER = 4, 2  # hex digits that number a stream's rows, and that group the prefixes


def schedule(spark: SparkSession, weights: list[int]) -> DataFrame:
    """``stream, turn, slot``: one period of the schedule, ``sum(weights)`` slots.

    Block k (from 0) of a stream of weight w is released at ``k * period div w`` and due
    at ``ceil((k + 1) * period / w)``. Each slot goes to the released block that is due
    first, then to the first stream. All deadlines are met, so before any slot a stream has
    had less than one block more or less than its share.
    """
    period, streams = sum(weights), len(weights)
    if not 0 < period <= MAX_PERIOD or min(weights) <= 0:
        raise ValueError(f"weights must be positive and sum to at most {MAX_PERIOD}")
    weight = F.array(*[F.lit(w) for w in weights])

    def due(done: Column, i: Column) -> Column:
        return F.ceil((done[i] + 1) * period / weight[i])

    def released(done: Column, i: Column, slot: Column) -> Column:
        return (done[i] < weight[i]) & (F.floor(done[i] * period / weight[i]) <= slot)

    def step(state: Column, slot: Column) -> Column:
        done = state["done"]
        ready = F.filter(
            F.sequence(F.lit(0), F.lit(streams - 1)), lambda i: released(done, i, slot)
        )
        first = F.array_min(F.transform(ready, lambda i: F.struct(due(done, i), i.alias("i"))))

        def take(pick: Column) -> Column:
            counted = F.transform(done, lambda v, i: v + (i == pick).cast("int"))
            return F.struct(
                counted.alias("done"), F.concat(state["picks"], F.array(pick)).alias("picks")
            )

        return F.transform(F.array(first["i"]), take)[0]

    start = F.struct(
        F.array_repeat(F.lit(0), streams).alias("done"),
        F.array().cast("array<int>").alias("picks"),
    )
    slots = F.sequence(F.lit(0), F.lit(period - 1))
    picks = F.aggregate(slots, start, step, lambda state: state["picks"])
    table = spark.range(1).select(F.posexplode(picks).alias("slot", "stream"))
    turn = F.row_number().over(Window.partitionBy("stream").orderBy("slot")) - 1
    return table.select("stream", turn.alias("turn"), "slot")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest: int,
    block: int = 64,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All rows of ``docs`` in the order of the mix, with ``mix_slot`` (the slot of the row's
    block) and ``mix_order`` (unique, ascending).

    Each source named in ``weights`` is a stream; all others, null among them, share one of
    weight ``rest``. A stream's rows come by the md5 of their key and are cut into blocks of
    ``block`` rows; the schedule of one period gives each block its slot, so nothing is
    simulated over the data. While every stream has rows, any prefix of the mix holds less than
    one block more or less of each stream than its weight asks for. A stream that has ended
    leaves its slots empty, and the others keep their pace. No row is dropped or repeated.

    A stream with any share of the rows is numbered by md5 prefixes: rows inside a prefix, and
    prefixes by two levels of running sums, so that no task holds a whole stream. A null key
    counts as the empty text. Rows of equal key come by the hash of their text; equal rows are
    all kept. Input columns named ``mix_slot`` or ``mix_order`` are replaced. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    names = [*weights]
    parts = [*weights.values(), rest]
    period = sum(parts)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (SLOT, ORDER)])
    stream, digest, prefix, group, place, turn, ends, within, before = free_names(
        docs, "stream", "digest", "prefix", "super", "place", "turn", "ends", "within", "before"
    )
    number = F.lit(len(names))
    if names:
        known = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
        number = F.coalesce(F.when(F.col(source).isNotNull(), known[F.col(source)]), number)
    rows = docs.withColumns(
        {stream: number, digest: F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))}
    ).withColumn(prefix, F.substring(digest, 1, _PREFIX))

    counts = rows.groupBy(stream, prefix).agg(F.count("*").alias("n"))
    counts = counts.withColumn(group, F.substring(prefix, 1, _SUPER))
    sums = counts.groupBy(stream, group).agg(F.sum("n").alias("n"))
    # At most one row per stream, and there are no more streams than weights.
    totals = {r[0]: r[1] for r in sums.groupBy(stream).agg(F.sum("n")).collect()}

    def running(*keys: str, by: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(by).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return F.coalesce(F.sum("n").over(earlier), F.lit(0))

    starts = counts.withColumn(within, running(stream, group, by=prefix)).join(
        sums.select(stream, group, running(stream, by=group).alias(before)), [stream, group]
    )
    starts = starts.select(stream, prefix, (F.col(within) + F.col(before)).alias(before))
    order = Window.partitionBy(stream, prefix).orderBy(digest, key, F.xxhash64(text))
    numbered = rows.withColumn(place, F.row_number().over(order) - 1)
    numbered = numbered.join(starts, [stream, prefix])
    number_in_stream = (F.col(place) + F.col(before)).cast("long")
    block_no = F.floor(number_in_stream / block)
    share = F.array(*[F.lit(w) for w in parts])[F.col(stream)]
    # One row per slot of a period: at most MAX_PERIOD rows.
    plan = F.broadcast(
        schedule(spark, parts).select(
            F.col("stream").alias(stream), F.col("turn").alias(turn), F.col("slot").alias(ends)
        )
    )
    placed = numbered.withColumn(turn, (block_no % share).cast("int")).join(plan, [stream, turn])
    slot = F.floor(block_no / share) * period + F.col(ends)
    mixed = placed.select(
        *[F.col(name) for name in docs.columns],
        slot.cast("long").alias(SLOT),
        (slot * block + number_in_stream % block).cast("long").alias(ORDER),
    )

    # Rows before a slot, from the streams' totals, deal the slots out evenly.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ahead = sum(
        (
            F.least(F.lit(float(n)), F.col(SLOT) * (block * parts[i] / period))
            for i, n in totals.items()
        ),
        F.lit(0.0),
    )
    part = F.least(
        F.floor(ahead * (width / max(1, sum(totals.values())))), F.lit(width - 1)
    ).cast("int")
    return mixed.repartitionById(width, part).sortWithinPartitions(ORDER)
