"""Near-duplicate groups by SetSketch registers, confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.llm.components import components
from cadenza.operators.ranking import full_rank
from cadenza.llm.words import LOWER, Words, bytes_of, mix, slices

# Register K = clip(floor(1 - log_b(h)), 0, Q + 1) of the least h ~ Exp(RATE) of a set.
BASE, RATE, Q = 1.001, 20.0, (1 << 16) - 2
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
SHINGLE = 5
# Pairs whose likelihood ratio against the threshold is worse than this are given up: two
# normal standard errors squared give 2 * ratio, so 18 stands for six of them.
MAX_RATIO = 18.0

_SEED = np.random.default_rng(20240131)
_MULTIPLY = _SEED.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEED.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2)
_BAND_SALT = _SEED.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_CHUNK = 1 << 18  # hashes evaluated at a time
FINE = 4096  # registers of the finer sketch, of which the lowest bit is kept
_FINE_MULTIPLY = _SEED.integers(0, 1 << 63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_ADD = _SEED.integers(0, 1 << 63, FINE, dtype=np.uint64) * np.uint64(2)


def registers_of(
    items: np.ndarray, multiply: np.ndarray = _MULTIPLY, add: np.ndarray = _ADD
) -> np.ndarray:
    """The registers of a set of 64-bit hashes. A union's are the greater of both sets'."""
    least = np.full(len(multiply), np.iinfo(np.uint64).max, np.uint64)
    size = _CHUNK // len(multiply)
    for low in range(0, len(items), size):
        part = items[low : low + size, None] * multiply + add
        np.minimum(least, part.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    value = np.floor(1 - np.log(exponential) / math.log(BASE))
    return np.clip(value, 0, Q + 1).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    padded = np.zeros((BANDS, 8), np.uint16)
    padded[:, :ROWS] = registers.reshape(BANDS, ROWS)
    halves = padded.view(np.uint64)
    return mix(mix(halves[:, 0] + _BAND_SALT) ^ halves[:, 1])


def alike(a: Column, b: Column, percent: int) -> Column:
    """Whether the low bits of two fine sketches agree as often as those of similar sets do.

    Registers agree with a chance of at least the similarity, and low bits of other registers
    with one of a half. The bound lies 5.5 standard errors below what ``percent`` gives.
    """
    chance = (1 + percent / 100) / 2
    least = FINE * chance - 5.5 * math.sqrt(FINE * chance * (1 - chance))
    differ = sum(F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(FINE // 64))
    return differ <= math.floor(FINE - least)


def shingle_sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes. A text of fewer than ``SHINGLE`` words is
    one shingle, one without words has none."""
    words = Words(*bytes_of(batch.column("text")), fold=LOWER)
    hashes, text, _ = words.grams(SHINGLE)
    first = np.searchsorted(text, np.arange(len(words) + 1))
    whole = None
    for i, count in enumerate(words.counts()):
        if count >= SHINGLE:
            yield np.unique(hashes[first[i] : first[i + 1]])
        elif count:
            part = words.hash[words.first[i] : words.first[i + 1]]
            whole = mix(np.uint64(count) + np.zeros(1, np.uint64))
            for word in part:
                whole = mix(whole ^ word)
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def _digest(items: np.ndarray) -> int:
    return int(mix(items).sum(dtype=np.uint64).view(np.int64))


_SKETCH = "doc_id long, n long, set_hash long, regs binary, bands array<long>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sizes, digests, sketches, bands = [], [], [], []
        for items in shingle_sets(batch):
            sizes.append(len(items))
            digests.append(_digest(items))
            if len(items):
                registers = registers_of(items)
                sketches.append(registers.tobytes())
                bands.append(band_keys(registers).view(np.int64))
            else:
                sketches.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.int64()),
                pa.array(sketches, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n", "set_hash", "regs", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = list(shingle_sets(batch))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(items) for items in sets], pa.int64()),
                pa.array([_digest(items) for items in sets], pa.int64()),
                pa.array([items.view(np.int64) for items in sets], pa.list_(pa.int64())),
            ],
            ["doc_id", "n", "set_hash", "items"],
        )


def joint_loss(n_a, n_b, registers_a, registers_b, similarity: float) -> np.ndarray:
    """How much less likely (in logs) the registers are at the closest similarity of at least
    ``similarity`` than at the best estimate, given both set sizes. 0 where the estimate
    itself reaches it; infinite where the sizes rule it out."""
    share_a = n_a / (n_a + n_b)
    share_b = 1 - share_a
    most = np.minimum(share_a / share_b, share_b / share_a)
    less = (registers_a < registers_b).sum(axis=1)
    more = (registers_a > registers_b).sum(axis=1)
    even = REGISTERS - less - more

    def part(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def log_likelihood(j):
        up, down = part(share_a - share_b * j), part(share_b - share_a * j)
        tiny = 1e-300
        return (
            more * np.log(np.maximum(up, tiny))
            + less * np.log(np.maximum(down, tiny))
            + even * np.log(np.maximum(1 - up - down, tiny))
        )

    grid = np.linspace(0, 1, 65)[:, None]
    best = np.max([log_likelihood(g * most) for g in grid], axis=0)
    above = np.max([log_likelihood(similarity + g * (most - similarity)) for g in grid], axis=0)
    return np.where(most < similarity - 1e-12, np.inf, np.maximum(best - above, 0))


def _likely(percent: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = [batch.column(f"n_{x}").to_numpy().astype(float) for x in "ab"]
            regs = [
                np.frombuffer(b"".join(batch.column(f"regs_{x}").to_pylist()), np.uint16)
                for x in "ab"
            ]
            regs = [x.reshape(-1, REGISTERS) for x in regs]
            loss = joint_loss(*n, *regs, percent / 100)
            yield batch.select(["a", "b"]).filter(pa.array(loss <= MAX_RATIO))

    return keep


def _with(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The columns of ``facts`` for both documents of each pair."""
    for side in "ab":
        names = [F.col(c).alias(side if c == "doc_id" else f"{c}_{side}") for c in facts.columns]
        pairs = pairs.join(facts.select(*names), side)
    return pairs


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = []
        for items in batch.column("items"):
            items = items.values.to_numpy().view(np.uint64)
            registers = registers_of(items, _FINE_MULTIPLY, _FINE_ADD)
            bits.append(np.packbits((registers & 1).astype(np.uint8)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(bits, pa.list_(pa.int64()))], ["doc_id", "bits"]
        )


def _full_sets(ids: DataFrame, docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``doc_id, items``: the whole shingle sets of some documents, stored.

    The ids grow with the input, so texts and ids meet by a merge join at every size.
    """
    sets = docs.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(
        _sets, "doc_id long, n long, set_hash long, items array<long>"
    )
    chosen = sketches.select("doc_id", "n", "set_hash")
    sets = sets.join(chosen, ["doc_id", "n", "set_hash"]).dropDuplicates(["doc_id"])
    return stored(sets.select("doc_id", "items"), "sets")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    full = _with(pairs, sets)
    both = F.size(F.array_intersect("items_a", "items_b"))
    either = F.size("items_a") + F.size("items_b") - both
    return stored(full.where(both * 100 >= either * percent).select("a", "b"), "links")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document (columns ``doc_id`` long,
    ``text`` string; others are ignored).

    Documents are linked when their sets of five-word shingles are similar by at least
    ``percent`` hundredths (Jaccard), and groups are what links reach. Only one document of
    each set of equal texts is compared. In each band bucket the document that shares most
    buckets with others, such as the original of many copies, is compared with all others;
    members that those comparisons leave in different groups are then compared pair by pair,
    if the low bits of a finer sketch agree. So a large group costs a star and not all its pairs, and no
    pair of a bucket is lost. A pair at the threshold misses all bands with a chance of 6e-9
    at 0.85 and 5e-6 at 0.8.

    A null or empty text has no shingles and stays alone. Rows that repeat a doc_id count as
    one document, the one with the most shingles (of these the greatest set hash); rows with a
    null doc_id are left out (``duplicates_by_row`` takes each row as its own). An empty table
    gives an empty result.
    """
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    sketched = stored(docs.mapInArrow(_sketches, _SKETCH), "sketches")
    one = sketched.groupBy("doc_id").agg(F.max(F.struct("n", "set_hash")).alias("one"))
    one = one.select("doc_id", F.col("one.n").alias("n"), F.col("one.set_hash").alias("set_hash"))
    classes = one.where("n > 0").groupBy("n", "set_hash").agg(F.min("doc_id").alias("doc_id"))
    # Joined on all three, as a repeated doc_id has several sketches.
    sketches = sketched.join(classes, ["doc_id", "n", "set_hash"], "left_semi")
    sketches = stored(sketches.dropDuplicates(["doc_id"]), "classes")

    banded = sketches.select(F.explode("bands").alias("key"), "doc_id")
    sizes = banded.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    met = stored(banded.join(sizes, "key"), "met")
    degrees = met.groupBy("doc_id").agg(F.sum("rows").alias("degree"))
    members = stored(met.join(degrees, "doc_id").select("key", "doc_id", "degree"), "members")
    hubs = members.groupBy("key").agg(
        F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"))).alias("hub")
    )
    members = members.drop("degree").join(
        hubs.select("key", (-F.col("hub.minus")).alias("hub")), "key"
    )
    star = members.where("doc_id <> hub").select(
        F.greatest("doc_id", "hub").alias("a"), F.least("doc_id", "hub").alias("b")
    )
    likely = _with(star.distinct(), sketches.select("doc_id", "n", "regs"))
    likely = likely.select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
    likely = stored(likely.mapInArrow(_likely(percent), "a long, b long"), "likely")
    sets = _full_sets(degrees.select("doc_id"), docs, sketches)
    links = _links(likely, sets, percent)
    groups = stored(components(links, "groups"), "groups")

    # Members of a bucket that the stars have not brought together.
    placed = members.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
    apart = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_ = placed.join(apart.where("low < high").select("key"), "key").where("doc_id <> hub")
    open_ = stored(open_.join(sketches.select("doc_id", "n"), "doc_id"), "open")
    loose = sets.join(open_.select("doc_id").distinct(), "doc_id", "left_semi")
    fine = stored(loose.mapInArrow(_fine, "doc_id long, bits array<long>"), "fine")
    open_ = open_.join(fine, "doc_id")
    left, right = open_.alias("l"), open_.alias("r")
    rest = left.join(right, F.col("l.key") == F.col("r.key")).where(
        F.expr(
            "l.doc_id > r.doc_id and l.component <> r.component"
            f" and 100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n)"
        )
        & alike(F.col("l.bits"), F.col("r.bits"), percent)
    )
    rest = rest.select(F.col("l.doc_id").alias("a"), F.col("r.doc_id").alias("b")).distinct()
    more = _links(stored(rest, "rest"), sets, percent)
    groups = stored(components(links.union(more), "groups"), "components")

    found = one.join(
        classes.withColumnRenamed("doc_id", "node"), ["n", "set_hash"], "left"
    ).join(groups, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (component == F.col("doc_id")).alias("kept"),
    )


def duplicates_by_row(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``near_duplicates`` with one row for every row of ``docs``, whatever its id.

    Rows that share a doc_id or have none are documents of their own, numbered in the order of
    id (null last) and text hash. A group's ``component_id`` is its smallest id, null where no
    row of it has one; ``kept`` marks one row of each group, the first in that order.
    """
    rows = docs.select("doc_id", "text")
    times = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    if times.where("n > 1 or doc_id is null").isEmpty():
        return near_duplicates(rows, percent)
    order = [F.asc_nulls_last("id"), F.col("hash")]
    hashed = rows.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("hash"))
    numbered = full_rank(hashed, [], order, "own")
    found = near_duplicates(numbered.select(F.col("own").alias("doc_id"), "text"), percent)
    found = found.withColumnsRenamed({"doc_id": "own", "component_id": "first"})
    names = numbered.select("own", F.col("id").alias("doc_id"))
    firsts = numbered.select(F.col("own").alias("first"), F.col("id").alias("component_id"))
    return found.join(names, "own").join(firsts, "first").select(
        "doc_id", "n_shingles", "component_id", "kept"
    )
