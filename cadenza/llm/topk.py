"""Exact top-k search by exhaustive term-at-a-time accumulation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.operators.ranking import top_n

SCALE = 256
QUERY_BLOCK, ROW_BLOCK = 256, 4096  # rows of a block; a pair of blocks is a task's unit

GROUP = 4  # row blocks that a task handles with one query block

_PARTS = ("ids", "places", "terms", "weights")
_BLOCK = ", ".join(f"{name} binary" for name in _PARTS)


def scaled(vectors: DataFrame) -> DataFrame:
    """``vec_id, terms, weights``: the non-zero components of each vector, ``floor(256 * x)``
    with x as double, as sparse rows. Vectors that are null or hold null or non-finite
    components are left out, an empty vector is a row without terms."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    good = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")),
    )
    kept = vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & good)
    parts = F.filter(
        F.transform(whole, lambda w, i: F.struct(i.alias("term"), w.alias("weight"))),
        lambda p: p["weight"] != 0,
    )
    rows = kept.select("vec_id", parts.alias("parts"))
    return rows.select(
        "vec_id", F.col("parts.term").alias("terms"), F.col("parts.weight").alias("weights")
    )


def postings(rows: pa.Array | pa.RecordBatch) -> list[np.ndarray]:
    """Ids of sparse rows, and their postings sorted by term: place, term and weight."""
    terms, weights, ids = (rows.field(c) for c in ("terms", "weights", "vec_id"))
    counts = pa.compute.list_value_length(terms).to_numpy()
    places = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    terms = terms.flatten().to_numpy().astype(np.int32)
    order = np.argsort(terms, kind="stable")
    weights = weights.flatten().to_numpy().astype(np.int64)
    return [ids.to_numpy().astype(np.int64), places[order], terms[order], weights[order]]


def _pack(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = postings(batch.slice(low, size).to_struct_array())
                packed = [pa.array([x.tobytes()], pa.binary()) for x in part]
                yield pa.RecordBatch.from_arrays(packed, list(_PARTS))

    return run


def _best(k: int):
    kinds = (np.int64, np.int32, np.int32, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                query = postings(batch.column("q")[at].values)
                rows = [
                    np.frombuffer(batch.column(name)[at].as_py(), kind)
                    for name, kind in zip(_PARTS, kinds, strict=True)
                ]
                scores = accumulate(query, rows)
                best = [select(scores[i], rows[0], q, k) for i, q in enumerate(query[0])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query[0], [len(b) for b in best])),
                        pa.array(rows[0][np.concatenate(best)]),
                        pa.array(np.concatenate([scores[i][b] for i, b in enumerate(best)])),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return run


def accumulate(query: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """Dense scores of all queries and rows of two blocks: each term's postings of the rows
    are scattered, weighted by each query that has the term."""
    q_ids, q_places, q_terms, q_weights = query
    ids, places, terms, weights = rows
    scores = np.zeros((len(q_ids), len(ids)), np.int64)
    for term in np.intersect1d(q_terms, terms):
        qs = slice(*np.searchsorted(q_terms, [term, term + 1]))
        rs = slice(*np.searchsorted(terms, [term, term + 1]))
        # A vector has a term once, so no place is written twice in one statement.
        if rs.stop - rs.start == len(ids):
            for q, w in zip(q_places[qs], q_weights[qs], strict=True):
                scores[q] += w * weights[rs]
        else:
            for q, w in zip(q_places[qs], q_weights[qs], strict=True):
                scores[q, places[rs]] += w * weights[rs]
    return scores


def select(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the ``k`` best scores of other rows, ties to the smaller id."""
    others = np.flatnonzero(ids != own)
    if len(others) > k:
        least = np.partition(scores[others], len(others) - k)[len(others) - k]
        others = others[scores[others] >= least]
    order = np.lexsort((ids[others], -scores[others]))
    return others[order[:k]]


def top_k(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query, a row whose vec_id is divisible by
    ``every``, the ``k`` other rows of the greatest inner product of ``floor(256 * x)``, ties
    to the smaller vec_id.

    Queries and rows are packed into blocks of sparse postings. Each row block meets each
    query block once; a task holds two blocks and their dense scores, and passes on ``k`` rows
    per query. Rows with the query's own vec_id are no candidates, repeated rows of another
    one are all. Vectors of different lengths are multiplied over the components both have. An
    empty table, or one without queries, gives an empty result.
    """
    rows = stored(scaled(vectors.select("vec_id", "embedding")), "vectors")
    packed = stored(rows.mapInArrow(_pack(ROW_BLOCK), _BLOCK), "rows")
    queries = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    groups = max(1, -(-packed.count() // GROUP))
    asked = queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("q_block")).agg(
        F.collect_list(F.struct("vec_id", "terms", "weights")).alias("q")
    )
    # Every pair of a query block and a row group is one key, so the work spreads evenly.
    asked = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    packed = packed.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    packed = packed.withColumn(
        "q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    pairs = packed.join(asked, ["q_block", "group"]).select("q", *_PARTS)
    best = pairs.mapInArrow(_best(k), "query_id long, vec_id long, score long")
    ranked = top_n(best, k, ["query_id"], [F.desc("score"), F.asc("vec_id")], "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
