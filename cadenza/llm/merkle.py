"""Merkle manifest of a dataset, proofs and their check by a cogrouped exchange of subtrees.

Leaves are numbered inside their source and cut into superblocks of 16**3 consecutive ones.
On the way up each superblock is reduced to one node, and the nodes are numbered, cut and reduced
in the same way until a source has one, its subroot; the subroots, by source, are reduced to the
root. On the way down each superblock is cogrouped with the one row of outer nodes that its
leaves need: what stands before and after its own node at every level above it. Together they
finish the reduction, join the proofs and fold them. No group has more rows than a superblock.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.operators.ranking import full_rank

FAN = 16  # nodes of a run that become one
LOCAL = 3  # levels inside a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_KEY = ["named", "name"]  # a source: null is (false, ''), before all others
_NODE = "named boolean, name string, place long, digest binary"
_PATH = "before array<binary>, after array<binary>, subroot binary, root binary"
RESULT = (
    "id string, name string, named boolean, leaf string, subroot string, root string, "
    "proof binary, folded_root string, verified boolean"
)


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over the values, each ``-`` if null, else its byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    parts = [
        F.when(t.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)
        )
        for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def digest_of(nodes: Sequence[bytes]) -> bytes:
    """SHA-256 over the hex texts of the nodes."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def height(n: int) -> int:
    """Levels that ``n`` nodes need to become one."""
    levels = 0
    while n > 1:
        n = -(-n // FAN)
        levels += 1
    return levels


def local_levels(nodes: Sequence[bytes], block: int, local: int) -> list[list[bytes]]:
    """The nodes of a superblock level by level. One that is not alone in its source goes up
    all ``local`` levels, since a short last run becomes a node too."""
    levels = [list(nodes)]
    for _ in range(local if block else height(len(nodes))):
        below = levels[-1]
        levels.append([digest_of(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def _block(local: int) -> Column:
    return F.floor(F.col("place") / FAN**local).cast("long")


def reduced(nodes: DataFrame, keys: Sequence[str], local: int) -> DataFrame:
    """One node per superblock; its ``place`` is the superblock's number."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        top = local_levels(rows["digest"].tolist(), int(key[-1]), local)[-1][0]
        named, name = rows["named"].iloc[0], rows["name"].iloc[0]
        return pd.DataFrame(
            {"named": [bool(named)], "name": [name], "place": [int(key[-1])], "digest": [top]}
        )

    grouped = nodes.withColumn("block", _block(local)).groupBy(*keys, "block")
    return grouped.applyInPandas(run, _NODE)


def levels_above(nodes: DataFrame, keys: Sequence[str], local: int) -> list[DataFrame]:
    """Node tables above ``nodes``, up to the one with a single node per key."""
    above = []
    while True:
        nodes = stored(reduced(nodes, keys, local), "nodes")
        above.append(nodes)
        if not nodes.agg(F.max("place")).first()[0]:
            return above


def _siblings(levels: list[list[bytes]], at: int):
    """What stands before and after the node of leaf ``at`` in its run, level by level."""
    for nodes in levels[:-1]:
        low = at - at % FAN
        yield nodes[low:at], nodes[at + 1 : low + FAN]
        at //= FAN


def _paths(local: int):
    """Nodes of a superblock with the siblings on their way to the root."""

    def run(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, top = nodes.sort_values("place"), outer.iloc[0]
        levels = local_levels(nodes["digest"].tolist(), int(key[-1]), local)
        before, after = [], []
        for at in range(len(nodes)):
            own = [[b"".join(x) for x in level] for level in _siblings(levels, at)]
            before.append([*[x[0] for x in own], *top["before"]])
            after.append([*[x[1] for x in own], *top["after"]])
        ends = {name: [top[name]] * len(nodes) for name in ("subroot", "root")}
        found = nodes[["named", "name", "place", "digest"]].copy()
        return found.assign(before=before, after=after, **ends)

    return run


def _proved(local: int):
    """Leaves of a superblock with their proofs, folded from the leaf as it is presented."""

    def run(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves, top = leaves.sort_values("place"), outer.iloc[0]
        levels = local_levels(leaves["digest"].tolist(), int(key[-1]), local)
        beyond = list(zip(top["before"], top["after"], strict=True))
        outside = b"".join(before + after for before, after in beyond)
        texts = [(before.hex().encode(), after.hex().encode()) for before, after in beyond]
        proofs, folded = [], []
        for at, node in enumerate(leaves["shown"]):
            proof = []
            for before, after in _siblings(levels, at):
                proof += before + after
                node = digest_of([*before, node, *after])
            for before, after in texts:
                node = hashlib.sha256(before + node.hex().encode() + after).digest()
            proofs.append(b"".join(proof) + outside)
            folded.append(node.hex())
        root, subroot = top["root"].hex(), top["subroot"].hex()
        return pd.DataFrame(
            {
                "id": leaves["id"].array,
                "name": leaves["name"].array,
                "named": leaves["named"].array,
                "leaf": [d.hex() for d in leaves["digest"]],
                "subroot": subroot,
                "root": root,
                "proof": proofs,
                "folded_root": folded,
                "verified": [f == root for f in folded],
            }
        )

    return run


def _exchanged(
    nodes: DataFrame, outer: DataFrame, keys: Sequence[str], local: int, run, schema: str
) -> DataFrame:
    """Superblocks of ``nodes`` cogrouped with their nodes' rows of ``outer``."""
    outer = outer.withColumn("block", F.col("place"))
    inner = nodes.withColumn("block", _block(local)).groupBy(*keys, "block")
    return inner.cogroup(outer.groupBy(*keys, "block")).applyInPandas(run(local), schema)


def _descended(
    above: list[DataFrame], outer: DataFrame, keys: Sequence[str], local: int
) -> DataFrame:
    """Rows of outer nodes from the top of ``above`` down to its lowest table."""
    for nodes in reversed(above[:-1]):
        outer = _exchanged(nodes, outer, keys, local, _paths, f"{_NODE}, {_PATH}")
    return outer


def manifest(docs: DataFrame, shown: Column | None = None, local: int = LOCAL) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``leaf``, the ``subroot`` of its
    source, the ``root`` of the dataset, its ``proof``, ``folded_root`` and ``verified``.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Leaves of a source come by
    doc_id; every ``FAN`` consecutive nodes, a last run of fewer too, become one until one is
    left, and the sources' nodes likewise. ``proof`` holds the digests of the siblings (32 bytes
    each), level by level, left to right. ``folded_root`` is what the proof gives for a row whose
    text is ``shown`` (its own text by default), ``verified`` whether that is the root. A
    superblock holds ``local`` levels.

    Null values have a leaf form of their own. A null source is a source, before all others; the
    empty text is another. Null doc_ids come first in their source; rows that share a doc_id come
    by their leaf, and equal rows get proofs for different places. Empty and very long texts are
    hashed whole. Other columns of ``docs`` have no part in a leaf and are not returned. An empty
    table gives an empty result.
    """
    fields = [F.col(name) for name in FIELDS]
    changed = [*fields[:-1], fields[-1] if shown is None else shown]
    leaves = docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").alias("at"),
        F.col("source").isNotNull().alias("named"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
        leaf_digest(fields).alias("digest"),
        leaf_digest(changed).alias("shown"),
    )
    leaves = stored(leaves, "leaves")
    order = [F.asc_nulls_first("at"), F.col("digest"), F.col("shown")]
    placed = full_rank(leaves, _KEY, order, "place").withColumn("place", F.col("place") - 1)
    placed = placed.drop("at")

    within = levels_above(placed.select(*_KEY, "place", "digest"), _KEY, local)
    # Sources are numbered like leaves: there may be many.
    subroots = full_rank(within[-1].drop("place"), [], [F.col(k) for k in _KEY], "place")
    subroots = stored(subroots.withColumn("place", F.col("place") - 1), "subroots")
    across = levels_above(subroots.select(*_KEY, "place", "digest"), [], local)

    none = F.array().cast("array<binary>")
    top = across[-1].select(
        *_KEY, "place", none.alias("before"), none.alias("after"),
        F.col("digest").alias("subroot"), F.col("digest").alias("root"),
    )
    sources = _descended([subroots, *across], top, [], local)
    outer = sources.withColumn("place", F.lit(0).cast("long")).withColumn("subroot", F.col("digest"))
    outer = stored(_descended(within, outer.drop("digest"), _KEY, local), "outer")
    found = _exchanged(placed, outer, _KEY, local, _proved, RESULT)
    return found.select(
        F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.when(F.col("named"), F.col("name")).alias("source"),
        "leaf", "subroot", "root", "proof", "folded_root", "verified",
    )
