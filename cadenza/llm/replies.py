"""Chat formatting of reply trees: root-to-leaf paths, ranked, each as one conversation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.operators.ranking import top_n

OPEN, MARK, CLOSE = "<turn>", "#", "</turn>"
# What stands for each control character inside a text, "&" first and last read.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("#", "&num;"))


def escape(text: Column) -> Column:
    """``text`` without control strings; ``unescape`` gives it back unchanged."""
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def turns_as_tree(turns: DataFrame) -> DataFrame:
    """``tree, node, parent, role, text, score`` from ``conv_id, turn, role, text``.

    Each row answers the one before it, so a conversation is a tree with one branch. Rows with
    equal turns come by role and text, repeated rows are kept, null role and text are empty,
    and rows with a null conv_id form one conversation.
    """
    plain = turns.select(
        F.col("conv_id").alias("tree"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    name = F.concat(F.coalesce(F.col("tree").cast("string"), F.lit("")), F.lit(":"))
    return plain.withColumn("place", place).select(
        "tree",
        F.concat(name, F.col("place").cast("string")).alias("node"),
        F.when(F.col("place") > 1, F.concat(name, (F.col("place") - 1).cast("string"))).alias(
            "parent"
        ),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def reply_paths(nodes: DataFrame, branches: int) -> DataFrame:
    """``tree, leaf, branch, node, height``: the best ``branches`` root-to-leaf paths of each
    tree, one row per node, ``height`` counted from the leaf (0).

    ``nodes`` has ``tree, node, parent, score``; node names are unique. A path's score is the
    sum of its nodes' scores (null is 0), ties go to the smaller leaf name. A parent that is
    not there is none. Each round of self-joins doubles how far up a node sees, so a tree of
    depth d takes log2(d) rounds; nodes on a cycle of parents, or below one, are on no path.
    """
    named = nodes.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("node").alias("parent"))
    step = named.join(known.withColumn("there", F.lit(True)), "parent", "left").select(
        "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.col("score").alias("total")
    )
    jumps = [stored(step, "jump")]
    rounds = math.ceil(math.log2(max(2, jumps[0].count()))) + 1
    while len(jumps) <= rounds and not jumps[-1].where("up is not null").isEmpty():
        last = jumps[-1]
        above = last.select(
            F.col("node").alias("up"), F.col("up").alias("top"), F.col("total").alias("more")
        )
        # A node that sees past the root needs no join.
        further = last.where("up is not null").join(above, "up")
        further = further.select(
            "node", F.col("top").alias("up"), (F.col("total") + F.col("more")).alias("total")
        )
        jumps.append(stored(last.where("up is null").unionByName(further), "jump"))

    parents = jumps[0].where("up is not null").select(F.col("up").alias("node")).distinct()
    leaves = jumps[-1].where("up is null").join(parents, "node", "left_anti")
    leaves = leaves.join(nodes.select("node", "tree"), "node")
    best = top_n(leaves, branches, ["tree"], [F.desc("total"), F.asc("node")], "branch")
    path = best.select(
        "tree", F.col("node").alias("leaf"), "branch", "node", F.lit(0).cast("long").alias("height")
    )
    for k, jump in enumerate(jumps[:-1]):
        further = path.join(jump.where("up is not null").select("node", "up"), "node").select(
            "tree", "leaf", "branch", F.col("up").alias("node"), F.col("height") + (1 << k)
        )
        path = stored(path.union(further), "path")
    return path


def format_conversations(
    nodes: DataFrame, branches: int = 1, learn: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """``tree, branch, formatted, loss`` for the best ``branches`` paths of each tree.

    A turn is written as ``<turn>role#text</turn>``, with ``&``, ``<`` and ``#`` inside role
    and text escaped, so that no text can end a turn or begin one. ``loss`` holds the spans
    (``start``, ``end``; code points, end exclusive) of the texts of roles in ``learn``: what a
    model is trained on. Null role and text are empty. An empty table gives an empty result.
    One conversation is one row, so it must fit into a task's memory, as any single text.
    """
    path = reply_paths(nodes, branches)
    turns = path.join(nodes.select("node", "role", "text"), "node").select(
        "tree",
        "branch",
        "leaf",
        "height",
        F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit(""))), F.lit(MARK)).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
    )
    earlier = Window.partitionBy("tree", "branch", "leaf").orderBy(F.desc("height"))
    size = F.length("head") + F.length("body") + len(CLOSE)
    ends = F.sum(size.cast("long")).over(earlier)
    start = (ends - len(CLOSE) - F.length("body")).alias("start")
    end = (ends - len(CLOSE)).alias("end")
    turns = turns.select(
        "tree",
        "branch",
        "leaf",
        F.struct(
            (-F.col("height")).alias("place"),
            F.concat("head", "body", F.lit(CLOSE)).alias("turn"),
            F.when(F.col("role").isin(*learn), F.struct(start, end)).alias("loss"),
        ).alias("t"),
    )
    whole = turns.groupBy("tree", "branch", "leaf").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select(
        "tree",
        "branch",
        F.array_join(F.col("t.turn"), "").alias("formatted"),
        F.filter(F.col("t.loss"), lambda span: span.isNotNull()).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The ``role`` and ``text`` of each turn, read back from a formatted conversation."""
    pieces = F.slice(F.split(formatted, CLOSE), 1, F.size(F.split(formatted, CLOSE)) - 1)

    def parts(piece: Column) -> Column:
        inner = F.split(F.substring(piece, len(OPEN) + 1, 1 << 30), MARK)
        return F.struct(unescape(inner[0]).alias("role"), unescape(inner[1]).alias("text"))

    return F.transform(pieces, parts)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(
            loss,
            lambda span: unescape(
                F.substr(
                    formatted,
                    (span["start"] + 1).cast("int"),
                    (span["end"] - span["start"]).cast("int"),
                )
            ),
        ),
        "",
    )
