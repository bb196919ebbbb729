"""Benchmark decontamination by a distributed positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import free_names, stored
from cadenza.operators.projection import computed_once

WINDOW = 13
PROBES = 3  # posting lists that are intersected for a window, from its rarest term on
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of ASCII letters (A-Z in lower case), digits and all characters past ASCII."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(plain, _GAP), "")


def postings(docs: DataFrame) -> DataFrame:
    """``term, doc_id, pos`` of every word of every document, stored once.

    The index is cut by documents: a posting stays in the task that read its document, so a
    term in every document makes no hot list, and only the lists of probed terms are shuffled.
    """
    terms = docs.select("doc_id", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return stored(terms.select("term", "doc_id", "pos"), "postings")


def windows_of(items: DataFrame) -> DataFrame:
    """``phrase, words, items``: every distinct window of the items, and whose it is.

    An item of fewer than ``WINDOW`` words, but not none, is one window. Items with a null
    item_id have windows too, but name none; rows that repeat an id add their windows to it.
    """
    worded = computed_once(items, F.struct(words_of(F.col("text")).alias("words")), "item_id")
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    starts = worded.where(F.size("words") > 0).select(
        "item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("start")
    )
    cut = starts.select("item_id", F.slice("words", F.col("start") + 1, WINDOW).alias("words"))
    cut = cut.withColumn("phrase", F.array_join("words", " "))
    return cut.groupBy("phrase").agg(
        F.first("words").alias("words"), F.collect_set("item_id").alias("items")
    )


def probes_of(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``phrase, probes``: the ``PROBES`` rarest places of each window, as (n, term, offset),
    rarest first. A window with a term the index has not is gone."""
    placed = windows.select("phrase", F.posexplode("words").alias("offset", "term"))
    terms = stored(placed.select("term").distinct(), "terms")
    counts = index.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    weighed = placed.join(counts, "term", "left").groupBy("phrase").agg(
        F.sort_array(F.collect_list(F.struct("n", "term", "offset"))).alias("places"),
        F.count("*").alias("n_places"),
        F.count("n").alias("n_known"),
    )
    return weighed.where("n_places = n_known").select(
        "phrase", F.slice("places", 1, PROBES).alias("probes")
    )


def aligned(probes: DataFrame, index: DataFrame, slack: int = 0) -> DataFrame:
    """``phrase, doc_id, start``: where the probed lists, each moved by its offset, meet.

    Lists are intersected from the rarest on; with ``slack`` a list meets another where the
    moved positions differ by at most that many words (proximity), and ``start`` is the
    rarest term's.
    """
    terms = probes.select(F.explode("probes.term").alias("term")).distinct()
    lists = stored(index.join(stored(terms, "probed"), "term", "left_semi"), "lists")
    found = probes.select("phrase", "probes", F.col("probes")[0]["term"].alias("term")).join(
        lists, "term"
    )
    found = found.select(
        "phrase", "probes", "doc_id", (F.col("pos") - F.col("probes")[0]["offset"]).alias("start")
    )
    if not slack:
        found = found.where("start >= 0")
    for k in range(1, PROBES):
        probe = F.get("probes", F.lit(k))
        listed = lists.select(
            F.col("term").alias("t"), F.col("doc_id").alias("d"), F.col("pos").alias("p")
        )
        done = found.where(F.size("probes") <= k)
        place = F.col("start") + F.col("offset")
        near = (F.abs(F.col("p") - place) <= slack) if slack else (F.col("p") == place)
        met = (
            found.where(F.size("probes") > k)
            .withColumns({"term": probe["term"], "offset": probe["offset"]})
            .join(
                listed,
                (F.col("term") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")) & near,
                "left_semi",
            )
        )
        found = done.unionByName(met.select(done.columns))
    return found.drop("probes")


def proximity_matches(docs: DataFrame, items: DataFrame, slack: int) -> DataFrame:
    """``doc_id, phrase, start``: windows whose rarest terms lie in the document as in the
    window, each within ``slack`` words of its place; other terms are not asked for."""
    index = postings(docs)
    return aligned(stored(probes_of(windows_of(items), index), "probes"), index, slack).distinct()


def contamination(docs: DataFrame, items: DataFrame, prefix: str = "") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words, n_hit, n_items, items_sha256,
    contaminated`` (each behind ``prefix``).

    A document word is hit if it lies inside an occurrence of a window of ``WINDOW``
    consecutive item words (a shorter item is one window); a document is contaminated if at
    least a twentieth of its words are hit. The windows' rarest terms are looked up in the
    index and their lists intersected; what is left is compared with the document's own
    words, so each row is judged by its own text, also where rows share a doc_id or have none.
    Items without an id count as hits but not in ``n_items`` and ``items_sha256``.
    Null or empty texts have no words. Without items nothing is hit, and an empty table gives
    an empty result. Input columns with the names of results are replaced.
    """
    index = postings(docs)
    windows = stored(windows_of(items), "windows")
    probes = stored(probes_of(windows, index), "probes")
    starts = aligned(probes, index).join(windows.select("phrase", "items"), "phrase")
    per_doc = starts.groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "phrase", "items")).alias("starts")
    )
    results = [f"{prefix}{x}" for x in ("n_words", "n_hit", "n_items", "items_sha256")]
    results.append(f"{prefix}contaminated")
    kept = [c for c in docs.columns if c.lower() not in {r.lower() for r in results}]
    docs = docs.select(*kept)
    of, todo, words, size, found = free_names(docs, "of", "todo", "words", "size", "found")
    per_doc = per_doc.select(F.col("doc_id").alias(of), F.col("starts").alias(todo))
    joined = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col(of)), "left")
    worded = computed_once(
        joined, F.struct(words_of(F.col("text")).alias(words)), *kept, todo
    )

    def stands(c: Column) -> Column:
        length = F.size(F.split(c["phrase"], " "))
        there = F.slice(F.col(words), c["start"] + 1, length)
        return F.array_join(there, " ") == c["phrase"]

    checked = worded.select(
        *kept,
        F.size(words).cast("long").alias(size),
        F.filter(F.coalesce(F.col(todo), F.array()), stands).alias(found),
    )

    def covered(c: Column) -> Column:
        return F.sequence(c["start"], c["start"] + F.size(F.split(c["phrase"], " ")) - 1)

    hit = F.size(F.array_distinct(F.flatten(F.transform(found, covered)))).cast("long")
    names = F.array_sort(
        F.array_distinct(
            F.transform(F.flatten(F.col(f"{found}.items")), lambda i: i.cast("string"))
        )
    )
    plain = {
        results[0]: F.col(size),
        results[1]: hit,
        results[2]: F.size(names).cast("long"),
        results[3]: F.sha2(F.array_join(names, ","), 256),
        results[4]: (hit > 0) & (hit * 20 >= F.col(size)),
    }
    return checked.select(*kept, *[value.alias(name) for name, value in plain.items()])
