"""Removal of repeated word windows, found through anchors that the repeats share.

An operator names anchors: places of a document whose run of words stands elsewhere too, such
that two equal windows always have an anchor at the same place inside. Here every window around
an anchor is an entry under the hash of all its words; equal windows meet, and all but the
earliest are repeats. Entries travel as packed arrays, one row per task slice and bucket.
Repeats inside a slice are settled there, so a window that stands in a third of all documents
sends one entry per slice, and the windows that reach past a frequent passage, each with its
own hash, are spread over all buckets.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import free_names, stored
from cadenza.llm.words import Polynomial, Words, bytes_of, slices

NULL_ID = -(1 << 63)  # stands for a null doc_id, before all others
BUCKET_BYTES = 1 << 20  # text per bucket of packed entries
MIN_BUCKETS = 1 << 10
BUCKETS_A_TASK, MOST_TASKS = 16, 1 << 16
RESULTS = ("n_words", "n_removed", "kept")
PACKED = "bucket int, done boolean, ids binary, places binary, facts binary"
_NAMES = ["bucket", "done", "ids", "places", "facts"]
_STEP = 0x9E3779B1  # odd, so that consecutive numbers get distinct buckets
_TEXTS = 32  # texts whose settled entries travel together


def plain_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with ids that numpy holds."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text"
    )


def bucket_count(docs: DataFrame) -> int:
    """A power of two that gives each bucket about ``BUCKET_BYTES`` of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(MIN_BUCKETS, 1 << int(size // BUCKET_BYTES).bit_length())


def planes(values: np.ndarray) -> bytes:
    """Bytes by significance, so that the high ones compress away."""
    return values.reshape(-1).view(np.uint8).reshape(values.size, -1).T.tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def packed_ids(ids: np.ndarray) -> bytes:
    """Ids as steps, which are small where entries come in the order of their documents."""
    return planes(np.diff(ids, prepend=0))


def unpacked_ids(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.int64))


def rows_of(columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def packed_rows(
    bucket: np.ndarray, done: bool, ids: np.ndarray, places: np.ndarray, facts: np.ndarray
) -> pa.RecordBatch:
    """One row per bucket; ``facts`` has one line of values per entry. Entries in the order of
    their documents pack best."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(first_of_runs(bucket))
    rows = [[], [], [], [], []]
    for low, high in zip(cuts, np.append(cuts[1:], len(bucket)), strict=len(cuts) > 0):
        part = order[low:high]
        values = (int(bucket[low]), done, packed_ids(ids[part]), planes(places[part]))
        for column, value in zip(rows, (*values, planes(facts[part])), strict=True):
            column.append(value)
    return rows_of(rows)


def task_count(bucket_total: int, least: int) -> int:
    """Tasks of about ``BUCKETS_A_TASK`` buckets, so that a task's share stays the same as the
    input grows; buckets are read one by one, so beyond ``MOST_TASKS`` tasks get longer, and
    need no more memory."""
    wanted = bucket_total // BUCKETS_A_TASK if bucket_total > MIN_BUCKETS else 0
    return max(least, min(wanted, MOST_TASKS))


def in_buckets(packed: DataFrame, bucket_total: int) -> DataFrame:
    """The rows of a bucket next to each other in one task."""
    least = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = task_count(bucket_total, least)
    return packed.repartition(width, "bucket").sortWithinPartitions("bucket", "done")


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[tuple]]]:
    """Rows as (ids, places, facts): settled ones at once, others by whole buckets."""
    held, now = [], None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in _NAMES]
        for bucket, done, *row in zip(*columns, strict=True):
            if done:
                yield True, [tuple(row)]
                continue
            if bucket != now and held:
                yield False, held
                held = []
            now = bucket
            held.append(tuple(row))
    if held:
        yield False, held


def first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    fresh = np.ones(len(keys[0]), bool)
    if len(fresh) > 1:
        fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return fresh


def owners(hashes: np.ndarray, text: np.ndarray, bucket_total: int) -> np.ndarray:
    """A bucket per settled entry of a slice, by its text. They need no meeting, and those of a
    frequent run would all go to one task by its hash."""
    salt = int(hashes.sum(dtype=np.uint64)) % bucket_total
    return ((salt + text // _TEXTS * _STEP) % bucket_total).astype(np.int32)


def earliest(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray):
    """The entries in the order of hash, id and place, a mask of the first of each hash, and
    a mask of those that start later than it; several of one place are not later."""
    order = np.lexsort((places, ids, hashes))
    heads = first_of_runs(hashes[order])
    head = order[np.maximum.accumulate(np.where(heads, np.arange(len(order)), 0))]
    later = (ids[order] != ids[head]) | (places[order] != places[head])
    return order, heads, later


def _windows(window: int, anchor: int, bucket_total: int):
    """The windows around the anchors that end within their reach: repeats among the slice's
    own are settled, the first of each go on in buckets by their hash."""
    bits = np.uint64(int(bucket_total).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(*bytes_of(batch.column("text")))
            listed = batch.column("places")
            count = pa.compute.list_value_length(listed).to_numpy()
            text = np.repeat(np.arange(len(words)), count)
            place = listed.flatten().to_numpy().astype(np.int64)
            reach = batch.column("reach").flatten().to_numpy().astype(np.int64)
            n = words.counts()
            low = np.maximum(place - (window - anchor), 0)
            high = np.minimum(place + reach, n[text]) - window
            inside = (place >= 0) & (place + anchor <= n[text]) & (low <= high)
            if not inside.any():
                continue
            first = words.first[:-1][text][inside]
            around = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(around, first + low[inside], 1)
            np.add.at(around, first + high[inside] + 1, -1)
            at = np.flatnonzero(np.cumsum(around) > 0)
            text = np.searchsorted(words.first, at, "right") - 1
            ids = batch.column("doc_id").to_numpy()[text]
            place = (at - words.first[text]).astype(np.int32)
            hashes = Polynomial(words.hash).span(at, at + window)
            order, heads, later = earliest(hashes, ids, place)
            sent, known = np.sort(order[heads]), np.sort(order[later])
            # The bucket has the lowest bits.
            bucket = (hashes[sent] & np.uint64(bucket_total - 1)).astype(np.int32)
            yield packed_rows(bucket, False, ids[sent], place[sent], hashes[sent] >> bits)
            owner = owners(hashes, text[known], bucket_total)
            none = np.zeros(len(known), np.uint8)
            yield packed_rows(owner, True, ids[known], place[known], none)

    return run


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for done, rows in buckets(batches):
        ids = np.concatenate([unpacked_ids(r[0]) for r in rows])
        places = np.concatenate([unplanes(r[1], np.int32) for r in rows])
        if not done:
            hashes = np.concatenate([unplanes(r[2], np.uint64) for r in rows])
            order, _, later = earliest(hashes, ids, places)
            ids, places = ids[order[later]], places[order[later]]
        yield from grouped(ids, places)


def grouped(ids: np.ndarray, places: np.ndarray, reach: np.ndarray | None = None):
    """Entries as one row per document: ``doc_id``, ``places`` and, where given, ``reach``."""
    if not len(ids):
        return
    facts = [places] if reach is None else [places, reach]
    order = np.lexsort((places, ids))
    ids, facts = ids[order], [x[order].astype(np.int32) for x in facts]
    cuts = np.flatnonzero(first_of_runs(ids))
    ends = pa.array(np.append(cuts, len(ids)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in facts]
    names = ["doc_id", "places", "reach"][: len(lists) + 1]
    yield pa.RecordBatch.from_arrays([pa.array(ids[cuts]), *lists], names)


def by_document(found: DataFrame, *names: str) -> DataFrame:
    """All rows of a document as one; it holds at most one entry per word and source."""
    parts = [F.flatten(F.collect_list(name)).alias(name) for name in names]
    return found.groupBy("doc_id").agg(*parts)


def _removed(window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(*bytes_of(batch.column("text")))
            n = words.counts()
            places = batch.columns[-1]
            gone = np.zeros(len(words.hash) + 1, np.int64)
            count = pa.compute.list_value_length(places).fill_null(0).to_numpy()
            text = np.repeat(np.arange(len(n)), count)
            place = places.flatten().to_numpy().astype(np.int64)
            there = (place >= 0) & (place + window <= n[text])
            at = (words.first[:-1][text] + place)[there]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
            removed = np.cumsum(gone[:-1]) > 0
            n_removed = np.diff(np.concatenate([[0], np.cumsum(removed)])[words.first])
            kept = []
            for i in range(len(n)):
                rows = slice(words.first[i], words.first[i + 1])
                pieces = zip(
                    words.start[rows][~removed[rows]].tolist(),
                    words.end[rows][~removed[rows]].tolist(),
                    strict=True,
                )
                base, data = 0, words.data
                if n[i]:
                    base = int(words.start[words.first[i]])
                    data = data[base : int(words.end[words.first[i + 1] - 1])]
                raw = data.tobytes() if n[i] else b""
                if n_removed[i]:
                    kept.append(b" ".join(raw[s - base : e - base] for s, e in pieces))
                else:
                    kept.append(b" ".join(raw.split()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(n.astype(np.int64)),
                    pa.array(n_removed.astype(np.int64)),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names,
            )

    return run


def remove_repeats(docs: DataFrame, places: DataFrame, window: int, anchor: int) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept``, the text
    without the words of every ``window`` that also starts earlier; ``places`` has each
    document's anchors (``doc_id, places``), runs of ``anchor`` words that stand elsewhere too.
    Where it has a column ``reach``, at most so many words from the anchor on do, else there
    may be ``window``."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in RESULTS])
    if "reach" not in places.columns:
        places = places.withColumn("reach", F.transform("places", lambda _: F.lit(window)))
    total = bucket_count(docs)
    texts = plain_texts(docs).join(places, "doc_id")
    around = texts.mapInArrow(_windows(window, anchor, total), PACKED)
    marks = in_buckets(around, total).mapInArrow(_judged, "doc_id long, places array<int>")
    of, where = free_names(docs, "of", "places")
    marks = by_document(marks, "places").select(
        F.col("doc_id").alias(of), F.col("places").alias(where)
    )
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    joined = docs.join(marks, own == F.col(of), "left").drop(of)
    kinds = (T.LongType(), T.LongType(), T.StringType())
    out = T.StructType(
        [*docs.schema.fields, *(T.StructField(c, k) for c, k in zip(RESULTS, kinds, strict=True))]
    )
    return joined.mapInArrow(_removed(window, out.names), out)
