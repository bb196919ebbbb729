"""Substring deduplication by fixed-block anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadenza.llm.anchors import (
    PACKED,
    bucket_count,
    buckets,
    by_document,
    first_of_runs,
    grouped,
    in_buckets,
    owners,
    packed_rows,
    plain_texts,
    remove_repeats,
    unpacked_ids,
    unplanes,
)
from cadenza.llm.common import stored, with_own_ids
from cadenza.llm.words import Words, bytes_of, slices

WINDOW = 20
BLOCK = WINDOW // 2  # every window holds a whole block of its document's grid


def _probes(bucket_total: int):
    """Every rolling run of ``BLOCK`` words of a slice, each distinct one once, in buckets.

    An index block is a run at a multiple of ``BLOCK``. Runs that repeat inside the slice are
    anchors already; one of them goes on for the other slices, as a block if one of them is.
    """
    bits = int(bucket_total).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(*bytes_of(batch.column("text")))
            hashes, text, place = words.grams(BLOCK)
            if not len(hashes):
                continue
            ids = batch.column("doc_id").to_numpy()[text]
            order = np.argsort(hashes, kind="stable")
            hashes, ids, place = hashes[order], ids[order], place[order].astype(np.int32)
            heads = np.flatnonzero(first_of_runs(hashes))
            block = np.add.reduceat((place % BLOCK == 0).astype(np.int64), heads) > 0
            size = np.diff(np.append(heads, len(hashes)))
            # The bucket has the lowest bits; the next 31 and the block's mark are kept.
            rest = (hashes[heads] >> np.uint64(bits)).astype(np.uint32)
            rest = rest & np.uint32(0xFFFFFFFE) | block.astype(np.uint32)
            bucket = (hashes[heads] & np.uint64(bucket_total - 1)).astype(np.int32)
            read = np.argsort(order[heads])  # back in the order of the text
            first = heads[read]
            yield packed_rows(bucket[read], False, ids[first], place[first], rest[read])
            again = np.flatnonzero(np.repeat(size > 1, size))
            where = again[np.argsort(order[again])]
            owner = owners(hashes, text[order[where]], bucket_total)
            none = np.zeros(len(where), np.uint8)
            yield packed_rows(owner, True, ids[where], place[where], none)

    return run


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The probes that meet an index block other than themselves, and those blocks."""
    for done, rows in buckets(batches):
        ids = np.concatenate([unpacked_ids(r[0]) for r in rows])
        places = np.concatenate([unplanes(r[1], np.int32) for r in rows])
        if not done:
            rest = np.concatenate([unplanes(r[2], np.uint32) for r in rows])
            order = np.argsort(rest >> 1, kind="stable")
            key, block = rest[order] >> 1, rest[order] & 1
            heads = np.flatnonzero(first_of_runs(key))
            size = np.diff(np.append(heads, len(key)))
            hit = (size > 1) & (np.add.reduceat(block.astype(np.int64), heads) > 0)
            found = order[np.repeat(hit, size)]
            ids, places = ids[found], places[found]
        yield from grouped(ids, places)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept``: the text
    without each word covered by a run of ``WINDOW`` words that also starts earlier (smaller
    doc_id, or the same and an earlier word). Kept words are joined by one space.

    The blocks of ``BLOCK`` words at a document's multiples of ``BLOCK`` are the index; every
    rolling run of ``BLOCK`` words probes it. Two equal windows always share such a hit at the
    same place, as each window holds a whole block. Hits are extended to all windows around
    them, which are compared as wholes.

    Windows are judged on the input, not on what is left. Null texts have no words and an empty
    ``kept``. Rows that share a doc_id or have none are documents of their own, in the order of
    their texts' hashes, null before all ids; of equal rows one stays whole. An empty table
    gives an empty result. Input columns with the names of results are replaced.
    """
    return with_own_ids(docs, _without_substrings)


def _without_substrings(docs: DataFrame) -> DataFrame:
    plain = plain_texts(docs)
    total = bucket_count(docs)
    probes = plain.mapInArrow(_probes(total), PACKED)
    hits = in_buckets(probes, total).mapInArrow(_hits, "doc_id long, places array<int>")
    places = stored(by_document(hits, "places"), "hits")
    return remove_repeats(docs, places, WINDOW, BLOCK)
