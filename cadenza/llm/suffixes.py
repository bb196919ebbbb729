"""Repeated passages by a sparse suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.anchors import by_document, grouped, plain_texts, remove_repeats
from cadenza.llm.common import stored, with_own_ids
from cadenza.llm.words import Words, bytes_of, slices

PASSAGE = 50  # words from which a repeat counts, and words of a suffix that are sorted
PREFIX = PASSAGE // 2  # words that a minimiser looks at, and the least that a match shares
SPAN = PASSAGE - PREFIX + 1  # prefixes in a passage, one of which is its minimiser
_LETTERS = 255  # words become letters from 1, by their hash; 0 is the end of a text
_SUFFIX = "suffix binary, doc_id long, place int"
_ORDER = ("suffix", "doc_id", "place")


def letters_of(words: Words) -> np.ndarray:
    """A letter per word, and ``PASSAGE`` ends after the last."""
    letters = (words.hash >> np.uint64(32)) % np.uint64(_LETTERS) + np.uint64(1)
    return np.append(letters.astype(np.uint8), np.zeros(PASSAGE, np.uint8))


def _fixed(rows: np.ndarray) -> pa.Array:
    """Lines of bytes as a binary column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    data = np.ascontiguousarray(rows)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes at minimisers: of every ``SPAN`` consecutive prefixes the least by hash,
    the first of equal ones. Equal passages choose the same places. A suffix is written as
    the letters of its first ``PASSAGE`` words."""
    for batch in slices(batches):
        words = Words(*bytes_of(batch.column("text")))
        hashes, text, place = words.grams(PREFIX)
        if len(hashes) < SPAN:
            continue
        views = np.lib.stride_tricks.sliding_window_view(hashes, SPAN)
        least = np.arange(len(views)) + views.argmin(axis=1)
        chosen = np.unique(least[text[: len(views)] == text[SPAN - 1 :]])
        text, place = text[chosen], place[chosen]
        at = (words.first[:-1][text] + place)[:, None] + np.arange(PASSAGE)
        suffix = np.where(at < words.first[1:][text][:, None], letters_of(words)[at], 0)
        yield pa.RecordBatch.from_arrays(
            [
                _fixed(suffix.astype(np.uint8)),
                batch.column("doc_id").take(pa.array(text)),
                pa.array(place.astype(np.int32)),
            ],
            list(_ORDER),
        )


def common_words(suffixes: np.ndarray) -> np.ndarray:
    """How many letters each suffix but the last shares with the next, up to an end."""
    same = (suffixes[1:] == suffixes[:-1]) & (suffixes[1:] != 0)
    return np.where(same.all(axis=1), PASSAGE, same.argmin(axis=1))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes, those that share ``PREFIX`` words with a neighbour, and how many
    with the nearer one. The first and last of a task come with their letters too, to be
    compared with the neighbouring tasks'."""

    def edge(row: tuple) -> pa.RecordBatch:
        suffix, doc_id, place = row
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(doc_id)], pa.int64()),
                pa.array([[int(place)]], pa.list_(pa.int32())),
                pa.array([[0]], pa.list_(pa.int32())),
                pa.array([suffix.tobytes()], pa.binary()),
            ],
            _FOUND,
        )

    held = [np.zeros((0, PASSAGE), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    first, before = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        data, _ = bytes_of(batch.column("suffix"))
        new = [data.reshape(-1, PASSAGE), *(batch.column(c).to_numpy() for c in _ORDER[1:])]
        suffixes, ids, place = (np.concatenate(x) for x in zip(held, new, strict=True))
        if first is None:
            first = (suffixes[0], ids[0], place[0])
        after = common_words(suffixes)
        reach = np.maximum(np.append(before, after)[:-1], after)
        # The last one still waits for what follows it.
        yield from _matches(ids[:-1], place[:-1], reach)
        before = int(after[-1]) if len(after) else before
        held = [suffixes[-1:], ids[-1:], place[-1:]]
    if first is not None:
        yield from _matches(held[1], held[2], np.array([before]))
        last = tuple(x[0] for x in held)
        yield edge(first)
        if last[1:] != first[1:]:
            yield edge(last)


_FOUND = ["doc_id", "places", "reach", "edge"]


def _matches(ids: np.ndarray, places: np.ndarray, reach: np.ndarray) -> Iterator[pa.RecordBatch]:
    shared = reach >= PREFIX
    for rows in grouped(ids[shared], places[shared], reach[shared]):
        none = pa.nulls(rows.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([*rows.columns, none], _FOUND)


def repeated_suffixes(docs: DataFrame) -> DataFrame:
    """``doc_id, places, reach``: the minimisers whose words stand elsewhere too, at least
    ``PREFIX`` of them, and how many from there on (``PASSAGE`` for more).

    The suffix array is sorted over all tasks by the words' letters, then by place, so that
    frequent words are cut into several tasks. A suffix shares with no other one more than
    with its two neighbours, so ``reach`` bounds its repeats wherever they stand; letters that
    are equal for unlike words only make it longer. The ends of the tasks, two rows of each,
    are sorted once more and compared in the same way.
    """
    suffixes = stored(docs.mapInArrow(_suffixes, _SUFFIX), "suffixes")
    found = suffixes.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    kinds = "doc_id long, places array<int>, reach array<int>, edge binary"
    found = stored(found.mapInArrow(_neighbours, kinds), "neighbours")
    edges = found.where("edge is not null").select(
        F.col("edge").alias("suffix"), "doc_id", F.col("places")[0].alias("place")
    )
    across = edges.coalesce(1).sortWithinPartitions(*_ORDER).mapInArrow(_neighbours, kinds)
    every = found.unionByName(across).where("edge is null")
    return by_document(every, "places", "reach")


def dedup_passages(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept``: the text
    without each word of a passage of at least ``PASSAGE`` words that also starts earlier
    (smaller doc_id, or the same and an earlier word). Kept words are joined by one space.

    Only suffixes at content-selected minimisers are kept, about two in 27. Neighbours of the
    sorted array that share ``PREFIX`` words are matches. To the right each reaches as far as
    its words are those of a neighbour; to the left it is extended by comparing the passages
    that begin before it and end within that reach, so every repeat of ``PASSAGE`` words or
    more is found whole.

    Passages are judged on the input. Null texts have no words and an empty ``kept``. Rows
    that share a doc_id or have none are documents of their own, in the order of their texts'
    hashes, null before all ids; of equal rows one stays whole. An empty table gives an empty
    result. Input columns with the names of results are replaced.
    """
    return with_own_ids(docs, _without_passages)


def _without_passages(docs: DataFrame) -> DataFrame:
    places = stored(repeated_suffixes(plain_texts(docs)), "matches")
    return remove_repeats(docs, places, PASSAGE, PREFIX)
