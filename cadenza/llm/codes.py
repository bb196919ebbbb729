"""Codes of vectors by exact integer Lloyd rounds that look only at entries that moved."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import discard, recorded, stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LARGEST = 1 << 27  # components up to this size have distances of up to 64 dimensions in 63 bits
_EXACT = 1 << 53  # integers below this are exact as doubles
_CELLS = 1 << 21  # distances held at a time
_STATE = "vec_id long, label {label}, whole array<long>, code array<int>, away array<long>"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, whole``: each component as ``floor(1024 * x)``. Vectors that are null or
    hold null, non-finite or too large components are left out."""
    good = F.forall(
        "embedding",
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(F.floor(x.cast("double") * SCALE)) <= LARGEST),
    )
    kept = vectors.where(F.col("embedding").isNotNull() & good)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("whole"))


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    largest = max(np.abs(rows).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * rows.shape[1] * int(largest) ** 2 < _EXACT:
        x, c = rows.astype(float), entries.astype(float)
        squares = (x * x).sum(1)[:, None] + (c * c).sum(1)
        return (squares - 2 * (x @ c.T)).astype(np.int64)
    out = np.zeros((len(rows), len(entries)), np.int64)
    for i in range(rows.shape[1]):
        out += (rows[:, i, None] - entries[:, i]) ** 2
    return out


def nearest(rows: np.ndarray, entries: np.ndarray, only: np.ndarray | None = None):
    """Number and distance of each row's nearest entry, the lowest number of equal ones; of
    the entries ``only``, which ascend."""
    only = np.arange(len(entries)) if only is None else only
    code, away = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int64)
    step = max(1, _CELLS // max(1, len(only)))
    for low in range(0, len(rows), step):
        d = distances(rows[low : low + step], entries[only])
        best = d.argmin(1)
        code[low : low + step] = only[best]
        away[low : low + step] = d[np.arange(len(d)), best]
    return code, away


def reassigned(rows, entries, moved, code, away):
    """The same as ``nearest`` for rows with their last code and exact distance.

    Where a row's entry has not moved, its distance holds, and no entry that has not moved can
    have become nearer: only moved entries are compared, a tie goes to the lower number. Rows
    whose entry moved are compared with all.
    """
    code, away = code.copy(), away.copy()
    fixed, changed = ~moved[code], np.flatnonzero(moved)
    if len(changed):
        new, near = nearest(rows[fixed], entries, changed)
        old, far = code[fixed], away[fixed]
        better = (near < far) | ((near == far) & (new < old))
        code[fixed], away[fixed] = np.where(better, new, old), np.where(better, near, far)
        code[~fixed], away[~fixed] = nearest(rows[~fixed], entries)
    return code, away


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy().astype(kind).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(values.reshape(-1)))


def _assign(books: np.ndarray, moved: np.ndarray | None):
    """Rows with their codes for ``books`` (part, entry, position); the first time from scratch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column("whole"), np.int64)
            parts = whole.reshape(len(whole), PARTS, -1)
            code = np.zeros((len(whole), PARTS), np.int32)
            away = np.zeros((len(whole), PARTS), np.int64)
            if moved is not None:
                code = _matrix(batch.column("code"), np.int32)
                away = _matrix(batch.column("away"), np.int64)
            for p in range(PARTS):
                if moved is None:
                    code[:, p], away[:, p] = nearest(parts[:, p], books[p])
                else:
                    found = reassigned(parts[:, p], books[p], moved[p], code[:, p], away[:, p])
                    code[:, p], away[:, p] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _lists(code), _lists(away)],
                ["vec_id", "label", "whole", "code", "away"],
            )

    return run


def _sums(shape: tuple[int, int, int]):
    """Count and sums of each entry's parts, one row per entry and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _matrix(batch.column("whole"), np.int64).reshape(-1, PARTS, shape[2])
            code = _matrix(batch.column("code"), np.int32)
            for p in range(PARTS):
                np.add.at(total[p], code[:, p], parts[:, p])
                count[p] += np.bincount(code[:, p], minlength=shape[1])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(count[part, entry]),
                _lists(total[part, entry]) if len(part) else pa.array([], pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "total"],
        )

    return run


def _updated(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of their parts' means; those without parts stay."""
    sums = state.mapInArrow(
        _sums(books.shape), "part int, entry int, n long, total array<long>"
    )
    each = sums.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    means = each.groupBy("part", "entry", "at").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n")
    )
    # One row per entry and position: no more than the codebooks hold.
    new = books.copy()
    for row in means.collect():
        new[row["part"], row["entry"], row["at"]] = row["x"] // row["n"]
    return new


def _first_books(rows: DataFrame) -> np.ndarray | None:
    """The parts of the vectors of the smallest ids, of one length."""
    first = rows.where("vec_id is not null").orderBy("vec_id", "whole").limit(ENTRIES).collect()
    if not first:
        return None
    whole = np.array([r["whole"] for r in first], np.int64)
    return whole.reshape(len(whole), PARTS, -1).transpose(1, 0, 2).copy()


def encode(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, away``: the number of the nearest codebook entry of each of the
    ``PARTS`` parts of a vector, and the squared distances; and the codebooks (part, entry,
    position).

    Components become ``floor(1024 * x)``, so all sums are exact. The codebooks start as the
    parts of the ``ENTRIES`` smallest vec_ids; ``ROUNDS`` times all parts go to their nearest
    entry and each entry moves to the floor of their mean. A row keeps its codes and distances
    from round to round; what is done again is what moved. Only the codebooks and their sums
    reach the driver.

    Vectors that are null or hold null, non-finite or too large components (beyond ``LARGEST``)
    are left out, and so are those whose length is not a multiple of ``PARTS`` or not that of
    the smallest vec_id's vector. Rows of a null vec_id are coded but start no entry; rows of
    equal ids are separate, and start entries in the order of their components. With fewer than
    ``ENTRIES`` rows the codebooks are shorter. Null labels are kept. Other columns are not
    returned. Without usable rows the result is empty.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors).where(F.size("whole") % PARTS == 0).where(F.size("whole") > 0)
    smallest = rows.where("vec_id is not null").orderBy("vec_id", "whole").first()
    if smallest is None:
        smallest = rows.orderBy("whole").first()
    length = len(smallest["whole"]) if smallest else 0
    label = vectors.schema["label"].dataType.simpleString()
    schema = _STATE.format(label=label)
    with recorded() as paths:
        state = stored(rows.where(F.size("whole") == length), "vectors")
    books = _first_books(state)
    if books is None:
        empty = spark.createDataFrame([], schema).drop("whole")
        return empty, np.zeros((PARTS, 0, length // PARTS), np.int64)
    moved = None
    for number in range(ROUNDS + 1):
        with recorded() as new:
            state = stored(state.mapInArrow(_assign(books, moved), schema), "codes")
        # The last round's rows hold all that is needed.
        discard(spark, paths)
        paths = new
        if number < ROUNDS:
            after = _updated(state, books)
            moved, books = (after != books).any(2), after
    return state.drop("whole"), books
