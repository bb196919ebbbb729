"""Quality classifier by co-training a text view and a metadata view."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import stored
from cadenza.llm.words import SPACE, Words, bytes_of, mix, slices

MAX_LABELLED = 20_000  # labelled rows of the fit; the pool is all rows without a label
ROUNDS = 5
CONFIDENT = 0.98  # calibrated probability from which a view's label is passed on
KEEP_FROM = 0.5  # documents of at least this probability of good quality are kept
GROWTH = 0.1  # at most this share of the pool per round and view
SCORES = ("text_score", "meta_score", "quality_score")

_CLASSES = np.zeros((8, 256))
_CLASSES[0, 0x41:0x5B] = 1
_CLASSES[1, 0x61:0x7B] = 1
_CLASSES[2, 0x30:0x3A] = 1
_CLASSES[3, SPACE] = 1
_CLASSES[4, [ord(c) for c in ".,;:'\"()-?"]] = 1
_CLASSES[5, [ord(c) for c in "!|"]] = 1
_CLASSES[6, [ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = 1
_CLASSES[7, 0x80:] = 1
_LENGTHS, _BUCKETS = 24, 32
_CELLS = _BUCKETS * _BUCKETS * _LENGTHS  # values that the metadata view can take
_PLAIN = 14  # features of the text view before their roots and the constant
_BINS = 1 << 16
SURE = float(np.log(CONFIDENT / (1 - CONFIDENT)))


def text_view(column: pa.Array) -> np.ndarray:
    """Shares of character classes, word lengths, and repetition of each text."""
    data, offsets = bytes_of(column)
    size = np.maximum(np.diff(offsets), 1)[:, None]
    shares = []
    for table in _CLASSES:
        sums = np.zeros(len(data) + 1)
        np.cumsum(table[data], out=sums[1:])
        shares.append(np.diff(sums[offsets]))
    shares = np.array(shares).T / size
    words = Words(data, offsets)
    count = words.counts()
    n = np.maximum(count, 1)
    text = np.repeat(np.arange(len(words)), count)

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, of))
        h, t = hashes[order], of[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        return np.bincount(t[fresh], minlength=len(words))

    pairs, pair_text, _ = words.grams(2)
    again = np.zeros(len(text))
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (text[1:] == text[:-1])
    length = np.bincount(text, words.end - words.start, minlength=len(words)) / n
    extra = [
        distinct(words.hash, text) / n,
        distinct(pairs, pair_text) / np.maximum(count - 1, 1),
        np.bincount(text, again, minlength=len(words)) / n,
        np.log1p(length),
        np.log1p(count),
        1 / np.sqrt(n),
    ]
    return widened(np.column_stack([shares, *extra]))


def widened(plain: np.ndarray) -> np.ndarray:
    return np.column_stack([plain, np.sqrt(plain), np.ones(len(plain))])


def meta_view(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Language, source and length class of each document, without its text."""
    out = np.zeros((len(lang), 2 * _BUCKETS + _LENGTHS + 1))
    rows = np.arange(len(lang))
    for k, column in enumerate((lang, source)):
        coded = column.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        bucket = [zlib.crc32(str(v).encode()) % (_BUCKETS - 1) + 1 for v in coded.dictionary]
        index = coded.indices.fill_null(len(bucket)).to_numpy(zero_copy_only=False)
        out[rows, k * _BUCKETS + np.array([*bucket, 0])[index]] = 1
    size = np.maximum(n_chars.cast(pa.int64()).fill_null(0).to_numpy(), 0)
    step = np.minimum(np.floor(np.log2(size + 1.0)).astype(int), _LENGTHS - 1)
    out[rows, 2 * _BUCKETS + step] = 1
    out[:, -1] = 1
    return out


def cells_of(meta: np.ndarray) -> np.ndarray:
    """A number for each distinct row of ``meta_view``."""
    lang, source, step = np.split(meta[:, :-1], [_BUCKETS, 2 * _BUCKETS], axis=1)
    return (lang.argmax(1) * _BUCKETS + source.argmax(1)) * _LENGTHS + step.argmax(1)


def meta_of(cells: np.ndarray) -> np.ndarray:
    out = np.zeros((len(cells), 2 * _BUCKETS + _LENGTHS + 1))
    rows, pairs = np.arange(len(cells)), cells // _LENGTHS
    out[rows, pairs // _BUCKETS] = 1
    out[rows, _BUCKETS + pairs % _BUCKETS] = 1
    out[rows, 2 * _BUCKETS + cells % _LENGTHS] = 1
    out[:, -1] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def sums_of(x: np.ndarray, y: np.ndarray, w: np.ndarray, n=1.0):
    """Gradient and Hessian of the loss at ``w``; row i counts ``n[i]`` times."""
    p = _sigmoid(x @ w)
    return x.T @ (n * (p - y)), (x * (n * (p * (1 - p) + 1e-9))[:, None]).T @ x


def fit_logistic(
    x: np.ndarray, y: np.ndarray, penalty: float = 1.0, more=None
) -> np.ndarray:
    """Ridge logistic regression by Newton steps; ``y`` may be probabilities. ``more`` gives
    the sums of further rows at a point."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        slope, curve = sums_of(x, y, w)
        if more:
            slope, curve = (a + b for a, b in zip((slope, curve), more(w), strict=True))
        curve = curve + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, slope + penalty * w)
        w -= step * min(1.0, 10 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class View:
    """One view's classifier: scaling, weights, and calibration of its logit."""

    shift: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    line: np.ndarray | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.shift) / self.scale

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = self.scaled(x) @ self.weights
        return np.clip(self.line[0] * z + self.line[1], -35, 35)

    def fit(self, x, y, held_x, held_y, told=None) -> None:
        more = told and (lambda w: told(self, w))
        self.weights = fit_logistic(self.scaled(x), y, 1.0, more)
        self.line = np.array([1.0, 0.0])
        raw = self.logit(held_x)
        self.line = fit_logistic(np.column_stack([raw, np.ones(len(raw))]), held_y, 1e-2)


@dataclass
class Model:
    """Both views and the weights that combine their calibrated logits; without views, the
    same score for all."""

    views: tuple[View, View] | None
    joint: np.ndarray
    prior: float = 1.0

    def scores(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        if self.views is None:
            return [np.full(len(text), self.prior)] * 3
        z = [view.logit(x) for view, x in zip(self.views, (text, meta), strict=True)]
        joint = np.column_stack([*z, np.ones(len(text))]) @ self.joint
        return [_sigmoid(x) for x in (*z, joint)]


def ranks(z: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How sure a logit is, by steps; equal ones by ``order``, which is below ``_BINS``."""
    return (np.abs(z) / 35 * (_BINS - 1)).astype(np.int64) * _BINS + order


def labels_by(passed: list[tuple[View, int]], x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The label that each row got from a view: in the first round, as (view, least rank),
    in which it was sure enough; nan where it never was."""
    label = np.full(len(x), np.nan)
    for view, least in passed:
        z = view.logit(x)
        chosen = (np.abs(z) >= SURE) & (ranks(z, order) >= least) & np.isnan(label)
        label[chosen] = z[chosen] > 0
    return label


class ArrayPool:
    """Rows without a label, in memory."""

    def __init__(self, text: np.ndarray, meta: np.ndarray):
        self.data = (text, meta)
        self.count = len(text)
        self.order = (mix(np.arange(len(text), dtype=np.uint64)) % np.uint64(_BINS)).astype(np.int64)

    def total(self, counted, size: int) -> np.ndarray:
        """The sum of ``counted(data, order)``, ``size`` numbers, over all rows."""
        return counted(self.data, self.order)

    def told(self, k: int, passed: list):
        """The sums of view ``k`` over the rows that the other view has labelled."""
        label = labels_by(passed, self.data[1 - k], self.order)
        x, y = self.data[k][~np.isnan(label)], label[~np.isnan(label)]
        return lambda view, w: sums_of(view.scaled(x), y, w)


class TablePool(ArrayPool):
    """Rows without a label as a table ``plain, cell, order``, read once per sum."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.count = rows.count()

    def total(self, counted, size: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                if not batch.num_rows:
                    continue
                plain = np.frombuffer(b"".join(batch.column("plain").to_pylist()))
                meta = meta_of(batch.column("cell").to_numpy())
                data = (widened(plain.reshape(-1, _PLAIN)), meta)
                out += counted(data, batch.column("order").to_numpy().astype(np.int64))
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["at", "part"])

        parts = self.rows.mapInArrow(run, "at long, part double")
        parts = parts.groupBy("at").agg(F.sum("part").alias("part")).toArrow()
        out = np.zeros(size)
        out[parts.column("at").to_numpy()] = parts.column("part").to_numpy()
        return out

    def told(self, k: int, passed: list):
        if k:
            def labelled(data, order):
                label, cells = labels_by(passed, data[0], order), cells_of(data[1])
                there = ~np.isnan(label)
                pairs = 2 * cells[there] + label[there].astype(int)
                return np.bincount(pairs, minlength=2 * _CELLS)

            n = self.total(labelled, 2 * _CELLS)
            at = np.flatnonzero(n)
            x = meta_of(at // 2)
            return lambda view, w: sums_of(view.scaled(x), at % 2, w, n[at])

        def sums(view, w):
            view = replace(view)

            def both(data, order):
                label = labels_by(passed, data[1], order)
                there = ~np.isnan(label)
                found = sums_of(view.scaled(data[0][there]), label[there], w)
                return np.concatenate([x.ravel() for x in found])

            flat = self.total(both, len(w) * (len(w) + 1))
            return flat[: len(w)], flat[len(w) :].reshape(len(w), len(w))

        return sums


def least_ranks(pool: ArrayPool, views: list[View]) -> list[int]:
    """Per view the rank from which at most ``GROWTH`` of the pool are sure."""
    views, most = [replace(v) for v in views], int(pool.count * GROWTH) + 1

    def counts(step, places):
        found = []
        for view, x, place in zip(views, step[0], places, strict=True):
            z = view.logit(x)
            rank = ranks(z, step[1])[np.abs(z) >= SURE]
            if place is not None:
                rank = rank[rank // _BINS == place] % _BINS * _BINS
            found.append(np.bincount(rank // _BINS, minlength=_BINS))
        return np.concatenate(found)

    def cut(n, left):
        """The least bin from which no more than ``left`` are counted, and what remains."""
        above = np.append(np.cumsum(n[::-1])[::-1], 0)
        at = int(np.argmax(above <= left))
        return at, left - above[at]

    size = 2 * _BINS
    coarse = pool.total(lambda data, order: counts((data, order), (None, None)), size)
    at = [cut(n, most) for n in np.split(coarse, 2)]
    if not any(bin_ for bin_, _ in at):
        return [0, 0]
    split = [bin_ - 1 for bin_, _ in at]
    fine = pool.total(lambda data, order: counts((data, order), split), size)
    ends = [cut(n, left)[0] for n, (_, left) in zip(np.split(fine, 2), at, strict=True)]
    return [max(b * _BINS + e, 0) for b, e in zip(split, ends, strict=True)]


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, pool=None) -> Model:
    """A model from rows in a fixed order; ``label`` is 0, 1, or -1 for the pool, unless that
    is given as ``pool``.

    Every fifth labelled row is held out to calibrate. In each round a view labels the pool
    rows it is surest of, and those labels train the other view in the next round.
    """
    known = np.flatnonzero(label >= 0)
    if pool is None:
        pool = ArrayPool(text[label < 0], meta[label < 0])
    held, train = known[::5], np.setdiff1d(known, known[::5])
    y = label.astype(float)
    if min(len(set(label[held])), len(set(label[train]))) < 2:
        return Model(None, np.zeros(3), float(y[known].mean()) if len(known) else 1.0)
    data = (text, meta)
    views = []
    for x in data:
        shift, scale = x[known].mean(axis=0), x[known].std(axis=0)
        flat = scale < 1e-9
        views.append(View(np.where(flat, 0, shift), np.where(flat, 1, scale)))
    passed = ([], [])  # by each view, as views and least ranks
    for step in range(ROUNDS):
        for k, view in enumerate(views):
            told = pool.told(k, passed[1 - k]) if step and pool.count else None
            view.fit(data[k][train], y[train], data[k][held], y[held], told)
        if step < ROUNDS - 1 and pool.count:
            for view, least, rounds in zip(views, least_ranks(pool, views), passed, strict=True):
                rounds.append((replace(view), least))
    z = [view.logit(x[held]) for view, x in zip(views, data, strict=True)]
    joint = fit_logistic(np.column_stack([*z, np.ones(len(held))]), y[held], 1e-2)
    return Model((views[0], views[1]), joint)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        plain = text_view(batch.column("text"))[:, :_PLAIN]
        meta = meta_view(*(batch.column(c) for c in ("lang", "source", "n_chars")))
        columns = [
            batch.column("doc_id"),
            batch.column("digest"),
            pa.array([row.tobytes() for row in plain], pa.binary()),
            pa.array(cells_of(meta)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "plain", "cell"])


_FACTS = ("doc_id", "text", "lang", "source", "n_chars")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``MAX_LABELLED`` labelled documents, the first by the hash of their id,
    and on all documents without a label, of which only sums come to the driver.

    Labels other than 0 and 1, null ids among them, are ignored; of several labels of one
    document the least counts, of several rows the one with the least text hash. Rows
    without an id are documents of their own, but for equal texts.
    """
    given = labels.where("doc_id is not null and quality in (0, 1)")
    given = given.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rows = docs.select(*_FACTS).withColumn("digest", F.xxhash64("text"))
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    found = rows.mapInArrow(_features, f"doc_id {kind}, digest long, plain binary, cell long")
    none = F.when(F.col("doc_id").isNull(), F.col("digest"))
    one = found.groupBy("doc_id", none.alias("none")).agg(
        F.min(F.struct("digest", "plain", "cell")).alias("one")
    )
    one = one.join(given, "doc_id", "left").select(
        "doc_id", "quality", F.xxhash64("doc_id", "none").alias("hash"), "one.plain", "one.cell"
    )
    one = stored(one, "features")
    known = one.where("quality is not null").orderBy("hash", "doc_id").limit(MAX_LABELLED)
    table = known.toArrow().sort_by([("hash", "ascending"), ("doc_id", "ascending")])
    if not table.num_rows:
        return Model(None, np.zeros(3))
    order = F.pmod("hash", F.lit(_BINS)).cast("int").alias("order")
    pool = TablePool(one.where("quality is null").select("plain", "cell", order))
    plain = np.frombuffer(b"".join(table.column("plain").to_pylist())).reshape(-1, _PLAIN)
    meta = meta_of(table.column("cell").to_numpy())
    return co_train(widened(plain), meta, table.column("quality").to_numpy(), pool)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``text_score, meta_score, quality_score``: the
    probability of good quality by each view and by both.

    Null and empty texts are scored like any text, null metadata are a class of their own.
    Input columns with the names of results are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in SCORES])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = text_view(batch.column("text"))
            meta = meta_view(*(batch.column(c) for c in ("lang", "source", "n_chars")))
            columns = [*batch.columns, *(pa.array(x) for x in model.scores(text, meta))]
            yield pa.RecordBatch.from_arrays(columns, [*names, *SCORES])

    schema = T.StructType(
        [*docs.schema.fields, *(T.StructField(c, T.DoubleType()) for c in SCORES)]
    )
    return docs.mapInArrow(run, schema)
