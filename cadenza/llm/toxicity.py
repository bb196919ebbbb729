"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel counts the common subsequences of ``ORDER`` characters of two strings; one of
``gaps`` skipped characters weighs ``DECAY ** gaps``, up to ``SPAN`` characters in all, so an insult
with inserted characters still shares most of its subsequences. Its strings are the windows of a
sentence: words with their edges, single letters that stand next to each other taken together,
and overlapping pieces of long words. The machine learns on windows (multiple-instance learning:
which ones make a toxic text toxic is part of what is learned); a text is judged by its worst
windows and how many windows lie on the toxic side.

The machine is linear in the landmarks' kernel values, and those are linear in subsequences,
so a fitted model is one weight per subsequence, and a text is scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.anchors import first_of_runs
from cadenza.llm.common import stored
from cadenza.llm.words import bytes_of, slices

ORDER, SPAN, DECAY = 3, 5, 0.5
MAX_LABELLED = 20_000  # labelled documents of the fit
LANDMARKS = (256, 128)  # strings of toxic and of clean sentences
WITNESSES = 3  # windows of a toxic text that speak for it
CLEAN_WINDOWS = 4_000  # windows of clean sentences per round, at random, and the worst so far
ROUNDS = 4
PENALTY = 1e-3
SIGNIFICANT = 12.0  # chi-square from which a run of four characters speaks for toxic sentences
MAX_RUNS = 4_096  # such runs kept, by significance
TOXIC_FROM = 0.7
RESULT = "toxicity"

_EDGE, _DROP, _SYMBOLS = 63, 255, 64
_BLOCK = 12  # a window is at most two blocks of characters
_OFFSETS = [(a, c) for c in range(2, SPAN) for a in range(1, c)]
_CELLS = _SYMBOLS**ORDER


def _alphabet() -> np.ndarray:
    """A symbol per byte: letters, digits, shares of the bytes of other scripts, edges at white
    space; other ASCII characters are left out, so that they cannot part a word."""
    fold = np.full(256, _DROP, np.uint8)
    fold[0x61:0x7B] = np.arange(26)
    fold[0x30:0x3A] = 26 + np.arange(10)
    fold[0x80:] = 36 + np.arange(128) % 27
    fold[[0x20, *range(0x09, 0x0E)]] = _EDGE
    return fold


_FOLD = _alphabet()


def _self_kernel() -> np.ndarray:
    """Root of the kernel of a window of n symbols with itself, all subsequences distinct."""
    size = 2 * _BLOCK + 1
    out = np.zeros(size)
    for n in range(size):
        out[n] = sum(max(n - c, 0) * DECAY ** (2 * (c + 1 - ORDER)) for _, c in _OFFSETS)
    return np.sqrt(np.maximum(out, 1.0))


_NORM = _self_kernel()


class Windows:
    """The windows of several texts: ``text`` (number) of each, its ``low`` and ``high`` in
    ``symbols``."""

    def __init__(self, column: pa.Array):
        column = pa.compute.utf8_lower(column.cast(pa.large_string()).fill_null(""))
        data, offsets = bytes_of(column)
        # Two edges between texts keep their single letters apart.
        ends = np.repeat(offsets[:-1], 2)
        symbols = _FOLD[np.insert(data, ends, 0x20)]
        of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 2)
        kept = symbols != _DROP
        symbols, of = symbols[kept], of[kept]
        edge = symbols == _EDGE
        between = np.zeros(len(edge), bool)
        if len(edge) > 4:
            between[2:-2] = edge[2:-2] & ~edge[1:-3] & edge[:-4] & ~edge[3:-1] & edge[4:]
        symbols, of = symbols[~between], of[~between]
        symbols = np.append(symbols, np.uint8(_EDGE))
        of = np.append(of, of[-1] if len(of) else 0)
        edge = symbols == _EDGE
        self.symbols = symbols
        # Blocks of a word, which begins at the edge before it.
        starts = np.flatnonzero(edge)
        sizes = np.diff(np.append(starts, len(symbols)))
        pieces = -(-sizes // _BLOCK)
        word = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.blocks = starts[word] + nth * _BLOCK
        after = np.append(self.blocks[1:], len(symbols))
        two = np.append(word[1:] == word[:-1], False)
        # A window is a block and the next of the word; a last block has been part of one.
        alone = (nth == 0) | two
        whole = alone & (sizes[word] > 1)
        self.index = np.flatnonzero(whole)
        self.two = two[self.index]
        self.low = self.blocks[self.index]
        self.high = np.where(self.two, np.append(after[1:], len(symbols))[self.index], after[self.index])
        self.text = of[self.low]
        far = np.where(edge, np.arange(len(edge)), len(edge))
        next_edge = np.append(np.minimum.accumulate(far[::-1])[::-1][1:], len(edge))
        self.reach = next_edge - np.arange(len(edge))

    def __len__(self) -> int:
        return len(self.low)

    def subsequences(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Start, subsequence and weight, one array per pattern of gaps."""
        s = self.symbols.astype(np.int32)
        for a, c in _OFFSETS:
            at = np.flatnonzero(self.reach[: len(s) - c] >= c) if len(s) > c else np.zeros(0, int)
            key = (s[at] * _SYMBOLS + s[at + a]) * _SYMBOLS + s[at + c]
            yield at, key, DECAY ** (c + 1 - ORDER)

    def norms(self) -> np.ndarray:
        # The edge after the word belongs to its windows too.
        size = self.high - self.low + (self.symbols[np.minimum(self.high, len(self.symbols) - 1)] == _EDGE)
        return _NORM[np.minimum(size, len(_NORM) - 1)]

    def values(self, weights: np.ndarray) -> np.ndarray:
        """The sum of the weights of each window's subsequences, by its norm."""
        each = np.zeros(len(self.symbols))
        for at, key, weight in self.subsequences():
            each[at] += weight * weights[key]
        return self.sums(each) / self.norms()

    def sums(self, each: np.ndarray) -> np.ndarray:
        if not len(self.index):
            return np.zeros(0)
        blocks = np.append(np.add.reduceat(each, self.blocks), 0.0)
        return blocks[self.index] + np.where(self.two, blocks[self.index + 1], 0.0)

    def strings(self, which: np.ndarray) -> list[bytes]:
        """Symbols of windows, with the edges around them: equal strings are equal windows."""
        tail = self.symbols.tobytes()
        return [
            tail[low : high + (high < len(tail) and tail[high] == _EDGE)]
            for low, high in zip(self.low[which].tolist(), self.high[which].tolist(), strict=True)
        ]

    def worst(self, values: np.ndarray, above: float) -> tuple[np.ndarray, np.ndarray]:
        """The windows of each text with a value over ``above``, the worst first, and the place
        of each among those of its text."""
        found = np.flatnonzero(values > above)
        order = found[np.lexsort((found, -values[found], self.text[found]))]
        heads = np.flatnonzero(first_of_runs(self.text[order])) if len(order) else order
        size = np.diff(np.append(heads, len(order)))
        return order, np.arange(len(order)) - np.repeat(heads, size)


def profiles(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, subsequence and normalised weight of strings of symbols, summed."""
    rows, keys, weights = [], [], []
    for row, text in enumerate(strings):
        s = np.frombuffer(text, np.uint8).astype(np.int64)
        inner = np.flatnonzero(s[1:] == _EDGE) + 1
        end = int(inner[0]) if len(inner) else len(s)
        size = min(len(s), len(_NORM) - 1)
        for a, c in _OFFSETS:
            at = np.arange(max(0, min(len(s) - c, end - c + 1)))
            keys.append((s[at] * _SYMBOLS + s[at + a]) * _SYMBOLS + s[at + c])
            weights.append(np.full(len(at), DECAY ** (c + 1 - ORDER) / _NORM[size]))
            rows.append(np.full(len(at), row))
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(weights)


def landmark_features(strings: list[bytes], landmarks: list[bytes]):
    """Nystroem features of the strings, and the map from landmarks' features to weights of
    subsequences."""
    rows, keys, weights = profiles(landmarks)
    known, column = np.unique(keys, return_inverse=True)
    marks = np.zeros((len(landmarks), len(known)))
    np.add.at(marks, (rows, column), weights)
    values, vectors = np.linalg.eigh(marks @ marks.T)
    good = values > 1e-8 * max(values.max(initial=0), 1e-12)
    root = vectors[:, good] / np.sqrt(values[good])
    fold = marks.T @ root  # subsequence to feature
    rows, keys, weights = profiles(strings)
    at = np.searchsorted(known, keys)
    there = np.flatnonzero((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == keys))
    out = np.zeros((len(strings), fold.shape[1]))
    for low in range(0, len(there), 1 << 15):
        part = there[low : low + (1 << 15)]
        each = fold[at[part]] * weights[part, None]
        heads = np.flatnonzero(first_of_runs(rows[part]))
        out[rows[part][heads]] += np.add.reduceat(each, heads)
    return out, known, fold


def fit_machine(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of a support vector machine with squared hinge loss, by Newton
    steps; both classes weigh the same, rows inside them by their counts."""
    sign = np.where(y, 1.0, -1.0)
    share = np.where(y, 0.5 / max(counts[y].sum(), 1e-9), 0.5 / max(counts[~y].sum(), 1e-9)) * counts
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], PENALTY)
    ridge[-1] = 1e-9
    for _ in range(50):
        margin = 1 - sign * (z @ w)
        on = margin > 0
        slope = ridge * w - z[on].T @ (share[on] * sign[on] * margin[on])
        curve = (z[on] * share[on, None]).T @ z[on] + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class Model:
    """A weight per subsequence, the machine's constant, and the scale of its probabilities."""

    weights: np.ndarray
    constant: float
    scale: np.ndarray

    def values(self, windows: Windows) -> np.ndarray:
        return windows.values(self.weights) + self.constant

    def probability(self, texts: pa.Array) -> np.ndarray:
        z = text_facts(Windows(texts), self, len(texts)) @ self.scale[:-1] + self.scale[-1]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def text_facts(windows: Windows, model: Model, texts: int) -> np.ndarray:
    """The values of the ``WITNESSES`` worst windows of each text, from -1 to 1, and how many
    windows lie on the toxic side, in all and by the text's size, as logarithms."""
    values = model.values(windows)
    facts = np.zeros((texts, WITNESSES + 2))
    facts[:, :WITNESSES] = -1.0
    order, place = windows.worst(values, -1.0)
    few = place < WITNESSES
    facts[windows.text[order[few]], place[few]] = np.minimum(values[order[few]], 1.0)
    size = np.bincount(windows.text, minlength=texts)
    toxic = np.bincount(windows.text[values > 0], minlength=texts)
    facts[:, -2] = np.log1p(toxic)
    facts[:, -1] = np.log1p(toxic * 100 / np.maximum(size, 1))
    return facts


def calibrated(facts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights that turn the facts of texts into a probability: ridge logistic regression with
    smoothed targets, the constant last."""
    n, m = int(toxic.sum()), int((~toxic).sum())
    target = np.where(toxic, (n + 1) / (n + 2), 1 / (m + 2))
    x = np.column_stack([facts, np.ones(len(facts))])
    ridge = np.full(x.shape[1], 0.1)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (p - target) + ridge * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, text`` of at most ``MAX_LABELLED`` labelled documents."""
    found = labels.where("doc_id is not null and toxic in (0, 1)")
    found = found.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    # At most MAX_LABELLED rows of two numbers.
    found = F.broadcast(stored(found, "labels"))
    texts = docs.select("doc_id", "text").join(found, "doc_id")
    # Rows that share an id are one document: the text of the least hash.
    text = F.min_by("text", F.xxhash64("text")).alias("text")
    return stored(texts.groupBy("doc_id", "toxic").agg(text), "labelled")


def labelled_sentences(texts: DataFrame) -> DataFrame:
    """``sentence, toxic``: the distinct sentences, those of any clean document clean. Copies of
    a document so count once."""
    parts = texts.select("toxic", F.explode(F.split("text", r"[.!?\n]+")).alias("sentence"))
    parts = parts.where(F.length(F.trim("sentence")) > 0)
    return stored(parts.groupBy("sentence").agg(F.min("toxic").alias("toxic")), "sentences")


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clean and toxic sentences of a slice with each run of four symbols."""
    for batch in slices(batches, "sentence"):
        run, of = _runs(Windows(batch.column("sentence")))
        toxic = batch.column("toxic").to_numpy()[of]
        pair = np.unique(run * np.int64(len(batch) + 1) + of)
        run, of = pair // (len(batch) + 1), pair % (len(batch) + 1)
        toxic = batch.column("toxic").to_numpy()[of] > 0
        known, at = np.unique(run, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(known),
                pa.array(np.bincount(at, toxic, len(known)).astype(np.int64)),
                pa.array(np.bincount(at, ~toxic, len(known)).astype(np.int64)),
            ],
            ["run", "toxic", "clean"],
        )


def _runs(windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Runs of four neighbouring symbols inside words, and the text of each."""
    s = windows.symbols.astype(np.int64)
    if len(s) < 4 or not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(windows.reach[:-3] >= 3)
    run = ((s[at] * 64 + s[at + 1]) * 64 + s[at + 2]) * 64 + s[at + 3]
    window = np.searchsorted(windows.low, at, "right") - 1
    return run, windows.text[np.maximum(window, 0)]


def _significant(sentences: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Runs of four symbols that stand more often in toxic sentences, with the likelihood
    ratio's chi-square."""
    sums = sentences.groupBy("toxic").count().collect()
    total = {r["toxic"]: r["count"] for r in sums}
    n, m = float(total.get(1, 0)), float(total.get(0, 0))
    if not n or not m:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = sentences.mapInArrow(_run_counts, "run long, toxic long, clean long")
    counts = counts.groupBy("run").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a"), F.col("b")
    rate = (a + b) / (n + m)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    chi = 2 * (
        part(a, rate * n) + part(b, rate * m)
        + part(F.lit(n) - a, (1 - rate) * n) + part(F.lit(m) - b, (1 - rate) * m)
    )
    best = counts.where(a * m > b * n).select("run", chi.alias("chi"))
    best = best.where(F.col("chi") >= SIGNIFICANT).orderBy(F.desc("chi"), "run").limit(MAX_RUNS)
    rows = sorted((r["run"], r["chi"]) for r in best.collect())
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows])


def _first_values(windows: Windows, runs: np.ndarray, chi: np.ndarray) -> np.ndarray:
    """The root of the chi-squares of each window's runs, as the first guess."""
    s = windows.symbols.astype(np.int64)
    each = np.zeros(len(s))
    if len(s) >= 4 and len(runs):
        at = np.flatnonzero(windows.reach[:-3] >= 3)
        run = ((s[at] * 64 + s[at + 1]) * 64 + s[at + 2]) * 64 + s[at + 3]
        place = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
        each[at] = np.where(runs[place] == run, np.sqrt(chi[place]), 0.0)
    return windows.sums(each)


def _witnesses(valued):
    """The worst windows of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            windows = Windows(batch.column("text"))
            values = valued(windows)
            order, place = windows.worst(values, 0.0)
            strings = windows.strings(order[place < WITNESSES])
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary())], ["window"])

    return run


def _clean_windows(valued, salt: int):
    """Of the distinct windows of a slice, the worst, and some drawn by what they hold."""
    table = np.random.default_rng(salt).random(_CELLS) * 1e6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sentence"):
            windows = Windows(batch.column("sentence"))
            value, draw = valued(windows), np.round(windows.values(table) % 1, 3)
            order = np.lexsort((draw, np.round(value, 9)))
            heads = np.flatnonzero(first_of_runs(np.round(value, 9)[order], draw[order]))
            count = np.diff(np.append(heads, len(order)))
            order = order[heads]
            value, draw = value[order], draw[order]
            size = min(CLEAN_WINDOWS, len(value))
            worst = np.argsort(-value, kind="stable")[:size]
            drawn = np.argsort(draw, kind="stable")[:size]
            picked = np.union1d(worst, drawn)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(windows.strings(order[picked]), pa.binary()),
                    pa.array(value[picked]),
                    pa.array(draw[picked]),
                    pa.array(count[picked]),
                ],
                ["window", "value", "draw", "n"],
            )

    return run


def _witness_rows(texts: DataFrame, valued) -> tuple[np.ndarray, np.ndarray]:
    """The distinct witnesses of the toxic texts, and how many texts name each: at most
    ``WITNESSES`` rows for each of ``MAX_LABELLED`` texts."""
    found = texts.where("toxic = 1").select("doc_id", "text").mapInArrow(
        _witnesses(valued), "window binary"
    )
    rows = sorted((bytes(r[0]), r[1]) for r in found.groupBy("window").count().collect())
    return np.array([r[0] for r in rows], dtype=object), np.array([r[1] for r in rows], float)


def _clean_rows(sentences: DataFrame, valued, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """At most twice ``CLEAN_WINDOWS`` windows of clean sentences, and how often each was met."""
    found = sentences.where("toxic = 0").select("sentence").mapInArrow(
        _clean_windows(valued, salt), "window binary, value double, draw double, n long"
    )
    distinct = found.groupBy("window").agg(
        F.max("value").alias("value"), F.min("draw").alias("draw"), F.sum("n").alias("n")
    )
    distinct = stored(distinct, "clean")
    worst = distinct.orderBy(F.desc("value"), "window").limit(CLEAN_WINDOWS)
    drawn = distinct.orderBy("draw", "window").limit(CLEAN_WINDOWS)
    rows = dict((bytes(r[0]), r[1]) for r in worst.union(drawn).select("window", "n").collect())
    strings = sorted(rows)
    return np.array(strings, dtype=object), np.array([rows[x] for x in strings], float)


def _spread(strings: np.ndarray, often: np.ndarray, size: int) -> list[bytes]:
    """Of sorted distinct strings, the most frequent, then others at equal steps."""
    if len(strings) <= size:
        return list(strings)
    most = np.argsort(-often, kind="stable")[: size // 2]
    others = np.setdiff1d(np.arange(len(strings)), most)
    steps = others[np.linspace(0, len(others) - 1, size - len(most)).astype(int)]
    return [strings[i] for i in sorted({*most.tolist(), *steps.tolist()})]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels.toxic`` from at most ``MAX_LABELLED`` labelled documents.

    Each toxic document names witnesses, the windows that speak loudest: at first by runs of
    characters that toxic sentences hold significantly more often, then by the machine itself. The
    machine separates witnesses from windows of clean sentences, those it gets most wrong among
    them. The probabilities are scaled on every fifth document, which the
    machine has not seen, where these have ten of each label; else on all.

    Labels other than 0 and 1, null labels and null ids count as none. A document labelled both
    ways is toxic. Of rows that share an id one text is taken. Texts without words have no
    sentence. Without labels of both kinds, or without anything that speaks for toxic sentences,
    the model gives every text the share of toxic labels.
    """
    texts = labelled_texts(docs, labels)
    fifth = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0
    kinds = {r["toxic"]: r["count"] for r in texts.where(fifth).groupBy("toxic").count().collect()}
    held = min(kinds.get(0, 0), kinds.get(1, 0)) >= 10
    seen = texts.where(~fifth) if held else texts
    sentences = labelled_sentences(seen)
    weights, constant = np.zeros(_CELLS), 0.0
    runs, chi = _significant(sentences)

    def valued(windows: Windows) -> np.ndarray:
        return _first_values(windows, runs, chi)

    share = _odds(seen)
    if len(runs):
        spoken, often = _witness_rows(seen, valued)
    for number in range(ROUNDS if len(runs) and len(spoken) else 0):
        clean, met = _clean_rows(sentences, valued, number)
        # A witness that clean texts name as readily is none.
        there = dict(zip(clean, met, strict=True))
        telling = often > share * np.array([there.get(x, 0.0) for x in spoken])
        if not telling.any():
            break
        spoken, often = spoken[telling], often[telling]
        marks = _spread(spoken, often, LANDMARKS[0])
        marks += _spread(clean, met, LANDMARKS[1])
        x, known, fold = landmark_features([*spoken, *clean], marks)
        toxic = np.arange(len(x)) < len(spoken)
        counts = np.sqrt(np.concatenate([often, met]))
        machine, constant = fit_machine(x, toxic, counts)
        weights = np.zeros(_CELLS)
        weights[known] = fold @ machine
        valued = _valuer(weights, constant)
        named = _witness_rows(seen, valued)
        if not len(named[0]):
            break
        spoken, often = named
    return _scaled(Model(weights, constant, np.zeros(0)), texts.where(fifth) if held else texts)


def _odds(texts: DataFrame) -> float:
    """Toxic texts for each clean one."""
    sums = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    return sums.get(1, 0) / max(sums.get(0, 0), 1)


def _valuer(weights: np.ndarray, constant: float):
    def valued(windows: Windows) -> np.ndarray:
        return windows.values(weights) + constant

    return valued


def _scaled(model: Model, texts: DataFrame) -> Model:
    """The model with its probabilities scaled on the texts: at most ``MAX_LABELLED`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            facts = text_facts(Windows(batch.column("text")), model, len(batch))
            kept = [batch.column("doc_id"), batch.column("toxic"), pa.array(list(facts))]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "toxic", "facts"])

    rows = texts.mapInArrow(run, "doc_id long, toxic int, facts array<double>").collect()
    rows = sorted((r["doc_id"], r["toxic"], r["facts"]) for r in rows)
    toxic = np.array([r[1] > 0 for r in rows], bool)
    if not toxic.any() or toxic.all():
        share = (toxic.sum() + 1) / (len(toxic) + 2)
        scale = np.array([0.0] * (WITNESSES + 2) + [np.log(share / (1 - share))])
    else:
        scale = calibrated(np.array([r[2] for r in rows]), toxic)
    return replace(model, scale=scale)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``toxicity``, the probability from 0 to 1 (six
    decimals) that the row's text is toxic.

    Only the text counts. Null, empty and wordless texts get what a text without any window over
    -1 gets. Whole texts of any length are read. An empty table gives an empty
    result. An input column named ``toxicity`` is replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == RESULT])
    out = T.StructType([*docs.schema.fields, T.StructField(RESULT, T.DoubleType())])
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chance = model.probability(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(chance, 6))], names)

    return docs.mapInArrow(run, out)
