"""Line deduplication within one word edit, by a join of deletion neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import free_names, stored
from cadenza.llm.words import LENGTH_SALT, Polynomial, Words, bytes_of, mix, signed, slices

MIN_WORDS = 8  # shorter lines must be equal
_PREFIX, _SUFFIX, _SAME_PLACE, _SHORTER = (
    np.random.default_rng(7).integers(0, 1 << 63, 4, dtype=np.uint64)
)
SUBSTITUTED, WHOLE, SHORTENED = 0, 1, 2


class Lines:
    """The lines with words of a batch: text index, line number, and range of words."""

    def __init__(self, column: pa.Array):
        data, offsets = bytes_of(column)
        self.words = Words(data, offsets)
        breaks = np.flatnonzero(data == 0x0A)
        text = np.repeat(np.arange(len(self.words)), self.words.counts())
        line = np.searchsorted(breaks, self.words.start)
        line = line - np.searchsorted(breaks, offsets[:-1])[text]
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
        self.low = np.flatnonzero(fresh)
        self.high = np.append(self.low[1:], len(text)) if len(text) else self.low
        self.text, self.line = text[self.low], line[self.low]
        self.poly = Polynomial(self.words.hash)
        self.hash = self.poly.span(self.low, self.high)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line with its hash and the keys that lines one edit away share.

    One edit leaves the first or the last half of the words alone, the halves being those of
    the shorter line; a line is the shorter or the longer one.
    """
    for batch in slices(batches):
        lines = Lines(batch.column("text"))
        n = lines.high - lines.low
        short = n < MIN_WORDS
        keys = []
        for shorter in (n, n - 1):
            half, salt = np.maximum(shorter, 0) // 2, mix(shorter.astype(np.uint64))
            ends = ((_PREFIX, lines.low, lines.low + half), (_SUFFIX, lines.high - half, lines.high))
            for kind, low, high in ends:
                key = mix(lines.poly.span(low, high) ^ (salt + kind))
                keys.append(pa.array(key.view(np.int64), mask=short))
        ids = batch.column("doc_id").take(pa.array(lines.text))
        place = pa.array(lines.line.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [ids, place, signed(lines.hash), *keys],
            ["doc_id", "line", "hash", "key0", "key1", "key2", "key3"],
        )


def deletion_keys(poly: Polynomial, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a line's deletion neighbourhood, and the kind of each.

    Two lines of one length that are equal without the word at the same place share a
    SUBSTITUTED key; a line that lacks one word of another has as WHOLE the other's SHORTENED
    key. No other two lines share such keys, so equal keys are within one edit.
    """
    n = int(high - low)
    at = np.arange(n)
    rest = poly.raw(low, low + at) + poly.up[at] * poly.raw(low + at + 1, np.full(n, high))
    rest = mix(rest + np.uint64((n - 1) * LENGTH_SALT & (1 << 64) - 1))
    same_place = mix(rest ^ mix(at.astype(np.uint64) + _SAME_PLACE))
    whole = poly.span(np.array([low]), np.array([high]))
    keys = np.concatenate([same_place, mix(rest + _SHORTER), mix(whole + _SHORTER)])
    kinds = np.repeat(np.array([SUBSTITUTED, SHORTENED, WHOLE], np.int32), (n, n, 1))
    return keys, kinds


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        lines = Lines(batch.column("text"))
        wanted = [set(x) for x in batch.column("wanted").to_pylist()]
        hashes = lines.hash.view(np.int64)
        picked = [
            k
            for k, (text, line) in enumerate(zip(lines.text, lines.line, strict=True))
            if wanted[text] and int(line) in wanted[text]
        ]
        found = [deletion_keys(lines.poly, lines.low[k], lines.high[k]) for k in picked]
        sizes = [len(keys) for keys, _ in found]
        of = np.repeat(np.array(picked, np.int64), sizes)
        keys = np.concatenate([np.zeros(0, np.uint64), *(keys for keys, _ in found)])
        kinds = np.concatenate([np.zeros(0, np.int32), *(kinds for _, kinds in found)])
        # Key and kind travel as one number; there are many more of these than lines.
        tags = keys & np.uint64((1 << 64) - 4) | kinds.astype(np.uint64)
        yield pa.RecordBatch.from_arrays([signed(tags), pa.array(hashes[of])], ["tag", "hash"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        lines = Lines(batch.column("text"))
        wanted = [set(x) for x in batch.column("wanted").to_pylist()]
        words, hashes, out = lines.words, [], []
        for k, (text, line) in enumerate(zip(lines.text, lines.line, strict=True)):
            if int(line) in wanted[text]:
                low, high = words.start[lines.low[k]], words.end[lines.high[k] - 1]
                hashes.append(lines.hash[k].view(np.int64))
                out.append(words.data[low:high].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes, pa.int64()), pa.array(out, pa.binary())], ["hash", "words"]
        )


def within_one_edit(a: list, b: list) -> bool:
    """Whether one insertion, deletion or substitution, or none, makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(
            batch.column("words").to_pylist(), batch.column("near_words").to_pylist(), strict=True
        )
        good = [within_one_edit(a.split(), b.split()) for a, b in pairs]
        kept = batch.select(["hash", "near"]).filter(pa.array(good, pa.bool_()))
        yield kept


def _rewritten(results: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lines = Lines(batch.column("text"))
            hashes = lines.hash.view(np.int64)
            count = np.bincount(lines.text, minlength=batch.num_rows)
            text = batch.column("text")
            drops = batch.column(batch.num_columns - 1)
            removed = np.zeros(batch.num_rows, np.int64)
            changed = {}
            for i in np.flatnonzero(drops.is_valid().to_numpy(zero_copy_only=False)):
                listed = {(d["line"], d["hash"]) for d in drops[i].as_py()}
                low, high = np.searchsorted(lines.text, [i, i + 1])
                gone = {
                    int(lines.line[k])
                    for k in range(low, high)
                    if (int(lines.line[k]), int(hashes[k])) in listed
                }
                if gone:
                    parts = text[i].as_py().split("\n")
                    changed[i] = "\n".join(x for k, x in enumerate(parts) if k not in gone)
                    removed[i] = len(gone)
            if changed:
                values = text.to_pylist()
                for i, value in changed.items():
                    values[i] = value
                text = pa.array(values, text.type)
            columns = [
                text if name == "text" else batch.column(name) for name in batch.schema.names[:-1]
            ]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(count.astype(np.int64)), pa.array(removed)], results
            )

    return run


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines taken out of ``text``, and
    ``n_lines`` (lines that have words) and ``n_removed``.

    A line goes if an earlier line (smaller doc_id, then smaller line number) has the same
    words, or, where both have ``MIN_WORDS`` or more, words that one insertion, deletion or
    substitution of a word makes equal. Lines are judged on the input, not on what is left.
    Words are separated by ASCII white space, lines by line feeds; lines without words stay.

    Null texts stay null and have no lines; null doc_ids come before all others. Rows that
    share a doc_id are one place: equal lines with the same number are no repeats of each
    other. An empty table gives an empty result. Input columns with the names of results are
    replaced. Only lines that share half of their words with another line have their deletion
    neighbourhood made, which loses none, and a key's rows are never paired with each other:
    each key needs only its earliest line of each kind.
    """
    results = ["n_lines", "n_removed"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in results])
    plain = docs.select("doc_id", "text")
    schema = "doc_id long, line int, hash long, key0 long, key1 long, key2 long, key3 long"
    lines = stored(
        plain.select(F.col("doc_id").cast("long"), "text").mapInArrow(_listed, schema), "lines"
    )
    place = F.struct("doc_id", "line")
    keys = F.array("key0", "key1", "key2", "key3")
    distinct = lines.groupBy("hash").agg(
        F.min(place).alias("place"), F.count("*").alias("n"), F.first(keys).alias("keys")
    )
    distinct = stored(distinct, "distinct")

    halves = distinct.where("keys[0] is not null").select(F.explode("keys").alias("key"), "hash")
    shared = halves.groupBy("key").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    near = halves.join(shared.where("low < high").select("key"), "key", "left_semi")
    near = distinct.join(near.select("hash").distinct(), "hash", "left_semi")
    wanted = near.groupBy(F.col("place.doc_id").alias("of")).agg(
        F.collect_set("place.line").alias("wanted")
    )
    texts = plain.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select(
        F.col("doc_id").cast("long"), "text", "wanted"
    )
    texts = stored(texts, "texts")
    variants = stored(texts.mapInArrow(_neighbourhoods, "tag long, hash long"), "variants")
    keyed = variants.select(F.shiftright("tag", 2).alias("key"), "tag", "hash")
    met = keyed.groupBy("key").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    met = keyed.join(met.where("low < high").select("key"), "key")
    met = met.join(near.select("hash", "place"), "hash").select(
        "key",
        F.col("tag").bitwiseAND(F.lit(3)).cast("int").alias("kind"),
        "hash",
        "place.doc_id",
        "place.line",
    )
    met = stored(met, "met")
    first = [
        F.min(F.when(F.col("kind") == kind, F.struct("doc_id", "line", "hash"))).alias(f"first{kind}")
        for kind in (SUBSTITUTED, WHOLE, SHORTENED)
    ]
    met = met.join(met.groupBy("key").agg(*first), "key")
    other = (
        F.when(F.col("kind") == SUBSTITUTED, F.col(f"first{SUBSTITUTED}"))
        .when(F.col("kind") == WHOLE, F.col(f"first{SHORTENED}"))
        .otherwise(F.col(f"first{WHOLE}"))
    )
    met = met.withColumn("near", other).where("near is not null and near.hash <> hash")
    met = met.groupBy("hash").agg(F.min("near").alias("near"))
    words = stored(texts.mapInArrow(_texts, "hash long, words binary"), "words")
    words = words.groupBy("hash").agg(F.first("words").alias("words"))
    pairs = met.join(words, "hash").join(
        words.select(F.col("hash").alias("h"), F.col("words").alias("near_words")),
        F.col("near.hash") == F.col("h"),
    )
    pairs = pairs.select("hash", F.struct("near.doc_id", "near.line").alias("near"), "words", "near_words")
    checked = pairs.mapInArrow(
        _verified, "hash long, near struct<doc_id: long, line: int>"
    )

    earliest = distinct.join(checked, "hash", "left").where("n > 1 or near is not null")
    earliest = earliest.select(
        "hash", F.when(F.col("near") < F.col("place"), F.col("near")).otherwise(F.col("place")).alias("e")
    )
    gone = lines.select("doc_id", "line", "hash").join(earliest, "hash").where(place > F.col("e"))
    of, drops = free_names(docs, "of", "drops")
    gone = gone.groupBy(F.col("doc_id").alias(of)).agg(
        F.collect_list(F.struct("line", "hash")).alias(drops)
    )
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(of)), "left").drop(of)
    out = T.StructType(
        [*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in results)]
    )
    return joined.mapInArrow(_rewritten(out.names), out)
