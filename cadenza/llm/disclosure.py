"""Information-theoretic sanitisation of personal data."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import free_names, stored
from cadenza.llm.words import LOWER, Words, bytes_of, signed, slices

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 10  # words on either side of an entity that may disclose it
MIN_SUPPORT = 2  # documents a term must share with an entity to count as evidence
GENERALISE, REMOVE = 0.8, 0.95  # shares of an entity's information that a term gives away

# Terms are runs of ASCII letters, in lower case, and of bytes past ASCII.
_TERMS = LOWER.copy()
_TERMS[:0x61], _TERMS[0x7B:0x80] = 0x20, 0x20
_TERMS[0x41:0x5B] = np.arange(0x61, 0x7B)
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _parts(address: str) -> list[str]:
    """The numbers of an address without leading zeros, of which there may be any number."""
    return [part.lstrip("0") for part in address.split(".")]


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs cost one scan."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of each kind in code points: leftmost, non-overlapping within a kind."""
    found = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    if not _DIGITS.search(text):
        return found
    found["ip"] = [
        m.span()
        for m in _IP.finditer(text)
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in _parts(m[0]))
    ]
    for match in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", match[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found["card"].append(match.span())
    if "+" in text:
        found["phone"] = [
            m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15
        ]
    return found


def _entity(kind: str, value: str) -> int:
    """A hash of the entity; spellings of one number are one entity."""
    plain = value.lower() if kind == "email" else _NOT_DIGITS.sub("", value)
    plain = value if kind == "ip" else plain
    digest = hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


class Terms:
    """The terms of a batch, and those of one text outside its base spans."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = bytes_of(column)
        self.words = Words(self.data, self.offsets, fold=_TERMS)

    def of(self, i: int, text: str, spans: dict[str, list[tuple[int, int]]]):
        """Hashes, byte starts and ends of text ``i``'s terms, and the base spans in bytes."""
        low, high = self.words.first[i], self.words.first[i + 1]
        start = self.words.start[low:high] - self.offsets[i]
        end = self.words.end[low:high] - self.offsets[i]
        placed = [
            (kind, s, e, len(text[:s].encode()), len(text[:e].encode()))
            for kind in KINDS
            for s, e in spans[kind]
        ]
        free = np.ones(len(start), bool)
        for *_, s, e in placed:
            free[np.searchsorted(end, s, "right") : np.searchsorted(start, e, "left")] = False
        return self.words.hash[low:high][free], start[free], end[free], placed


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each entity of a document with every term near any of its mentions, once."""
    for batch in slices(batches):
        column, terms, rows = batch.column("text"), None, []
        for i, text in enumerate(column.to_pylist()):
            spans = base_spans(text or "")
            if not any(spans.values()):
                continue
            terms = terms or Terms(column)
            hashes, start, end, placed = terms.of(i, text, spans)
            pairs = set()
            for kind, s, e, low, high in placed:
                entity = _entity(kind, text[s:e])
                before = np.searchsorted(end, low, "right")
                after = np.searchsorted(start, high, "left")
                near = [*hashes[max(0, before - CONTEXT) : before], *hashes[after : after + CONTEXT]]
                pairs |= {(entity, int(h.view(np.int64))) for h in near} | {(entity, None)}
            rows += [(i, e, t) for e, t in pairs]
        ids = pa.array([r[0] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(ids),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            ["doc_id", "entity", "term"],
        )


_HELD = 1 << 19  # terms counted in a task before they are passed on


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each term, summed over many documents of a task."""

    def summed(parts: list) -> pa.RecordBatch:
        terms, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
        return terms, counts

    def batch_of(terms, counts):
        return pa.RecordBatch.from_arrays([signed(terms), pa.array(counts)], ["term", "n"])

    held, size = [], 0
    for batch in slices(batches):
        words = Terms(batch.column("text")).words
        text = np.repeat(np.arange(len(words)), words.counts())
        order = np.lexsort((text, words.hash))
        hashes, text = words.hash[order], text[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes = hashes[fresh]
        held.append(summed([(hashes, np.ones(len(hashes)))]))
        size += len(held[-1][0])
        if size > _HELD:
            held = [summed(held)]
            size = len(held[0][0])
            if size > _HELD // 2:
                yield batch_of(*held[0])
                held, size = [], 0
    if held:
        yield batch_of(*summed(held))


def disclosures(docs: DataFrame) -> DataFrame:
    """``doc_id, terms``: for each document with an entity, the terms (``term``, ``share``)
    of its context that disclose it.

    With N documents and document counts n, a term's point-wise mutual information with an
    entity is log(N n(e, t) / (n(e) n(t))); its share of the entity's information
    log(N / n(e)) is 1 where the term gives the entity away in full. Pairs seen in fewer than
    ``MIN_SUPPORT`` documents are no evidence. All counts are over all documents.
    """
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    contexts = stored(
        plain.mapInArrow(_contexts, "doc_id long, entity long, term long"), "contexts"
    )
    total = plain.count()
    entities = contexts.where("term is null").groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = contexts.where("term is not null").groupBy("entity", "term")
    pairs = pairs.agg(F.count("*").alias("n_et")).where(F.col("n_et") >= MIN_SUPPORT)
    pairs = stored(pairs, "pairs")
    wanted = pairs.select("term").distinct()
    counts = plain.mapInArrow(_term_counts, "term long, n long")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n_t")).join(wanted, "term", "left_semi")
    judged = pairs.join(entities, "entity").join(counts, "term")
    whole = F.log(F.lit(float(total)) / F.col("n_e"))
    told = F.log(F.lit(float(total)) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    judged = judged.withColumn("share", told / whole).where(
        (F.col("n_e") < total) & (F.col("share") >= GENERALISE - 1e-9)
    )
    found = contexts.where("term is not null").join(
        judged.select("entity", "term", "share"), ["entity", "term"]
    )
    return found.groupBy("doc_id").agg(
        F.collect_set(F.struct("term", "share")).alias("terms")
    )


def _sanitised(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each span replaced; of overlapping ones the first stands for all."""
    out, done = [], 0
    for start, end, instead in sorted(spans):
        if start >= done:
            out += [text[done:start], instead]
        done = max(done, end)
    return "".join([*out, text[done:]])


RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "n_terms", "base_sha256", "spans", "sanitised")


def _applied(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column, terms, rows = batch.column("text"), None, []
            listed = batch.column(batch.num_columns - 1).to_pylist()
            for i, text in enumerate(column.to_pylist()):
                text = text or ""
                spans = base_spans(text)
                marks = [(s, e, f"[{k.upper()}]") for k in KINDS for s, e in spans[k]]
                base = [f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k]]
                extra = []
                if listed[i]:
                    terms = terms or Terms(column)
                    share: dict[int, float] = {}
                    for t in listed[i]:
                        share[t["term"]] = max(t["share"], share.get(t["term"], 0))
                    hashes, start, end, _ = terms.of(i, text, spans)
                    raw = np.frombuffer(text.encode(), np.uint8)
                    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    for h, s, e in zip(hashes.view(np.int64), chars[start], chars[end], strict=True):
                        if int(h) in share:
                            instead = "" if share[int(h)] >= REMOVE else "[TERM]"
                            marks.append((int(s), int(e), instead))
                            extra.append(f"term:{s}:{e}")
                rows.append(
                    (
                        *(len(spans[k]) for k in KINDS),
                        len(extra),
                        hashlib.sha256(",".join(base).encode()).hexdigest(),
                        ",".join(base + extra),
                        _sanitised(text, marks) if marks else text,
                    )
                )
            types = [pa.int64()] * 5 + [pa.string()] * 3
            found = [
                pa.array(values, kind)
                for values, kind in zip(zip(*rows, strict=True), types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names)

    return run


def sanitise(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_email, n_ip, n_card, n_phone, n_terms``,
    ``base_sha256`` (digest of the base spans), ``spans`` (all, as kind:start:end in code points,
    end exclusive) and ``sanitised`` (the text with spans replaced).

    Base spans are replaced by their kind. Terms near an entity that give away a share of its
    information of at least ``GENERALISE`` are generalised to ``[TERM]`` wherever they stand in
    that document, of at least ``REMOVE`` taken out; documents without an entity stay as they
    are. A null or empty text is empty and has no spans. Rows that share a doc_id, or have
    none, count as documents of their own but share the terms found for that id. An empty
    table gives an empty result. Input columns with the names of results are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in RESULTS])
    of, terms = free_names(docs, "of", "terms")
    found = disclosures(docs).select(F.col("doc_id").alias(of), F.col("terms").alias(terms))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(of)), "left").drop(of)
    kinds = [T.LongType()] * 5 + [T.StringType()] * 3
    out = T.StructType(
        [*docs.schema.fields, *(T.StructField(c, k) for c, k in zip(RESULTS, kinds, strict=True))]
    )
    return joined.mapInArrow(_applied(out.names), out)
