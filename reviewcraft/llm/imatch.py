"""I-Match fingerprints of documents (operator 13).

A lexicon keeps the terms of a band of inverse document frequency: neither those that too
many documents share nor those of a single document. A document's fingerprint hashes its
distinct lexicon terms in sorted order, once for the whole lexicon and once for each of
several randomised subsets of it. Subsets come in two sizes, so that documents of few and
of many terms both have some in which only a term or two decide: two documents agree there
about as often as they share terms. Their likeness is the share of equal hashes among the
subsets that hold a term of either.

Document frequencies are counted over all documents, in a fixed number of hashed cells; the
frequency of a cell is the sum over its words. The lexicon is one bit a cell, so what is
broadcast has a fixed size and vocabularies have none.

A text without lexicon terms is fingerprinted by all its words. A text without words (null
counts as empty) has the fingerprint of no term; two of those are alike (1), and unlike (0)
any other. Equal texts have equal fingerprints.

Documents follow each other by ``doc_id`` (null first), then by the hash of their text, so
repeated rows are neighbours. The last is followed by the first; a single document follows
itself. Columns other than ``doc_id`` and ``text`` are not read by the comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft.llm.cells import is_set, mixed, tallied_bits
from reviewcraft.llm.common import bounded_batches, stored, utf8
from reviewcraft.llm.split_words import byte_kinds, split_words
from reviewcraft.llm.word_memo import text_slices

#: All ASCII but letters and digits is white space here.
KINDS = byte_kinds(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Bytes of text that are taken apart at a time, unless one text is longer.
SLICE_BYTES = 1 << 20
SUBSETS = 64
#: A subset of each of these sizes holds one lexicon term in so many.
ONE_IN = (64, 512)
WHOLE_DIGITS, SUBSET_DIGITS = 16, 4
LENGTH = WHOLE_DIGITS + SUBSET_DIGITS * SUBSETS * len(ONE_IN)
NO_TERM = "0" * LENGTH


@dataclass(frozen=True)
class LexiconParams:
    #: Terms of fewer documents are too rare for the band.
    least_documents: int = 2
    #: Terms of more than one document in so many are too common for it.
    most_share: float = 1 / 8
    cells: int = 1 << 26


def _hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def _cell(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (mixed(hashes) & np.uint64(cells - 1)).astype(np.int64)


def learn_lexicon(docs: DataFrame, params: LexiconParams = LexiconParams()) -> np.ndarray:
    """One bit for each cell of terms: whether it lies in the band. Counts all documents."""
    bounded_batches(docs.sparkSession)
    most = int(docs.count() * params.most_share)

    def cells_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        texts, cells, counts = [x.as_py() for x in batch.column(0)], [], []
        for a, b in text_slices(texts, SLICE_BYTES):
            words = split_words(texts[a:b], KINDS)
            n = max(len(words.distinct), 1)
            once = np.unique(words.text * n + words.codes) % n
            cells.append(_cell(_hashes(words.distinct), params.cells))
            counts.append(np.bincount(once, minlength=len(words.distinct)))
        none = np.empty(0, dtype=np.int64)
        return np.concatenate([none, *cells]), np.concatenate([none, *counts])

    return tallied_bits(
        docs.select(utf8().alias("utf8")),
        cells_of,
        params.cells,
        lambda counts: (counts >= params.least_documents) & (counts <= most),
    )


# --- fingerprints -----------------------------------------------------------------------------


def fingerprint(hashes: np.ndarray, in_lexicon: np.ndarray) -> str:
    """The fingerprint of a text from the sorted hashes of its distinct words."""
    terms = hashes[in_lexicon] if in_lexicon.any() else hashes
    if not len(terms):
        return NO_TERM
    digest = xxhash.xxh3_64_intdigest
    slots = np.zeros((len(ONE_IN), SUBSETS), dtype=np.uint16)
    for level, one_in in enumerate(ONE_IN):
        subset = (mixed(terms, 16 + level) % np.uint64(one_in)).astype(np.int64)
        held = np.flatnonzero(subset < SUBSETS)
        order = held[np.argsort(subset[held], kind="stable")]
        starts = np.flatnonzero(np.diff(subset[order], prepend=-1))
        ends = [*starts[1:].tolist(), len(order)]
        data = terms[order]
        for at, (a, b) in zip(subset[order[starts]].tolist(), zip(starts.tolist(), ends)):
            slots[level, at] = digest(data[a:b].tobytes(), level) % 0xFFFF + 1
    whole = f"{digest(terms.tobytes()) or 1:0{WHOLE_DIGITS}x}"
    return whole + slots.astype(">u2").tobytes().hex()


def fingerprints(texts: list[bytes], lexicon: np.ndarray) -> list[str]:
    """Fingerprints of many texts."""
    out: list[str] = []
    for a, b in text_slices(texts, SLICE_BYTES):
        out += _fingerprints(texts[a:b], lexicon)
    return out


def _fingerprints(texts: list[bytes], lexicon: np.ndarray) -> list[str]:
    words = split_words(texts, KINDS)
    hashes = _hashes(words.distinct)
    # Codes in the order of their hashes, so that the distinct ones of a text come sorted.
    order = np.argsort(hashes)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    hashes = hashes[order]
    known = is_set(lexicon, _cell(hashes, 8 * len(lexicon)))
    n = max(len(hashes), 1)
    pairs = np.unique(words.text * n + rank[words.codes])
    cuts = np.searchsorted(pairs, np.arange(len(texts) + 1, dtype=np.int64) * n)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        at = pairs[a:b] % n
        out.append(fingerprint(hashes[at], known[at]))
    return out


def likeness(one: str, other: str) -> float:
    """Share of equal hashes among those that are of some term in either fingerprint."""
    if one == other:
        return 1.0
    if one == NO_TERM or other == NO_TERM:
        return 0.0
    a = np.frombuffer(bytes.fromhex(one[WHOLE_DIGITS:]), dtype=">u2")
    b = np.frombuffer(bytes.fromhex(other[WHOLE_DIGITS:]), dtype=">u2")
    used = (a > 0) | (b > 0)
    same_whole = one[:WHOLE_DIGITS] == other[:WHOLE_DIGITS]
    return float((np.count_nonzero(used & (a == b)) + same_whole) / (np.count_nonzero(used) + 1))


def with_fingerprints(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """``docs`` with a column ``fingerprint``, which is replaced if it exists."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf(T.StringType())
    def of_texts(texts):
        return texts.__class__(fingerprints([bytes(t) for t in texts], shared.value), dtype=object)

    return docs.withColumn("fingerprint", of_texts(utf8()))


# --- documents, their edited texts and the next documents ----------------------------------------


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# Hexadecimal columns are stored as the bytes they stand for.
_HEX = ["edited_sha256", "fingerprint", "edited_fingerprint"]
_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, "
    "part int, first_text string, last_text string"
)
_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "double": pa.float64(),
}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in _COMPARED.split(", "))])


def _compared(doc_id, text: str, own: str, following: str, next_own: str, changed: str, mark: str):
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).digest(),
        bytes.fromhex(own),
        bytes.fromhex(mark),
        likeness(own, mark),
        likeness(own, next_own),
    )


def compare_with_edits(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """Each document against its edited text and against the next document.

    Texts move once, into ranges of their order. The last document of a range waits, with its
    text, for the first of the next one: two texts a range, joined afterwards.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting = None  # the last document so far: id, text, fingerprint, text if first
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data = [x.as_py() for x in batch.column("utf8")]
            texts = [x.decode() for x in data]
            before = [waiting[1]] if waiting else []
            chain = [*before, *texts]
            changed = [edited(a, b) for a, b in zip(chain[:-1], chain[1:], strict=True)]
            marks = fingerprints([*data, *(c.encode() for c in changed)], shared.value)
            own, marks = marks[: len(data)], marks[len(data) :]
            rows = [waiting] if waiting else []
            rows += [(i, t, f, None) for i, t, f in zip(ids, texts, own, strict=True)]
            if not waiting and rows:
                rows[0] = (*rows[0][:3], rows[0][1])
            out = [
                (*_compared(i, t, f, rows[at + 1][1], rows[at + 1][2], c, m), part, first, None)
                for at, ((i, t, f, first), c, m) in enumerate(zip(rows[:-1], changed, marks, strict=True))
            ]
            if rows:
                waiting = rows[-1]
            if out:
                columns = zip(zip(*out, strict=True), _SCHEMA, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in columns], schema=_SCHEMA
                )
        if waiting:
            doc_id, text, own, first = waiting
            mark = bytes.fromhex(own)
            row = (doc_id, len(text), None, mark, None, None, None, part, first, text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _SCHEMA, strict=True)], schema=_SCHEMA
            )

    order = [F.col("doc_id").asc_nulls_first(), F.col("mark"), F.col("row")]
    ranges = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("utf8"))
        .withColumn("mark", F.xxhash64("utf8"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "utf8")
    )
    rows = stored(ranges.mapInArrow(compare, _COMPARED), "imatch-compared")
    # The order of the ranges that hold documents: one number a task.
    parts = sorted(
        r[0] for r in rows.filter(F.col("first_text").isNotNull()).select("part").collect()
    )
    follows = spark.createDataFrame(
        list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, next_part int"
    )
    firsts = rows.filter(F.col("first_text").isNotNull()).select(
        F.col("part").alias("next_part"),
        F.col("first_text").alias("next_text"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    pairs = (
        rows.filter(F.col("last_text").isNotNull())
        .select("doc_id", "last_text", "fingerprint", "part")
        .join(follows, "part")
        .join(firsts, "next_part")
        .select("doc_id", "last_text", "fingerprint", "next_text", "next_fingerprint")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            changed = [edited(r[1], r[3]) for r in found]
            marks = fingerprints([c.encode() for c in changed], shared.value)
            out = [
                (*_compared(i, t, f.hex(), n, nf.hex(), c, m), None, None, None)
                for (i, t, f, n, nf), c, m in zip(found, changed, marks, strict=True)
            ]
            if out:
                columns = zip(zip(*out, strict=True), _SCHEMA, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in columns], schema=_SCHEMA
                )

    closed = rows.filter(F.col("last_text").isNull())
    both = closed.unionByName(pairs.mapInArrow(finish, _COMPARED))
    return both.drop("part", "first_text", "last_text").withColumns(
        {name: F.lower(F.hex(name)) for name in _HEX}
    )
