"""Phrase collocations by best-first branch-and-bound growth (operator 12).

A phrase of 2 to 5 words scores by its weakest cut. Cut after its first word, it scores at most
``1000 n / f(first word)``, whatever follows: the count of a prefix bounds all that grows
from it. First words are therefore expanded in descending order of that bound, a share of
each language at a time:

1. Words are counted once; texts are stored as codes of the words that are frequent enough.
2. A round grows the phrases of the expanded first words, one word at a time, from prefixes
   that are frequent themselves. Each count comes with the smallest and largest neighbour on
   either side, so it is known at once whether some longer phrase occurs as often.
3. Phrases that survive and whose last cut reaches the score of rank 2000 get the counts
   of their other parts, and with them their score.
4. The score of rank 2000 shows which first words could still matter. Those are the next
   round; a language is settled when there are none. Ties at that rank are kept to the end.

Which phrases are worth counting is asked of Bloom filters of bounded size; a wrong yes costs
a count and nothing else, as all decisions rest on exact counts. Words are known by 64 bits
of a hash, whose seed changes should two words of a language ever share one.

Null texts are empty; a null language is ``und``. Only A-Z are lower-cased. Repeated rows
count again, whatever their ids; an empty table has no phrases. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft.llm.cells import both_set, key_filter, mixed
from reviewcraft.llm.common import bounded_batches, stored, utf8
from reviewcraft.llm.split_words import byte_kinds, split_words

KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")


@dataclass(frozen=True)
class CollocationParams:
    longest: int = 5
    least_count: int = 100
    top: int = 2000
    #: Share of a language's occurrences that the first round expands; it grows fourfold until
    #: a score of the last rank is known.
    first_share: float = 0.25


def _signed(value: int) -> int:
    return (value if value < 1 << 63 else value - (1 << 64)) or 1


#: Bytes of text that are taken apart at a time, unless a single text is longer. All arrays of a
#: task, and the rows of coded texts that the JVM holds, are a few times as large.
RUN_BYTES = 2 << 20


def _lang_runs(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, ``RUN_BYTES`` at a time."""
    texts: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, value in zip(batch.column("lang").to_pylist(), batch.column("utf8"), strict=True):
        text = value.as_py()
        if sizes.get(lang, 0) + len(text) > RUN_BYTES and lang in texts:
            sizes.pop(lang)
            yield lang, texts.pop(lang)
        texts.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
    yield from texts.items()


def _word_counts(seed: int):
    digest = xxhash.xxh3_64_intdigest

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _lang_runs(batch):
                words = split_words(texts, KINDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words.distinct), pa.string()),
                        pa.array(words.distinct, pa.binary()).cast(pa.string()),
                        pa.array([_signed(digest(w, seed)) for w in words.distinct], pa.int64()),
                        pa.array(np.bincount(words.codes, minlength=len(words.distinct)), pa.int64()),
                    ],
                    names=["lang", "word", "h", "f"],
                )

    return count


# --- texts as codes of frequent words ---------------------------------------------------------


def _key(lang: np.ndarray | int, hashes: list[np.ndarray]) -> np.ndarray:
    """One number for a phrase of a language, for the filters."""
    key = np.zeros(len(hashes[0]), dtype=np.uint64) + np.uint64(lang) if np.isscalar(lang) else lang
    for h in hashes:
        key = mixed(key ^ h.view(np.uint64))
    return key


def _column_key(columns: list[str]):
    def key_of(batch: pa.RecordBatch) -> np.ndarray:
        arrays = [batch.column(c).to_numpy() for c in columns]
        return _key(batch.column("lang_hash").to_numpy().view(np.uint64), arrays)

    return key_of


_CODED = "lang string, lang_hash long, words binary, codes binary"


def _coded(frequent, seed: int):
    """Texts of a language in one row: the hashes of its words and a code at each place.

    Code 0 stands where a piece ends or a word is not frequent.
    """
    digest = xxhash.xxh3_64_intdigest

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _lang_runs(batch):
                words = split_words(texts, KINDS)
                if not len(words.codes):
                    continue
                lang_hash = _signed(digest(lang))
                hashes = np.array([_signed(digest(w, seed)) for w in words.distinct], dtype=np.int64)
                known = both_set(frequent.value, _key(lang_hash & (2**64 - 1), [hashes]))
                new = np.where(known, np.cumsum(known), 0)
                codes = new[words.codes]
                # A break goes in front of each piece; what breaks already needs no second one.
                cuts = np.flatnonzero(np.diff(words.piece, prepend=-1))
                codes = np.insert(codes, cuts, 0)
                keep = codes > 0
                keep[1:] |= codes[:-1] > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang], pa.string()),
                        pa.array([lang_hash], pa.int64()),
                        pa.array([np.concatenate(([0], hashes[known])).astype("<i8").tobytes()]),
                        pa.array([codes[keep].astype("<u4").tobytes()]),
                    ],
                    names=["lang", "lang_hash", "words", "codes"],
                )

    return code


def _places(batch: pa.RecordBatch):
    """Language, its hash, word hashes and codes of each row of coded texts."""
    for lang, lang_hash, words, codes in zip(*(batch.column(i) for i in range(4)), strict=True):
        yield (
            lang.as_py(),
            lang_hash.as_py(),
            np.frombuffer(words.as_buffer(), dtype="<i8"),
            np.frombuffer(codes.as_buffer(), dtype="<u4").astype(np.int64),
        )


def _phrase_ids(columns: list[np.ndarray], base: int) -> np.ndarray:
    """One number for each row of codes; equal rows get equal numbers."""
    ids, size = columns[0], base
    for column in columns[1:]:
        if size > (1 << 62) // base:
            distinct, ids = np.unique(ids, return_inverse=True)
            size = len(distinct)
        ids, size = ids * base + column, size * base
    return ids


def _names(k: int) -> list[str]:
    return [f"h{i}" for i in range(k)]


def _grown(first, k: int, prefix):
    """Counts of the phrases of ``k`` words after known prefixes, with their neighbours."""
    names = ["lang", "lang_hash", *_names(k), "a", "left_min", "left_max", "right_min", "right_max"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, lang_hash, words, codes in _places(batch):
                unsigned = lang_hash & (2**64 - 1)
                opens = both_set(first.value, _key(unsigned, [words]))
                opens[0] = False
                padded = np.concatenate((codes, np.zeros(k + 1, dtype=np.int64)))
                at = np.flatnonzero(opens[codes])
                for i in range(1, k):
                    at = at[padded[at + i] > 0]
                if k > 2 and len(at):
                    at = at[both_set(prefix.value, _key(unsigned, [words[codes[at + i]] for i in range(k - 1)]))]
                if not len(at):
                    continue
                columns = [codes[at + i] for i in range(k)]
                ids = _phrase_ids(columns, len(words))
                order = np.argsort(ids, kind="stable")
                starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
                left = words[np.where(at > 0, codes[at - 1], 0)][order]
                right = words[padded[at + k]][order]
                heads = order[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(starts), pa.string()),
                        pa.array(np.full(len(starts), lang_hash)),
                        *(pa.array(words[c[heads]]) for c in columns),
                        pa.array(np.diff(starts, append=len(ids))),
                        pa.array(np.minimum.reduceat(left, starts)),
                        pa.array(np.maximum.reduceat(left, starts)),
                        pa.array(np.minimum.reduceat(right, starts)),
                        pa.array(np.maximum.reduceat(right, starts)),
                    ],
                    names=names,
                )

    return grow, ", ".join(["lang string", *(f"{n} long" for n in names[1:])])


def _wanted_counts(wanted, longest: int):
    """Counts of wanted phrases of 2 to ``longest`` words; unused hashes are 0."""
    names = ["lang", *_names(longest), "f"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, lang_hash, words, codes in _places(batch):
                unsigned = lang_hash & (2**64 - 1)
                padded = np.concatenate((codes, np.zeros(longest, dtype=np.int64)))
                at = np.flatnonzero(codes)
                for k in range(2, longest + 1):
                    at = at[padded[at + k - 1] > 0]
                    if not len(at):
                        break
                    hashes = [words[codes[at + i]] for i in range(k)]
                    fill = [np.zeros(len(at), dtype=np.int64)] * (longest - k)
                    hit = at[both_set(wanted.value, _key(unsigned, hashes + fill))]
                    if not len(hit):
                        continue
                    columns = [codes[hit + i] for i in range(k)]
                    _, heads, found = np.unique(
                        _phrase_ids(columns, len(words)), return_index=True, return_counts=True
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(heads), pa.string()),
                            *(pa.array(words[c[heads]]) for c in columns),
                            *(pa.array(f[: len(heads)]) for f in fill),
                            pa.array(found),
                        ],
                        names=names,
                    )

    return count, ", ".join(["lang string", *(f"{n} long" for n in names[1:])])


@F.pandas_udf(T.LongType())
def _score(a: pd.Series, n: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
    """floor(1000 a n / (l r)) in whole numbers of any size."""
    rows = zip(a.tolist(), n.tolist(), left.tolist(), right.tolist(), strict=True)
    return pd.Series([1000 * x * y // (p * q) for x, y, p, q in rows], dtype="int64")


# --- rounds -------------------------------------------------------------------------------------


#: Tables of no more rows than this are offered for a broadcast: at most about 8 MB each, as the
#: driver holds those of several rounds at a time.
BROADCAST_ROWS = 50_000


def _offered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` counted rows, to be broadcast if they are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _next_cut(state: DataFrame, frequent: DataFrame, share: float) -> DataFrame:
    """``done`` and ``cut`` of each language: first words with ``done`` < f <= ``cut`` are next.

    Where the score of the last rank is known, all words that could reach it; else the rarest
    ones up to ``share`` of all occurrences. Counts of words are summed by narrow classes, so
    a language is a few hundred rows here.
    """
    classes = (
        frequent.groupBy("lang", F.floor(8 * F.log2("f")).alias("class"))
        .agg(F.sum("f").alias("mass"), F.max("f").alias("most"))
        .withColumn("up_to", F.sum("mass").over(Window.partitionBy("lang").orderBy("class")))
        .withColumn("all", F.sum("mass").over(Window.partitionBy("lang")))
    )
    reached = classes.groupBy("lang").agg(
        F.min(F.when(F.col("up_to") >= F.col("all") * share, F.col("most"))).alias("by_share")
    )
    # one more, as the quotient may be rounded
    by_score = F.floor(1000 * F.col("n") / F.greatest("last_score", F.lit(1)) + 1).cast("long")
    cut = F.when(F.col("last_score").isNull(), F.col("by_share")).otherwise(by_score)
    return state.join(reached, "lang").select(
        "lang", "n", "last_score", F.col("cut").alias("done"), F.greatest("cut", cut).alias("cut")
    )


def _parts(
    candidates: DataFrame, words: DataFrame, counts: DataFrame | None, longest: int, n: int
) -> DataFrame:
    """One row per candidate and cut with the count of the rest; ``counts`` of longer rests.

    ``n``: rows of words and counts together, about."""
    found = words.select("lang", F.array(F.col("h")).alias("rest"), F.col("f").alias("r"))
    if counts is not None:
        kept = F.filter(F.array(*_names(longest)), lambda x: x != 0)
        found = found.unionByName(counts.select("lang", kept.alias("rest"), F.col("f").alias("r")))
    return candidates.join(_offered(found, n), ["lang", "rest"])


def collocations(
    docs: DataFrame, params: CollocationParams = CollocationParams(), seed: int = 0
) -> DataFrame:
    """The best ``params.top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``,
    ``l``, ``r``, ``n``, ``score`` and ``words``, the phrase as an array."""
    spark = docs.sparkSession
    bounded_batches(spark)
    k_most, least = params.longest, params.least_count
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), utf8().alias("utf8"))
    while True:
        words = stored(
            texts.mapInArrow(_word_counts(seed), "lang string, word string, h long, f long")
            .groupBy("lang", "word", "h")
            .agg(F.sum("f").alias("f")),
            "colloc-words",
        )
        if words.groupBy("lang", "h").count().filter("count > 1").isEmpty():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = stored(
        words.filter(F.col("f") >= least).withColumn("lang_hash", _lang_hash("lang")), "colloc-frequent"
    )
    n_frequent = frequent.count()
    frequent = _offered(frequent, n_frequent)
    broadcast = spark.sparkContext.broadcast

    def filter_of(rows: DataFrame, columns: list[str], n: int):
        found = key_filter(rows.select("lang_hash", *columns), _column_key(columns), n)
        return broadcast(found)

    known = filter_of(frequent, ["h"], n_frequent)
    coded = stored(texts.mapInArrow(_coded(known, seed), _CODED), "colloc-coded")
    state = stored(
        totals.select("lang", "n", F.lit(None).cast("long").alias("last_score"), F.lit(0).cast("long").alias("cut")),
        "colloc-state",
    )
    best, share = None, params.first_share
    while True:
        state = stored(_next_cut(state, frequent, share), "colloc-state")
        opened = stored(
            frequent.join(state, "lang").filter((F.col("f") > F.col("done")) & (F.col("f") <= F.col("cut"))),
            "colloc-first-words",
        )
        n_opened = opened.count()
        if not n_opened:
            if share >= 1:
                break
            share = min(4 * share, 1.0)
            continue
        scored = _expanded(
            coded, opened, n_opened, frequent, n_frequent, state, params, filter_of
        )
        best = scored if best is None else best.unionByName(scored)
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        best = stored(
            best.withColumn("place", F.rank().over(order)).filter(F.col("place") <= params.top).drop("place"),
            "colloc-best",
        )
        last = best.groupBy("lang").agg(
            F.when(F.count(F.lit(1)) >= params.top, F.min("score")).alias("last_score")
        )
        state = stored(state.drop("last_score", "done").join(last, "lang", "left"), "colloc-state")
        share = min(4 * share, 1.0)
    return _ranked(best, frequent, params) if best is not None else _nothing(spark)


def _lang_hash(column: str):
    @F.pandas_udf(T.LongType())
    def digest(langs: pd.Series) -> pd.Series:
        return langs.map(lambda x: _signed(xxhash.xxh3_64_intdigest(x))).astype("int64")

    return digest(F.col(column))


def _expanded(
    coded, opened, n_opened: int, frequent, n_frequent: int, state, params, filter_of
) -> DataFrame:
    """Scored phrases that start with an ``opened`` word, survive and may reach the last rank."""
    k_most, least = params.longest, params.least_count
    first = filter_of(opened, ["h"], n_opened)
    n_known, known = n_opened, opened.select("lang", F.col("h").alias("h0"), F.array("f").alias("parts"))
    prefix, levels = None, []
    for k in range(2, k_most + 1):
        grow, schema = _grown(first, k, prefix)
        counted = (
            coded.mapInArrow(grow, schema)
            .groupBy("lang", "lang_hash", *_names(k))
            .agg(
                F.sum("a").alias("a"),
                F.min("left_min").alias("left_min"),
                F.max("left_max").alias("left_max"),
                F.min("right_min").alias("right_min"),
                F.max("right_max").alias("right_max"),
            )
            .filter(F.col("a") >= least)
        )
        # parts: counts of the first 1, 2, ... words
        known = _offered(known, n_known)
        level = stored(counted.join(known, ["lang", *_names(k - 1)]), f"colloc-level-{k}")
        levels.append(level)
        n_known = level.count()
        if not n_known:
            break
        known = level.select("lang", *_names(k), F.array_append("parts", F.col("a")).alias("parts"))
        if k < k_most:
            prefix = filter_of(level, _names(k), n_known)
    always = lambda side: (F.col(f"{side}_min") == F.col(f"{side}_max")) & (F.col(f"{side}_min") != 0)
    alive = None
    for k, level in enumerate(levels, 2):
        kept = level if k == k_most else level.filter(~(always("left") | always("right")))
        kept = kept.select("lang", "lang_hash", F.array(*_names(k)).alias("phrase"), "a", "parts")
        alive = kept if alive is None else alive.unionByName(kept)
    ends = frequent.select("lang", F.col("h").alias("end"), F.col("f").alias("r"))
    last_cut = _score(F.col("a"), F.col("n"), F.element_at("parts", -1), F.col("r"))
    reach = stored(
        alive.withColumn("end", F.element_at("phrase", -1))
        .join(ends, ["lang", "end"])
        .join(state.select("lang", "n", "last_score"), "lang")
        .withColumn("bound", last_cut)
        .filter(F.col("last_score").isNull() | (F.col("bound") >= F.col("last_score")))
        .select("lang", "lang_hash", "phrase", "a", "n", "parts"),
        "colloc-reach",
    )
    cuts = reach.select(
        "lang", "lang_hash", "phrase", "a", "n", F.posexplode("parts").alias("at", "l")
    ).select(
        "lang", "lang_hash", "phrase", "a", "n", (F.col("at") + 1).alias("cut"), "l",
        F.expr("slice(phrase, at + 2, size(phrase))").alias("rest"),
    )
    padded = [F.coalesce(F.get("rest", F.lit(i)), F.lit(0)).alias(f"h{i}") for i in range(k_most - 1)]
    wanted = stored(
        cuts.filter(F.size("rest") > 1).select("lang", "lang_hash", *padded).distinct(),
        "colloc-wanted",
    )
    counts, n_wanted = None, wanted.count()
    if n_wanted:
        count, schema = _wanted_counts(filter_of(wanted, _names(k_most - 1), n_wanted), k_most - 1)
        counts = stored(
            coded.mapInArrow(count, schema)
            .groupBy("lang", *_names(k_most - 1))
            .agg(F.sum("f").alias("f")),
            "colloc-rests",
        )
    scores = _parts(cuts, frequent, counts, k_most - 1, n_frequent + n_wanted).withColumn(
        "score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    )
    return (
        scores.groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
        .select("lang", "phrase", "a", "n", "weakest.score", "weakest.l", "weakest.r")
    )


_RESULT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "words"]


def _ranked(best: DataFrame, frequent: DataFrame, params: CollocationParams) -> DataFrame:
    named = (
        best.withColumnRenamed("phrase", "hashes")
        .select("*", F.posexplode("hashes").alias("at", "h"))
        .join(frequent.select("lang", "h", "word"), ["lang", "h"])
        .groupBy("lang", "hashes", "a", "l", "r", "n", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).getField("word").alias("words"))
        .withColumn("phrase", F.array_join("words", " "))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        named.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= params.top)
        .select(*_RESULT)
    )


def _nothing(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "lang string, rank long, phrase string, a long, l long, r long, n long, score long, words array<string>",
    )
