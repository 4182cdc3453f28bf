"""Language identification by nearest centroid (operator 3).

A text becomes a vector of character n-grams: letters are lower-cased, everything else is
one space, n-grams of one to three characters are hashed into ``slots`` numbers, counts
are damped by a logarithm, weighted by inverse document frequency and scaled to length
one. Each language has several centroids, found by clustering its own texts. A text gets
the language of the centroid with the greatest cosine, which is also its score. Texts
farther from every centroid than the radius of its language are rejected.

Document frequencies come from all training texts. Clustering uses at most ``texts_per_language``
training texts of each language, those with the smallest hash of their id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, set_aside, utf8

UNDETERMINED = "und"


@dataclass(frozen=True)
class CentroidParams:
    slots: int = 1 << 13
    #: The documented bound of the labelled sample that is clustered.
    texts_per_language: int = 1000
    centroids: int = 4
    rounds: int = 8
    #: Radius of a language: this share of a low quantile of the cosines that its sampled texts
    #: have to it. Below the quantile lie texts that are mislabelled or junk.
    slack: float = 0.5
    low_quantile: float = 0.02
    #: Texts with fewer letters have too few n-grams for a distance; they are never rejected.
    letters_for_rejection: int = 20
    seed: int = 11


@functools.cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: bytes, slots: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Slots, their counts, and the number of letters of a text in UTF-8."""
    lowered = text.decode("utf-8", "replace").lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    n_letters = int(letter.sum())
    if not n_letters:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    points = np.where(letter, points, 32)
    points = np.concatenate(([32], points, [32])).astype(np.uint64)
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    bits = np.uint64(64 - slots.bit_length() + 1)
    counts = np.zeros(slots, dtype=np.int64)
    key = np.zeros(len(points), dtype=np.uint64)
    for n in (1, 2, 3):
        # key[i] stands for the n points from i on
        key = key[: len(points) - n + 1] * np.uint64(0x110001) + points[n - 1 :]
        hashed = ((key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> bits
        counts += np.bincount(hashed.astype(np.int64), minlength=slots)
    used = np.flatnonzero(counts)
    return used, counts[used], n_letters


def _vector(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    used, counts, n_letters = gram_counts(text, len(idf))
    values = np.log1p(counts) * idf[used]
    norm = np.sqrt((values * values).sum())
    return used, values / norm if norm else values, n_letters


@dataclass
class CentroidModel:
    languages: list[str]
    #: One row per centroid.
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    #: One for each language.
    radius: np.ndarray
    params: CentroidParams

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is too far from all centroids."""
        used, values, n_letters = _vector(text or b"", self.idf)
        if not n_letters or not len(self.owner):
            return UNDETERMINED, 0.0, True
        cosines = self.centroids[:, used] @ values
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        far = n_letters >= self.params.letters_for_rejection and bool(
            (cosines < self.radius[self.owner]).all()
        )
        return self.languages[self.owner[best]], score, far


def _document_frequencies(texts: DataFrame, slots: int) -> tuple[np.ndarray, int]:
    """Texts that have each slot, over all of ``texts``: ``slots`` + 1 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(slots + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column("_text"):
                used, _, n_letters = gram_counts(text.as_py(), slots)
                if n_letters:
                    sums[used] += 1
                    sums[slots] += 1
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())], names=["slot", "n"]
        )

    found = texts.select("_text").mapInArrow(run, "slot int, n long")
    sums = np.zeros(slots + 1, dtype=np.int64)
    for slot, n in found.groupBy("slot").agg(F.sum("n").alias("n")).collect():
        sums[slot] = n
    return sums[:slots], int(sums[slots])


def _cluster(vectors: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Spherical k-means; centroids of length one."""
    rng = np.random.default_rng(seed)
    chosen = rng.permutation(len(vectors))[: min(k, len(vectors))]
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        for c in range(len(centroids)):
            members = vectors[nearest == c]
            if len(members):
                mean = members.mean(axis=0)
                centroids[c] = mean / (np.linalg.norm(mean) or 1.0)
    return centroids


def train_centroids(
    labelled: DataFrame, params: CentroidParams | None = None
) -> CentroidModel:
    """Learn from ``text`` and ``lang`` of ``labelled``; ``doc_id`` only orders the sample.

    Rows with a null text, a null language or no letter teach nothing. Without any usable
    row the model rejects everything.
    """
    params = params or CentroidParams()
    bounded_batches(labelled.sparkSession)
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "lang", utf8().alias("_text"), F.xxhash64("doc_id", "text").alias("_order")
    )
    frequency, n = _document_frequencies(rows, params.slots)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    # Only about 1.5 times the bound leaves the tasks; ranks then cut to the bound itself.
    share = (
        rows.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("lang", (F.lit(1.5 * params.texts_per_language) / F.col("_n")).alias("_share"))
    )
    # One row for each language, as many as the model has; the texts stay where they are.
    near = rows.join(F.broadcast(share), "lang").filter(
        F.pmod("_order", F.lit(1 << 20)) < F.col("_share") * (1 << 20)
    )
    picked = Window.partitionBy("lang").orderBy("_order")
    sample = (
        near.withColumn("_rank", F.row_number().over(picked))
        .filter(F.col("_rank") <= params.texts_per_language)
        .select("lang", "_text")
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, used, values, letters = [], [], [], []
            for lang, text in zip(batch.column("lang"), batch.column("_text"), strict=True):
                u, v, n_letters = _vector(text.as_py(), idf)
                if n_letters:
                    langs.append(lang.as_py())
                    used.append(u.astype(np.int32))
                    values.append(v.astype(np.float32))
                    letters.append(n_letters)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(used, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float32())),
                    pa.array(letters, pa.int64()),
                ],
                names=["lang", "used", "values", "letters"],
            )

    def cluster(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros((len(frame), params.slots), dtype=np.float32)
        for i, (used, values) in enumerate(zip(frame["used"], frame["values"], strict=True)):
            dense[i, used] = values
        order = np.lexsort(dense[:, :64].T)
        dense = dense[order]
        centroids = _cluster(dense, params.centroids, params.rounds, params.seed)
        nearest = (dense @ centroids.T).max(axis=1)
        # Texts that are never rejected set no radius, unless the language has no others.
        long = frame["letters"].to_numpy()[order] >= params.letters_for_rejection
        low = np.quantile(nearest[long] if long.any() else nearest, params.low_quantile, method="higher")
        return pd.DataFrame({"lang": key[0], "centroid": list(centroids), "low": float(low)})

    learned = (
        sample.mapInArrow(vectors, "lang string, used array<int>, values array<float>, letters long")
        .groupBy("lang")
        .applyInPandas(cluster, "lang string, centroid array<float>, low double")
        .orderBy("lang")
        .collect()
    )
    low = {r["lang"]: r["low"] for r in learned}
    languages = sorted(low)
    return CentroidModel(
        languages,
        np.array([languages.index(r["lang"]) for r in learned], dtype=np.int64),
        np.array([r["centroid"] for r in learned], dtype=np.float64).reshape(-1, params.slots),
        idf,
        np.array([params.slack * low[name] for name in languages], dtype=np.float64),
        params,
    )


def predict_languages(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; same-named columns are replaced.

    Texts that are null or have no letter get ``und``, score 0, and are rejected.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    new = ["lang_pred", "score", "rejected"]
    docs, given_back = set_aside(docs.drop(*new))
    kept = [f for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(len(kept))]
            langs, scores, far = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(far, pa.bool_()),
                ],
                names=[*(f.name for f in kept), *new],
            )

    schema = docs.schema
    for name, kind in zip(new, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return given_back(
        docs.withColumn("_utf8_text", F.col("text").cast("binary")).mapInArrow(run, schema)
    )


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that may teach: those whose id has not remainder 2 (see ``held_out``)."""
    return docs.filter(~held_out())


def held_out():
    """crc32 of the id as text, modulo 4, is 2; a null id counts as empty text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(doc_id.cast("binary")) % 4 == 2


def language_of_documents(docs: DataFrame, params: CentroidParams | None = None) -> DataFrame:
    """Train on the rows that may teach and predict all: adds ``held_out`` as well."""
    model = train_centroids(training_rows(docs), params)
    return predict_languages(docs.withColumn("held_out", held_out()), model)
