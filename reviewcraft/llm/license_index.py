"""Licence scan over a positional rare-token index (operator 4).

Templates are short licence notices. The index holds, for each template word, the templates
and positions where it stands. Document frequencies of the template words are counted over
all files. In a file, the words of each template with the highest IDF are looked up; each
place of such a word votes for the start that the template would have there (place minus
position), and postings are intersected by that relative position. Where enough rare words
agree, the template's mandatory key phrase must stand in full near that start.

Besides, the places of four base phrases are counted in every file.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, set_aside, utf8

# The base phrases with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, notice, mandatory key phrase.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    (
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        "gnu general public license version 3",
    ),
    (
        "gpl-2.0",
        "licensed under the gnu general public license version 2",
        "gnu general public license version 2",
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license v 2 0",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
        "permission to use copy modify",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
)

#: ASCII letters in lower case; every other ASCII character but digits separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


@dataclass(frozen=True)
class LicenseParams:
    #: Words of each template, rarest first, that are looked up in a file.
    rare_words: int = 4
    #: Share of these that must agree on one start.
    agreement: float = 0.5


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Start (in words) and label of every place of a base phrase."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in BASE_PHRASES.items():
        pattern = b" " + phrase.encode() + b" "
        at = joined.find(pattern)
        counted, number = 0, 0
        while at >= 0:
            number += joined.count(b" ", counted, at)
            counted = at
            found.append((number, label))
            at = joined.find(pattern, at + 1)
    return found


class RareTokenIndex:
    """Postings of template words, and each template's words from rare to frequent."""

    def __init__(self, idf: dict[bytes, float], params: LicenseParams, templates=TEMPLATES):
        self.params = params
        self.templates = [
            (label, notice.encode().split(), key.encode().split())
            for label, notice, key in templates
        ]
        self.offset = [_position(notice, key) for _, notice, key in self.templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.rare: list[list[bytes]] = []
        for number, (_, notice, _) in enumerate(self.templates):
            for position, word in enumerate(notice):
                self.postings[word].append((number, position))
            self.rare.append(sorted(set(notice), key=lambda w: (-idf.get(w, 0.0), w)))

    def matches(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """Label, start and share of the notice's words in place, for each template found."""
        present = self.postings.keys() & set(words)
        if not present:
            return []
        looked_up: dict[bytes, set[int]] = defaultdict(set)
        needed = {}
        for number, rare in enumerate(self.rare):
            chosen = [w for w in rare if w in present][: self.params.rare_words]
            needed[number] = max(2, math.ceil(self.params.agreement * self.params.rare_words))
            if len(chosen) >= needed[number]:
                for word in chosen:
                    looked_up[word].add(number)
        if not looked_up:
            return []
        votes: Counter[tuple[int, int]] = Counter()
        for place, word in enumerate(words):
            numbers = looked_up.get(word)
            if numbers:
                for number, position in self.postings[word]:
                    if number in numbers:
                        votes[number, place - position] += 1
        best: dict[int, tuple[float, int]] = {}
        for (number, start), agreeing in votes.items():
            if agreeing < needed[number]:
                continue
            _, notice, key = self.templates[number]
            at = start + self.offset[number]
            if at < 0 or words[at : at + len(key)] != key:
                continue
            inside = sum(
                0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(notice)
            )
            share = inside / len(notice)
            if number not in best or (share, -start) > (best[number][0], -best[number][1]):
                best[number] = (share, start)
        return [(self.templates[n][0], start, share) for n, (share, start) in sorted(best.items())]


def _position(words: list[bytes], part: list[bytes]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(part)] == part)


def template_words() -> set[bytes]:
    return {w for _, notice, _ in TEMPLATES for w in notice.encode().split()}


def inverse_document_frequencies(files: DataFrame) -> dict[bytes, float]:
    """IDF of every template word over all rows of ``files``."""
    bounded_batches(files.sparkSession)
    wanted = template_words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("_text"):
                counts.update(wanted.intersection(words_of(text.as_py())))
                counts[b""] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    sums = files.select(utf8().alias("_text")).mapInArrow(run, "word binary, n long")
    found = {bytes(r["word"]): r["n"] for r in sums.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = found.get(b"", 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) for w in wanted}


SCANNED = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, matches array<struct<label: string, start: long, share: double>>"
)


def scan_licenses(files: DataFrame, params: LicenseParams | None = None) -> DataFrame:
    """``files`` with the columns of ``SCANNED``; same-named columns are replaced.

    Null or empty texts have no words, no labels (empty strings) and score 0. ``score`` is 1
    with a base phrase, else the best share of a notice's words that stand in place.
    ``matches`` has one entry for each template found. Repeated rows are scanned each.
    """
    params = params or LicenseParams()
    index = RareTokenIndex(inverse_document_frequencies(files), params)
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
    kept, given_back = set_aside(files.drop(*new))
    schema = kept.schema
    n_kept = len(schema)
    shared = files.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(n_kept):
                words = words_of(text.as_py())
                base = base_places(words)
                found = shared.value.matches(words)
                starts = [s for s, _ in base]
                base_labels = {label for _, label in base}
                labels = base_labels | {label for label, _, _ in found}
                score = 1.0 if base else max((share for _, _, share in found), default=0.0)
                rows.append(
                    (
                        len(words),
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(labels)),
                        score,
                        [{"label": a, "start": b, "share": c} for a, b, c in found],
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(new)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            kinds.append(
                pa.list_(
                    pa.struct(
                        [("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]
                    )
                )
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:n_kept],
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=[*schema.names, *new],
            )

    extended = kept.withColumn("_utf8_text", utf8())
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return given_back(extended.mapInArrow(run, f"{columns}, {SCANNED}"))
