"""Words of many texts at once, by the kind of each byte."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE, WORD, BREAK = 0, 1, 2

#: A-Z become a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_kinds(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: words consist of all but ``spaces`` and ``breaks``."""
    kinds = np.full(256, WORD, dtype=np.uint8)
    kinds[list(spaces)] = SPACE
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass
class Words:
    """Words in order: ``distinct`` ones, their ``codes``, the text and the piece of each."""

    distinct: list[bytes]
    codes: np.ndarray
    text: np.ndarray
    piece: np.ndarray


def split_words(texts: list[bytes], kinds: np.ndarray) -> Words:
    """Lower-cased words of all texts. Breaks and ends of texts end a piece."""
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)] if texts else LOWER[:0]
    kind = kinds[data]
    if len(ends):
        kind[ends - 1] = BREAK
    word = kind == WORD
    edges = np.diff(word.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edges == 1)
    stops = np.flatnonzero(edges == -1)
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[word].tobytes())],
    ).dictionary_encode()
    return Words(
        column.dictionary.to_pylist(),
        column.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.searchsorted(ends, starts, side="right"),
        np.searchsorted(np.flatnonzero(kind == BREAK), starts),
    )
