"""Byte-level BPE with the tokenizers library, with a memory of the pieces of texts.

The split of such a tokenizer into words never joins text across a single space between
two other characters, nor across a change between ASCII letters, digits and punctuation
(an apostrophe stays with the letters after it, a space with what follows it). So the ids
of a text are the ids of its pieces between such places. Pieces recur, so their ids are
kept in the worker; pieces that are not there are encoded together. Texts for which the
rule does not hold (white space next to white space or at an end, or the text of a special
token) go to the library whole. Pieces of many texts are told apart in one Arrow
dictionary, so Python handles distinct pieces only.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa

_BESIDE = re.compile(r"\s\s")
#: How the vocabulary writes the bytes of a space and of a line feed.
_SPACE_MARK, _LINE_MARK = "Ġ", "Ċ"

# Kinds of bytes. What is not ASCII, or a control character, may be of any kind: no cut beside it.
_LETTER, _DIGIT, _QUOTE, _PUNCT, _SPACE, _LINE, _ANY = range(7)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _ANY, dtype=np.uint8)
    for byte in range(0x21, 0x7F):
        char = chr(byte)
        kinds[byte] = _LETTER if char.isalpha() else _DIGIT if char.isdigit() else _PUNCT
    kinds[ord("'")], kinds[ord(" ")], kinds[0x09:0x0E] = _QUOTE, _SPACE, _LINE
    return kinds


def _cuts() -> np.ndarray:
    """Whether a piece ends between a byte of one kind and a byte of another (8 * one + other)."""
    cuts = np.zeros((8, 8), dtype=bool)
    cuts[:, [_SPACE, _LINE]] = True
    cuts[_LINE] = True
    runs = [_LETTER, _DIGIT, _PUNCT]
    for a in runs:
        for b in runs:
            cuts[a, b] = a != b
    cuts[[_LETTER, _DIGIT], _QUOTE] = True
    return cuts.ravel()


_KINDS, _CUTS = _byte_kinds(), _cuts()


def _values(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values as bytes, without an Arrow scalar for each."""
    _, offsets, data = column.buffers()
    data = data.to_pybytes()
    ends = np.frombuffer(offsets, dtype=np.int64)[: len(column) + 1].tolist()
    return [data[a:b] for a, b in itertools.pairwise(ends)]


class WordMemo:
    def __init__(self, path: str, kept_words: int = 500_000, words_per_call: int = 256):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        splits = self.tokenizer.pre_tokenizer
        #: whether the rule of pieces holds for this tokenizer
        self.by_pieces = (
            isinstance(splits, ByteLevel)
            and splits.use_regex
            and not splits.add_prefix_space
            and self.tokenizer.normalizer is None
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.opens_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens_word[[i for t, i in vocabulary.items() if t.startswith(_SPACE_MARK)]] = True
        self.line_feed = vocabulary.get(_LINE_MARK, -1)
        self.kept_words, self.words_per_call = kept_words, words_per_call
        #: place of each known piece; its ids are ``ids[starts[place] : starts[place + 1]]``
        self.memory: dict[bytes, int] = {}
        self.ids, self.starts = np.empty(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def _whole(self, text: str) -> np.ndarray:
        # the fast form leaves out the places of tokens in the text
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def _regular(self, text: str) -> bool:
        return self.by_pieces and not (
            not text
            or text[0].isspace()
            or text[-1].isspace()
            or _BESIDE.search(text)
            or any(s in text for s in self.special)
        )

    def _after_spaces(self, part: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of pieces that open with a space and their counts, if one call tells them apart."""
        ids = self._whole(b"".join(part).decode())
        counts = np.diff(np.flatnonzero(self.opens_word[ids]), append=len(ids))
        return (ids, counts) if len(counts) == len(part) else None

    def _in_lines(self, part: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of pieces without white space, each with a line feed after it."""
        ids = self._whole(b"\n".join([*part, b""]).decode())
        ends = ids == self.line_feed
        counts = np.diff(np.flatnonzero(ends), prepend=-1) - 1
        return (ids[~ends], counts) if len(counts) == len(part) else None

    def _alone(self, part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._whole(piece.decode()) for piece in part]
        return np.concatenate(ids), np.array(list(map(len, ids)))

    def _new_pieces(self, pieces: list[bytes], together) -> list[tuple[np.ndarray, np.ndarray]]:
        cuts = range(0, len(pieces), self.words_per_call)
        parts = [pieces[at : at + self.words_per_call] for at in cuts]
        return [together(part) or self._alone(part) for part in parts]

    def _ids_of_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of distinct pieces, and ``ids`` and ``starts`` that they point into."""
        known = map(self.memory.get, pieces, itertools.repeat(-1))
        places = np.fromiter(known, dtype=np.int64, count=len(pieces))
        ids, starts = self.ids, self.starts
        spaced, plain, white = [], [], []
        for i in np.flatnonzero(places < 0).tolist():
            piece = pieces[i]
            (white if piece.isspace() else spaced if piece[:1] == b" " else plain).append(i)
        missing = spaced + plain + white
        if missing:
            found = self._new_pieces([pieces[i] for i in spaced], self._after_spaces)
            found += self._new_pieces([pieces[i] for i in plain], self._in_lines)
            found += self._new_pieces([pieces[i] for i in white], self._alone)
            new_places = range(len(starts) - 1, len(starts) - 1 + len(missing))
            places[missing] = new_places
            counts = np.concatenate([n for _, n in found])
            starts = np.concatenate((starts, starts[-1] + np.cumsum(counts)))
            ids = np.concatenate((ids, *(new for new, _ in found)))
            if len(self.memory) + len(missing) <= self.kept_words:
                self.memory.update(zip((pieces[i] for i in missing), new_places, strict=True))
                self.ids, self.starts = ids, starts
        return places, ids, starts

    def _by_pieces(self, texts: list[bytes]) -> list[bytes]:
        """Ids of regular texts: distinct pieces are looked up, their ids gathered at once."""
        buffer = b"".join(texts)
        kinds = _KINDS[np.frombuffer(buffer, dtype=np.uint8)]
        opens = np.ones(len(buffer), dtype=bool)
        opens[1:] = _CUTS[kinds[:-1] << 3 | kinds[1:]]
        text_ends = np.cumsum(list(map(len, texts)))
        opens[text_ends[:-1]] = True
        offsets = np.append(np.flatnonzero(opens), len(buffer))
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(buffer)]
        ).dictionary_encode()
        places, ids, starts = self._ids_of_pieces(_values(column.dictionary))
        codes = column.indices.to_numpy()
        n = np.diff(starts)[places][codes]
        upto = np.cumsum(n)
        at = np.repeat(starts[places][codes] - upto + n, n)
        at += np.arange(len(at))
        found = ids[at].tobytes()
        last = np.searchsorted(offsets, text_ends) - 1
        cuts = [0, *(4 * upto[last]).tolist()]
        return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        regular = [i for i, text in enumerate(texts) if self._regular(text)]
        out = [b""] * len(texts)
        if regular:
            found = self._by_pieces([texts[i].encode() for i in regular])
            for i, ids in zip(regular, found, strict=True):
                out[i] = ids
        others = set(range(len(texts))).difference(regular)
        for i in others:
            if texts[i]:
                out[i] = self._whole(texts[i]).tobytes()
        return out


@functools.cache
def word_memo(path: str) -> WordMemo:
    """One memory for each worker process."""
    return WordMemo(path)


def text_slices(data: list[bytes | None], most_bytes: int = 4 << 20):
    """Runs of rows ``(from, to)`` with a bounded number of bytes; a longer row stands alone."""
    start, size = 0, 0
    for at, value in enumerate(data):
        n = len(value or b"")
        if size and size + n > most_bytes:
            yield start, at
            start, size = at, 0
        size += n
    if start < len(data):
        yield start, len(data)
