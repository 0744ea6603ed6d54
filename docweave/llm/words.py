"""Words of texts as numpy arrays, inside Arrow batches.

A word is a run of characters other than the six ASCII blanks. Texts are handled as UTF-8 bytes, whose
``split()`` cuts at exactly these blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 2 << 20
CACHE_WORDS = 1 << 19
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64
)


def word_code(word: bytes) -> int:
    """64 bits of a word, the same on every machine."""
    return xxhash.xxh3_64_intdigest(word)


class WordCache(dict):
    """Values of words by a function, kept for up to ``limit`` words."""

    def __init__(self, value, limit: int = CACHE_WORDS):
        super().__init__()
        self.value, self.limit = value, limit

    def __missing__(self, word: bytes):
        if len(self) >= self.limit:
            self.clear()
        got = self[word] = self.value(word)
        return got


def chunks(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``limit``; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def text_chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of the chunks of a batch."""
    values = batch.column(column)
    lengths = pc.binary_length(values).fill_null(0).to_pylist()
    for start, end in chunks(lengths):
        yield start, values.slice(start, end - start).cast(pa.large_binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def rolling(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive codes; position i covers ``codes[i:i + k]``."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(k))
    for j in range(k):
        total = mix(total * _ODD[j % 5] + codes[j : j + n])
    return total


def split_words(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray]:
    """All words of some texts in one list, and where each text begins in it (one more at the end)."""
    words: list[bytes] = []
    starts = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        if text:
            words += text.split()
        starts[i + 1] = len(words)
    return words, starts


def word_codes(words: list[bytes], cache: WordCache) -> np.ndarray:
    """Codes of words through a cache."""
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def lower_ascii(text: bytes | None) -> bytes | None:
    """A-Z in lower case, all else untouched."""
    return None if text is None else text.lower()


_SMALL_BYTES = 1 << 17  # whose arrays stay in a processor's cache
_PLACES = 64
_TABLE = np.random.default_rng(20_240_607).integers(0, 1 << 64, _PLACES * 256, np.uint64)  # a number for every place and byte of a word
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of some texts, and where each text begins among them (one more at the end).

    A code is the sum of a random number for every place and byte of the word, so two words have equal codes with chance 2^-64. Words
    of more than ``_PLACES`` bytes, which are rare, have the code of ``word_code``. All of it works on whole arrays; the codes are
    the same on every machine but others than those of ``word_code``.
    """
    parts = [_hashed(texts[a:b]) for a, b in chunks([len(t or b"") for t in texts], _SMALL_BYTES)]
    if not parts:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    before = np.cumsum([0, *[len(codes) for codes, _ in parts]])
    starts = [found[:-1] + n for (_, found), n in zip(parts, before)]
    return np.concatenate([codes for codes, _ in parts]), np.concatenate([*starts, before[-1:]])


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    joined = b"\n".join(t or b"" for t in texts)
    data = np.frombuffer(joined, np.uint8)
    edges = np.flatnonzero(np.diff(_BLANK[data].view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    begins, ends = edges[0::2], edges[1::2]
    lengths = ends - begins
    codes = np.empty(0, np.uint64)
    if len(begins):
        at = np.flatnonzero(~_BLANK[data])  # bytes that belong to words
        place = at - np.repeat(begins, lengths)
        values = _TABLE[np.minimum(place, _PLACES - 1) * 256 + data[at]]
        codes = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    for i in np.flatnonzero(lengths > _PLACES).tolist():
        codes[i] = word_code(joined[begins[i] : ends[i]])
    offsets = np.cumsum([0, *[len(t or b"") + 1 for t in texts]])
    return codes, np.searchsorted(begins, offsets).astype(np.int64)
