"""Sets of word shingles as sorted 64-bit hashes, computed on whole batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS_PER_SHINGLE = 5
#: Texts are hashed together up to so many bytes; a longer one is hashed alone.
CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_random = np.random.Generator(np.random.PCG64(20))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 20, 1 << (n - 1).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size <= 1 << 21:
            _powers[size] = tuple(tables)
        return tuple(tables)
    return _powers[size]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word in bytes that begin with a word or blank and end with a blank."""
    inside = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    first, end = edges[::2], edges[1::2]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[first]) * down[first]), first


def _chunks(texts: Sequence[bytes]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def shingle_sets(texts: Sequence[bytes | None], words: int = WORDS_PER_SHINGLE) -> Iterator[np.ndarray]:
    """For each UTF-8 text its distinct shingles as sorted hashes.

    Words are runs of anything but blank and the control characters 9 to 13, A-Z lower-cased. A text with fewer words
    than a shingle has one shingle, the whole sequence; one without words, or a null, has none.
    """
    for chunk in _chunks([text or b"" for text in texts]):
        data = np.frombuffer(b" ".join(chunk) + b" ", np.uint8)
        hashes, first = word_hashes(data)
        ends = np.cumsum([len(text) + 1 for text in chunk])
        upto = np.searchsorted(first, ends).tolist()
        runs = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            runs += hashes[k : k + len(runs)] * _PLACE[k]
        runs = mixed(runs)
        begin = 0
        for end in upto:
            n = end - begin
            if n >= words:
                yield np.unique(runs[begin : end - words + 1])
            elif n:
                short = (hashes[begin:end] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True)
                yield mixed(short + _PLACE[32 + n : 33 + n])
            else:
                yield np.zeros(0, np.uint64)
            begin = end
