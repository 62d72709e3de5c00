"""Vectorised hashes of the words of many texts at once, in numpy; used inside Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, size=256, dtype=np.uint64)
#: Bytes of text that are hashed together; a longer text forms a chunk of its own.
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (multiply and shift, twice)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@functools.lru_cache(maxsize=2)
def _powers_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for ``size`` places at least."""
    return _powers_of(max(CHUNK + (CHUNK >> 1), 1 << (size - 1).bit_length()))


def chunks(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes together."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield start, k
            start, size = k, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of byte value times base**place before each place, and the inverse powers: the hash of
    bytes [a, b) is (sums[b] - sums[a]) * inverse[a]."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return sums, down


def word_table(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts in order: hashes, and where they start and end in the texts joined by one
    byte each; and the place of each text's first word (one more at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    word = _IS_WORD[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    sums, down = prefix_sums(data)
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the place of each text's first word (one more at the end)."""
    hashes, _, _, first = word_table(texts)
    return hashes, first
