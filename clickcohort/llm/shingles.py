"""Sets of hashed word shingles with numpy, for use inside tasks.

A text is lower-cased (A-Z) and cut into words at ASCII white space; its set holds the
64-bit hashes of its distinct runs of `k` words. A text of fewer words has its whole
sequence as the one shingle; a text without words, or null, has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U)
_ODD = U(0x9E3779B97F4A7C15)
_PIECE = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = _LOWER[raw]
    inside = ~_SPACE[low]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, length = edges[::2], edges[1::2] - edges[::2]
    hashes = length.astype(U)
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded, shape=(len(low) + 1, 8), strides=(1, 1))
    left, k = np.arange(len(start)), 0
    while len(left):
        eight = lanes[start[left] + 8 * k].copy().view(U).ravel()
        eight &= _LANE[np.minimum(length[left] - 8 * k, 8)]
        hashes[left] = mix((hashes[left] ^ eight) * _ODD + U(k))
        k += 1
        left = left[length[left] > 8 * k]
    return hashes, start


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; long inputs are worked through in pieces."""
    if len(raw) <= _PIECE:
        return _words(raw)
    parts, begin = [], 0
    while begin < len(raw):
        stop = min(begin + _PIECE, len(raw))
        while stop < len(raw) and not _SPACE[raw[stop]]:
            stop += 1
        hashes, start = _words(raw[begin:stop])
        parts.append((hashes, start + begin))
        begin = stop
    return np.concatenate([h for h, _ in parts]), np.concatenate([s for _, s in parts])


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    hashes, start = word_hashes(np.frombuffer(b"\n".join(texts), dtype=np.uint8))
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(start, ends)])
    rolled = hashes
    for n in range(1, k):  # rolled[i] covers words i to i + n
        rolled = mix(rolled[:-1] * _ODD + hashes[n:]) if len(rolled) > 1 else rolled[:0]
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= k:
            yield np.unique(rolled[a:b - k + 1])
        elif b > a:
            whole = hashes[a:a + 1]
            for w in hashes[a + 1:b]:
                whole = mix(whole * _ODD + w)
            # Apart from the shingles of longer texts, which always have k words.
            yield mix(whole + U(b - a))
        else:
            yield hashes[:0]


def runs(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """Encoded texts in runs of about `limit` bytes."""
    run, size = [], 0
    for text in texts:
        raw = (text or "").encode()
        if run and size + len(raw) > limit:
            yield run
            run, size = [], 0
        run.append(raw)
        size += len(raw)
    if run:
        yield run


def texts_of(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """Values of an Arrow column, few at a time as Python strings."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()
