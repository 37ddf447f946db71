"""Vectorised hashing of words and shingles inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 2**64)
SLICE_BYTES = 2_000_000

_powers: dict[str, np.ndarray] = {"up": np.ones(0, np.uint64), "down": np.ones(0, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers["up"]) < n:
        for k, base in (("up", BASE), ("down", BACK)):
            x = np.full(n, base, dtype=np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (the public splitmix64 step)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its rows; a null row is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def row_slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows holding about ``most`` bytes each (one row at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased, split at ASCII white space) and the word offsets of the rows."""
    n = len(raw)
    first = np.zeros(len(off), dtype=np.int64)
    if not n:
        return np.zeros(0, np.uint64), first
    solid = ~SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    up, down = powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE[LOWER[raw]] * up[:n], out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    first[:] = np.searchsorted(starts, off)
    return words, first


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words of every row: sorted 64-bit hashes, and offsets.

    A row with fewer words, but some, has its whole sequence as its only shingle; a row without words has none.
    """
    raw, off = text_bytes(texts)
    out: list[np.ndarray] = []
    counts = np.zeros(len(off) - 1, dtype=np.int64)
    for i, j in row_slices(off):
        words, first = word_hashes(raw[off[i] : off[j]], off[i : j + 1] - off[i])
        sh = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
        for k in range(width):
            sh += words[k : k + len(sh)] * PLACE[k]
        sh = mix(sh)
        for r in range(j - i):
            a, b = first[r], first[r + 1]
            if b - a >= width:
                own = np.sort(sh[a : b - width + 1])
                fresh = np.empty(len(own), dtype=bool)
                fresh[0] = True
                np.not_equal(own[1:], own[:-1], out=fresh[1:])
                own = own[fresh]
            elif b > a:
                own = mix((words[a:b] * PLACE[32 : 32 + b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                continue
            counts[i + r] = len(own)
            out.append(own)
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(counts)])
