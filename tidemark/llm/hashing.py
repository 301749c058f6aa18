"""Vectorised hashing of words and byte windows, and lookup tables keyed by hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of the six white-space characters words are split at.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Bytes outside letters: words made of letters only (ASCII or not) are split at these.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Finalises 64-bit hashes so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for x in (_BASE, _INVERSE):
        p = np.full(size + 1, x, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n + 1`` of each."""
    size = 1 << max(16, int(n).bit_length())
    return _powers(size)


def prefix(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes: ``out[j] - out[i]`` is that of ``data[i:j]`` times ``base**i``."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def words(data: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every maximal run of bytes that are no breaks."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~breaks[data]
    edge = np.flatnonzero(np.diff(inside))
    start, end = edge[::2], edge[1::2]
    p = prefix(data)
    _, down = powers(len(data))
    return mix((p[end] - p[start]) * down[start]), start, end


def pieces(raw: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """A text cut at white space into pieces of about ``most`` bytes (a longer word stays whole)."""
    at = 0
    while len(raw) - at > most:
        cut = at + most
        while cut < len(raw) and not SPACES[raw[cut]]:
            cut += 1
        yield raw[at:cut]
        at = cut
    if at < len(raw) or not at:
        yield raw[at:]


class HashTable:
    """Rows of values found by 64-bit hashes; built once, looked up in bulk."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.bits = max(1, len(keys).bit_length())
        bucket = (self.keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.first = np.searchsorted(bucket, np.arange((1 << self.bits) + 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of every key, -1 where there is none."""
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full(len(keys), -1, np.int64)
        todo = np.flatnonzero(at < end)
        at, end = at[todo], end[todo]
        while len(todo):
            same = self.keys[at] == keys[todo]
            out[todo[same]] = at[same]
            at = at + 1
            more = ~same & (at < end)
            todo, at, end = todo[more], at[more], end[more]
        return out

    def get(self, keys: np.ndarray, default: float | np.ndarray) -> np.ndarray:
        at = self.find(keys)
        out = self.values[at] if len(self.values) else np.zeros((len(keys), *self.values.shape[1:]), self.values.dtype)
        out[at < 0] = default
        return out
