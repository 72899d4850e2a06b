"""Whole texts as arrays: code points, word limits and word hashes of many
texts at once, without a Python object per word."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), for whole arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _point_values() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * _BASE)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; kept up to 4 M."""
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n, 1 << 16)
        made = []
        for base in (_BASE, inverse):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        if size > 1 << 22:
            return made[0][:n], made[1][:n]
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


@lru_cache(maxsize=1)
def blank_table() -> np.ndarray:
    """True for code points that belong to words between blanks (all but
    space and U+0009 to U+000D)."""
    out = np.ones(0x110000, bool)
    out[[0x20, *range(0x09, 0x0E)]] = False
    return out


@lru_cache(maxsize=1)
def alnum_table() -> np.ndarray:
    """True for letters, marks and numbers."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)])


@lru_cache(maxsize=1)
def ascii_lower() -> np.ndarray:
    out = np.arange(0x110000, dtype=np.uint32)
    out[65:91] += 32
    return out


class Words:
    """The words of ``texts`` (null: none): ``starts`` and ``ends`` in the
    joined code points, and ``at``, where each text's words begin."""

    def __init__(self, texts: list[str | None], member: np.ndarray, fold: np.ndarray | None = None):
        texts = [t or "" for t in texts]
        self.whole = "\n".join(texts) + "\n"
        self.points = np.frombuffer(self.whole.encode("utf-32-le"), np.uint32)
        if fold is not None:
            self.points = fold[self.points]
        inside = member[self.points]
        self.cuts = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        inside[self.cuts] = False
        turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            turn = np.concatenate([[0], turn])
        self.starts, self.ends = turn[0::2], turn[1::2]
        self.at = np.concatenate([[0], np.searchsorted(self.starts, self.cuts)])
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit polynomial hash of each span of code points; equal texts
        have equal hashes wherever they stand."""
        power, inverse = _powers(len(self.points))
        if self._sums is None:
            self._sums = np.zeros(len(self.points) + 1, np.uint64)
            np.cumsum(_point_values()[self.points] * power, out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * inverse[np.minimum(starts, len(inverse) - 1)]
                   + (ends - starts).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends)


class HashTable:
    """Open addressing from 64-bit keys to integers, for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.shift = np.uint64(64 - max(4, (4 * max(1, len(keys))).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask, self.missing = np.int64(size - 1), missing
        self.keys, self.full = np.zeros(size, np.uint64), np.zeros(size, bool)
        self.values = np.full(size, missing, values.dtype)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[~self.full[slot[left]]]
            self.keys[slot[free]] = keys[free]  # of several, one stays
            self.full[slot[free]] = True
            won = self.keys[slot[left]] == keys[left]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        same, full = self.keys[slot] == keys, self.full[slot]
        out = np.where(same & full, self.values[slot], self.values.dtype.type(self.missing))
        left = np.flatnonzero(full & ~same)
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            same, full = self.keys[slot[left]] == keys[left], self.full[slot[left]]
            hit = same & full
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[full & ~same]
        return out
