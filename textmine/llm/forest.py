"""Approximate nearest neighbours with a forest of hash prefixes.

Every tree hashes a unit vector to a long bit string (signs of projections on
fixed random directions) and keeps the strings of a block of rows in a sorted
array.  A query descends each tree to its longest prefix match, a range of
the array; then all trees ascend together, one bit at a time, so ranges widen
until they hold enough candidates.  Candidates are ranked by exact cosine on
the original vectors, and blocks are merged.

Rows whose vector is null, zero or has null or non-finite components take no
part; shorter vectors count as filled up with 0; rows equal in key and
vector count once, others that repeat a key are candidates and queries of
their own (a query key's best are taken over all its rows; rows of the
query's key are no candidates); ties go to the smaller key; an empty table
gives no rows.  Every row is indexed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.vectors import search_blocks, top, usable

TREES, BITS = 64, 32
#: Candidates a query gathers from all trees of a block together, times the
#: block's rows (ranges of different trees overlap).
GATHER = 0.5


class Forest:
    """The trees over one block of unit vectors."""

    def __init__(self, unit: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.trees, self.bits = trees, bits
        self.directions = rng.standard_normal((unit.shape[1], trees * bits))
        codes = self.hash(unit)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, 0)

    def hash(self, unit: np.ndarray) -> np.ndarray:
        """One bit string of every tree, first bit highest (n, trees)."""
        signs = (unit @ self.directions > 0).reshape(len(unit), self.trees, self.bits)
        return signs @ (np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def ranges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of rows that share each prefix length with each query:
        arrays (trees, bits + 1, queries), from no bit to all."""
        low = np.empty((self.trees, self.bits + 1, len(codes)), np.int32)
        high = np.empty_like(low)
        for t in range(self.trees):
            for used in range(self.bits + 1):
                step = np.int64(1) << (self.bits - used)
                prefix = codes[:, t] // step * step
                low[t, used] = np.searchsorted(self.sorted[:, t], prefix)
                high[t, used] = np.searchsorted(self.sorted[:, t], prefix + step)
        return low, high

    def candidates(self, unit: np.ndarray, enough: int):
        """For each query the rows under the longest common level at which
        the trees together hold ``enough`` (all rows, if no level does)."""
        low, high = self.ranges(self.hash(unit))
        held = (high - low).sum(axis=0)  # (levels, queries), falling with the level
        level = np.maximum(0, np.count_nonzero(held >= enough, axis=0) - 1)
        for q in range(len(unit)):
            mask = np.zeros(len(self.order), bool)
            for t in range(self.trees):
                mask[self.order[low[t, level[q], q]:high[t, level[q], q], t]] = True
            yield np.flatnonzero(mask)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their length; scaled first, so that nothing overflows."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def index(ids: np.ndarray, rows: np.ndarray):
    """A search of query blocks over the forest of one shard of rows."""
    unit = unit_rows(rows)
    forest = Forest(unit)

    def find(query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
        wanted = unit_rows(queries)
        found: tuple[list, list, list] = ([], [], [])
        enough = max(8 * k * TREES, int(GATHER * len(rows)))
        for own, q, at in zip(query_ids, wanted, forest.candidates(wanted, enough)):
            at = at[ids[at] != own]
            score = unit[at] @ q
            best = top(ids[at], score, k)
            found[0].append(np.full(len(best), own))
            found[1].append(ids[at[best]])
            found[2].append(score[best])
        return tuple(np.concatenate(x) for x in found)

    return find


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
           k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found by
    cosine; ``is_query`` is a condition on the column ``key``."""
    whole = usable(df, key, vector).filter(F.exists("vector", lambda x: x != 0))
    return search_blocks(whole, is_query, index, k, "double")
