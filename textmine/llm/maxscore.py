"""Exact top-k search by inner product with MaxScore.

Vectors are documents, dimensions are terms, and a component is the weight of
its posting.  Postings of a block are kept per term in order of weight.  With
signed weights a term adds between ``low`` and ``low + bound`` to a score.
Terms are ordered by bound; those at the end that cannot lift a document over
the current k-th score together are non-essential.  The heads of the
essential postings give the candidates (a document has to reach the mean of
the missing score in one of them); the other terms are probed a few at a
time, and only while a candidate stays competitive.  Blocks are searched
independently and merged.

Rows whose vector is null or has null or non-finite components take no part;
vectors shorter than the longest count as filled up with 0; rows equal in
key and vector count once, others that repeat a key are candidates and
queries of their own (a query key's best are taken over all its rows; rows
of the query's key are no candidates); ties go to the smaller key; an empty
table gives no rows.  Components beyond 2**25 in size are outside what
the integer sums are made for.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.vectors import search_blocks, top, usable

PROBE = 8


class Postings:
    """One block: weights by term, and for each term the rows by weight."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids = ids
        self.terms = np.ascontiguousarray(rows.T)
        self.order = np.argsort(self.terms, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.terms, self.order, 1)
        self.least, self.most = self.sorted[:, 0], self.sorted[:, -1]

    def search(self, own: int, q: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows (positions) and scores of the ``k`` best except ``own``;
        ``floor`` is a score that ``k`` rows are known to reach."""
        at_least, at_most = q * self.least, q * self.most
        low, high = np.minimum(at_least, at_most), np.maximum(at_least, at_most)
        bound, base = high - low, low.sum()
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)  # what terms from here on may add
        essential = int(np.count_nonzero(base + rest[:-1] >= floor))
        n = len(self.ids)
        share = (floor - base - rest[essential]) / max(1, essential)
        if essential and share > 0:
            mask = np.zeros(n, bool)
            for d in order[:essential].tolist():
                if bound[d] >= share:
                    mask[self._head(d, q[d], (share + low[d]))] = True
            rows = np.flatnonzero(mask)
        else:
            rows = np.arange(n)
        score = np.full(len(rows), float(base))
        for at in range(0, len(order), PROBE):
            some = order[at:at + PROBE]
            part = self.terms[some] if len(rows) == n else self.terms[np.ix_(some, rows)]
            score += q[some] @ part - low[some].sum()
            alive = score + rest[min(at + PROBE, len(order))] >= floor
            if np.count_nonzero(alive) < 0.9 * len(rows):
                rows, score = rows[alive], score[alive]
        keep = self.ids[rows] != own
        rows, score = rows[keep], score[keep]
        best = top(self.ids[rows], score, k)
        return rows[best], score[best]

    def _head(self, d: int, weight: float, least: float) -> np.ndarray:
        """Rows whose posting of term ``d`` adds at least ``least``."""
        if weight > 0:
            return self.order[d, np.searchsorted(self.sorted[d], least / weight - 1e-6, side="left"):]
        if weight < 0:
            return self.order[d, :np.searchsorted(self.sorted[d], least / weight + 1e-6, side="right")]
        return self.order[d] if least <= 0 else self.order[d, :0]


def index(ids: np.ndarray, rows: np.ndarray):
    """A search of query blocks over the postings of one shard of rows."""
    postings = Postings(ids, rows)
    few = rows[:: max(1, len(rows) // 256)]
    of_few = ids[:: max(1, len(rows) // 256)]

    def find(query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
        # the k-th best of a few rows is reached by k rows besides the query's own
        floors = np.full(len(queries), -np.inf)
        if len(few) > k:
            scores = np.where(of_few == query_ids[:, None], -np.inf, queries @ few.T)
            floors = np.partition(scores, len(few) - k, axis=1)[:, len(few) - k]
        found: tuple[list, list, list] = ([], [], [])
        for own, q, floor in zip(query_ids, queries, floors):
            at, score = postings.search(own, q, k, floor)
            found[0].append(np.full(len(at), own))
            found[1].append(ids[at])
            found[2].append(score)
        return tuple(np.concatenate(x) for x in found)

    return find


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5,
           scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest integer inner
    products of components ``floor(scale * x)``; ``is_query`` is a condition
    on the column ``key``."""
    whole = usable(df, key, vector).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * F.lit(scale)).cast("double")))
    return search_blocks(whole, is_query, index, k, "long")
