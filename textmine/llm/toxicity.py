"""Toxicity by a convolutional text classifier.

A word is the sum of hashed embeddings (two hashes of the word and one of its
beginning); filters of several widths run over the word sequence, each keeps
its maximum over the text, and a logistic layer scores the maxima.  It is
trained in numpy on a bounded sample of labelled rows.  Thresholds are
calibrated by language on rows kept out of the training.

Null and empty texts are scored from the filters' floor alone; labels that
are null teach nothing; labels that disagree for one key count as toxic.
Long texts are read whole; repeated rows are scored each by itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import add_columns
from textmine.llm.sampling import labelled_sample
from textmine.llm.words import Words, alnum_table

WIDTHS = (1, 2, 3)
PREFIX = 4
FLOOR = -4.0  # what a filter gives at least, so that empty texts have a value


def word_ids(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Three table rows for every word (letters, marks and numbers, lower
    case) and where each text's words begin."""
    w = Words([t.lower() if t else t for t in texts], alnum_table())
    whole = w.hashes()
    begin = w.span_hashes(w.starts, np.minimum(w.starts + PREFIX, w.ends))
    mask = np.uint64((1 << bits) - 1)
    rows = np.stack([whole & mask, (whole >> np.uint64(32)) & mask, begin & mask], axis=1).astype(np.int64)
    return rows + np.arange(3) * (1 << bits), w.at


@dataclass
class Network:
    """``embedding`` (3 tables, dim), filters by width (width * dim, filters),
    their biases, and the output layer."""

    bits: int
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def start(cls, bits: int, dim: int, filters: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        return cls(bits, (rng.standard_normal((3 << bits, dim)) * 0.3).astype(np.float32),
                   [(rng.standard_normal((k * dim, filters)) * (0.7 / np.sqrt(k * dim))).astype(np.float32)
                    for k in WIDTHS], [np.zeros(filters, np.float32) for _ in WIDTHS],
                   (rng.standard_normal(filters * len(WIDTHS)) * 0.3).astype(np.float32), -1.0)

    def maxima(self, ids: np.ndarray, at: np.ndarray, where: bool = False):
        """The maximum of every filter over every text; with ``where`` also
        the word at which it stands (-1: the floor)."""
        vectors = self.embedding[ids].sum(axis=1)
        n, docs, dim = len(ids), len(at) - 1, vectors.shape[1]
        sizes = np.diff(at)
        top, spots = [], []
        last = np.repeat(at[1:], sizes)
        for k, w, b in zip(WIDTHS, self.filters, self.biases):
            got = np.full((docs, w.shape[1]), FLOOR, np.float32)
            spot = np.full((docs, w.shape[1]), -1, np.int64)
            act = np.full((n, w.shape[1]), FLOOR, np.float32)
            if n >= k:
                sums = vectors[:n - k + 1] @ w[:dim] + b
                for j in range(1, k):
                    sums += vectors[j:n - k + 1 + j] @ w[j * dim:(j + 1) * dim]
                inside = np.arange(n - k + 1) + k <= last[:n - k + 1]
                act[:n - k + 1][inside] = np.maximum(sums[inside], FLOOR)
            full = np.flatnonzero(sizes > 0)
            if len(full):
                got[full] = np.maximum.reduceat(act, at[full], axis=0)
                if where:
                    for d in full.tolist():
                        best = act[at[d]:at[d + 1]].argmax(axis=0)
                        spot[d] = np.where(got[d] > FLOOR, at[d] + best, -1)
            top.append(got)
            spots.append(spot)
        return np.hstack(top), (np.hstack(spots) if where else None), vectors

    def scores(self, texts: list[str | None]) -> np.ndarray:
        top, _, _ = self.maxima(*word_ids(texts, self.bits))
        return 1 / (1 + np.exp(-np.clip(top.astype(np.float64) @ self.out + self.bias, -60, 60)))


def train(docs: list[tuple[np.ndarray, int]], bits: int = 16, dim: int = 8, filters: int = 8, epochs: int = 6,
          rate: float = 0.08, batch: int = 64, seed: int = 7) -> Network:
    """Adagrad on the logistic loss; gradients reach only the words that hold
    a filter's maximum."""
    net = Network.start(bits, dim, filters, seed)
    rng = np.random.default_rng(seed)
    memory: dict[int, np.ndarray] = {}

    def step(i: int, value: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        seen = memory.setdefault(i, np.zeros_like(value))
        seen[rows] += grad * grad
        value[rows] -= rate * grad / (np.sqrt(seen[rows]) + 1e-6)

    bias = np.array([net.bias])
    positives = max(1, sum(y for _, y in docs))
    raise_ = min(5.0, (len(docs) - positives) / positives)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), batch):
            part = [docs[i] for i in order[a:a + batch]]
            ids = np.concatenate([d for d, _ in part])
            at = np.concatenate([[0], np.cumsum([len(d) for d, _ in part])])
            y = np.array([v for _, v in part], float)
            net.bias = float(bias[0])
            top, spots, vectors = net.maxima(ids, at, where=True)
            p = 1 / (1 + np.exp(-np.clip(top @ net.out + net.bias, -30, 30)))
            d_out = ((p - y) * np.where(y > 0, raise_, 1.0) / len(part)).astype(np.float32)
            d_top = d_out[:, None] * net.out
            d_vec = np.zeros_like(vectors)
            new_filters = []
            for f, k in enumerate(WIDTHS):
                cols = slice(f * filters, (f + 1) * filters)
                grad, pos = d_top[:, cols], spots[:, cols]
                rows, col = np.nonzero(pos >= 0)
                g, at_word = grad[rows, col], pos[rows, col]
                d_w = np.zeros_like(net.filters[f])
                for j in range(k):
                    np.add.at(d_w.reshape(k, dim, filters)[j].T, col, g[:, None] * vectors[at_word + j])
                    np.add.at(d_vec, at_word + j, g[:, None] * net.filters[f].reshape(k, dim, filters)[j].T[col])
                d_b = np.zeros(filters, np.float32)
                np.add.at(d_b, col, g)
                new_filters.append((d_w, d_b))
            touched = np.flatnonzero(np.abs(d_vec).sum(axis=1))
            if len(touched):
                rows, back = np.unique(ids[touched].ravel(), return_inverse=True)
                d_rows = np.zeros((len(rows), dim), np.float32)
                np.add.at(d_rows, back, np.repeat(d_vec[touched], 3, axis=0))
                step(0, net.embedding, d_rows, rows)
            for f, (d_w, d_b) in enumerate(new_filters):
                step(1 + 2 * f, net.filters[f], d_w)
                step(2 + 2 * f, net.biases[f], d_b)
            step(99, net.out, (d_out[:, None] * top).sum(axis=0))
            step(100, bias, np.array([d_out.sum()]))
    net.bias = float(bias[0])
    return net


def calibrate(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold of highest F1, midway between neighbouring scores; 0.5
    where one class is missing."""
    if not len(labels) or labels.min() == labels.max():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores are not cut apart
    best = int(f1.argmax())
    return float((s[best] + s[best + 1]) / 2 if best + 1 < len(s) else s[best])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        lang: str | None = "lang", where: Column | None = None, rows_per_class: int = 2000, bits: int = 17) -> Network:
    """Train on labelled rows whose key ``where`` admits.

    ``rows_per_class`` is the expected number of rows of each label that are
    learned from, chosen by a hash of the key.  A fifth of them calibrates
    the thresholds.  Whole texts go in as table rows of their words."""
    schema = "label int, lang string, ids binary"
    sample = labelled_sample(docs, labels, key, text, label, [lang] if lang else [], where, rows_per_class)

    def encode(batches):
        for batch in batches:
            ids, at = word_ids(batch.column("text").to_pylist(), bits)
            flat = ids.astype(np.int32)
            langs = batch.column(lang) if lang else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), langs,
                 pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=["label", "lang", "ids"])

    rows = sorted(sample.mapInArrow(encode, schema).collect(), key=lambda r: (r["label"], bytes(r["ids"])))
    data = [(np.frombuffer(r["ids"], np.int32).reshape(-1, 3).astype(np.int64), r["label"]) for r in rows]
    if not data:
        return Network.start(bits, 8, 8, 7)
    aside = np.arange(len(data)) % 5 == 4
    net = train([d for d, out in zip(data, aside) if not out], bits)
    kept = [i for i in range(len(data)) if aside[i]]
    scores = np.array([_score(net, data[i][0]) for i in kept])
    y, langs = np.array([data[i][1] for i in kept]), [rows[i]["lang"] for i in kept]
    for k in sorted({k for k in langs if k is not None}):
        mine = np.array([x == k for x in langs])
        net.thresholds[k] = calibrate(scores[mine], y[mine])
    return net


def _score(net: Network, ids: np.ndarray) -> float:
    top, _, _ = net.maxima(ids, np.array([0, len(ids)]))
    return float(1 / (1 + np.exp(-np.clip(top[0] @ net.out + net.bias, -60, 60))))


def score(df: DataFrame, net: Network, text: str = "text", keep: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """Append the probability that a text is toxic."""
    sent = df.sparkSession.sparkContext.broadcast(net)  # tables of fixed size
    return add_columns(df, text, f"`{out}` double",
                       lambda column: [pa.array(sent.value.scores(column.to_pylist()))], keep)


def threshold(net: Network, lang: Column, default: float = 0.5) -> Column:
    """The calibrated threshold of a row's language."""
    out = F.lit(default)
    for k, v in net.thresholds.items():
        out = F.when(lang == k, F.lit(v)).otherwise(out)
    return out
