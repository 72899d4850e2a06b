"""Quality by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words between blanks,
the last one shorter).  Every passage is described by the forms of its words
and by repetition, encoded by a small network, weighted by gated attention
that is learned from document labels alone, and the weighted representation
is scored by a logistic layer.  Training is numpy on a bounded sample.

Null, empty and blank texts are one empty passage.  Labels that are null
teach nothing; labels that disagree for one key count as good.  Repeated
rows are scored each by itself; long texts have more passages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from textmine.llm.common import add_columns
from textmine.llm.sampling import labelled_sample
from textmine.llm.words import Words, alnum_table, blank_table, mix

PASSAGE = 48
SHAPES = 24
PLAIN = 12  # features besides the hashed word forms
FEATURES = PLAIN + SHAPES


def _kinds() -> np.ndarray:
    """0 other, 1 lower-case or caseless letter, 2 upper-case, 3 digit."""
    out = np.where(alnum_table(), 1, 0).astype(np.uint8)
    for c in np.flatnonzero(out).tolist():
        ch = chr(c)
        out[c] = 2 if ch.isupper() else 3 if ch.isdecimal() else 1
    return out


_KINDS: list[np.ndarray] = []


def kinds() -> np.ndarray:
    if not _KINDS:
        _KINDS.append(_kinds())
    return _KINDS[0]


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and where each text's passages begin."""
    w = Words(texts, blank_table())
    counts = np.diff(w.at)
    per = np.maximum(1, -(-counts // PASSAGE))
    at = np.concatenate([[0], np.cumsum(per)])
    n = at[-1]
    if not len(w):
        return np.zeros((n, FEATURES), np.float32), at
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(w)) - w.at[doc]
    of = at[doc] + place // PASSAGE
    kind = kinds()[w.points]
    size = (w.ends - w.starts).astype(np.float64)
    by = [np.add.reduceat((kind == k).astype(np.int32), w.starts) for k in range(1, 4)]
    # a blank may follow a word before the next one starts; blanks are kind 0
    lower, upper, digit = (b.astype(np.float64) for b in by)
    other = size - lower - upper - digit
    h = w.hashes()
    same = np.zeros(len(w), bool)
    same[1:] = (h[1:] == h[:-1]) & (place[1:] > 0)
    near = np.zeros(len(w), bool)
    near[2:] = (h[2:] == h[:-2]) & (place[2:] > 1)
    total = np.bincount(of, minlength=n).astype(np.float64)
    distinct = np.bincount(_distinct(of, h), minlength=n)
    last = kind[w.ends - 1]
    first = kind[w.starts]
    mean = lambda x: np.bincount(of, x, n) / np.maximum(1, total)
    letters = np.maximum(1, lower + upper)
    x = np.zeros((n, FEATURES), np.float32)
    x[:, 0] = np.log1p(total) / 4
    x[:, 1] = distinct / np.maximum(1, total)
    x[:, 2] = mean(same)
    x[:, 3] = mean(near)
    x[:, 4] = mean(size) / 8
    x[:, 5] = mean(upper / letters)
    x[:, 6] = mean(digit / size)
    x[:, 7] = mean(other / size)
    x[:, 8] = mean((other == size).astype(float))
    x[:, 9] = mean(np.minimum(other, 4) / 4)
    x[:, 10] = mean((upper > 1).astype(float))
    x[:, 11] = mean(np.minimum(size, 40) > 20)
    # the form of a word: kinds at both ends, length, other signs, capitals
    form = (((first.astype(np.uint64) * np.uint64(4) + last) * np.uint64(8)
             + np.minimum(size, 14).astype(np.uint64) // np.uint64(2)) * np.uint64(4)
            + np.minimum(other, 3).astype(np.uint64)) * np.uint64(2) + (upper > 1)
    shape = (mix(form + np.uint64(1)) % np.uint64(SHAPES)).astype(np.int64)
    grid = np.bincount(of * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)
    x[:, PLAIN:] = grid / np.maximum(1, total)[:, None]
    return x, at


def _distinct(of: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The passage of every distinct (passage, word)."""
    key = mix(h + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    return of[first]


@dataclass
class Network:
    """Encoder, the two gates of the attention, and the output layer."""

    w: dict[str, np.ndarray]
    offset: float = 0.0

    @classmethod
    def start(cls, hidden: int = 16, gate: int = 8, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        shape = {"enc": (FEATURES, hidden), "enc_b": (hidden,), "tanh": (hidden, gate), "sig": (hidden, gate),
                 "att": (gate,), "out": (hidden,), "out_b": (1,)}
        return cls({k: rng.standard_normal(s) * (0 if k.endswith("_b") else 1 / np.sqrt(s[0]))
                    for k, s in shape.items()})

    def forward(self, x: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        h = np.maximum(0, x @ w["enc"] + w["enc_b"])
        t, s = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-np.clip(h @ w["sig"], -30, 30)))
        e = np.clip((t * s) @ w["att"], -30, 30)
        sizes = np.diff(at)
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, at[:-1]), sizes))
        a /= np.repeat(np.add.reduceat(a, at[:-1]), sizes)
        z = np.add.reduceat(a[:, None] * h, at[:-1], axis=0)
        logit = z @ w["out"] + w["out_b"][0] + self.offset
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(logit, -60, 60)))}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x, at = passages(texts)
        return self.forward(x, at)["p"] if len(texts) else np.zeros(0)


def train(bags: list[tuple[np.ndarray, int]], epochs: int = 30, rate: float = 0.01, batch: int = 64,
          seed: int = 3) -> Network:
    """Adam on the logistic loss of the documents."""
    net = Network.start(seed=seed)
    rng = np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in net.w.items()}
    m2 = {k: np.zeros_like(v) for k, v in net.w.items()}
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), batch):
            part = [bags[i] for i in order[start:start + batch]]
            x = np.concatenate([b for b, _ in part]).astype(np.float64)
            sizes = np.array([len(b) for b, _ in part])
            at = np.concatenate([[0], np.cumsum(sizes)])
            y = np.array([v for _, v in part], float)
            f, w, g = net.forward(x, at), net.w, {}
            d = (f["p"] - y) / len(part)
            g["out"], g["out_b"] = d @ f["z"], np.array([d.sum()])
            d_z = np.repeat(d[:, None] * w["out"], sizes, axis=0)
            d_a = (d_z * f["h"]).sum(axis=1)
            inner = np.repeat(np.add.reduceat(f["a"] * d_a, at[:-1]), sizes)
            d_e = f["a"] * (d_a - inner)
            g["att"] = d_e @ (f["t"] * f["s"])
            d_t = d_e[:, None] * w["att"] * f["s"] * (1 - f["t"] ** 2)
            d_s = d_e[:, None] * w["att"] * f["t"] * f["s"] * (1 - f["s"])
            g["tanh"], g["sig"] = f["h"].T @ d_t, f["h"].T @ d_s
            d_h = (d_z * f["a"][:, None] + d_t @ w["tanh"].T + d_s @ w["sig"].T) * (f["h"] > 0)
            g["enc"], g["enc_b"] = x.T @ d_h, d_h.sum(axis=0)
            steps += 1
            for k, grad in g.items():
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.999 * m2[k] + 0.001 * grad * grad
                w[k] -= rate * (m1[k] / (1 - 0.9 ** steps)) / (np.sqrt(m2[k] / (1 - 0.999 ** steps)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        where: Column | None = None, rows_per_class: int = 2500) -> Network:
    """Train on labelled rows whose key ``where`` admits: about
    ``rows_per_class`` of each label, chosen by a hash of the key, as the
    features of all passages of their whole texts."""
    sample = labelled_sample(docs, labels, key, text, label, [], where, rows_per_class)

    def encode(batches):
        for batch in batches:
            x, at = passages(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([x[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=["label", "bag"])

    rows = sorted((r["label"], bytes(r["bag"])) for r in sample.mapInArrow(encode, "label int, bag binary").collect())
    bags = [(np.frombuffer(b, np.float32).reshape(-1, FEATURES), y) for y, b in rows]
    return train(bags) if bags else Network.start()


def score(df: DataFrame, net: Network, text: str = "text", keep: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """Append the probability that a text is good."""
    sent = df.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers
    return add_columns(df, text, f"`{out}` double",
                       lambda column: [pa.array(sent.value.scores(column.to_pylist()))], keep)
