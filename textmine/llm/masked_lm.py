"""Language-model scores by masked pseudo-likelihood.

Every word of a text is predicted from the words on both its sides by a
window network; the sum of the conditional log probabilities scores the text.
A word's probability is that of its class given the window (the network) times
that of the word in its class (corpus counts).  The most frequent words are
classes of their own; all others fall into classes by their ending.  The
number of classes grows with the vocabulary (its power 0.44); the network
predicts a class in two steps, its group and then its place in the group, so
an output costs the root of the number of classes.

Counts cover all words of all documents, and the network is trained on all
of them, in numpy inside Spark tasks: each task trains on its documents from
the same start, and updates are averaged in a tree of sums, round by round.
The rounds share the rows out, so every row (repeated texts as often as they
occur) is trained on once.  The result depends on how the rows lie in
partitions, as each task's updates follow the order of its rows.

The counts of frequent words go to the tasks as a list; those of all other
words are joined to the tokens by a shuffle, so no word is without its own.

Null and empty texts have 0 words and score 0; their mean is 0.  Repeated rows
are scored each by itself; texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmine.llm.common import add_columns, checkpointed, slices
from textmine.llm.words import HashTable, Words, alnum_table, mix
from textmine.session import ship_package

ENDINGS = 4096  # by hash; folded to the classes that a vocabulary has
BUCKETS, DIM, HIDDEN = 8192, 16, 32
SIDES = (-2, -1, 1, 2)
CHUNK = 1_024  # words scored at once
PLAIN = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.BooleanType)  # columns that deal rows to rounds


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending of every word (letters, marks and numbers, lower
    case), and where each text's words begin."""
    w = Words([t.lower() if t else t for t in texts], alnum_table())
    last = w.points[w.ends - 1].astype(np.uint64)
    before = np.where(w.ends - w.starts > 1, w.points[w.ends - 2], 0).astype(np.uint64)
    ending = mix((before << np.uint64(21)) + last + np.uint64(1)) % np.uint64(ENDINGS)
    return w.hashes(), ending.astype(np.int16), w.at


def count_words(df: DataFrame, text: str) -> DataFrame:
    """``word, ending, n`` over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8_000_000):
                h, ending, _ = tokens(part.column("text").to_pylist())
                word, first, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), pa.array(ending[first]), pa.array(n.astype(np.int64))],
                    names=["word", "ending", "n"])

    counted = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "word long, ending short, n long")
    return counted.groupBy("word", "ending").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Class and log probability in its class of the frequent words, the mean
    log probability of any other word by ending, and the log of what is
    counted in each ending's class.  There are ``side`` groups of ``side``
    classes; ``own`` of the classes are words, the others endings."""

    words: np.ndarray
    classes: np.ndarray
    logs: np.ndarray
    other: np.ndarray
    totals: np.ndarray
    side: int
    own: int

    @property
    def endings(self) -> int:
        return self.side ** 2 - self.own

    def __post_init__(self) -> None:
        self.table = HashTable(self.words.view(np.uint64), np.arange(len(self.words), dtype=np.int32), -1)

    def classify(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.table.find(h)
        known = at >= 0
        ending = ending % self.endings
        kind, log = self.own + ending.astype(np.int64), self.other[ending]
        kind[known], log[known] = self.classes[at[known]], self.logs[at[known]]
        return kind, log

    def listed(self, h: np.ndarray) -> np.ndarray:
        return self.table.find(h) >= 0


def class_numbers(words: int) -> tuple[int, int]:
    """Classes to a group (as many as groups) and classes of single words,
    for a vocabulary of ``words``."""
    side = max(20, math.ceil(words ** 0.22))
    return side, side * side * 3 // 4


def vocabulary(counts: DataFrame, size: int) -> Vocabulary:
    """The most frequent words and sums by ending over all words; ``counts``
    as made by ``count_words``.  Words go in by steps of their count (16 to
    a doubling) as long as all of a step fit into ``size``, so that only
    these words reach the driver."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, room = 1 << 30, size
    for r in sorted(steps, key=lambda r: -r["step"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    known = sorted(counts.filter(step >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    side, of_own = class_numbers(sum(r["words"] for r in steps))
    endings = side * side - of_own
    word = np.array([r["word"] for r in known], np.int64)
    ending = np.array([r["ending"] for r in known], np.int64) % endings
    n = np.array([r["n"] for r in known], float)
    own = np.arange(len(known)) < of_own
    total, kinds = np.zeros(endings), np.zeros(endings)
    fold = (F.col("ending") % endings).alias("ending")
    for r in counts.groupBy(fold).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect():
        total[r["ending"]], kinds[r["ending"]] = r["n"], r["kinds"]
    np.subtract.at(total, ending[own], n[own])  # own classes leave their ending's
    rest, rest_kinds = total.copy(), kinds
    np.subtract.at(rest, ending[~own], n[~own])
    np.subtract.at(rest_kinds, ending, 1)
    rate = np.where(rest_kinds > 0, rest / np.maximum(1, rest_kinds), 1.0)
    other = np.log(np.maximum(rate, 1e-9) / np.maximum(total, 1.0))
    logs = np.where(own, 0.0, np.log(n / np.maximum(1.0, total[ending] if len(known) else 1.0)))
    return Vocabulary(word, np.where(own, np.arange(len(known)), of_own + ending), logs, other,
                      np.log(np.maximum(total, 1.0)), side, of_own)


@dataclass
class Network:
    """Input rows (word bucket, class of a word, or the padding), a hidden
    layer over the window, the output over groups, and the output over places
    in a group from the hidden layer moved by the group."""

    embed: np.ndarray
    inner: np.ndarray  # (window, DIM, HIDDEN)
    inner_b: np.ndarray
    outer: np.ndarray
    outer_b: np.ndarray
    group: np.ndarray
    place: np.ndarray
    place_b: np.ndarray

    NAMES = ("embed", "inner", "inner_b", "outer", "outer_b", "group", "place", "place_b")

    @classmethod
    def start(cls, side: int, own: int, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        f = np.float32
        return cls((rng.standard_normal((BUCKETS + own + 1, DIM)) * 0.1).astype(f),
                   (rng.standard_normal((len(SIDES), DIM, HIDDEN)) / math.sqrt(DIM * len(SIDES))).astype(f),
                   np.zeros(HIDDEN, f), (rng.standard_normal((HIDDEN, side)) / math.sqrt(HIDDEN)).astype(f),
                   np.zeros(side, f), (rng.standard_normal((side, HIDDEN)) * 0.1).astype(f),
                   (rng.standard_normal((HIDDEN, side)) / math.sqrt(HIDDEN)).astype(f), np.zeros(side, f))

    def copy(self) -> Network:
        return Network(*(getattr(self, k).copy() for k in self.NAMES))


def windows(h: np.ndarray, kind: np.ndarray, at: np.ndarray, own: int) -> np.ndarray:
    """Input rows of the neighbours of every word (n, sides): a frequent word
    by its class, any other by its bucket, the padding beyond a text's ends."""
    row = np.where(kind < own, BUCKETS + kind, (h % np.uint64(BUCKETS)).astype(np.int64))
    n = len(row)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out = np.full((n, len(SIDES)), BUCKETS + own, np.int32)
    for j, side in enumerate(SIDES):
        here = np.arange(max(0, -side), n - max(0, side))
        here = here[text[here] == text[here + side]]
        out[here, j] = row[here + side]
    return out


def class_logs(net: Network, rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Log probability of every word's class given its window."""
    tables = [net.embed @ w for w in net.inner]
    out = np.empty(len(rows))
    for a in range(0, len(rows), CHUNK):
        part = rows[a:a + CHUNK]
        group, place = np.divmod(kind[a:a + CHUNK], len(net.place_b))
        hidden = tables[0][part[:, 0]] + net.inner_b
        for j in range(1, len(SIDES)):
            hidden += tables[j][part[:, j]]
        out[a:a + CHUNK] = (_chosen(net.outer.T @ np.tanh(hidden).T + net.outer_b[:, None], group)
                            + _chosen(net.place.T @ np.tanh(hidden + net.group[group]).T + net.place_b[:, None], place))
    return out


def _chosen(logit: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Log of the softmax down each column, at one row of it."""
    top = logit.max(axis=0)
    return logit[mine, np.arange(len(mine))] - top - np.log(np.exp(logit - top).sum(axis=0))


def _softmax_slope(logit: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Slope of the mean loss by the logits, a column for each word."""
    p = logit - logit.max(axis=0)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    p[mine, np.arange(len(mine))] -= 1
    p /= np.float32(len(mine))
    return p


class Trainer:
    """Adagrad on the masked words of a stream of texts, from a given start."""

    def __init__(self, net: Network, rate: float, batch: int = 2048):
        self.net, self.rate, self.batch = net, rate, batch
        self.memory = {k: np.full_like(getattr(net, k), 1e-6) for k in net.NAMES}
        self.used = np.zeros(len(net.embed), np.float32)
        self.seen = 0

    def learn(self, rows: np.ndarray, kind: np.ndarray) -> None:
        for a in range(0, len(rows), self.batch):
            self._step(rows[a:a + self.batch], kind[a:a + self.batch])

    def _step(self, rows: np.ndarray, kind: np.ndarray) -> None:
        net, n = self.net, len(rows)
        vectors = net.embed[rows]  # (n, sides, DIM)
        flat = vectors.reshape(n, -1)
        group, place = np.divmod(kind, len(net.place_b))
        whole = flat @ net.inner.reshape(-1, HIDDEN) + net.inner_b
        hidden, moved = np.tanh(whole), np.tanh(whole + net.group[group])
        # words as columns: sums over few classes are sums of long rows
        p = _softmax_slope(net.outer.T @ hidden.T + net.outer_b[:, None], group)
        q = _softmax_slope(net.place.T @ moved.T + net.place_b[:, None], place)
        d_moved = (q.T @ net.place.T) * (1 - moved * moved)
        d_hidden = (p.T @ net.outer.T) * (1 - hidden * hidden) + d_moved
        of_group = (np.arange(len(net.group))[:, None] == group).astype(np.float32)
        d_rows = (d_hidden @ net.inner.reshape(-1, HIDDEN).T).reshape(-1, DIM)
        ids = rows.ravel().astype(np.uint16)  # sorts by radix
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        each, summed = ids[first], np.add.reduceat(d_rows[order].T.copy(), first, axis=1).T
        for k, g in (("outer", (p @ hidden).T), ("outer_b", p.sum(axis=1)), ("group", of_group @ d_moved),
                     ("place", (q @ moved).T), ("place_b", q.sum(axis=1)),
                     ("inner", (flat.T @ d_hidden).reshape(net.inner.shape)), ("inner_b", d_hidden.sum(axis=0))):
            self.memory[k] += g * g
            getattr(net, k)[...] -= self.rate * g / np.sqrt(self.memory[k])
        self.memory["embed"][each] += summed * summed
        net.embed[each] -= self.rate * summed / np.sqrt(self.memory["embed"][each])
        self.used[each] += np.diff(np.append(first, len(ids)))
        self.seen += n


def _flat(net: Network) -> np.ndarray:
    return np.concatenate([getattr(net, k).ravel() for k in net.NAMES])


def _unflat(values: np.ndarray, like: Network) -> Network:
    made, at = [], 0
    for k in Network.NAMES:
        shape = getattr(like, k).shape
        made.append(values[at:at + math.prod(shape)].reshape(shape).astype(np.float32))
        at += math.prod(shape)
    return Network(*made)


def train(sample: DataFrame, vocab: Vocabulary, rounds: int = 2, rate: float = 0.16, pieces: int = 16,
          share: str | None = None) -> Network:
    """Rounds of local training and averaging over the rows of ``sample``
    (``text``); where ``share`` names a column, round i takes the rows that
    hold i there.  Each task's parameters count by the words it trained on (an
    input row by how often it was used); sums go through a tree of groups, so
    no task meets more than about the root of the number of tasks."""
    spark = sample.sparkSession
    net = Network.start(vocab.side, vocab.own)
    fan = max(1, math.isqrt(max(1, sample.rdd.getNumPartitions())))
    known = spark.sparkContext.broadcast(vocab)  # of the vocabulary's size
    schema = "piece int, fan int, total binary, weight binary"

    for turn in range(rounds):
        mine_now = (sample.filter(F.col(share) == turn) if share else sample).select("text")
        sent = spark.sparkContext.broadcast(net)

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trainer = Trainer(sent.value.copy(), rate)
            for batch in batches:
                for part in slices(batch, "text"):
                    h, ending, at = tokens(part.column("text").to_pylist())
                    kind, _ = known.value.classify(h, ending)
                    trainer.learn(windows(h, kind, at, known.value.own), kind)
            if trainer.seen:
                values = _flat(trainer.net).astype(np.float64)
                weight = np.full(len(values), float(trainer.seen))
                weight[:trainer.used.size * DIM] = np.repeat(trainer.used, DIM)
                mine = TaskContext.get().partitionId() % fan
                for i, (v, w) in enumerate(zip(np.array_split(values * weight, pieces), np.array_split(weight, pieces))):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([mine], pa.int32()),
                                                      pa.array([v.tobytes()]), pa.array([w.tobytes()])],
                                                     names=["piece", "fan", "total", "weight"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(b) for b in pdf["total"])
            weight = sum(np.frombuffer(b) for b in pdf["weight"])
            return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "fan": [0], "total": [total.tobytes()],
                                 "weight": [weight.tobytes()]})

        summed = mine_now.mapInArrow(local, schema).groupBy("piece", "fan").applyInPandas(add, schema)
        rows = sorted(summed.groupBy("piece").applyInPandas(add, schema).collect(), key=lambda r: r["piece"])
        if not rows:
            continue
        total = np.concatenate([np.frombuffer(bytes(r["total"])) for r in rows])
        weight = np.concatenate([np.frombuffer(bytes(r["weight"])) for r in rows])
        old = _flat(net)
        net = _unflat(np.where(weight > 0, total / np.maximum(weight, 1), old), net)
    return net


@dataclass
class Model:
    vocab: Vocabulary
    net: Network
    counts: DataFrame | None = None  # of all words, as made by ``count_words``

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words and pseudo log-likelihood of each text, words
        outside the list at their ending's mean."""
        h, ending, at = tokens(texts)
        kind, log = self.vocab.classify(h, ending)
        return np.diff(at), _sums(class_logs(self.net, windows(h, kind, at, self.vocab.own), kind) + log, at)

    def parts(self, texts: list[str | None]) -> list[pa.Array]:
        """Number of words and pseudo log-likelihood of each text, without the
        log counts of the words outside the list, and these words."""
        h, ending, at = tokens(texts)
        kind, log = self.vocab.classify(h, ending)
        rare = ~self.vocab.listed(h)
        log[rare] = -self.vocab.totals[ending[rare] % self.vocab.endings]
        total = _sums(class_logs(self.net, windows(h, kind, at, self.vocab.own), kind) + log, at)
        words = pa.StructArray.from_arrays([pa.array(h[rare].view(np.int64)), pa.array(ending[rare])],
                                           ["word", "ending"])
        upto = np.concatenate([[0], np.cumsum(rare)])[at].astype(np.int32)
        return [pa.array(np.diff(at)), pa.array(total), pa.ListArray.from_arrays(pa.array(upto), words)]


def _sums(each: np.ndarray, at: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(each)])
    return upto[at[1:]] - upto[at[:-1]]


def fit(df: DataFrame, text: str = "text", words: int = 20_000, fraction: float = 1.0, rounds: int = 2) -> Model:
    """Count the words of all rows and train the network on all rows, each in
    one of ``rounds`` by a hash of its columns.  A ``fraction`` below 1 leaves
    out the rows whose text hash falls beyond it (whole texts)."""
    ship_package(df.sparkSession)
    counts = checkpointed(count_words(df, text))
    vocab = vocabulary(counts, words)
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, PLAIN)]
    rows = df.filter(F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.pmod(F.xxhash64(*plain, F.lit(7)), F.lit(rounds)).alias("share"))
    if fraction < 1:
        draw = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.filter(draw < fraction)
    return Model(vocab, train(rows, vocab, rounds, share="share"), counts)


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``n_tokens``, ``log_likelihood`` (the sum) and
    ``mean_log_likelihood`` (by word).  ``model`` is one that ``fit`` made."""
    # of the list's and network's size
    sent = df.sparkSession.sparkContext.broadcast(Model(model.vocab, model.net))
    other = F.array(*[F.lit(float(x)) for x in model.vocab.other + model.vocab.totals])

    def make(column: pa.Array) -> list[pa.Array]:
        return sent.value.parts(column.to_pylist())

    fields = "n_tokens long, _lm_sum double, _lm_rare array<struct<word:long,ending:short>>"
    made = ("n_tokens", "log_likelihood", "mean_log_likelihood")
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    base = checkpointed(add_columns(df, text, fields, make, keep).withColumn(
        "_lm_row", F.monotonically_increasing_id()))
    rare = base.select("_lm_row", F.inline("_lm_rare")).join(model.counts, ["word", "ending"], "left")
    # a word that was never counted stands at its ending's mean
    log = F.coalesce(F.log(F.col("n").cast("double")), F.get(other, F.col("ending").cast("int") % model.vocab.endings))
    logs = rare.groupBy("_lm_row").agg(F.sum(log).alias("_lm_logs"))
    total = F.col("_lm_sum") + F.coalesce("_lm_logs", F.lit(0.0))
    return base.drop("_lm_rare").join(logs, "_lm_row", "left").select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens", total.alias("log_likelihood"),
        (total / F.greatest("n_tokens", F.lit(1))).alias("mean_log_likelihood"))
