"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces (a
forward algorithm over the word), a text's is the product over its words.
Probabilities are learned by expectation-maximisation: expected piece counts
over all segmentations are computed in Spark tasks, summed by a shuffle, and
only the pieces-by-languages table comes to the driver.

A text that is null or has no letter is ``und`` with score 0; ties go to the
first language by code point.  Rows with a null language teach nothing.
Repeated rows are scored each by itself; words of any length are scored
whole, long ones in runs that advance together (``long_forward``), in bounded
memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import add_columns, checkpointed, slices
from textmine.llm.words import HashTable, Words, blank_table
from textmine.session import ship_package

#: Bytes of text scored at once; the distinct words of a slice are scored.
SLICE = 4_000_000
TINY, BIG = 1e-120, 1e120
#: Words of this many characters are scored one by one, in runs, unless this
#: many have one length.
LONG, FEW = 256, 24


def read_pieces(path: str) -> list[str]:
    """The normal and byte pieces of a sentencepiece model, in id order."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i))]


class Lattice:
    """Looks up, for spans of words, the pieces of the vocabulary.  A word is
    written with the word mark in front, as the vocabulary's pieces are."""

    MARK = "▁"

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        byte = {p: i for i, p in enumerate(pieces)}
        self.byte_ids = np.array([byte.get(f"<0x{b:02X}>", -1) for b in range(256)], np.int32)
        plain = [i for i, p in enumerate(pieces) if not (len(p) == 6 and p.startswith("<0x"))]
        w = Words([pieces[i] for i in plain], np.ones(0x110000, bool))
        keys = w.span_hashes(w.starts, w.ends)
        self.longest = max((len(pieces[i]) for i in plain), default=1)
        self.table = HashTable(keys, np.array(plain, np.int32), -1)

    def spans(self, words: list[str]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """For words of one length L: the code points (n, L) and, by piece length,
        the piece ids (n, L - length + 1)."""
        n, size = len(words), len(words[0])
        w = Words(["".join(words)], np.ones(0x110000, bool))
        points = w.points[:-1].reshape(n, size)
        base = np.arange(n, dtype=np.int64)[:, None] * size
        found = {}
        for k in range(1, min(self.longest, size) + 1):
            starts = (base + np.arange(size - k + 1)).ravel()
            found[k] = self.table.find(w.span_hashes(starts, starts + k)).reshape(n, -1)
        return points, found

    def point_bytes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct code points of ``points`` (inverse index) and their byte
        pieces, padded with -1."""
        distinct, back = np.unique(points, return_inverse=True)
        rows = np.full((len(distinct), 4), -1, np.int32)
        for i, c in enumerate(distinct.tolist()):
            for j, b in enumerate(chr(c).encode("utf-8", "surrogatepass")):
                rows[i, j] = self.byte_ids[b]
        return rows, back.reshape(points.shape)


def long_forward(lattice: Lattice, word: str, prob: np.ndarray, step: int = 64, part: int = 16384) -> np.ndarray:
    """Log probability of one long word in each language.

    The forward recursion is linear in its last values, as many as the longest
    piece has characters.  So the word is cut into runs of ``step``
    characters, all runs of a ``part`` advance together, each from every unit
    vector, and the resulting matrices are applied one after the other.
    Memory is that of a part."""
    window, langs = lattice.longest, prob.shape[1]
    padded = np.vstack([prob, np.zeros((1, langs))])
    ones = np.vstack([prob, np.ones((1, langs))])
    state = np.full((window, langs), -np.inf)  # log of the value 0, 1, .. places back
    state[0] = 0.0
    part = part // step * step
    cuts = [0, *range(len(word) % part or part, len(word) + 1, part)]  # only the first part may be uneven
    for low, high in zip(cuts[:-1], cuts[1:]):
        before = min(low, window - 1)
        points, found = lattice.spans([word[low - before:high]])
        rows, back = lattice.point_bytes(points)
        spelled = (ones[rows].prod(axis=1) * (rows[:, :1] >= 0))[back[0, before:]]
        runs = -(-(high - low) // step)
        gap = runs * step - (high - low)  # filled up in front, where nothing is read
        spelled = np.vstack([np.ones((gap, langs)), spelled]).reshape(runs, step, langs)
        ids = np.full((len(found) + 1, window + runs * step), -1, np.int32)  # by the place after ``window``
        for k, at in found.items():
            begin = window + gap - before
            ids[k, begin:begin + at.shape[1]] = at[0]
        # values of the last places, newest at place i modulo the window
        value = np.zeros((window + 1, runs, window, langs))
        shift = np.zeros_like(value)
        for j in range(window):
            value[-j % (window + 1), :, j] = 1.0
        base = window + np.arange(runs) * step
        for i in range(1, step + 1):
            last = shift[(i - 1) % (window + 1)]
            total = value[(i - 1) % (window + 1)] * spelled[:, i - 1, None]
            for k in found:
                piece = ids[k, base + i - k]
                if (here := np.flatnonzero(piece >= 0)).size:
                    old = (i - k) % (window + 1)
                    rate = np.exp(np.minimum(700, shift[old, here] - last[here]))
                    total[here] += value[old, here] * padded[piece[here], None] * rate
            small = (total < 1e-30) & (total > 0)
            scale = np.where(small, np.maximum(total, TINY), 1.0)
            value[i % (window + 1)], shift[i % (window + 1)] = total / scale, last + np.log(scale)
        newest = (step - np.arange(window)) % (window + 1)
        with np.errstate(divide="ignore"):
            moves = np.log(value[newest]) + shift[newest]  # (to, runs, from, languages)
        for r in range(runs):
            terms = moves[:, r] + state
            top = np.maximum(terms.max(axis=1), -1e300)
            with np.errstate(divide="ignore"):
                state = np.log(np.exp(terms - top[:, None]).sum(axis=1)) + top
    return np.maximum(state[0], -1e300)


def forward(lattice: Lattice, words: list[str], prob: np.ndarray,
            weights: np.ndarray | None = None) -> np.ndarray:
    """Log probability of each word (all of one length) in each language;
    with ``weights`` (n, languages) instead the expected piece counts
    (languages, pieces), by a backward pass over the same lattice."""
    n, size, langs = len(words), len(words[0]), prob.shape[1]
    points, found = lattice.spans(words)
    rows, back = lattice.point_bytes(points)
    padded = np.vstack([prob, np.zeros((1, langs))])  # id -1: no such piece
    ones = np.vstack([prob, np.ones((1, langs))])
    spelled = ones[rows].prod(axis=1) * (rows[:, :1] >= 0)  # by its bytes
    alpha = np.zeros((size + 1, n, langs))
    shift = np.zeros((size + 1, n, langs))  # natural log taken out so far
    alpha[0] = 1.0
    for i in range(1, size + 1):
        total = alpha[i - 1] * spelled[back[:, i - 1]]
        for k, ids in found.items():
            if k <= i and (here := np.flatnonzero(ids[:, i - k] >= 0)).size:
                rate = np.exp(shift[i - k, here] - shift[i - 1, here]) if i - k < i - 1 else 1.0
                total[here] += alpha[i - k, here] * padded[ids[here, i - k]] * rate
        scale = np.where(total < 1e-30, np.maximum(total, TINY), 1.0)
        alpha[i], shift[i] = total / scale, shift[i - 1] + np.log(scale)
    score = np.log(np.maximum(alpha[size], TINY)) + shift[size]
    if weights is None:
        return score
    counts = np.zeros((langs, len(prob) + 1))
    beta = np.zeros((size + 1, n, langs))
    shift_b = np.zeros((size + 1, n, langs))
    beta[size] = 1.0
    for i in range(size - 1, -1, -1):
        by_bytes = spelled[back[:, i]] * beta[i + 1]
        total = by_bytes.copy()
        post = weights * np.exp(np.minimum(0, np.log(np.maximum(alpha[i] * by_bytes, TINY)) + shift[i]
                                           + shift_b[i + 1] - score))
        for j in range(4):
            ids = rows[back[:, i], j]
            used = np.flatnonzero(ids >= 0)
            for lang in range(langs):
                np.add.at(counts[lang], ids[used], post[used, lang])
        for k, ids in found.items():
            if i + k <= size and (here := np.flatnonzero(ids[:, i] >= 0)).size:
                part = padded[ids[here, i]] * beta[i + k, here]
                rate = np.exp(shift_b[i + k, here] - shift_b[i + 1, here])
                total[here] += part * rate
                post = weights[here] * np.exp(np.minimum(0, np.log(np.maximum(alpha[i, here] * part, TINY))
                                                         + shift[i, here] + shift_b[i + k, here] - score[here]))
                for lang in range(langs):
                    np.add.at(counts[lang], ids[here, i], post[:, lang])
        scale = np.where(total < 1e-30, np.maximum(total, TINY), 1.0)
        beta[i], shift_b[i] = total / scale, shift_b[i + 1] + np.log(scale)
    return counts[:, :-1]


def by_length(words: list[str], cells: int = 400_000):
    """Index groups of words of one length, of bounded total size."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        size = sizes[order[at]]
        end = min(np.searchsorted(sizes[order], size, side="right"), at + max(1, cells // int(size)))
        yield order[at:end]
        at = end


class Distinct:
    """The distinct words of a slice: their hashes (sorted), the index of
    every word among them, and where each text's words begin."""

    def __init__(self, texts: list[str | None]):
        self.words = Words(texts, blank_table())
        self.at = self.words.at
        self.hashes, self.first, self.back = np.unique(self.words.hashes(), return_index=True, return_inverse=True)

    def marked(self, which: np.ndarray) -> list[str]:
        """Some of the distinct words, with the word mark."""
        whole, i = self.words.whole, self.first[which]
        return [Lattice.MARK + whole[a:b] for a, b in zip(self.words.starts[i].tolist(), self.words.ends[i].tolist())]


def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of rows of ``values`` between the limits ``at``."""
    upto = np.vstack([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)])
    return upto[at[1:]] - upto[at[:-1]]


@dataclass
class Model:
    langs: list[str]
    lattice: Lattice
    prob: np.ndarray  # (pieces, languages)
    prior: np.ndarray
    cache_words: int = 600_000

    def word_scores(self, d: Distinct) -> np.ndarray:
        """Log probabilities of the distinct words; a worker keeps those of
        recent words, sorted by hash."""
        keys, scores = getattr(self, "_known", (np.zeros(0, np.uint64), np.zeros((0, len(self.langs)))))
        each = np.zeros((len(d.hashes), len(self.langs)))
        if len(keys):
            spot = np.minimum(np.searchsorted(keys, d.hashes), len(keys) - 1)
            hit = keys[spot] == d.hashes
            each[hit] = scores[spot[hit]]
            new = np.flatnonzero(~hit)
        else:
            new = np.arange(len(d.hashes))
        words = d.marked(new)
        for group in by_length(words):
            if len(words[group[0]]) >= LONG and len(group) < FEW:
                each[new[group]] = [long_forward(self.lattice, words[i], self.prob) for i in group]
            else:
                each[new[group]] = forward(self.lattice, [words[i] for i in group], self.prob)
        if len(new):
            if len(keys) + len(new) > self.cache_words:
                keys, scores = d.hashes, each
            else:
                keys = np.concatenate([keys, d.hashes[new]])
                order = np.argsort(keys)
                keys, scores = keys[order], np.concatenate([scores, each[new]])[order]
            self._known = keys, scores
        return each

    def log_scores(self, texts: list[str | None]) -> np.ndarray:
        d = Distinct(texts)
        return per_text(self.word_scores(d)[d.back], d.at) + np.log(self.prior)


def has_letter(texts: list[str | None]) -> list[bool]:
    return [bool(t) and (t.isalpha() or any(map(str.isalpha, t))) for t in texts]


def fit(df: DataFrame, pieces: list[str], text: str = "text", lang: str = "lang", where: Column | None = None,
        rows_per_language: int = 600, rounds: int = 3, add: float = 0.01, longest_taught: int = 2000) -> Model:
    """Learn piece probabilities by language from rows with a language that
    ``where`` admits.

    ``rows_per_language`` is the expected number of rows learned from in each
    language, chosen by a hash of the text (repeated texts count once); their
    whole texts are read, but words of more than ``longest_taught``
    characters teach nothing.  Only (language, piece) sums reach the driver.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.filter(where) if where is not None else df
    rows = rows.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    totals = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    langs, lattice = [k for k, _ in totals], Lattice(pieces)
    if not langs:
        return Model(["und"], lattice, np.full((len(pieces), 1), 1 / len(pieces)), np.ones(1))
    share = F.lit(0.0)
    for k, n in totals:
        share = F.when(F.col("lang") == k, F.lit(min(1.0, rows_per_language / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sample = checkpointed(rows.filter(draw < share).dropDuplicates(["lang", "text"]))
    index = {k: i for i, k in enumerate(langs)}
    schema = "lang int, piece int, n double"

    def expected(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                d = Distinct(part.column("text").to_pylist())
                words = d.marked(np.arange(len(d.hashes)))
                of = np.array([index[k] for k in part.column("lang").to_pylist()])
                weights = np.zeros((len(words), len(langs)))
                np.add.at(weights, (d.back, np.repeat(of, np.diff(d.at))), 1.0)
                total = np.zeros((len(langs), len(pieces)))
                for group in by_length(words, 200_000):
                    if len(words[group[0]]) > longest_taught:
                        break  # groups come by length
                    total += forward(lattice, [words[i] for i in group], prob, weights[group])
                k, piece = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[k, piece])],
                    names=["lang", "piece", "n"])

    size = np.array([len(p) for p in pieces], float)
    prob = np.repeat((0.02 ** np.minimum(size, 6))[:, None], len(langs), axis=1)
    prob /= prob.sum(axis=0)
    spread = sample.repartition(max(1, spark.sparkContext.defaultParallelism))
    for _ in range(rounds):
        summed = spread.mapInArrow(expected, schema).groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((len(pieces), len(langs)), add)
        counts[summed["piece"], summed["lang"]] += summed["n"]
        prob = counts / counts.sum(axis=0)
    prior = np.array([n for _, n in totals], float)
    return Model(langs, lattice, prob, prior / prior.sum())


def predict(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            out: str = "lang_pred", score: str = "score") -> DataFrame:
    """Append the most probable language and its posterior probability."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # pieces by languages

    def make(column: pa.Array) -> list[pa.Array]:
        texts, fitted = column.to_pylist(), sent.value
        logs = fitted.log_scores(texts)
        best = logs.argmax(axis=1)
        posterior = 1 / np.exp(np.minimum(700, logs - logs.max(axis=1, keepdims=True))).sum(axis=1)
        known = has_letter(texts)
        return [pa.array([fitted.langs[b] if k else "und" for b, k in zip(best.tolist(), known)], pa.string()),
                pa.array(np.where(known, posterior, 0.0))]

    return add_columns(df, text, f"`{out}` string, `{score}` double", make, keep, SLICE)
