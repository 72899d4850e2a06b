"""Best-fit packing of token sequences with exact complements.

``pieces`` tokenizes documents and cuts those longer than a sequence;
``place`` packs pieces into sequences of at most ``capacity`` tokens.

What decides a packing is how many pieces there are of each length, at most
``capacity`` numbers whatever the input; only this histogram reaches the
driver.  ``plan`` fills sequences from the longest length down: it closes a
gap exactly by one, two or three lengths found through an index of length
sums, under the counts still available, and takes as many equal sequences at
once as those counts allow; where no such combination exists it places the
best-fitting length and looks again.  The result is a table of runs ("the
next pieces of length l, k to a sequence, go to m sequences from number s on,
from offset o"), whose number also depends on the lengths only.

The pieces are numbered in order of length by a distributed range sort, so a
length that holds most rows is spread over many tasks, and each row finds its
run by its number.

Defined results: a null text is an empty one and gives the end token alone;
pieces equal in every column are different pieces; an empty table gives an
empty result; columns named like an output column give way to it.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textmine.llm.common import checkpointed, slices
from textmine.llm.words import HashTable, Words, blank_table
from textmine.operators.verbs import global_row_number
from textmine.session import ship_package

CAPACITY = 4096
END = 1

# ---------------------------------------------------------------- tokens


class WordTokenizer:
    """Token ids of whole texts by a ``tokenizers`` file of lower-cased words
    with word ends, whose pre-tokenizer removes blanks and takes letters in
    runs, and whose tokens never join a letter to a following ASCII sign or
    digit.

    A text is cut at ASCII blanks and behind letters before an ASCII sign or
    digit; each distinct part goes through the library once and its ids are
    kept, up to ``most`` parts, then forgotten at once.  Parts of ASCII
    letters alone are words as they are: the library's model takes many of
    them in one call, and every word ends with the one token that has a word
    end.
    """

    def __init__(self, path: str, end: int = END, most: int = 400_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words = Tokenizer(Tokenizer.from_file(path).model)
        self.words.pre_tokenizer = WhitespaceSplit()
        self.closes = np.zeros(self.own.get_vocab_size(), bool)
        self.closes[[i for t, i in self.own.get_vocab().items() if t.endswith("</w>")]] = True
        self.end, self.most = end, most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # of parts in the table; those met since then are in ``fresh``
        self.table, self.fresh = HashTable(self.keys, np.zeros(0, np.int64), -1), {}
        self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def _room(self, name: str, need: int) -> np.ndarray:
        have = getattr(self, name)
        if len(have) < need:
            setattr(self, name, np.concatenate([have, np.zeros(max(need, 2 * len(have)) - len(have), have.dtype)]))
        return getattr(self, name)

    def _learn(self, keys: list[int], parts: list[str]) -> None:
        plain = [i for i, p in enumerate(parts) if p.isascii() and p.isalpha()]
        others = [i for i, p in enumerate(parts) if not (p.isascii() and p.isalpha())]
        made = [e.ids for e in self.own.encode_batch_fast([parts[i] for i in others], add_special_tokens=False)]
        joined = [" ".join([parts[i].lower() for i in plain[low:low + 100]]) for low in range(0, len(plain), 100)]
        ids = [i for e in self.words.encode_batch_fast(joined, add_special_tokens=False) for i in e.ids]
        stops = np.flatnonzero(self.closes[ids]) + 1 if ids else np.zeros(0, np.int64)
        if len(stops) != len(plain):
            raise ValueError("the tokenizer has no word ends")
        sizes = np.concatenate([np.diff(stops, prepend=0), np.fromiter(map(len, made), np.int64, len(made))])
        ids.extend(i for part in made for i in part)
        at, total = len(self.keys) + len(self.fresh), len(ids)
        self._room("size", at + len(keys))[at:at + len(keys)] = sizes
        self._room("first", at + len(keys))[at:at + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self._room("flat", self.used + total)[self.used:self.used + total] = ids
        self.used += total
        self.fresh.update(zip([keys[i] for i in plain + others], range(at, at + len(keys))))

    def _find(self, hashes: np.ndarray, words: Words, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = self.table.find(hashes)
        lost = np.flatnonzero(found < 0)
        keys, first, back = np.unique(hashes[lost], return_index=True, return_inverse=True)
        if len(self.keys) + len(self.fresh) + len(keys) > self.most and len(self.keys):
            self._forget()
            return self._find(hashes, words, starts, ends)
        known = keys.tolist()
        new = [i for i, k in enumerate(known) if k not in self.fresh]
        if new:
            at = lost[first[new]]
            self._learn([known[i] for i in new], [words.points[s:e].tobytes().decode("utf-32-le")
                                                  for s, e in zip(starts[at].tolist(), ends[at].tolist())])
        found[lost] = np.array([self.fresh[k] for k in known], np.int64)[back]
        if len(self.fresh) > max(4096, len(self.keys) // 3):
            self.keys = np.concatenate([self.keys, np.fromiter(self.fresh, np.uint64, len(self.fresh))])
            self.table, self.fresh = HashTable(self.keys, np.arange(len(self.keys)), -1), {}
        return found

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end token behind each text, and where each text ends."""
        words = Words(texts, blank_table())
        starts, ends = parts(words)
        part = self._find(words.span_hashes(starts, ends), words, starts, ends)
        size = self.size[part]
        text = np.searchsorted(words.cuts, starts, side="right")
        stops = np.cumsum(np.bincount(text, size, len(texts)).astype(np.int64) + 1)
        out = np.full(int(stops[-1]) if len(texts) else 0, self.end, np.uint32)
        if len(part):
            before = np.cumsum(size) - size
            nth = np.arange(int(size.sum()))
            out[np.repeat(text, size) + nth] = self.flat[np.repeat(self.first[part] - before, size) + nth]
        return out, stops


def parts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points cut further behind an ASCII letter before an
    ASCII sign or digit.  ``words.points`` is put in lower case where that
    cannot change how a letter joins a mark behind it."""
    points = words.points
    lower = points | 32
    letter = (lower >= 97) & (lower <= 122) & (points < 128)
    plain = np.append(points[1:] < 128, True)
    words.points = np.where(letter & plain, lower, points)
    cut = np.flatnonzero(letter[:-1] & ~letter[1:] & plain[:-1]) + 1
    cut = cut[blank_table()[points[cut]]]  # a blank ends the word already
    return (np.sort(np.concatenate([words.starts, cut]), kind="stable"),
            np.sort(np.concatenate([words.ends, cut]), kind="stable"))


_TOKENIZERS: dict[tuple, WordTokenizer] = {}


def pieces(df: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None,
           capacity: int = CAPACITY, end: int = END, ids: bool = True) -> DataFrame:
    """The pieces of every document: ``piece`` (from 0), ``start``,
    ``length``, ``ids_crc32`` of the little-endian 32-bit ids and, unless
    ``ids`` is False, the ``ids``.  ``path`` names a tokenizer file that all
    executors see.  A document is worked on in the task that holds its row.
    """
    ship_package(df.sparkSession)
    new = T._parse_datatype_string("piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids)
    names = {f.name for f in new.fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_value"))
    schema = T.StructType([*source.schema.fields[:-1], *new.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _TOKENIZERS.get((path, end))
        if tokenizer is None:
            tokenizer = _TOKENIZERS[path, end] = WordTokenizer(path, end)
        for batch in batches:
            for part in slices(batch, len(kept)):
                flat, stops = tokenizer.encode(part.column(len(kept)).to_pylist())
                yield _cut(part, flat.astype("<u4", copy=False), stops, len(kept), capacity, ids, arrow)

    return source.mapInArrow(run, schema)


def _cut(part: pa.RecordBatch, flat: np.ndarray, stops: np.ndarray, width: int, capacity: int, ids: bool,
         arrow: pa.Schema) -> pa.RecordBatch:
    begins = np.concatenate([[0], stops[:-1]])
    n = -(-(stops - begins) // capacity)
    row = np.repeat(np.arange(len(stops)), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = number * capacity
    low = begins[row] + start
    high = np.minimum(low + capacity, stops[row])
    bytes_ = memoryview(flat).cast("B")
    sums = [zlib.crc32(bytes_[4 * a:4 * b]) for a, b in zip(low.tolist(), high.tolist())]
    made = [pa.array(number), pa.array(start), pa.array(high - low), pa.array(sums, pa.int64())]
    if ids:
        made.append(pa.ListArray.from_arrays(pa.array(np.append(low, high[-1]), pa.int32()), pa.array(flat.view("<i4"))))
    return pa.RecordBatch.from_arrays(
        [a.cast(f.type) for a, f in zip([*part.take(pa.array(row)).columns[:width], *made], arrow, strict=True)],
        schema=arrow)


# ---------------------------------------------------------------- plan


class Sums:
    """Lengths still available and the number of pairs of different lengths
    behind each sum, kept up to date while lengths run out."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.there = self.left > 0
        self.pairs = np.zeros(2 * len(counts), np.int64)
        known = np.zeros(len(counts), bool)
        for length in np.flatnonzero(self.there):
            self.pairs[length:length + len(counts)] += known
            known[length] = True

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            self.there[length] = False
            self.pairs[length:length + len(self.there)] -= self.there

    def give_back(self, length: int, n: int) -> None:
        if not self.left[length]:
            self.pairs[length:length + len(self.there)] += self.there
            self.there[length] = True
        self.left[length] += n

    def pair(self, total: int) -> tuple[int, ...]:
        """Two available lengths of this sum, the longer one longest."""
        if total < 2 or total >= len(self.pairs):
            return ()
        half = total // 2
        if self.pairs[total]:
            high = np.arange(min(total, len(self.there)) - 1, half, -1)
            hit = np.flatnonzero(self.there[high] & (total - high > 0) & self.there[total - high])
            if len(hit):
                return int(high[hit[0]]), total - int(high[hit[0]])
        return (half, half) if total == 2 * half and self.left[half] > 1 else ()

    def exact(self, gap: int) -> tuple[int, ...]:
        """One, two or three available lengths whose sum is ``gap``."""
        if self.there[gap]:
            return (gap,)
        two = self.pair(gap)
        if two:
            return two
        firsts = np.flatnonzero(self.there[:gap - 1])[::-1]
        rest = gap - firsts
        halves = np.where(rest % 2 == 0, self.left[rest // 2] > 1, False)
        for first in firsts[(self.pairs[rest] > 0) | halves].tolist():
            if 3 * first < gap:  # the longest of three holds a third at least
                break
            self.take(first, 1)
            two = self.pair(gap - first)
            self.give_back(first, 1)
            if two:
                return (first, *two)
        return ()

    def best_fit(self, gap: int) -> int:
        fits = np.flatnonzero(self.there[:gap + 1])
        return int(fits[-1]) if len(fits) else 0


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Runs that pack ``counts[l]`` pieces of each length l (1 to
    ``capacity``): a row (length, pieces of this length placed before, pieces
    of it to a sequence, sequences, first sequence, offset)."""
    sums = Sums(np.asarray(counts[:capacity + 1]))
    placed = np.zeros(capacity + 1, np.int64)
    runs: list[tuple[int, ...]] = []
    sequence, longest = 0, capacity
    while True:
        while longest and not sums.left[longest]:
            longest -= 1
        if not longest:
            return np.array(sorted(runs), np.int64).reshape(-1, 6)
        pattern = {longest: 1}
        sums.take(longest, 1)
        gap = capacity - longest
        while gap:
            closing = sums.exact(gap)
            if closing:
                for length in closing:
                    sums.take(length, 1)
                    pattern[length] = pattern.get(length, 0) + 1
                gap = 0
                break
            length = sums.best_fit(gap)
            if not length:
                break
            # three of the longest that fits cannot fill the gap: go on until they can
            n = int(min(sums.left[length], max(1, gap // length - 3)))
            sums.take(length, n)
            pattern[length] = pattern.get(length, 0) + n
            gap -= n * length
        more = min(int(sums.left[length]) // n for length, n in pattern.items())
        if more:
            for length, n in pattern.items():
                sums.take(length, n * more)
        offset = 0
        for length, n in pattern.items():
            runs.append((length, int(placed[length]), n, more + 1, sequence, offset))
            placed[length] += n * (more + 1)
            offset += n * length
        sequence += more + 1


# ---------------------------------------------------------------- placing


def place(df: DataFrame, length: str = "length", order: Sequence[str] = ("doc_id", "piece"),
          capacity: int = CAPACITY, sequence: str = "sequence_id", offset: str = "offset") -> DataFrame:
    """``df`` with the sequence of every row and its place there; sequences
    are filled from 0 without gaps.  ``length`` must lie in 1..``capacity``.

    ``order`` names columns that decide which of several rows of one length
    comes first, so that reruns agree; rows equal in these follow the order
    in which they are stored.  Eager: ``df`` and its sorted form are
    checkpointed, the histogram of lengths (at most ``capacity`` rows) goes to
    the driver.
    """
    kept = [c for c in df.columns if c not in (sequence, offset)]
    fixed = checkpointed(df.select(*[F.col(f"`{c}`") for c in kept])
                         .withColumn("_row", F.monotonically_increasing_id()))
    counts = np.zeros(capacity + 1, np.int64)
    for r in fixed.groupBy(F.col(f"`{length}`").cast("long").alias("l")).count().collect():
        if r["l"] is None or not 0 < r["l"] <= capacity:
            raise ValueError(f"length {r['l']} is not in 1..{capacity}")
        counts[r["l"]] = r["count"]
    runs = plan(counts, capacity)
    numbered = global_row_number(fixed, [F.col(f"`{c}`") for c in (length, *order)] + [F.col("_row")], "_number")
    # rows stand in order of length: a run's pieces begin behind all shorter ones
    first = (np.cumsum(counts) - counts)[runs[:, 0]] + runs[:, 1]
    source = numbered.select(*[F.col(f"`{c}`") for c in kept], "_number")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(sequence, T.LongType()),
                           T.StructField(offset, T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(len(kept)).to_numpy(zero_copy_only=False) - 1
            at = np.searchsorted(first, number, side="right") - 1
            size, _, n, _, base, begin = runs[at].T
            nth = number - first[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(base + nth // n), pa.array(begin + nth % n * size)], schema=arrow)

    ship_package(df.sparkSession)
    return source.mapInArrow(run, schema)


def sequences(placed: DataFrame, ids: str = "ids", sequence: str = "sequence_id", offset: str = "offset") -> DataFrame:
    """The packed token ids of every sequence, its pieces in order; one row
    holds at most a sequence."""
    packed = placed.groupBy(sequence).agg(F.sort_array(F.collect_list(F.struct(offset, ids))).alias("_parts"))
    return packed.select(sequence, F.flatten(F.transform("_parts", lambda p: p[ids])).alias(ids))
