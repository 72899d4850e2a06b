"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression.  Every code point has a class
(letter, number, space, apostrophe, ...) and every class is a transition
function of a small automaton over whole texts.  Composition of those
functions is associative, so the state at every position comes from a
blocked prefix scan over numpy arrays; a piece boundary is then a table look
up on the states around a position.  Pieces are merged by rank through a
bounded cache, and the byte end of every token is kept for decoding.

Null and empty texts encode to no ids and decode to no bytes; ids that are
null or outside the vocabulary decode to nothing.  Repeated rows and ties
need no care: each row is encoded by itself.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmine.llm.common import add_columns
from textmine.llm.words import HashTable

# Classes of code points; the letters are those that contractions need.
SPACE, BLANK, NUMBER, OTHER, QUOTE, LETTER, ONE, HALF, ELL, E, CUT = range(11)
# States of the automaton after a code point: in a run of letters, numbers or
# others; after an apostrophe that starts a piece; after apostrophe + r/v or
# + l; after a whole contraction; after a space or another blank; at a cut.
(IN_L, IN_N, IN_O, AT_Q, AT_QH, AT_QL, DONE, AT_S, AT_B, AT_CUT) = range(10)
STATES = 10

# Code points that Unicode 16 added as letters (L) and numbers
# (N); unicodedata of older Python versions does not know them.
UNICODE_16 = [
    (0x1c89, 0x1c8a, "L"), (0xa7cb, 0xa7cd, "L"), (0xa7da, 0xa7dc, "L"), (0x105c0, 0x105f3, "L"),
    (0x10d40, 0x10d49, "N"), (0x10d4a, 0x10d65, "L"), (0x10d6f, 0x10d85, "L"), (0x10ec2, 0x10ec4, "L"),
    (0x11380, 0x11389, "L"), (0x1138b, 0x1138b, "L"), (0x1138e, 0x1138e, "L"), (0x11390, 0x113b5, "L"),
    (0x113b7, 0x113b7, "L"), (0x113d1, 0x113d1, "L"), (0x113d3, 0x113d3, "L"), (0x116d0, 0x116e3, "N"),
    (0x11bc0, 0x11be0, "L"), (0x11bf0, 0x11bf9, "N"), (0x13460, 0x143fa, "L"), (0x16100, 0x1611d, "L"),
    (0x16130, 0x16139, "N"), (0x16d40, 0x16d6c, "L"), (0x16d70, 0x16d79, "N"), (0x18cff, 0x18cff, "L"),
    (0x1ccf0, 0x1ccf9, "N"), (0x1e5d0, 0x1e5ed, "L"), (0x1e5f0, 0x1e5f0, "L"), (0x1e5f1, 0x1e5fa, "N"),
]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
        elif chr(c).isspace() and not 0x1c <= c <= 0x1f:
            out[c] = BLANK
    for a, b, kind in UNICODE_16:
        out[a:b + 1] = LETTER if kind == "L" else NUMBER
    out[ord(" ")], out[ord("'")], out[ord("e")], out[ord("l")] = SPACE, QUOTE, E, ELL
    out[[ord(c) for c in "stmd"]] = ONE
    out[[ord(c) for c in "rv"]] = HALF
    return out


def _step(state: int, kind: int) -> int:
    """The automaton: the state after reading a code point of class ``kind``."""
    if kind in (SPACE, BLANK, NUMBER, OTHER, CUT):
        return {SPACE: AT_S, BLANK: AT_B, NUMBER: IN_N, OTHER: IN_O, CUT: AT_CUT}[kind]
    if kind == QUOTE:
        return IN_O if state in (IN_O, AT_Q, AT_S) else AT_Q
    if state == AT_Q:
        return {ONE: DONE, HALF: AT_QH, ELL: AT_QL}.get(kind, IN_L)
    if (state, kind) in ((AT_QH, E), (AT_QL, ELL)):
        return DONE
    return IN_L


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``of``: class to function; ``after``: composition of two functions;
    ``apply``: function and state to state; ``edge``: 1 where a piece starts
    between two states, 2 where the next state decides."""
    found: dict[tuple, int] = {tuple(range(STATES)): 0}
    of = [found.setdefault(tuple(_step(s, k) for s in range(STATES)), len(found)) for k in range(CUT + 1)]
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in list(found):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in found:
                    found[h] = len(found)
                    todo.append(h)
    kinds = list(found)
    after = np.array([[found[tuple(g[x] for x in f)] for g in kinds] for f in kinds], np.uint8)
    edge = np.zeros((STATES, STATES), np.uint8)
    blanks = (AT_S, AT_B)
    for p in range(STATES):
        for s in range(STATES):
            if p in (AT_CUT, DONE):
                start = 1
            elif s in blanks:
                start = 2 if p in blanks else 1
            elif p in blanks:
                start = int(p == AT_B)
            elif s == IN_N:
                start = int(p != IN_N)
            elif s == IN_O:
                start = int(p not in (IN_O, AT_Q))
            elif s == AT_Q:
                start = 1
            elif s in (AT_QH, AT_QL):
                start = 2
            elif s == IN_L:
                start = int(p in (IN_N, IN_O, AT_Q))
            else:  # a contraction goes on
                start = 0
            edge[p, s] = start
    return np.array(of, np.uint8), after, np.array(kinds, np.uint8), edge


def scan(fns: np.ndarray, after: np.ndarray, block: int = 256) -> np.ndarray:
    """Prefix compositions of transition functions, in blocks: all blocks
    advance together, their totals are scanned the same way, and each block
    is then put behind the total of those before it."""
    n = len(fns)
    flat = after.ravel()
    wide = np.intp(after.shape[0])
    if n <= block:
        out, run = np.empty(n, np.uint8), 0
        for i, f in enumerate(fns.tolist()):
            run = int(after[run, f])
            out[i] = run
        return out
    blocks = -(-n // block)
    grid = np.zeros(blocks * block, np.uint8)  # 0 is the identity
    grid[:n] = fns
    grid = np.ascontiguousarray(grid.reshape(blocks, block).T)
    for j in range(1, block):
        grid[j] = flat[grid[j - 1] * wide + grid[j]]
    before = np.zeros(blocks, np.uint8)
    before[1:] = scan(grid[-1], after, block)[:-1]
    head = before * wide
    for j in range(block):
        grid[j] = flat[head + grid[j]]
    return grid.T.ravel()[:n]


def boundaries(text: str, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every piece of ``text``; ``cuts`` are the positions
    of separators, which belong to no piece (the last one ends the text)."""
    kinds = classes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    kinds[cuts] = CUT
    of, after, apply, edge = automaton()
    state = apply[scan(of[kinds], after), AT_CUT]
    before = np.empty_like(state)
    before[0], before[1:] = AT_CUT, state[:-1]
    start = edge[before, state]
    look = np.flatnonzero(start == 2)
    if len(look):
        following = state[look + 1]  # a cut comes last, so this exists
        blank = (state[look] == AT_S) | (state[look] == AT_B)
        goes_on = (following == AT_S) | (following == AT_B) | (following == AT_CUT)
        start[look] = np.where(blank, ~goes_on, following != DONE)
    start[cuts] = 1
    marks = np.flatnonzero(start)
    real = state[marks] != AT_CUT
    ends = np.append(marks[1:], len(text))
    return marks[real], ends[real]


NO_RANK = 1 << 30


def pair_table(ranks: dict[bytes, int]) -> HashTable:
    """Rank of the token that two adjacent tokens make, over all splits of
    the vocabulary's entries."""
    pairs = [(ranks[w[:i]] << 32 | ranks[w[i:]], r) for w, r in ranks.items()
             for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
    return HashTable(np.array([k for k, _ in pairs], np.uint64), np.array([r for _, r in pairs], np.int32), NO_RANK)


class Vocabulary:
    """Merge ranks, the bytes of every id, and a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int], cache_pieces: int = 200_000):
        self.ranks, self.cache_pieces = ranks, cache_pieces
        self.cache: dict[str, bytes] = {}
        size = max(ranks.values()) + 1 if ranks else 0
        words = [b""] * size
        for word, i in ranks.items():
            words[i] = word
        self.length = np.array([len(w) for w in words], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.pairs = pair_table(ranks)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the adjacent pair of lowest rank merges first,
        the leftmost of equals."""
        rank = self.ranks
        if piece in rank:
            return [rank[piece]]
        return self._merge_heap(piece)

    def merge_many(self, pieces: list[bytes], width: int = 32) -> list[bytes]:
        """Ids (as int32 bytes) of many pieces.  All pieces of similar length
        merge together, one pair of each at a time; only the two pairs beside
        a merge are looked up again."""
        out: list[bytes] = [b""] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        known = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int32, len(pieces))
        for i in np.flatnonzero(known >= 0).tolist():
            out[i] = known[i].tobytes()
        sizes[known >= 0] = 0
        for i in np.flatnonzero(sizes > width).tolist():
            out[i] = np.array(self.merge(pieces[i]), np.int32).tobytes()
        low = 0
        for high in (4, 6, 8, 10, 12, 16, 24, width):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if not len(rows):
                continue
            data = b"".join([pieces[i].ljust(high, b"\0") for i in rows.tolist()])
            ids = self.byte_ids[np.frombuffer(data, np.uint8).reshape(-1, high)]
            n = sizes[rows]
            rank = self._pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, high - 1)
            rank[np.arange(1, high) >= n[:, None]] = NO_RANK
            cols = np.arange(high)
            while len(rows):
                best = rank.argmin(axis=1)
                lowest = rank[np.arange(len(rows)), best]
                done = lowest == NO_RANK
                if done.any():
                    for i, row, k in zip(rows[done].tolist(), ids[done], n[done].tolist()):
                        out[i] = row[:k].tobytes()
                    go = ~done
                    rows, ids, rank, n, best, lowest = rows[go], ids[go], rank[go], n[go], best[go], lowest[go]
                    if not len(rows):
                        break
                each = np.arange(len(rows))
                behind = cols >= best[:, None] + 1
                shifted = np.minimum(cols + behind, high - 1)
                ids = np.take_along_axis(ids, shifted, 1)
                ids[each, best] = lowest
                n = n - 1
                padded = np.concatenate([rank, np.full((len(rank), 1), NO_RANK, rank.dtype)], axis=1)
                rank = np.take_along_axis(padded, np.minimum(cols + (cols >= best[:, None]), high - 1), 1)[:, :-1]
                rank[:, -1] = NO_RANK
                right = np.flatnonzero(best + 1 < n)
                at = best[right]
                rank[right, at] = self._pair_ranks(ids[right, at], ids[right, at + 1])
                none = np.flatnonzero((best + 1 >= n) & (best < high - 1))
                rank[none, best[none]] = NO_RANK
                left = np.flatnonzero(best > 0)
                at = best[left] - 1
                rank[left, at] = self._pair_ranks(ids[left, at], ids[left, at + 1])
        return out

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.pairs.find((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))

    def _merge_heap(self, piece: bytes) -> list[int]:
        """Merges through a heap, for pieces of any length."""
        rank, n = self.ranks, len(piece)
        ends, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or ends[i] >= n or ends[ends[i]] != end:
                continue  # one of the two parts has changed since
            alive[ends[i]] = False
            ends[i] = end
            if end < n:
                prev[end] = i
                if (r := rank.get(piece[i:ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (p := prev[i]) >= 0 and (r := rank.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        return [rank[piece[i:ends[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and, for each text, where they end."""
        texts = [t or "" for t in texts]
        whole = "\n".join(texts) + "\n"
        cuts = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts, ends = boundaries(whole, cuts)
        pieces = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        cache, got = self.cache, list(map(self.cache.get, pieces))
        if None in got:
            if len(cache) > self.cache_pieces:
                cache.clear()
            new = list(dict.fromkeys([p for p, ids in zip(pieces, got) if ids is None]))
            made = dict(zip(new, self.merge_many([p.encode() for p in new])))
            got = [made[p] if ids is None else ids for p, ids in zip(pieces, got)]
            cache.update((p, ids) for p, ids in made.items() if len(p) <= 64)
        counts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, got), np.int64, len(got)) // 4)])
        return np.frombuffer(b"".join(got), np.int32), counts[np.searchsorted(starts, cuts)]

    def decode(self, ids: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """The bytes of valid ids in a row."""
        lengths = self.length[ids] if lengths is None else lengths
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.zeros(0, np.uint8)
        return self.bytes[np.repeat(self.offset[ids] - ends + lengths, lengths) + np.arange(ends[-1])]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


#: One vocabulary (and its cache) per worker process and set of ranks.
_LOADED: dict[str, Vocabulary] = {}


class Ranks:
    """Merge ranks read on the driver (a file of fixed size) and sent to the
    tasks by broadcast; workers build the look-up tables once."""

    def __init__(self, spark, path: str):
        self.name, self.sent = path, spark.sparkContext.broadcast(read_ranks(path))

    def vocabulary(self) -> Vocabulary:
        if self.name not in _LOADED:
            _LOADED[self.name] = Vocabulary(self.sent.value)
        return _LOADED[self.name]


def encode(df: DataFrame, ranks: Ranks, text: str = "text", keep: list[str] | None = None,
           ids: str = "ids", ends: str = "ends") -> DataFrame:
    """Append the token ids of ``text`` (array of int) and the byte offset at
    which each token ends (array of int, the offsets kept for decoding)."""

    def make(texts: pa.Array) -> list[pa.Array]:
        vocabulary = ranks.vocabulary()
        out, stops = vocabulary.encode(texts.to_pylist())
        offsets = np.concatenate([[0], stops]).astype(np.int32)
        upto = np.concatenate([[0], np.cumsum(vocabulary.length[out])])
        base = np.repeat(upto[offsets[:-1]], np.diff(offsets))
        return [pa.ListArray.from_arrays(offsets, pa.array(values)) for values in
                (out, (upto[1:] - base).astype(np.int32))]

    return add_columns(df, text, f"`{ids}` array<int>, `{ends}` array<int>", make, keep, limit=1_000_000)


def decode(df: DataFrame, ranks: Ranks, ids: str = "ids", keep: list[str] | None = None,
           out: str = "decoded") -> DataFrame:
    """Append the bytes that the token ids stand for (binary).  A null array
    decodes to no bytes."""

    def make(rows: pa.Array) -> list[pa.Array]:
        vocabulary = ranks.vocabulary()
        offsets = rows.offsets.to_numpy().astype(np.int64)
        flat = rows.values.slice(offsets[0], offsets[-1] - offsets[0])
        flat = np.nan_to_num(flat.to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
        good = (flat >= 0) & (flat < len(vocabulary.length))
        lengths = np.where(good, vocabulary.length[np.where(good, flat, 0)], 0)
        upto = np.concatenate([[0], np.cumsum(lengths)])[offsets - offsets[0]]
        data = vocabulary.decode(flat[good], lengths[good])
        return [pa.Array.from_buffers(pa.large_binary(), len(rows),
                                      [None, pa.py_buffer(upto.tobytes()), pa.py_buffer(data.tobytes())])]

    return add_columns(df, ids, f"`{out}` binary", make, keep, limit=1_000_000)
