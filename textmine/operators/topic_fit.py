"""Fitting topic models on tables: nothing of the vocabulary's or the
collection's size passes the driver.

The corpus is packed into blocks of documents, one row a block: its distinct
documents and terms and, as positions in these, its cells (document, term,
count).  The cells are kept as packed numbers, without names, one block a
partition, on the disks where they lie and never move again; names meet them
again when the fit is over.  Terms are dealt to shards by hash and numbered
there once.  In a round a task works
on a block with numpy and sends, packed by shard, its sums of the terms that
other blocks have too; a shard adds them up and sends every block the totals of
its terms.  Terms of a single block stay with it.  All that is sent, a block's
own state among it, is one table of messages, so a round is two shuffles; a
few rounds of a small corpus are one job.  The messages after a job are stored
under the checkpoint folder and those before it deleted, and its shuffles
are removed, so disk does not grow with the rounds.  The driver sees k totals
and one figure of merit a round.
A task goes through a block some ten thousand cells at a time, so what it
holds is a few numbers a cell.

* ``fit_variational``: batch variational EM with point estimates of the
  topics and a symmetric, optionally estimated, document prior.
* ``fit_em``: EM with the mode of the topics and of the documents' weights
  (the updates of MLlib's ``em`` optimizer).
* ``fit_gibbs``: collapsed Gibbs sampling; a block samples its tokens against
  the counts of the whole corpus at the start of the sweep and its own
  changes, and the counts are merged after every sweep.

All start from hashes of names and a seed, so reruns agree however the rows
are laid out: sampled counts exactly, variational weights up to the order in
which sums are rounded.  Cells with a null document or term or a count below 1 take no
part; rows that repeat a (document, term) are added up.  A document is worked
on in one block, so its distinct terms must fit a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine.session import drop_table, fixed_plans, scratch_table, ship_package, short_lived_shuffles
from textmine.sources.corpus import materialize

#: Cells of one block (one row of the packed corpus), (block, term) pairs of one shard, and cells worked on at a time.
BLOCK_CELLS, SHARD_PAIRS, STEP_CELLS = 1_250_000, 250_000, 16_000

_PACKED = ("block int, docs array<string>, doc_of array<int>, terms array<string>, term_of array<int>,"
           " counts array<int>")
#: The same with the cells as packed numbers, documents as their numbers of cells.
_STORED = "block int, docs array<string>, terms array<string>, sizes binary, term_of binary, counts binary"
#: A message: ``shard`` tells what it holds, the sums of one shard's terms or one of the below.
_MESSAGE = ("to int, sender int, shard int, doc_state array<double>, marks binary, at binary, sums binary,"
            " figures array<double>")
_OWN, _TOTALS, _FIRST = -1, -2, -3
#: Rounds of one job, whose shuffles stay until it ends, where the blocks are at most so many a core: of those that
#: send counts.  Weights take twice the room, and a round of these is a job.
ROUNDS_A_JOB, FEW_BLOCKS = 4, 8


@dataclass
class TopicModel:
    """``topic_terms`` holds ``term, c0..c{k-1}`` (weights, not yet shares),
    ``state`` a row per block with its documents' topic weights."""

    topic_terms: DataFrame
    state: DataFrame
    k: int
    merits: list[float]
    smooth_term: float = 0.0
    smooth_doc: float = 0.0

    def beta(self) -> DataFrame:
        """``(topic, term, beta)``, topics from 1; beta sums to 1 a topic."""
        totals = self.topic_terms.agg(F.count(F.lit(1)), *[F.sum(c) for c in columns(self.k)]).first()
        share = [F.struct(F.lit(j + 1).cast("long").alias("topic"), "term", (
            (F.col(c) + self.smooth_term) / F.lit((totals[j + 1] or 0.0) + self.smooth_term * totals[0] or 1.0))
            .alias("beta")) for j, c in enumerate(columns(self.k))]
        return self.topic_terms.select(F.inline(F.array(*share))).select("topic", "term", "beta")

    def gamma(self, document: str = "document") -> DataFrame:
        """``(document, topic, gamma)``; gamma sums to 1 a document."""
        k, smooth = self.k, self.smooth_doc
        each = self.state.select("docs", "doc_state").select(
            F.posexplode("docs").alias("_at", document), "doc_state")
        weights = each.select(document, F.transform(F.slice("doc_state", F.col("_at") * k + 1, k),
                                                    lambda x: x + smooth).alias("_w"))
        total = F.aggregate("_w", F.lit(0.0), lambda a, x: a + x)
        return (weights.select(document, total.alias("_t"), F.posexplode("_w").alias("topic", "_x"))
                .select(document, (F.col("topic") + 1).cast("long").alias("topic"),
                        (F.col("_x") / F.col("_t")).alias("gamma")))


def columns(k: int) -> list[str]:
    return [f"c{j}" for j in range(k)]


# ---------------------------------------------------------------- blocks

def packed_blocks(triplets: DataFrame, document: str = "document", term: str = "term", value: str = "count",
                  cells: int = BLOCK_CELLS) -> DataFrame:
    """One row per block of documents.  Eager: the cells are counted and the
    blocks stored."""
    d, t, n = (F.col(c) for c in (document, term, value))
    table = triplets.filter(d.isNotNull() & t.isNotNull() & (n >= 1)).select(
        d.cast("string").alias("d"), t.cast("string").alias("t"), n.cast("long").alias("n"))
    parallel = triplets.sparkSession.sparkContext.defaultParallelism
    rows = table.count()
    blocks = max(math.ceil(rows / cells), min(parallel, math.ceil(rows / 2000)), 1)

    def pack(table: pa.Table) -> pa.Table:
        (docs, doc_of), (terms, term_of) = _sorted_codes(table["d"]), _sorted_codes(table["t"])
        cell = doc_of.astype(np.int64) * len(terms) + term_of
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        counts = np.add.reduceat(table["n"].to_numpy()[order], starts)
        doc_of, term_of = np.divmod(cell[starts], len(terms))
        made = [table["block"].slice(0, 1), _list(docs), _list(terms), pa.array([_ints(np.bincount(doc_of))]),
                pa.array([_ints(term_of)]), pa.array([_ints(counts)])]
        return pa.table(made, names=[x.split()[0] for x in _STORED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # of one block, unless they are very many
        if held:
            table = pa.Table.from_batches(held)
            numbers = pc.unique(table["block"]).to_pylist()
            for number in numbers:
                mine = table if len(numbers) == 1 else table.filter(pc.equal(table["block"], number))
                yield from pack(mine).to_batches()

    ship_package(triplets.sparkSession)
    dealt = keyed(table.withColumn("block", F.pmod(F.xxhash64("d"), F.lit(blocks)).cast("int")), blocks)
    return materialize(dealt.repartition(blocks, "key").drop("key").mapInArrow(run, _STORED))


def packed(triplets: DataFrame, document: str = "document", term: str = "term", value: str = "count",
           cells: int = BLOCK_CELLS) -> DataFrame:
    """One row per block of documents, with the positions of its cells as
    arrays.  Eager as ``packed_blocks``."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                sizes = _numbers(one["sizes"][0], len(one["docs"][0]))
                held = [_numbers(one[c][0], int(sizes.sum())) for c in ("term_of", "counts")]
                doc_of, term_of, counts = (_list(pa.array(x, pa.int32())) for x in (np.repeat(np.arange(len(sizes)), sizes), *held))
                yield pa.RecordBatch.from_arrays([one["block"], one["docs"], doc_of, one["terms"], term_of, counts],
                                                 names=["block", "docs", "doc_of", "terms", "term_of", "counts"])

    return packed_blocks(triplets, document, term, value, cells).mapInArrow(spell, _PACKED)


def _sorted_codes(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and each row's place among them."""
    coded = column.combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int32)
    place[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(order), place[coded.indices.to_numpy()]


def _ints(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs."""
    top = int(values.max()) if len(values) else 0
    return values.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _numbers(cell: pa.Scalar, n: int) -> np.ndarray:
    """``n`` numbers of ``_ints``."""
    held = cell.as_py() or b""
    return np.frombuffer(held, f"<u{len(held) // n if held else 1}").astype(np.int64)


def partition_keys(parts: int) -> list[int]:
    """``parts`` numbers that Spark's hash deals to ``parts`` partitions, one
    to each in turn (its Murmur3 of an int)."""
    rotl = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    some = np.arange(max(64, 32 * parts), dtype=np.uint32)
    h = rotl(some * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593) ^ np.uint32(42)
    h = (rotl(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    at = (h ^ (h >> np.uint32(16))).view(np.int32) % parts
    found, first = np.unique(at, return_index=True)
    keys = some[first].tolist()
    if len(found) == parts:
        return keys
    held = dict(zip(found.tolist(), keys))
    return [held.get(i, len(some) + i) for i in range(parts)]  # as good as any other


#: Blocks that get a partition each; more are dealt by hash.
OWN_PARTITIONS = 8192


def keyed(blocks: DataFrame, parts: int) -> DataFrame:
    """The blocks with ``key``, by which they are dealt to partitions."""
    keys = partition_keys(parts) if parts <= OWN_PARTITIONS else None
    key = F.get(F.lit(keys), F.col("block")) if keys else F.col("block")
    return blocks.withColumn("key", key.cast("int"))


def shard_number(spark: SparkSession, pairs: int) -> int:
    """Shards for so many (block, term) pairs."""
    return max(math.ceil(pairs / SHARD_PAIRS), min(spark.sparkContext.defaultParallelism, math.ceil(pairs / 2000)), 1)


def linked(blocks: DataFrame) -> DataFrame:
    """A row per block for the rounds: its cells as packed numbers, and
    ``links``, one entry per shard: the positions of those of its terms that
    other blocks have too (``pos``), their numbers in the shard (``at``) and
    whether the block is the first to have them (``mine``).  Kept on
    disk, one block a partition."""
    spark = blocks.sparkSession
    ids, pairs = blocks.agg(F.max("block"), F.sum(F.size("terms"))).first()
    shards = shard_number(spark, pairs or 0)
    parts = (ids or 0) + 1

    def number(table: pa.Table) -> pa.Table:
        terms = table["term"].combine_chunks()
        codes = pc.index_in(terms, terms.unique()).to_numpy(zero_copy_only=False)
        shared = np.bincount(codes) > 1  # a block names a term once
        at = np.where(shared, np.cumsum(shared) - 1, -1)[codes]
        block, pos = table["block"].to_numpy(), table["pos"].to_numpy()
        kept = np.flatnonzero(at >= 0)
        kept = kept[np.lexsort((at[kept], block[kept]))]
        names, starts = np.unique(block[kept], return_index=True)
        cuts = [*starts[1:].tolist(), len(kept)] if len(names) else []
        mine = np.zeros(len(kept), np.uint8)
        mine[np.unique(at[kept], return_index=True)[1]] = 1
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(starts.tolist(), cuts)], pa.binary())
        held = np.add.reduceat(mine, starts, dtype=np.int32) if len(names) else np.zeros(0, np.int32)
        return pa.table({"block": pa.array(names, pa.int32()),
                         "shard": pa.array(np.full(len(names), table["shard"][0].as_py()), pa.int32()), "held": held,
                         "pos": cut(pos[kept].astype("<i4")), "at": cut(at[kept].astype("<i4")), "mine": cut(mine)})

    ship_package(spark)
    named = blocks.select("block", F.posexplode("terms").alias("pos", "term")).withColumn(
        "shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    links = named.groupBy("shard").applyInArrow(number, "block int, shard int, held int, pos binary, at binary, mine binary")
    by_block = keyed(links, parts).repartition(parts, "key").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("shard", "held", "pos", "at", "mine"))).alias("links"))
    compact = keyed(blocks.select("block", F.size("docs").alias("docs"), F.size("terms").alias("terms"), "sizes",
                                  "term_of", "counts"), parts).repartition(parts, "key")
    whole = compact.join(by_block.hint("shuffle_hash"), "key", "left")
    return whole.persist(StorageLevel.DISK_ONLY)


def distinct_terms(links: DataFrame) -> int:
    """The number of distinct terms of ``linked`` blocks: those that a block
    is the first to have."""
    none = F.lit(0).cast("long")
    first = F.aggregate("links", none, lambda a, x: a + x["held"] - F.octet_length(x["mine"]))
    return links.agg(F.sum(F.col("terms") + F.coalesce(first, none))).first()[0] or 0


def _list(values: pa.Array) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Block:
    """One packed row as arrays, with the topic-term rows of its terms and the
    ``totals`` by topic, from the messages to it."""

    def __init__(self, row: pa.Table, k: int, messages: pa.Table | None = None):
        get = lambda name: row[name][0]
        self.k, self.key = k, get("key").as_py()
        self.number, self.docs, self.terms = (get(c).as_py() for c in ("block", "docs", "terms"))
        self.sizes = _numbers(get("sizes"), self.docs)
        cells = int(self.sizes.sum())
        self.starts = np.cumsum(self.sizes) - self.sizes  # cells are in order of document
        self.term_of, self.counts = _numbers(get("term_of"), cells), _numbers(get("counts"), cells)
        links = get("links").as_py() or []
        self.links = {x["shard"]: tuple(np.frombuffer(x[c], kind) for c, kind in
                                        (("pos", "<i4"), ("at", "<i4"), ("mine", bool))) for x in links}
        alone, first = np.ones(self.terms, bool), np.ones(self.terms, bool)
        for pos, _, mine in self.links.values():
            alone[pos], first[pos] = False, mine
        self.alone, self.mine = np.flatnonzero(alone), np.flatnonzero(first)  # mine: first to have the term
        self.weights, self.doc_state = np.zeros((self.terms, k)), np.zeros((0, k))
        self.marks, self.past = np.zeros(0, np.uint8), np.zeros(0)  # past: the figures of all rounds so far
        if messages is None:
            return
        for i, shard in enumerate(messages["shard"].to_pylist()):
            sums = messages["sums"][i]
            if shard >= 0:
                self.weights[self.links[shard][0]] = _matrix(sums, len(self.links[shard][0]), k)
            elif shard == _OWN:
                self.weights[self.alone] = _matrix(sums, len(self.alone), k)
                self.doc_state = messages["doc_state"][i].values.to_numpy().reshape(-1, k)
                self.marks = _numbers(messages["marks"][i], int(self.counts.sum()))
            elif shard == _FIRST:
                self.weights[:] = messages["figures"][i].values.to_numpy().reshape(-1, k)
            else:
                self.past = messages["figures"][i].values.to_numpy()
        self.totals = self.past[-k:]

    def steps(self) -> Iterator[tuple[slice, slice]]:
        """The documents and cells worked on at a time: whole documents, as
        many as have ``STEP_CELLS`` cells, or one."""
        ends = np.cumsum(self.sizes)
        low = 0
        while low < self.docs:
            first = int(self.starts[low])
            upto = max(low + 1, int(np.searchsorted(ends, first + STEP_CELLS, "right")))
            yield slice(low, upto), slice(first, int(ends[upto - 1]))
            low = upto

    def by_term(self, values: np.ndarray) -> np.ndarray:
        """``values`` (a row per topic, a column per cell) added up by term."""
        return np.stack([np.bincount(self.term_of, row, self.terms) for row in values], axis=1)

    def sent(self, doc_state: np.ndarray, marks: np.ndarray, sums: np.ndarray, merit: float,
             logs: float = 0.0) -> pa.Table:
        """What the block sends after a round: its sums to the shards, its
        state to itself, and its figures: the merit, the documents' expected
        log weights and the totals by topic."""
        rows = [{"to": shard, "sender": self.key, "shard": shard, "at": at.tobytes(), "sums": _packed_matrix(sums[pos])}
                for shard, (pos, at, _) in self.links.items()]
        rows.append({"to": self.number, "sender": self.key, "shard": _OWN, "doc_state": doc_state.ravel().astype(float),
                     "marks": _ints(marks), "sums": _packed_matrix(sums[self.alone])})
        rows.append({"to": 0, "sender": self.key, "shard": _TOTALS,
                     "figures": [*self.past.tolist(), float(merit), float(logs), *sums.sum(0).tolist()]})
        return _messages(rows)


def _messages(rows: list[dict]) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    fields = [x.split() for x in _MESSAGE.split(", ")] if rows else []
    return pa.table({name: pa.array([x.get(name) for x in rows], kinds[kind]) for name, kind in fields}) if rows else \
        pa.table({x.split()[0]: pa.array([], kinds[x.split()[1]]) for x in _MESSAGE.split(", ")})


def _packed_matrix(values: np.ndarray) -> bytes:
    """Counts as 4 bytes a number, anything else as 8."""
    whole = values.dtype.kind == "i" and (not values.size or values.max() < 1 << 31)
    return values.astype("<i4" if whole else "<f8").tobytes()


def _matrix(cell: pa.Scalar, n: int, k: int) -> np.ndarray:
    """``n`` rows of ``_packed_matrix``."""
    held = cell.as_py() or b""
    return np.frombuffer(held, "<f8" if len(held) == 8 * n * k else "<i4").reshape(n, k)


def _added(messages: DataFrame, k: int, shards: int, parts: int) -> DataFrame:
    """The messages that the shards send back: to every block the sums over
    all blocks of its shared terms and the figures of the rounds so far (the
    last by topic); a block's own state goes through.  ``to`` is a shard in
    what comes and a block's key in what goes."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_shard: dict[int, list] = {}
        figures = []
        for batch in batches:
            kinds = batch.column("shard").to_numpy()
            own = np.flatnonzero(kinds == _OWN)
            if len(own):
                kept = batch.take(pa.array(own))
                yield kept.set_column(0, "to", kept.column("sender"))
            senders = batch.column("sender").to_numpy()
            for i in np.flatnonzero(kinds == _TOTALS).tolist():
                figures.append((int(senders[i]), batch.column("figures")[i].values.to_numpy()))
            for i in np.flatnonzero(kinds >= 0).tolist():
                at = np.frombuffer(batch.column("at")[i].as_py(), "<i4")
                of_shard.setdefault(int(kinds[i]), []).append((int(senders[i]), at, _matrix(batch.column("sums")[i], len(at), k)))
        for shard in list(of_shard):
            sent = sorted(of_shard.pop(shard), key=lambda x: x[0])  # sums are rounded alike however the rows come
            total = np.zeros((1 + max(int(at.max()) for _, at, _ in sent), k), np.result_type(*{x.dtype for _, _, x in sent}))
            total = total.astype(np.int64) if total.dtype.kind == "i" else total
            for _, at, sums in sent:
                total[at] += sums
            back = [{"to": to, "sender": -1, "shard": shard, "sums": _packed_matrix(total[at])} for to, at, _ in sent]
            yield from _messages(back).to_batches()
        if figures:
            figures.sort(key=lambda x: x[0])
            summed = figures[0][1].copy()
            summed[-k - 2:] = np.sum([x[-k - 2:] for _, x in figures], axis=0)
            back = [{"to": to, "sender": -1, "shard": _TOTALS, "figures": summed} for to, _ in figures]
            yield from _messages(back).to_batches()

    keys = partition_keys(shards) if shards <= OWN_PARTITIONS else None
    dealt = F.pmod(F.col("to"), F.lit(shards))
    dealt = F.get(F.lit(keys), dealt).cast("int") if keys else dealt
    back = messages.withColumn("to", dealt).repartition(shards, "to").mapInArrow(add, _MESSAGE)
    return back.repartition(parts, "to")


def _first_weights(blocks: DataFrame, first: F.Column | DataFrame) -> DataFrame:
    """``block, first``: the weights before the first round of all terms of a
    block, from an expression of a block or a table ``term, c0..c{k-1}``."""
    if not isinstance(first, DataFrame):
        return blocks.select("block", F.flatten(first).alias("first"))
    spark, k = blocks.sparkSession, len(first.columns) - 1
    pairs = blocks.agg(F.sum(F.size("terms"))).first()[0] or 0
    shards = shard_number(spark, pairs)
    of_shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard")

    def meet(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "at": pa.array([], pa.binary()),
                             "w": pa.array([], pa.binary())})
        at = pc.fill_null(pc.index_in(asked["term"].combine_chunks(), known["term"].combine_chunks()), known.num_rows)
        rows = np.stack([np.append(known[c].to_numpy(), 0.0) for c in columns(k)], axis=1)
        block, pos = asked["block"].to_numpy(), asked["at"].to_numpy()
        order = np.argsort(block, kind="stable")
        names, starts = np.unique(block[order], return_index=True)
        taken = np.split(order, starts[1:])
        at = at.to_numpy(zero_copy_only=False)
        return pa.table({"block": pa.array(names, pa.int32()),
                         "at": pa.array([pos[x].astype("<i4").tobytes() for x in taken], pa.binary()),
                         "w": pa.array([rows[at[x]].tobytes() for x in taken], pa.binary())})

    def place(table: pa.Table) -> pa.Table:
        weights = np.zeros((sum(len(a.as_py()) for a in table["at"]) // 4, k))
        for a, w in zip(table["at"], table["w"]):
            at = np.frombuffer(a.as_py(), "<i4")
            weights[at] = _matrix(w, len(at), k)
        return pa.table({"block": table["block"].slice(0, 1), "first": _list(pa.array(weights.ravel()))})

    asked = blocks.select("block", F.posexplode("terms").alias("at", "term")).select("block", "at", "term", of_shard)
    known = first.select("term", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns(k)], of_shard)
    found = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(meet, "block int, at binary, w binary")
    return found.groupBy("block").applyInArrow(place, "block int, first array<double>")


class _Rounds:
    """Rounds over kept blocks; the messages after a job are stored and those
    before it deleted.  ``first`` (``block, first``) holds the weights of all
    terms of a block before the first round; without it they are none."""

    def __init__(self, packed_: DataFrame, blocks: DataFrame, k: int, first: DataFrame | None = None):
        self.packed, self.blocks, self.k, self.path = packed_, blocks, k, None
        self.spark = spark = blocks.sparkSession
        ids, pairs = packed_.agg(F.max("block"), F.sum(F.size("terms"))).first()
        self.parts = (ids or 0) + 1
        self.shards = shard_number(spark, pairs or 0)
        few = self.parts <= FEW_BLOCKS * spark.sparkContext.defaultParallelism
        self.few = few
        self.messages = spark.createDataFrame([], _MESSAGE)
        if first is not None:
            none = {c: F.lit(None).cast(kind) for c, kind in (x.split() for x in _MESSAGE.split(", "))}
            none |= {"to": F.col("key"), "shard": F.lit(_FIRST), "figures": F.col("first")}
            self.messages = keyed(first, self.parts).select(*[e.alias(c) for c, e in none.items()])
        self.messages = self.messages.repartition(self.parts, "to")

    def run(self, *works: Callable[[Block], pa.Table]) -> list[tuple[float, float, list[float]]]:
        """A round for each of ``works``: on every block with the topic-term
        rows of its terms and the totals by topic as of then.  Returns for
        each the merit, log weights and totals by topic of all blocks."""
        k, messages, got = self.k, self.messages, len(works)

        def round_(work: Callable[[Block], pa.Table]) -> Callable:
            return lambda row, sent: work(Block(row, k, sent)) if row.num_rows else _messages([])

        for work in works:
            done = self.blocks.groupBy("key").cogroup(messages.groupBy("to")).applyInArrow(round_(work), _MESSAGE)
            messages = _added(done, k, self.shards, self.parts)
        before, self.path = self.path, scratch_table(self.spark)
        messages.write.parquet(self.path)
        self.messages = self.spark.read.schema(_MESSAGE).parquet(self.path).repartition(self.parts, "to")
        if before:
            drop_table(self.spark, before)
        stored = self.spark.read.schema(_MESSAGE).parquet(self.path)
        last = stored.filter(F.col("shard") == _TOTALS).select("figures").first()
        if last is None:
            return [(0.0, 0.0, [0.0] * k)] * got
        rounds = np.array(last[0]).reshape(-1, k + 2)[-got:].tolist()
        return [(x[0], x[1], x[2:]) for x in rounds]

    def merits(self, works: list[Callable[[Block], pa.Table]], at_once: int = 1) -> list[float]:
        """The merits of rounds of which none depends on the driver, as many
        ``at_once`` as a job's shuffles may hold where the blocks are few."""
        found, at_once = [], at_once if self.few else 1
        for low in range(0, len(works), at_once):
            found += [merit for merit, _, _ in self.run(*works[low:low + at_once])]
        return found

    def model(self, merits: list[float], **smooth: float) -> TopicModel:
        """The tables of the model; the last messages and the kept blocks go."""
        k, parts = self.k, self.parts

        def spell(row: pa.Table, sent: pa.Table) -> pa.Table:
            at, w = np.zeros(0), np.zeros(0)
            if row.num_rows:
                block = Block(row, k, sent)
                at, w = block.mine, block.weights[block.mine].ravel()
            return pa.table({"key": row["key"], "at": _list(pa.array(at, pa.int32())).slice(0, row.num_rows),
                             "w": _list(pa.array(w)).slice(0, row.num_rows)})

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    get = lambda c, r=r, batch=batch: batch.column(c).slice(r, 1).flatten()
                    weights = get("w").to_numpy().reshape(-1, k)
                    found = pa.RecordBatch.from_arrays([get("terms").take(get("at")), *map(pa.array, weights.T)],
                                                       names=["term", *columns(k)])
                    for low in range(0, found.num_rows, 1 << 14):
                        yield found.slice(low, 1 << 14)

        named = keyed(self.packed.select("block", "docs", "terms"), parts)
        made = self.blocks.groupBy("key").cogroup(self.messages.groupBy("to")).applyInArrow(
            spell, "key int, at array<int>, w array<double>")
        mine = named.select("key", "terms").repartition(parts, "key").join(made.repartition(parts, "key").hint("shuffle_hash"), "key")
        topics = materialize(mine.mapInArrow(name, ", ".join(["term string", *[f"{c} double" for c in columns(k)]])))
        own = self.messages.filter(F.col("shard") == _OWN).select(F.col("to").alias("key"), "doc_state")
        state = materialize(named.join(own.hint("shuffle_hash"), "key").select("block", "docs", "doc_state"))
        self.blocks.unpersist()
        if self.path:
            drop_table(self.spark, self.path)
        return TopicModel(topics, state, k, merits, **smooth)


def _uniform(*parts) -> F.Column:
    """A number in [0, 1) by a hash of ``parts``."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


# ---------------------------------------------------------------- variational EM

def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log gamma for x > 0: the recurrence up to 6 and more,
    then the asymptotic series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    for _ in range(6):
        out -= 1 / x
        x += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def variational_block(block: Block, totals: list[float], alpha: float, inner: int) -> pa.Table:
    """``inner`` updates of the documents' weights under fixed topics, then
    the expected counts by term; the merit is the bound of the likelihood."""
    k, beta, fit = block.k, block.weights / np.array(totals), 0.0
    gamma = block.doc_state.copy()
    if not len(gamma):  # before the first round
        gamma = np.full((block.docs, k), alpha + block.counts.sum() / max(block.docs, 1) / k)
    parts = np.empty((k, len(block.counts)))
    for docs, cells in block.steps():  # a row per topic: long loops
        cell = np.ascontiguousarray(beta.take(block.term_of[cells], axis=0).T)
        n, sizes, starts = block.counts[cells], block.sizes[docs], block.starts[docs] - cells.start
        mine = np.ascontiguousarray(gamma[docs].T)
        for _ in range(inner):
            expect = np.exp(digamma(mine) - digamma(mine.sum(0)))
            of_cell = np.repeat(expect, sizes, axis=1)
            share = cell * (n / np.einsum("ij,ij->j", cell, of_cell))
            mine = alpha + expect * np.add.reduceat(share, starts, axis=1)
        np.multiply(share, of_cell, out=parts[:, cells])
        gamma[docs] = mine.T
        expect = np.exp(digamma(mine) - digamma(mine.sum(0)))
        fit += float(n @ np.log(np.einsum("ij,ij->j", cell, np.repeat(expect, sizes, axis=1))))
    log = digamma(gamma) - digamma(gamma.sum(1, keepdims=True))
    prior = ((alpha - gamma) * log).sum() + float(np.sum(_lgamma(gamma))) - float(np.sum(_lgamma(gamma.sum(1))))
    prior += block.docs * (math.lgamma(k * alpha) - k * math.lgamma(alpha))
    return block.sent(gamma, block.marks, block.by_term(parts), fit + prior, float(log.sum()))


def best_alpha(alpha: float, k: int, docs: int, logs: float, steps: int = 50) -> float:
    """The symmetric prior that maximises the bound given ``logs``, the sum of
    expected log weights over documents and topics (Newton in the logarithm)."""
    for _ in range(steps):
        slope = docs * k * float(digamma(k * alpha) - digamma(alpha)) + logs
        h = 1e-5 * alpha
        upper = docs * k * float(digamma(k * (alpha + h)) - digamma(alpha + h)) + logs
        bend = (upper - slope) / h
        step = slope / (bend * alpha + slope) if bend * alpha + slope < 0 else -0.5 * math.copysign(1, slope)
        new = alpha * math.exp(max(-1.0, min(1.0, -step)))
        if abs(new - alpha) < 1e-7 * alpha:
            return new
        alpha = min(max(new, 1e-4), 1e4)
    return alpha


def start_topics(seed: int, k: int) -> F.Column:
    """A weight between 1 and 2 for every term of a block and topic, by hash."""
    return F.transform("terms", lambda t: F.array(*[1 + _uniform(F.lit(seed), F.lit(j), t) for j in range(k)]))


def fit_variational(triplets: DataFrame, k: int, seed: int = 1234, iterations: int = 100, inner: int = 5,
                    alpha: float | None = None, estimate_alpha: bool = True, tolerance: float = 1e-4,
                    start: DataFrame | None = None, document: str = "document", term: str = "term",
                    value: str = "count", cells: int = BLOCK_CELLS) -> TopicModel:
    """Variational EM: at most ``iterations`` rounds, fewer when the bound
    grows by less than ``tolerance`` of itself.

    ``start``: ``term, c0..c{k-1}`` to begin with (positive weights for every
    term; default by hash).  ``alpha`` defaults to 50 / k and is estimated
    again each round unless ``estimate_alpha`` is False.  Eager.
    """
    alpha = 50.0 / k if alpha is None else alpha
    merits: list[float] = []
    spark = triplets.sparkSession
    with short_lived_shuffles(spark):
        blocks = packed_blocks(triplets, document, term, value, cells)
        if start is None:
            first = start_topics(seed, k)
            weights = blocks.select(F.explode("terms").alias("term")).distinct().select(F.array("term").alias("terms")) \
                .select(first[0].alias("w")).select(*[F.col("w")[j].alias(c) for j, c in enumerate(columns(k))])
        else:
            first = weights = materialize(start.select("term", *columns(k)))
        docs = blocks.agg(F.sum(F.size("docs"))).first()[0] or 0
        totals = [x or 1.0 for x in weights.agg(*[F.sum(c) for c in columns(k)]).first()]
    with short_lived_shuffles(spark), fixed_plans(spark):
        rounds = _Rounds(blocks, linked(blocks), k, _first_weights(blocks, first))
        for _ in range(iterations if docs else 0):
            [(merit, logs, totals)] = rounds.run(
                lambda b, totals=totals, a=alpha: variational_block(b, totals, a, inner))
            if estimate_alpha:
                alpha = best_alpha(alpha, k, docs, logs)
            merits.append(merit)
            if len(merits) > 1 and abs(merits[-1] - merits[-2]) <= tolerance * abs(merits[-2]):
                break
        return rounds.model(merits)


# ---------------------------------------------------------------- EM

def em_block(block: Block, terms: int, alpha: float, eta: float, seed: int, first: bool) -> pa.Table:
    """Expected counts by document and term, each cell's topic shares being
    (N_wk + eta - 1) (N_dk + alpha - 1) / (N_k + V (eta - 1)); the first
    shares are random.  The merit is the log-likelihood of the tokens."""
    k, merit, rng = block.k, 0.0, np.random.default_rng([seed, block.number])
    own, parts = np.zeros((block.docs, k)), np.empty((k, len(block.counts)))
    if not first:
        words = (block.weights + (eta - 1)) / (block.totals + terms * (eta - 1))
        weights = np.ascontiguousarray((block.doc_state + (alpha - 1)).T)
    for docs, cells in block.steps():
        n = block.counts[cells]
        sizes, starts, part = block.sizes[docs], block.starts[docs] - cells.start, parts[:, cells]
        if first:
            part[:] = rng.random((len(n), k)).T
            part *= n / part.sum(0)
        else:
            part[:] = words.take(block.term_of[cells], axis=0).T
            part *= np.repeat(weights[:, docs], sizes, axis=1)
            whole = part.sum(0)
            merit += float(n @ np.log(whole / np.repeat(weights[:, docs].sum(0), sizes)))
            part *= n / whole
        own[docs] = np.add.reduceat(part, starts, axis=1).T
    return block.sent(own, block.marks, block.by_term(parts), merit)


def fit_em(triplets: DataFrame, k: int, seed: int = 1234, iterations: int = 100, alpha: float | None = None,
           eta: float = 1.1, document: str = "document", term: str = "term", value: str = "count",
           cells: int = BLOCK_CELLS) -> TopicModel:
    """EM, ``iterations`` rounds after random shares.  ``alpha`` defaults to
    50 / k + 1; both priors exceed 1 (MLlib's rules).  ``merits`` holds the
    log-likelihood at the start of each round.  Eager."""
    alpha = 50.0 / k + 1 if alpha is None else alpha
    if alpha <= 1 or eta <= 1:
        raise ValueError("alpha and eta must exceed 1")
    with _counting(triplets, k, document, term, value, cells) as (rounds, terms):
        steps = [lambda b: em_block(b, 0, alpha, eta, seed, True)]
        steps += [lambda b: em_block(b, terms, alpha, eta, seed, False)] * (iterations if terms else 0)
        merits = rounds.merits(steps)[1:]
        return rounds.model(merits, smooth_doc=alpha - 1)


@contextmanager
def _counting(triplets: DataFrame, k: int, *packing) -> Iterator[tuple[_Rounds, int]]:
    """Rounds that begin without counts, and the number of distinct terms."""
    spark = triplets.sparkSession
    with short_lived_shuffles(spark):
        blocks = packed_blocks(triplets, *packing)
        with fixed_plans(spark):
            links = linked(blocks)
            yield _Rounds(blocks, links, k), distinct_terms(links)


# ---------------------------------------------------------------- Gibbs sampling

def token_batches(doc: np.ndarray, least: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """An order of the tokens in which every document comes once before any
    comes again, and cuts of it into batches of whole turns of at least
    ``least`` tokens (the last one apart)."""
    sizes = np.bincount(doc, minlength=1)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # tokens are in order of document
    few = len(turn) and turn.max() < 1 << 16  # a stable sort of small numbers is one by digits
    order = np.argsort(turn.astype(np.uint16) if few else turn, kind="stable")
    ends = np.cumsum(np.bincount(turn, minlength=1))
    cuts, last = [], 0
    for end in ends.tolist():
        if end - last >= least:
            cuts.append(end)
            last = end
    return order, np.array([c for c in cuts if c < len(doc)], np.int64)


def gibbs_block(block: Block, terms: int, alpha: float, eta: float, seed: int, sweep: int) -> pa.Table:
    """One sweep over the block's tokens; sweep 0 makes the first draws.  A
    token is drawn given all other
    tokens of its document as they stand and the corpus counts as of the
    sweep's start with this block's changes; tokens of one batch are drawn
    together.  The merit is the log-likelihood of the tokens."""
    k = block.k
    doc, term = (np.repeat(x, block.counts) for x in (np.repeat(np.arange(block.docs), block.sizes), block.term_of))
    rng = np.random.default_rng([seed, sweep, block.number])
    order, cuts = token_batches(doc)
    doc, term = doc[order], term[order]
    merit = 0.0
    if not sweep:  # uniform
        topic = rng.integers(0, k, len(doc))[order]
    else:  # marks are in the order of the draws
        # counts of documents, of terms and of all, with their priors, as one array
        tables = [block.doc_state + alpha, block.weights + eta, (block.totals + terms * eta)[None]]
        counts = np.concatenate(tables)
        of_doc, of_term, whole = np.split(counts, np.cumsum([len(x) for x in tables])[:-1])
        counts, whole = counts.ravel(), whole[0]
        rows = np.empty((3, len(doc)), np.int64)
        np.multiply(doc, k, out=rows[0])
        np.add(np.multiply(term, k, out=rows[1]), block.docs * k, out=rows[1])
        rows[2] = (block.docs + block.terms) * k
        topic, draws, drawn = block.marks, rng.random(len(doc)), np.empty(len(doc))
        ends = [*cuts.tolist(), len(doc)]
        one, low = np.ones(3 * max(np.diff([0, *ends]))), 0
        for high in ends:
            some, n = slice(low, high), high - low
            low = high
            np.subtract.at(counts, (rows[:, some] + topic[some]).ravel(), one[:3 * n])
            part = of_term.take(term[some], axis=0)
            part *= of_doc.take(doc[some], axis=0)
            grown = np.ascontiguousarray(part.T)  # a row per topic: long loops
            grown /= whole[:, None]
            for j in range(1, k):
                grown[j] += grown[j - 1]
            drawn[some] = grown[-1]
            new = (grown[:-1] < draws[some] * grown[-1]).sum(0, dtype=np.int16 if k > 128 else np.int8)
            topic[some] = new
            np.add.at(counts, (rows[:, some] + topic[some]).ravel(), one[:3 * n])
        # a document's tokens in the batch take no part in its mass
        size = np.bincount(doc, minlength=block.docs)
        upto = np.cumsum(len(size) - np.cumsum(np.bincount(size)))  # tokens of the turns so far
        turns = np.searchsorted(upto, ends, "left") + 1
        widths, size = np.diff([0, *ends]), size[doc]
        held = np.minimum(size, np.repeat(turns, widths)) - np.repeat([0, *turns[:-1]], widths)
        merit = float(np.log(drawn / (size - held + k * alpha)).sum())
    own = np.bincount(doc * k + topic, minlength=block.docs * k)
    sums = np.bincount(term * k + topic, minlength=block.terms * k).reshape(-1, k)
    return block.sent(own, topic, sums, merit)


def fit_gibbs(triplets: DataFrame, k: int, seed: int = 1234, sweeps: int = 100, alpha_sum: float = 5.0,
              eta: float = 0.01, document: str = "document", term: str = "term", value: str = "count",
              cells: int = BLOCK_CELLS) -> TopicModel:
    """Collapsed Gibbs sampling, ``sweeps`` sweeps after the first draws.
    The topic-term table holds counts of tokens; ``merits`` the
    log-likelihood of each sweep.  Eager."""
    alpha = alpha_sum / k
    with _counting(triplets, k, document, term, value, cells) as (rounds, terms):
        steps = [lambda b, sweep=sweep: gibbs_block(b, terms, alpha, eta, seed, sweep)
                 for sweep in range(sweeps + 1 if terms else 1)]
        merits = rounds.merits(steps, ROUNDS_A_JOB)[1:]
        return rounds.model(merits, smooth_term=eta, smooth_doc=alpha)
