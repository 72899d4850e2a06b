"""Trie of the turns that conversations begin with, by screened prefixes.

A node is a distinct sequence of first turns; its members are the
conversations that begin so.

1. ``turns`` numbers each conversation's turns by a distributed range sort
   and keeps, of a turn, a digest and its length.
2. A prefix's digest is the sum of digests of (place, turn) over its turns,
   in four 32-bit parts: sums go over pieces of a conversation, so one of any
   length is not one task's work.  Texts are never shuffled.
3. ``screen``: each task counts its prefix digests in a count-min sketch of
   two rows and sends the touched cells as offsets within blocks; the merged
   sketch keeps one bit a cell, "counted at least twice", at most ``cells`` a
   row (2**28: 32 MB a row), and is broadcast.  A prefix one of whose cells
   was counted once belongs to one conversation alone: its node is emitted
   where its row is.  Only the others shuffle for exact grouping.
4. Exact grouping gives members and the least member (owner) of the possibly
   shared nodes.  An owner's nodes are a suffix of its path, so the sums over
   subtrees are sums over members: a member that is not the owner adds all of
   its own nodes' savings, the owner those from the node's depth on; each
   leaf belongs to one owner.

The sketch holds at most ``cells`` cells however large the input is: beyond
some 1e8 prefixes it proves fewer of them, and more are grouped exactly.

Defined results: rows with a null conversation take no part; null role or
text is an empty one; turns are ordered by turn (null first), then role, then
the digest of role and text; repeated rows are turns of their own; an empty
table has no nodes, also no root; further columns are not read.  Two
different prefixes whose 128 bits agree would be taken for one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmine.llm.common import checkpointed
from textmine.operators.verbs import global_row_number
from textmine.session import ship_package

PARTS = ("_a", "_b", "_c", "_d")
PIECE = 65536
BLOCK = 1 << 16
CELLS = 1 << 28


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """``conv, place`` (from 1), ``digest`` and ``length`` (code points) of
    every turn.  Eager: the sorted turns and the first of each conversation
    are checkpointed."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = df.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), said[0].alias("role"),
        F.unhex(F.md5(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said).cast("binary"))).alias("digest"),
        F.length(said[1]).cast("long").alias("length"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    numbered = global_row_number(rows, order, "_g")
    first = numbered.groupBy("conv").agg(F.min("_g").alias("_first"))
    return numbered.join(first, "conv").select("conv", (F.col("_g") - F.col("_first") + 1).alias("place"),
                                               "digest", "length")


def grafted(rows: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that share first turns: conversation c takes the first h
    turns of c - c % ``group`` (all if fewer, none if absent) in place of its
    own first h, h = crc32(c in decimals) % ``heads``.

    ``rows`` as from ``turns``; returns rows of the same kind, and all
    conversations with their ``n_turns`` (0 for one without turns).
    """
    rows = checkpointed(rows)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    convs = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = rows.filter((F.col("place") < heads) & (F.col("conv") % group == 0)).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "length"))).alias("begin"))
    convs = checkpointed(convs.join(bases, "base", "left").withColumn(
        "begin", F.when(F.col("begin").isNull() | (F.col("h") == 0),
                        F.array().cast("array<struct<place:bigint,digest:binary,length:bigint>>"))
        .otherwise(F.slice("begin", F.lit(1), F.greatest("h", F.lit(1)))))
        .withColumn("taken", F.size("begin")))
    begun = convs.select("conv", F.inline("begin"))
    own = rows.join(convs.select("conv", "h", "taken"), "conv").filter(F.col("place") > F.col("h")).select(
        "conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "length")
    return begun.unionByName(own), convs.select(
        "conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("n_turns"))


def _prefix_sums(df: DataFrame, by: str, order: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` replaced by their running sums within ``by`` in the order
    of the integer column ``order``, over pieces of ``PIECE`` rows at most;
    groups of one piece, the usual case, have no part in the join."""
    tagged = df.withColumn("_piece", F.floor(F.col(order) / PIECE).cast("long"))
    inner = Window.partitionBy(by, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumns({c: F.sum(c).over(inner) for c in columns})
    pieces = tagged.groupBy(by, "_piece").agg(*[F.sum(c).alias(c) for c in columns])
    before = Window.partitionBy(by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    earlier = pieces.select(by, "_piece", *[F.sum(c).over(before).alias(f"_e{c}") for c in columns]) \
        .filter(F.col(f"_e{columns[0]}").isNotNull())
    return local.join(earlier, [by, "_piece"], "left").withColumns(
        {c: F.col(c) + F.coalesce(F.col(f"_e{c}"), F.lit(0)) for c in columns}).select(*df.columns)


def _keyed(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Every (conversation, depth) with the key of its prefix, that of the
    prefix before, and whether the conversation ends there."""
    at = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.hex("digest")).cast("binary"), 256)
    parts = rows.withColumn("_at", at).withColumns(
        {c: F.conv(F.substring("_at", 1 + 8 * i, 8), 16, 10).cast("long") for i, c in enumerate(PARTS)}).drop("_at")
    own = {f"_o{c}": F.col(c) for c in PARTS}
    summed = _prefix_sums(parts.withColumns(own), "conv", "place", PARTS)
    key = lambda place, values: F.md5(F.concat_ws(":", place, *values).cast("binary"))
    return (summed.join(convs, "conv")
            .select("conv", F.col("place").alias("depth"), "length",
                    key(F.col("place"), [F.col(c) for c in PARTS]).alias("key"),
                    key(F.col("place") - 1, [F.col(c) - F.col(f"_o{c}") for c in PARTS]).alias("parent"),
                    (F.col("place") == F.col("n_turns")).alias("last"))
            .withColumn("x", F.xxhash64("key")).withColumn("px", F.xxhash64("parent")))


# ---------------------------------------------------------------- sketch


def _cells(x: np.ndarray, width: int) -> list[np.ndarray]:
    x = x.view(np.uint64)
    return [(x & np.uint64(width - 1)).astype(np.int64),
            ((x >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64)]


def screen(keyed: DataFrame, width: int, flush: int = 1 << 20) -> list[np.ndarray]:
    """The merged sketch of ``keyed.x``: for each of its two rows a bit a cell,
    set where the cell was counted at least twice (packed)."""

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def emit() -> pa.RecordBatch:
            out: list[list] = [[], [], []]
            for row, cells in enumerate(_cells(np.concatenate(held), width)):
                cell, count = np.unique(cells, return_counts=True)
                cell = np.repeat(cell, np.minimum(count, 2))
                block, first = np.unique(cell // BLOCK, return_index=True)
                for b, part in zip(block.tolist(), np.split((cell % BLOCK).astype("<u2"), first[1:])):
                    for column, value in zip(out, (row, b, part.tobytes())):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                               pa.array(out[2], pa.binary())], names=["row", "block", "cells"])

        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += batch.num_rows
            if n >= flush:
                yield emit()
                held, n = [], 0
        if n:
            yield emit()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts = None, np.zeros(BLOCK, np.uint8)

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()),
                                               pa.array([np.packbits(counts > 1).tobytes()])],
                                              names=["row", "block", "bits"])

        for batch in batches:
            for row, block, cells in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (row, block):
                    if key is not None:
                        yield emit()
                    key = (row, block)
                    counts[:] = 0
                more = np.bincount(np.frombuffer(cells, "<u2"), minlength=BLOCK)
                np.minimum(counts + np.minimum(more, 2), 2, out=counts, casting="unsafe")
        if key is not None:
            yield emit()

    ship_package(keyed.sparkSession)
    found = keyed.select("x").mapInArrow(touched, "row int, block long, cells binary")
    blocks = (found.repartition("row", "block").sortWithinPartitions("row", "block")
              .mapInArrow(merge, "row int, block long, bits binary"))
    out = [np.zeros(width // 8, np.uint8) for _ in range(2)]
    for r in blocks.toLocalIterator():
        out[r["row"]][r["block"] * BLOCK // 8:(r["block"] + 1) * BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _screened(keyed: DataFrame, bits, width: int) -> DataFrame:
    """``proved``: the prefix is one conversation's; ``under``: so is the one
    before it."""

    def alone(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for cells, row in zip(_cells(x, width), bits.value):
            out |= (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 0
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            proved = alone(batch.column("x").to_numpy())
            under = alone(batch.column("px").to_numpy()) & (depth > 1)
            rest = batch.drop_columns(["x", "px"])
            yield rest.append_column("proved", pa.array(proved)).append_column("under", pa.array(under))

    return keyed.select("conv", "depth", "length", "key", "parent", "last", "x", "px").mapInArrow(
        run, "conv long, depth long, length long, key string, parent string, last boolean, proved boolean, under boolean")


# ---------------------------------------------------------------- ends


def _ends(rows: DataFrame, chunk: int = 4096) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ``conv`` of each ``key``.  A
    range sort spreads a key's conversations over tasks, which join them into
    chunks; the chunks of a key are then hashed in order as they stream."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, convs = batch.column("key").to_pylist(), batch.column("conv").to_pylist()
            out: list[list] = [[], [], []]
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and end - at < chunk and keys[end] == keys[at]:
                    end += 1
                for column, value in zip(out, (keys[at], convs[at], ",".join(map(str, convs[at:end])))):
                    column.append(value)
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1], pa.int64()), pa.array(out[2])],
                                             names=["key", "first", "chunk"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out: list[tuple[str, str]] = []
            for k, part in zip(batch.column("key").to_pylist(), batch.column("chunk").to_pylist()):
                if k == key:
                    digest.update(b"," + part.encode())
                    continue
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(part.encode())
            yield _pairs(out)
        if key is not None:
            yield _pairs([(key, digest.hexdigest())])

    ordered = rows.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    chunks = ordered.mapInArrow(join, "key string, first long, chunk string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key string, ends string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)],
                                      names=["key", "ends"])


# ---------------------------------------------------------------- trie


def trie(rows: DataFrame, convs: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.

    ``rows``: ``conv, place, digest, length``; ``convs``: ``conv, n_turns``.
    Eager: prefixes, possibly shared prefixes and their nodes are
    checkpointed; the sketch passes the driver.
    """
    spark = rows.sparkSession
    convs = checkpointed(convs)
    keyed = checkpointed(_keyed(rows, convs))
    width = max(BLOCK, min(cells, 1 << (8 * keyed.count()).bit_length()))
    flagged = _screened(keyed, spark.sparkContext.broadcast(screen(keyed, width)), width)
    root = F.md5(F.concat_ws(":", *[F.lit(0)] * 5).cast("binary"))
    roots = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("length"),
                         root.alias("key"), F.lit(None).cast("string").alias("parent"),
                         (F.col("n_turns") == 0).alias("last"), F.lit(False).alias("under"))
    shared = checkpointed(flagged.filter(~F.col("proved")).drop("proved").unionByName(roots))
    alone = flagged.filter("proved")

    grouped = checkpointed(shared.groupBy("key").agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.min("length").alias("length"), F.max("under").alias("under")))
    kids = (grouped.filter(~F.col("under")).select("parent")
            .unionByName(alone.filter(~F.col("under")).select("parent")).filter("parent IS NOT NULL")
            .groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = checkpointed(grouped.join(kids, "key", "left").fillna(0, ["n_children"]))

    # what an owner's own nodes save, at each depth and in all
    saving = nodes.filter("n_convs > 1").select("key", "owner", "depth",
                                                ((F.col("n_convs") - 1) * F.col("length")).alias("own"))
    upto = _prefix_sums(saving.withColumn("upto", F.col("own")), "owner", "depth", ["upto"]) \
        .select("key", (F.col("upto") - F.col("own")).alias("above"))
    whole = saving.groupBy(F.col("owner").alias("conv")).agg(F.sum("own").alias("saves"))
    leaves = (nodes.filter("n_children = 0").select(F.col("owner").alias("conv"))
              .unionByName(alone.filter("last").select("conv")))
    adds = (whole.withColumn("leaf", F.lit(0)).unionByName(
        leaves.withColumn("leaf", F.lit(1)).withColumn("saves", F.lit(0).cast("long")))
        .groupBy("conv").agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("leaf")))
    below = (shared.select("conv", "key").join(adds, "conv").groupBy("key")
             .agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("n_leaves")))
    ends = _ends(shared.filter("last").select("key", "conv"))
    full = nodes.join(below, "key", "left").join(upto, "key", "left").join(ends, "key", "left")

    none = F.sha2(F.lit("").cast("binary"), 256)
    least = nodes.filter("depth = 0").select("owner").scalar()
    found = full.select(
        F.col("owner").alias("conv_id"), "depth", "parent", "under", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"),
        F.when(F.col("n_convs") > 1, F.col("saves") - F.col("above")).otherwise(0).cast("long").alias("saved_tokens"),
        F.coalesce("ends", none).alias("ends_sha256"))
    one = F.lit(1).cast("long")
    single = alone.select(
        F.col("conv").alias("conv_id"), "depth", "parent", "under", one.alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(none)
        .alias("ends_sha256"))
    every = found.unionByName(single)
    # a parent of one conversation alone is that conversation's, that of a first turn is the root; others are looked up
    asked = F.when(F.col("under") | (F.col("depth") < 2), None).otherwise(F.col("parent"))
    parents = nodes.filter((F.col("depth") > 0) & (F.col("n_children") > 0)).select(
        F.col("key").alias("_asked"), F.col("owner").alias("_parent"))
    return (every.withColumn("_asked", asked).join(parents, "_asked", "left")
            .select("conv_id", "depth",
                    F.when(F.col("depth") == 0, None).when(F.col("depth") == 1, least)
                    .when(F.col("under"), F.col("conv_id")).otherwise(F.col("_parent")).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
