"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct word shingles.  Documents with equal sets
form a class; one document stands for it.  In each of several independent
trees a document follows one or two branches from every node; a branch is a
minwise token (a coordinate of its signature, picked by the node) and its
value, so similar documents take the same branches.  Nodes that are small are
compared exhaustively by signature; larger ones branch again, until they are
small.  What passes forms clusters, and inside a cluster links are confirmed
on the full sets, read again from the whole texts.

Large groups cost no pairs: equal sets and equal signatures are merged first,
nodes and clusters give spanning links, and clusters beyond a bound of set
elements are compared in blocks (see ``cluster_links``).

Texts that are null or without words have an empty set and are linked with
nothing, as are rows with a null key (their ``component_id`` is null).  Rows
that repeat a key are one vertex, linked with all that any of them links to.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import add_columns, checkpointed
from textmine.llm.graph import components
from textmine.llm.words import Words, ascii_lower, blank_table, mix

COORDINATES = 64
TREES = 10
#: Highest chance to miss a pair at the threshold 0.8 that has no other path:
#: documents that branch too often for ``TREES`` trees get further ones.
MISS = 0.05
#: A second branch is taken with this chance, so that a pair at the threshold
#: 0.8 keeps 1 branch in the mean (1.25 branches, each shared with chance 0.8).
SECOND = 0.25
#: Largest node compared exhaustively, and most levels of branching.
NODE, LEVELS = 4096, 40
#: Coordinates that must agree to pass: 3.6 standard deviations under 0.8.
AGREE = 40
#: Documents of a large node that all its rows are held against, and the
#: coordinates that must agree to put a row into a pivot's cluster.
PIVOTS, STAR = 8, 32
#: Set elements of one block of a cluster, and the least a document counts.
BLOCK, LEAST = 1_500_000, 400
#: Cluster members up to which their keys are broadcast to fetch texts.
FETCH_ROWS = 200_000
#: Rows of one key beyond which an exact join spreads them over tasks, and the
#: number of such keys up to which they are broadcast (a sorted join beyond).
HOT_ROWS, HOT_KEYS = 2_000, 200_000

_RNG = np.random.default_rng(20)
_KEYS = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(texts, blank_table(), ascii_lower())
    h = w.hashes()
    out = []
    for a, b in zip(w.at[:-1].tolist(), w.at[1:].tolist()):
        x = h[a:b]
        if not len(x):
            out.append(np.zeros(0, np.uint64))
            continue
        run = min(words, len(x))  # fewer words: the whole sequence
        made = np.full(len(x) - run + 1, run, np.uint64)
        for i in range(run):
            made = mix(made * np.uint64(31) + x[i:len(x) - run + 1 + i])
        out.append(np.unique(made))
    return out


def signature(elements: np.ndarray) -> np.ndarray:
    """Minwise values of a set in every coordinate."""
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(elements), 4096):
        part = elements[at:at + 4096]
        np.minimum(out, ((part * _KEYS[:, None]) >> np.uint64(32)).astype(np.uint32).min(axis=1), out=out)
    return out


def features(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``doc, n, fp1, fp2, sig``: key, set size, a 128-bit fingerprint of the
    set, and its signature (bytes)."""
    def make(column: pa.Array) -> list[pa.Array]:
        sets = shingle_sets(column.to_pylist(), words)
        one = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
        two = np.array([np.add.reduce(mix(s + np.uint64(99))) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two),
                pa.array([signature(s).tobytes() for s in sets], pa.binary())]

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    return add_columns(rows, "text", "n long, fp1 long, fp2 long, sig binary", make, ["doc"])


def _children(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Branches from each row's node: the row and the child node."""
    pick = mix(node)
    rows, child = [], []
    for branch in range(2):
        take = np.arange(len(node)) if branch == 0 else np.flatnonzero(
            (pick >> np.uint64(40)).astype(np.float64) < SECOND * (1 << 24))
        first = pick[take] % np.uint64(COORDINATES)
        step = np.uint64(1) + (pick[take] >> np.uint64(20)) % np.uint64(COORDINATES - 1)
        at = ((first + np.uint64(branch) * step) % np.uint64(COORDINATES)).astype(np.int64)
        rows.append(take)
        child.append(mix(node[take] ^ mix(sig[take, at].astype(np.uint64) * np.uint64(COORDINATES)
                                          + at.astype(np.uint64))))
    return np.concatenate(rows), np.concatenate(child)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def parted(levels: int, alike: float = 0.8) -> float:
    """The chance that two sets of similarity ``alike`` share no node of one
    tree after ``levels`` branchings (coordinates taken as independent)."""
    chance = 0.0
    for _ in range(levels):
        one = 1 - alike + alike * chance
        chance = one * (1 - SECOND + SECOND * one)
    return chance


def trees_for(levels: int, miss: float = MISS) -> int:
    """Trees that miss such a pair with a chance of at most ``miss``."""
    return math.ceil(math.log(miss) / math.log(parted(max(1, levels))))


def _branch(rows: DataFrame, first: int, trees: int) -> DataFrame:
    """``node, doc``: the first nodes of every document (``doc, sig``) below
    the roots of ``trees`` trees, from number ``first`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, doc = _signatures(batch.column("sig")), batch.column("doc").to_numpy()
            node = np.repeat(mix(np.arange(first, first + trees, dtype=np.uint64)), len(doc))
            row, child = _children(node, np.tile(sig, (trees, 1)))
            doc = np.tile(doc, trees)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(doc[row])],
                                             names=["node", "doc"])

    return rows.mapInArrow(run, "node long, doc long")


def spanning(n: int, first: int, near: Callable[[int], np.ndarray]) -> np.ndarray:
    """Spanning links (pairs of positions) of ``n`` rows, where ``near(x)``
    gives the rows linked with ``x``; with ``first`` < n only links that
    touch one of the first rows count.

    Rows of the largest part are expanded while that pays; then every row
    outside it is expanded, so no link between two parts is missed, while the
    rows of one large part are not all compared with each other."""
    label, done, links = np.arange(n), np.zeros(n, bool), []

    def expand(x: int) -> bool:
        done[x] = True
        found = near(x)
        parts, at = np.unique(label[found], return_index=True)
        new = parts != label[x]
        if not new.any():
            return False
        links.extend((x, int(y)) for y in found[at[new]])
        merged = np.append(parts, label[x])
        label[np.isin(label, merged)] = merged.min()
        return True

    idle, anchor = 0, -1
    while first == n and idle < 4:
        inside = label == np.bincount(label).argmax()
        open_ = np.flatnonzero(inside & ~done)
        anchor = int(np.flatnonzero(inside)[0])
        if not len(open_):
            break
        idle = 0 if expand(int(open_[len(open_) // 2])) else idle + 1
    for x in range(first):
        if not done[x] and (anchor < 0 or label[x] != label[anchor]):
            expand(x)
    return np.array(links, np.int64).reshape(-1, 2)


def _passing(sig: np.ndarray) -> np.ndarray:
    """Spanning links of the rows of one node that agree enough."""
    by_coordinate = np.ascontiguousarray(sig.T)
    return spanning(len(sig), len(sig), lambda x: np.flatnonzero(
        (by_coordinate == by_coordinate[:, x:x + 1]).sum(axis=0, dtype=np.uint8) >= AGREE))


def _node_links(members: DataFrame) -> DataFrame:
    """``a, b``: spanning links of what passes inside each node.  Rows come
    hashed and sorted by node; nodes of up to 16 rows are compared together,
    larger ones (at most ``NODE`` rows) each by itself."""
    def compare(node: np.ndarray, doc: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        size = np.diff(np.append(edge, len(node)))
        own = np.repeat(size, size)
        left, right = [], []
        for step in range(1, 16):
            i = np.flatnonzero((node[:-step] == node[step:]) & (own[:-step] <= 16)) if len(node) > step else []
            if len(i):
                i = i[(sig[i] == sig[i + step]).sum(axis=1) >= AGREE]
                left.append(doc[i])
                right.append(doc[i + step])
        for at, n in zip(edge[size > 16].tolist(), size[size > 16].tolist()):
            pairs = at + _passing(sig[at:at + n])
            left.append(doc[pairs[:, 0]])
            right.append(doc[pairs[:, 1]])
        a = np.concatenate(left) if left else np.zeros(0, np.int64)
        b = np.concatenate(right) if right else np.zeros(0, np.int64)
        links = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
        sig = np.zeros((0, COORDINATES), np.uint32)
        for batch in batches:
            if not batch.num_rows:
                continue
            node = np.concatenate([node, batch.column("node").to_numpy()])
            doc = np.concatenate([doc, batch.column("doc").to_numpy()])
            sig = np.concatenate([sig, _signatures(batch.column("sig"))])
            whole = int(np.searchsorted(node, node[-1], side="left"))  # the last node may go on
            if whole:
                yield compare(node[:whole], doc[:whole], sig[:whole])
                node, doc, sig = node[whole:], doc[whole:], sig[whole:]
        if len(node):
            yield compare(node, doc, sig)

    return members.repartition("node").sortWithinPartitions("node").mapInArrow(run, "a long, b long")


def _pivot_groups(pivots: np.ndarray) -> np.ndarray:
    """The connected part of each pivot among the pivots of its node."""
    near = (pivots[:, None, :] == pivots[None, :, :]).sum(axis=2) >= STAR
    part = np.arange(len(pivots))
    for _ in range(len(pivots)):
        part = np.where(near, part[None, :], len(pivots)).min(axis=1)
    return part


def _open_up(large: DataFrame) -> DataFrame:
    """For the rows (``node, doc, sig``) of large nodes: ``node, doc, pivot,
    part, children``.  A row is held against a few documents of its node;
    ``pivot`` is the first that agrees in ``STAR`` coordinates (null: none),
    ``part`` the pivots' connected part that it belongs to (-1: none), and
    ``children`` are its branches."""
    slot = F.pmod(F.xxhash64("doc", "node"), F.lit(PIVOTS))
    few = large.groupBy("node", slot.alias("slot")).agg(F.min(F.struct("doc", "sig")).alias("one"))
    rows = large.join(few.groupBy("node").agg(F.collect_list("one").alias("pivots")), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, doc = batch.column("node").to_numpy(), batch.column("doc").to_numpy()
            sig, lists = _signatures(batch.column("sig")), batch.column("pivots")
            pivot, part = np.zeros(len(doc), np.int64), np.full(len(doc), -1, np.int64)
            edge = np.append(np.flatnonzero(np.append(True, node[1:] != node[:-1])), len(node))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                ids = lists[a].values.field("doc").to_numpy()
                theirs = _signatures(lists[a].values.field("sig"))
                group = _pivot_groups(theirs)
                near = np.stack([(sig[a:b] == t).sum(axis=1) >= STAR for t in theirs], axis=1)
                # a pivot names one of its own part, so that parts hang together
                lowest = np.where(near, group, len(ids)).min(axis=1)
                pivot[a:b] = ids[np.minimum(lowest, len(ids) - 1)]
                part[a:b] = np.where(lowest < len(ids), lowest, -1)
            row, child = _children(node.view(np.uint64), sig)
            order = np.argsort(row, kind="stable")
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(doc)))]).astype(np.int32)
            children = pa.ListArray.from_arrays(offsets, pa.array(child[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(doc), pa.array(pivot, mask=part < 0), pa.array(part), children],
                names=["node", "doc", "pivot", "part", "children"])

    return rows.sortWithinPartitions("node").mapInArrow(
        run, "node long, doc long, pivot long, part long, children array<long>")


def candidate_links(reps: DataFrame, trees: int = TREES, node_rows: int = NODE, levels: int = LEVELS) -> DataFrame:
    """``a, b``: spanning links of documents whose signatures agree, found in
    nodes of the trees.  ``reps`` has ``doc, sig``, one row per signature.

    The more often documents branch, the likelier two similar ones part in
    every tree.  So those that branch more often than ``trees`` trees allow
    for (``trees_for``) go through as many trees as their depth asks for."""
    found, deep, depth = _grow(reps, 1, trees, trees, node_rows, levels)
    while deep is not None and (wanted := trees_for(depth)) > trees:
        more, _, reached = _grow(reps.join(deep, "doc", "left_semi"), trees + 1, wanted - trees, trees, node_rows,
                                 levels)
        found, trees, depth = found.union(more), wanted, max(depth, reached)
    return found


def _grow(reps: DataFrame, first: int, trees: int, enough: int, node_rows: int,
          levels: int) -> tuple[DataFrame, DataFrame | None, int]:
    """The links found in ``trees`` trees from number ``first`` on, the
    documents that branch more often than ``enough`` trees allow for (none:
    null), and the number of branchings of the deepest.

    A node of up to ``node_rows`` rows is compared exhaustively.  The rows of
    a larger one are first held against its pivots; a node whose rows all
    belong to one part is done, any other branches again."""
    spark = reps.sparkSession
    keys, found, deep = _branch(reps, first, trees), spark.createDataFrame([], "a long, b long"), None
    for level in range(levels):
        if deep is None and trees_for(level + 1) > enough:
            deep = checkpointed(keys.select("doc").distinct())
        sizes = keys.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
        shared = checkpointed(keys.join(sizes, "node").join(reps, "doc").select("node", "doc", "rows", "sig"))
        largest = shared.agg(F.max("rows")).first()[0] or 0
        small = shared.filter(F.col("rows") <= node_rows).select("node", "doc", "sig")
        found = found.union(checkpointed(_node_links(small)))
        if largest <= node_rows:
            return found, deep, level + 1
        large = shared.filter(F.col("rows") > node_rows)
        if level == levels - 1:
            # what so many branchings left together: blocks of a bounded size
            parts = F.ceil(F.col("rows") / node_rows)
            dealt = large.withColumn("node", F.xxhash64("node", F.pmod(F.xxhash64("doc"), parts)))
            star = large.groupBy("node").agg(F.min("doc").alias("b"))
            star = large.join(star, "node").filter("doc <> b").select(F.col("doc").alias("a"), "b")
            return found.union(checkpointed(_node_links(dealt.select("node", "doc", "sig")).union(star))), deep, levels
        opened = checkpointed(_open_up(large.select("node", "doc", "sig")))
        found = found.union(opened.filter("pivot is not null and pivot <> doc").select(
            F.col("doc").alias("a"), F.col("pivot").alias("b")))
        mixed = opened.groupBy("node").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter(
            "lo < hi or lo < 0").select("node")
        keys = opened.join(mixed, "node", "left_semi").select(F.explode("children").alias("node"), "doc")
    return found, deep, levels


def _exact(sets: list[np.ndarray], similarity: int) -> np.ndarray:
    """Spanning links at ``100 * intersection >= similarity * union``."""
    size = np.array([len(s) for s in sets])
    offsets = np.concatenate([[0], np.cumsum(size)])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    flag = np.zeros(ids.max() + 1, bool)

    def near(x: int) -> np.ndarray:
        mine = ids[offsets[x]:offsets[x + 1]]
        flag[mine] = True
        common = np.add.reduceat(flag[ids], offsets[:-1], dtype=np.int64)
        flag[mine] = False
        return np.flatnonzero(100 * common >= similarity * (size + size[x] - common))

    return spanning(len(sets), len(sets), near)


def _counted(hot: DataFrame) -> DataFrame:
    """The materialised hot keys, broadcast where they are few."""
    return F.broadcast(hot) if hot.count() <= HOT_KEYS else hot.hint("merge")


def _join_uneven(left: DataFrame, right: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Inner join on ``key``, of which ``right`` repeats none.  Keys with more
    than ``HOT_ROWS`` rows of ``left`` are dealt by a hash of ``by`` to parts
    of about that size, and their row of ``right`` goes to each part."""
    hot = _counted(checkpointed(left.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).filter(
        F.col("_rows") > HOT_ROWS).select(*key, F.ceil(F.col("_rows") / HOT_ROWS).cast("int").alias("_parts"))))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*by, F.lit(8)), parts).cast("int"))
    every = right.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.drop("_parts").join(every.drop("_parts"), [*key, "_part"]).drop("_part")


def _full_sets(rows: DataFrame, words: int) -> DataFrame:
    """``cluster, cid, n, items``: the whole set of each class, from the texts
    of ``rows`` (``cluster, cid, n, fp1, text``)."""
    def make(column: pa.Array) -> list[pa.Array]:
        sets = shingle_sets(column.to_pylist(), words)
        prints = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
        return [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(prints)]

    # a repeated key may have brought other texts, or one text twice
    made = add_columns(rows, "text", "items array<long>, print long", make, ["cluster", "cid", "n", "fp1"])
    return made.filter("print = fp1").select("cluster", "cid", "n", "items").dropDuplicates(["cid"])


def _prefixes(sets: DataFrame, similarity: int) -> DataFrame:
    """``cluster, cid, n, prefix``: of each set the shingles, rarest in the
    cluster first, of which one is the first common shingle with any set that
    it links with (array of ``at, item``: the place and the shingle)."""
    each = sets.select("cluster", "cid", "n", F.explode("items").alias("item"))
    counts = checkpointed(each.groupBy("cluster", "item").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    shared = _join_uneven(each, counts, ["cluster", "item"], ["cid"])
    ranked = shared.groupBy("cluster", "cid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("x"))
    # shingles of one set only come first; they join with nothing
    alone = F.col("n") - F.size("x")
    placed = F.transform("x", lambda e, i: F.struct((alone + i).alias("at"), e["item"].alias("item")))
    long_enough = lambda e: 100 * (F.col("n") - e["at"]) >= similarity * F.col("n")
    return ranked.select("cluster", "cid", "n", F.filter(placed, long_enough).alias("prefix"))


def _pairs(ranked: DataFrame, similarity: int, pivots: bool) -> DataFrame:
    """``a, b``: pairs of sets in different parts that can be linked, by an
    equal-key join on prefix shingle and bucket of sizes; with ``pivots`` only
    those with one set of every key, which is linear in the rows.

    A link of sizes m <= n has at least s (m + n) / (100 + s) common shingles,
    all at or behind its first common one; so the place of a shingle bounds
    the sizes of the partners, and a shingle that all sets hold is met late
    and joins nothing unless the sets are that similar."""
    s = similarity
    bucket = lambda size: F.floor(F.log(size.cast("double")) / math.log(1.06)).cast("int")
    key = ["cluster", "item", "bucket"]
    each = ranked.select("cluster", "cid", "n", "part", F.inline("prefix")).withColumn("left", F.col("n") - F.col("at"))
    small = each.filter((100 + s) * F.col("left") >= 2 * s * F.col("n")).withColumn("bucket", bucket(F.col("n")))
    most = F.least("n", F.expr(f"left * {100 + s} div {s}") - F.col("n"))
    large = each.withColumn("lo", F.expr(f"({s} * n + 99) div 100")).withColumn("hi", most).filter("lo <= hi")
    large = large.withColumn("bucket", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))))
    small = small.select(*key, *[F.col(c).alias(f"{c}_s") for c in ("cid", "n", "part", "left")])
    large = large.select(*key, "cid", "n", "part", "left")
    if pivots:
        one = F.min(F.struct(F.xxhash64("cid_s", F.lit(6)), "cid_s", "n_s", "part_s", "left_s")).alias("one")
        small = small.groupBy(*key).agg(one).select(*key, "one.cid_s", "one.n_s", "one.part_s", "one.left_s")
        both = _join_uneven(large, small, key, ["cid"])
    else:
        # keys with many rows on both sides are dealt to squares of a bounded size
        sizes = small.groupBy(*key).agg(F.count(F.lit(1)).alias("ks")).join(
            large.groupBy(*key).agg(F.count(F.lit(1)).alias("kl")), key)
        hot = _counted(checkpointed(sizes.filter((F.col("ks") > HOT_ROWS) | (F.col("kl") > HOT_ROWS)).select(
            *key, *[F.ceil(F.col(c) / HOT_ROWS).cast("int").alias(c) for c in ("ks", "kl")])))

        def deal(rows: DataFrame, cid: str, own: str, other: str) -> DataFrame:
            rows = rows.join(hot, key, "left").fillna(1, ["ks", "kl"])
            return rows.withColumn(f"_{own}", F.pmod(F.xxhash64(cid, F.lit(5)), F.col(own)).cast("int")).withColumn(
                f"_{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("ks", "kl")

        both = deal(large, "cid", "kl", "ks").join(deal(small, "cid_s", "ks", "kl"), [*key, "_ks", "_kl"])
    able = F.least("left", "left_s") * (100 + s) >= s * (F.col("n") + F.col("n_s"))
    both = both.filter((F.col("part") != F.col("part_s")) & (F.col("n_s") <= F.col("n")) & able)
    return both.select(F.greatest("cid", "cid_s").alias("a"), F.least("cid", "cid_s").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The ``pairs`` (``a, b``) whose whole sets are similar."""
    of = lambda end: sets.select(F.col("cid").alias(end), F.col("n").alias(f"n_{end}"),
                                 F.col("items").alias(f"items_{end}"))
    both = _join_uneven(_join_uneven(pairs, of("a"), ["a"], ["b"]), of("b"), ["b"], ["a"])
    common = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    return both.withColumn("common", common).filter(
        100 * F.col("common") >= similarity * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def cluster_links(docs: DataFrame, members: DataFrame, key: str, text: str, words: int, similarity: int,
                  block: int = BLOCK) -> DataFrame:
    """``a, b``: links between classes confirmed on full sets inside each
    cluster.

    ``members`` has ``cluster, cid, doc, n, fp1``; the set is read again from
    the texts of ``doc``.  A cluster of up to ``block`` elements is one
    group.  A larger one is dealt to blocks, each compared in itself; then a
    few documents of every block's largest part meet; then what can be linked
    between two parts is found by an exact join on rare shingles (see
    ``_pairs``), first with one document of every key, so that most of a large
    part is together before all remaining pairs are taken.  So every link
    between two parts is found, while documents of one part are not compared
    with all others and no group holds more than ``block`` elements or
    ``HOT_ROWS`` rows a side.
    """
    weight = F.greatest(F.col("n"), F.lit(LEAST))
    blocks = members.groupBy("cluster").agg(F.ceil(F.sum(weight) / block).alias("blocks"))
    dealt = checkpointed(members.join(blocks, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("cid", F.lit(3)), F.col("blocks"))))
    rows = dealt.agg(F.count(F.lit(1)).alias("n"), F.max("blocks").alias("most")).first()
    body = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))

    def links_of(groups: DataFrame) -> DataFrame:
        """Links between the rows of each group (``cluster, block``)."""
        def compare(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("cid", kind="stable")
            sets = shingle_sets(pdf["text"].tolist(), words)
            prints = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            # a repeated key may have brought other texts, or one text twice
            right = pdf["fp1"].to_numpy() == prints
            right[right] = ~pdf["cid"][right].duplicated().to_numpy()
            sets = [s for s, r in zip(sets, right) if r]
            ids = pdf["cid"].to_numpy()[right]
            got = _exact(sets, similarity) if len(sets) > 1 else np.zeros((0, 2), np.int64)
            return pd.DataFrame({"a": ids[got[:, 0]], "b": ids[got[:, 1]]})

        wanted = groups.select("cluster", "cid", "doc", "fp1", "block")
        wanted = F.broadcast(wanted) if rows["n"] <= FETCH_ROWS and rows["most"] == 1 else wanted
        return checkpointed(body.join(wanted, "doc").groupBy("cluster", "block").applyInPandas(
            compare, "a long, b long"))

    links = links_of(dealt)
    if (rows["most"] or 0) <= 1:
        return links

    def placed(found: DataFrame) -> DataFrame:
        large = dealt.filter("blocks > 1")
        return checkpointed(large.join(components(found), F.col("cid") == F.col("vertex"), "left").withColumn(
            "part", F.coalesce("component", "cid")).drop("vertex", "component"))

    def largest(table: DataFrame, *by: str) -> DataFrame:
        sizes = table.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("rows"))
        return sizes.groupBy(*by).agg(F.max(F.struct("rows", "part")).alias("best")).select(
            *by, F.col("best.part").alias("main"))

    table = placed(links)
    mine = table.join(largest(table, "cluster", "block"), ["cluster", "block"]).filter("part = main")
    few = mine.withColumn("slot", F.pmod(F.xxhash64("cid", F.lit(4)), F.lit(8))).groupBy(
        "cluster", "block", "slot").agg(F.min("cid").alias("cid")).select("cluster", "cid")
    hubs = checkpointed(table.join(few, ["cluster", "cid"], "left_semi"))
    groups = hubs.groupBy("cluster").agg(F.ceil(F.sum(weight) / block).alias("groups"))
    links = links.union(links_of(hubs.join(groups, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("cid", F.lit(7)), F.col("groups")))))
    # parts that stay apart are compared by their shingles, no set with all others
    table = placed(links)
    open_ = table.groupBy("cluster").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter(
        "lo < hi").select("cluster")
    table = checkpointed(table.join(open_, "cluster", "left_semi"))
    sets = checkpointed(_full_sets(body.join(table.select("cluster", "cid", "doc", "n", "fp1"), "doc"), words))
    ranked = checkpointed(_prefixes(sets, similarity))
    for pivots in (True, False):
        parted = ranked.join(table.select("cid", "part"), "cid")
        pairs = checkpointed(_pairs(parted, similarity, pivots))
        links = links.union(checkpointed(_confirmed(pairs, sets, similarity)))
        table = placed(links) if pivots else table
    return links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: int = 80,
                    trees: int = TREES, block: int = BLOCK, node_rows: int = NODE) -> DataFrame:
    """``key, n_shingles, component_id, kept``: one row per row of ``docs``;
    the smallest key reachable over links, and whether it is this one."""
    rows = checkpointed(features(docs, key, text, words))
    full = rows.filter("doc is not null and n > 0")
    classes = checkpointed(full.groupBy("fp1", "fp2").agg(
        F.min("doc").alias("doc"), F.first("sig").alias("sig"), F.first("n").alias("n"))
        .withColumn("cid", F.xxhash64("fp1", "fp2")))
    # equal signatures: one stands for all in the trees, the others hang on it
    by_sig = checkpointed(classes.groupBy("sig").agg(F.min("cid").alias("top")))
    same = classes.join(by_sig, "sig").filter("top <> cid").select(F.col("cid").alias("a"), F.col("top").alias("b"))
    reps = by_sig.select(F.col("top").alias("doc"), "sig")
    cluster = components(candidate_links(reps, trees, node_rows).union(same))
    members = classes.join(cluster, F.col("cid") == F.col("vertex"), "left").withColumn(
        "cluster", F.coalesce("component", "cid"))
    crowd = cluster.select(F.col("component").alias("cluster")).distinct()
    members = members.join(crowd, "cluster", "left_semi").select("cluster", "cid", "doc", "n", "fp1")
    linked = cluster_links(docs, members, key, text, words, similarity, block)
    # rows of one key with different sets are one vertex
    named = full.select("doc", F.xxhash64("fp1", "fp2").alias("cid"))
    several = named.groupBy("doc").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).filter("lo < hi")
    bridge = named.join(several, "doc").filter("cid > lo").select(F.col("cid").alias("a"), F.col("lo").alias("b"))
    final = components(linked.union(bridge))
    labelled = checkpointed(classes.select("cid", F.col("doc").alias("least")).join(
        final, F.col("cid") == F.col("vertex"), "left").select(
        "cid", "least", F.coalesce("component", "cid").alias("part")))
    lowest = labelled.groupBy("part").agg(F.min("least").alias("component_id"))
    component = labelled.join(lowest, "part").select("cid", "component_id")
    out = rows.withColumn("cid", F.when(F.expr("doc is not null and n > 0"), F.xxhash64("fp1", "fp2")))
    out = out.join(component, "cid", "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(f"`{key}`") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: int = 80,
                trees: int = TREES) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the one
    with the smallest key stays (one row of it, if the key repeats).  Rows
    with a null key or an empty set stay."""
    found = checkpointed(near_duplicates(docs, key, text, words, similarity, trees).filter(
        F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key")).agg(
        F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")))
    name = F.col(f"`{key}`").cast("long")
    once = docs.join(found.filter("_rows > 1 or not _kept").select("_key"), name == F.col("_key"), "left_anti")
    again = docs.join(found.filter("_rows > 1 and _kept").select("_key"), name == F.col("_key"), "left_semi")
    return once.unionByName(again.dropDuplicates([key]))
