"""Mixing sources to target weights along a training schedule.

Every source has a weight schedule over training progress 0 to 1, piecewise
linear.  Its integral is the source's weight; the source's target is its
share of all words by weight, but at most ``max_repeat`` times its own size
(the excess goes to the others by weight until none is above).  A source's
documents, in a fixed hash order and repeated as often as needed, form a
stream; the word at cumulative demand u (0 to 1 of the target) is trained at
the progress where the integrated schedule reaches u.

Null sources form one source, the last; null texts have size 0 and are never
taken; repeated rows count each.  One row per source passes through the
driver; everything per document is distributed, and sums over a hot source
run in hash buckets of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmine.llm.common import checkpointed

Knots = Sequence[tuple[float, float]]
#: Rows that one window over a hash bucket sees (about).
BUCKET_ROWS = 1_000
#: Rows that one count is expanded to at once.
CHUNK_ROWS = 1_000
#: Groups of equal rows up to which their keys are broadcast to find the rows.
FEW_GROUPS = 50_000


def count_words(text: Column) -> Column:
    """Number of runs without space and U+0009 to U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def default_schedule(rank: int) -> list[tuple[float, float]]:
    """Weights 1, 2, 3 repeating by rank; the weight falls, stays or rises by
    half over training, around that mean."""
    weight, slope = rank % 3 + 1, (rank % 3 - 1) / 2
    return [(0.0, weight * (1 - slope)), (1.0, weight * (1 + slope))]


def integral(knots: Knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def targets(sizes: Sequence[int], weights: Sequence[float], max_repeat: float) -> list[float]:
    """Shares of the total by weight under the caps, the excess reshared."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), [i for i, w in enumerate(weights) if w > 0]
    while open_:
        weight = sum(weights[i] for i in open_)
        level = total / weight
        full = [i for i in open_ if weights[i] * level > max_repeat * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * level
            break
        for i in full:
            out[i] = float(max_repeat * sizes[i])
            total -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _segments(knots: Knots) -> list[tuple[float, float, float, float, float]]:
    """``(u0, u1, t0, w0, k)`` by piece: cumulative share, time, normalised
    weight at its start and slope."""
    whole, out, u = integral(knots), [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        step = (t1 - t0) * (w0 + w1) / 2 / whole if whole else t1 - t0
        if step:
            out.append((u, u + step, t0, w0 / whole if whole else 1.0, (w1 - w0) / (t1 - t0) / whole if whole else 0.0))
            u += step
    return out


def progress(segments: Column, u: Column) -> Column:
    """The time at which the integrated schedule reaches ``u``."""
    last = F.element_at(segments, -1)
    seg = F.coalesce(F.get(F.filter(segments, lambda s: u < s["u1"]), F.lit(0)), last)
    area = F.greatest(F.lit(0.0), u - seg["u0"])
    root = F.sqrt(F.greatest(F.lit(0.0), seg["w"] * seg["w"] + 2 * seg["k"] * area))
    return F.least(F.lit(1.0), seg["t"] + F.when(area == 0, 0.0).otherwise(2 * area / (seg["w"] + root)))


def plan(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
         schedules: dict[str | None, Knots] | None = None, max_repeat: int = 3) -> DataFrame:
    """One row per row of ``df``: ``key, source, size, source_size, target,
    taken, positions`` — the words taken (repeats counted) and the training
    progress at which each copy begins, in order.

    ``schedules`` gives knots by source; by default weights 1, 2, 3 repeat
    over the sources by code point (see ``default_schedule``).
    """
    return _numbered_plan(df, key, source, text, schedules, max_repeat).drop("_i", "_copies")


def _numbered_plan(df: DataFrame, key: str, source: str, text: str, schedules: dict[str | None, Knots] | None,
                   max_repeat: int) -> DataFrame:
    """``plan`` with the number ``_i`` of each row among the ``_copies`` rows
    equal in key, source and size."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"),
                     count_words(F.col(f"`{text}`")).alias("size"))
    # repeated rows become one with a count, so that no key is hot
    once = checkpointed(rows.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
                        .withColumn("_h", F.xxhash64("key", "size")))
    totals = once.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"),
                                        F.count(F.lit(1)).alias("rows")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    knots = [list((schedules or {}).get(r["source"], default_schedule(i))) for i, r in enumerate(totals)]
    want = targets([r["words"] for r in totals], [integral(k) for k in knots], max_repeat)
    table = spark.createDataFrame(
        [(r["source"], r["words"], t, _segments(k)) for r, t, k in zip(totals, want, knots)],
        "source string, source_size long, target double, "
        "segments array<struct<u0:double,u1:double,t:double,w:double,k:double>>")
    buckets = max(1, math.ceil(max([r["rows"] for r in totals], default=0) / BUCKET_ROWS))
    once = once.withColumn("_b", F.pmod("_h", F.lit(buckets)))
    mass = F.col("size") * F.col("copies")
    sums = once.groupBy("source", "_b").agg(F.sum(mass).alias("_sum"))
    before = sums.withColumn("_before", F.sum("_sum").over(
        Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col("source").alias("_s"), F.col("_b").alias("_sb"),
                           F.coalesce("_before", F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum(mass).over(Window.partitionBy("source", "_b").orderBy("_h", "key", "size")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = once.withColumn("_in", inside)
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    placed = placed.select("key", "source", "size", "copies", (F.col("_before") + F.col("_in")).alias("_start"))
    placed = placed.join(table.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # counts are expanded by chunks; those of large groups are spread over tasks
    chunk = F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {CHUNK_ROWS}"))
    many = placed.filter(F.col("copies") > CHUNK_ROWS).withColumn("_c", F.explode(chunk))
    many = many.repartition("key", "source", "size", "_c")
    chunks = placed.filter(F.col("copies") <= CHUNK_ROWS).withColumn("_c", F.lit(0).cast("long")).unionByName(many)
    each = chunks.withColumn("_i", F.explode(F.sequence(F.col("_c") * CHUNK_ROWS, F.least(
        F.col("copies"), (F.col("_c") + 1) * CHUNK_ROWS) - 1)))
    start = F.col("_start") + F.col("_i") * F.col("size")
    want_words = F.round("target").cast("long")
    passes = F.sequence(F.lit(0), F.lit(max_repeat - 1))
    part = F.transform(passes, lambda e: F.greatest(F.lit(0).cast("long"), F.least(
        F.col("size"), want_words - e.cast("long") * F.col("source_size") - F.col("_at"))))
    begin = F.transform(passes, lambda e: F.when(
        (F.col("size") > 0) & (e.cast("long") * F.col("source_size") + F.col("_at") < want_words),
        progress(F.col("segments"), (e.cast("long") * F.col("source_size") + F.col("_at")) / F.col("target"))))
    return (each.withColumn("_at", start)
            .select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
                    F.aggregate(part, F.lit(0).cast("long"), lambda a, b: a + b).alias("taken"),
                    F.filter(begin, lambda x: x.isNotNull()).alias("positions"), "_i", F.col("copies").alias("_copies")))


def range_sorted(planned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows ordered by the training progress of their first copy, by a range
    exchange; rows that are never taken come last, at 2.  A hash of the key
    orders equal positions, so that they do not fall into one range."""
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    order = [F.col("position"), F.xxhash64(F.col(f"`{key}`"))]
    return planned.withColumn("position", first).repartitionByRange(*order).sortWithinPartitions(*order)


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        schedules: dict[str | None, Knots] | None = None, max_repeat: int = 3) -> DataFrame:
    """The rows of ``df`` as the mix trains them: one row for each copy,
    whole texts, in order of training progress.  Rows that the targets leave
    no place for are not in it; a copy that the end of a target cuts is kept
    whole.  Rows equal in key, source and size (null keys, repeated rows) are
    numbered, and each follows the positions of its own number."""
    planned = _numbered_plan(df, key, source, text, schedules, max_repeat)
    planned = checkpointed(planned.select(
        F.col(f"`{key}`").alias("_k"), F.col(f"`{source}`").alias("_s"), F.col("size").alias("_n"), "_i", "_copies",
        F.col("positions").alias("_p")))
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(*columns, count_words(F.col(f"`{text}`")).alias("_size"))
    same = (F.col(f"`{key}`").eqNullSafe(F.col("_k")) & F.col(f"`{source}`").eqNullSafe(F.col("_s"))
            & (F.col("_size") == F.col("_n")))
    groups = (F.col("_copies") > 1) & (F.col("_i") == 0)
    most, several = planned.agg(F.coalesce(F.max("_copies"), F.lit(0)), F.count(F.when(groups, 1))).first()
    numbered = planned.filter("_copies > 1").select(
        *[F.col(c).alias(f"{c}2") for c in ("_k", "_s", "_n", "_i")], "_p")
    number = (F.col("_k").eqNullSafe(F.col("_k2")) & F.col("_s").eqNullSafe(F.col("_s2"))
              & (F.col("_n") == F.col("_n2")) & (F.col("_i") == F.col("_i2")))
    large = None
    if most > BUCKET_ROWS:  # at most one group in BUCKET_ROWS rows
        hot = F.broadcast(planned.filter((F.col("_copies") > BUCKET_ROWS) & (F.col("_i") == 0)).select("_k", "_s", "_n"))
        large = _numbered(rows.join(hot, same)).join(numbered, number).select(*columns, "_p")
        rows = rows.join(hot, same, "left_anti")
    joined = rows.join(planned.filter("_copies = 1").drop("_i", "_copies"), same).select(*columns, "_p")
    if most > 1:
        few = planned.filter(groups & (F.col("_copies") <= BUCKET_ROWS)).select("_k", "_s", "_n")
        few = F.broadcast(few) if several <= FEW_GROUPS else few  # spares an exchange of all texts
        order = Window.partitionBy("_k", "_s", "_n").orderBy(F.xxhash64(F.col(f"`{text}`")))
        again = rows.join(few, same).withColumn("_i", F.row_number().over(order) - 1)
        joined = joined.unionAll(again.join(numbered, number).select(*columns, "_p"))
    joined = joined if large is None else joined.unionAll(large)
    copies = joined.select(*columns, F.explode("_p").alias("_position"))
    return copies.repartitionByRange(F.col("_position")).sortWithinPartitions("_position").select(*columns)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_i``, their number from 0 within ``_k, _s, _n``.  Rows
    are numbered by partition and run of ``BUCKET_ROWS`` in it, runs after
    one another by their sums, so that no group meets in one task."""
    group = ["_k", "_s", "_n"]
    rows = checkpointed(rows.withColumn("_id", F.monotonically_increasing_id())).withColumn(
        "_run", F.expr(f"_id div {BUCKET_ROWS}"))
    sums = rows.groupBy(*group, "_run").agg(F.count(F.lit(1)).alias("_rows"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_rows").over(
        Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(*[F.col(c).alias(f"{c}b") for c in [*group, "_run"]], "_before")
    inside = F.row_number().over(Window.partitionBy(*group, "_run").orderBy("_id")) - 1
    same = [F.col(c).eqNullSafe(F.col(f"{c}b")) for c in group] + [F.col("_run") == F.col("_runb")]
    whole = same[0] & same[1] & same[2] & same[3]
    return rows.withColumn("_in", inside).join(before, whole).withColumn("_i", F.col("_before") + F.col("_in"))
