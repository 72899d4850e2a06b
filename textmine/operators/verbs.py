"""Table verbs: count, top-n, share, reshape, stop-word and lexicon joins,
plus the skew-safe building blocks the text operators share.

Scale rules followed throughout:

* aggregations are ``groupBy`` (partial aggregate before the shuffle), never a
  ``collect_list`` of a whole group;
* a group total is an aggregate joined back, not a window over the group,
  so a hot group is never buffered in one task;
* an aggregated side that is joined back is computed and counted first
  (``measured``): broadcast up to ``BROADCAST_ROWS`` rows and
  ``BROADCAST_BYTES``, a sort-merge join (with adaptive skew splitting)
  beyond, never by a planner's estimate;
* a large side of uneven keys (words) is split: its most met rows are
  broadcast, the rest is merged (``hot_join``);
* top-n is ``rank() <= n`` (Spark adds a partial WindowGroupLimit before the
  shuffle);
* row numbers over large inputs come from a range sort plus per-partition
  offsets (``global_row_number``), not from a window over one group;
* products of two key sets (``complete``) are equi-joins on block ids
  (``block_product``) so each task gets a bounded share.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above bit 33

# A counted side of up to this many rows and bytes is broadcast; larger ones are merged.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (grouping semantics).

    Output keeps the left key columns, then the right non-key columns.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("null_safe_join needs keys")
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    return joined.drop(*[f"_r_{k}" for k in keys])


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values, roughly: 8 for a number, text by its length,
    arrays of numbers by their size, other nested values as JSON text."""
    def width(field: T.StructField) -> Column:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.octet_length(col) + 8
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            return F.size(col) * 8
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(col)))
        return F.lit(8)

    return reduce(lambda a, b: a + b, [F.coalesce(width(f), F.lit(8)).cast("long") for f in schema.fields])


def measured(df: DataFrame, limit: int = BROADCAST_ROWS, *, max_bytes: int = BROADCAST_BYTES,
             large: str = "merge") -> DataFrame:
    """A join side with a strategy chosen by its real size.

    The size estimate of a table below an ``explode`` or a checkpoint can be
    far too low, so the side is computed once (stored), its rows and
    bytes counted on the way: up to ``limit`` rows and ``max_bytes`` it is
    broadcast, beyond that the join is a sort-merge join, or what ``large``
    says (``shuffle_hash`` for a side with one row per key).  Eager, one job.
    """
    from textmine.session import stored

    seen = Observation()
    table = stored(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df.schema)).alias("bytes")))
    size = seen.get
    small = (size["rows"] or 0) <= limit and (size["bytes"] or 0) <= max_bytes
    return F.broadcast(table) if small else table.hint(large)


def hot_and_cold(side: DataFrame, weight: str | Column, limit: int | None = None,
                 max_bytes: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """A join side as a part to broadcast and the rest (None if all is small).

    The first part holds the rows of largest ``weight`` (roughly the rows each
    will meet), up to ``limit`` rows and ``max_bytes``.  Words are so uneven
    that this small part meets nearly all rows of the other table, which then
    need no shuffle; only those of rare words are merged with the rest.  Which
    part a row goes to depends on its weight alone, so no row is in both.  Eager:
    the side is computed once, and counted by classes of weight.
    """
    from textmine.session import stored

    limit, max_bytes = BROADCAST_ROWS if limit is None else limit, BROADCAST_BYTES if max_bytes is None else max_bytes
    w = (F.col(weight) if isinstance(weight, str) else weight).cast("double")
    # classes of weight a sixth of a power of 2 apart, at most some thousands
    cls = F.when(w > 0, F.greatest(F.floor(F.log2(w) * 6), F.lit(-6000))).otherwise(F.lit(-6001))
    table = stored(side.withColumn("_class", cls.cast("int")))
    sizes = table.groupBy("_class").agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(side.schema)).alias("bytes"))
    rows = size = 0
    cut = None
    for r in sorted(sizes.collect(), key=lambda r: -r["_class"]):
        rows, size = rows + r["rows"], size + (r["bytes"] or 0)
        if rows > limit or size > max_bytes:
            break
        cut = r["_class"]
    else:
        return F.broadcast(table.drop("_class")), None
    hot = table.filter(F.col("_class") >= cut if cut is not None else F.lit(False)).drop("_class")
    cold = table.filter(F.col("_class") < cut) if cut is not None else table
    return F.broadcast(hot), cold.drop("_class").hint("merge")


def hot_join(df: DataFrame, side: DataFrame, key: str, weight: str | Column, how: str = "inner") -> DataFrame:
    """``null_safe_join`` (``inner`` or ``left_semi``) with a side that has one
    row per ``key`` and may be too large to broadcast: rows of ``df`` with a
    frequent key meet the side's broadcast part where they lie, the others are
    merged (``hot_and_cold``).  ``df`` is then read twice.  Eager."""
    hot, cold = hot_and_cold(side, weight)
    out = null_safe_join(df, hot, [key], how)
    if cold is None:
        return out
    rare = null_safe_join(df, F.broadcast(hot.select(key)), [key], "left_anti")
    return out.unionByName(null_safe_join(rare, cold, [key], how))


# --------------------------------------------------------------------------- counts

def count_by(df: DataFrame, *keys, wt: str | Column | None = None, sort: bool = False,
             name: str = "n") -> DataFrame:
    """Rows per key combination (``n``), or the sum of ``wt`` per key.

    Keys may be column names or aliased Column expressions (a computed key
    such as a line bucket).  ``sort`` orders by ``n`` descending, then keys.
    """
    agg = F.count(F.lit(1)) if wt is None else F.sum(wt)
    out = df.groupBy(*keys).agg(agg.alias(name))
    if sort:
        key_names = [c for c in out.columns if c != name]
        out = out.orderBy(F.desc(name), *key_names)
    return out


def top_n(df: DataFrame, n: int, wt: str | Column | None = None,
          by: str | Sequence[str] | None = None) -> DataFrame:
    """Rows whose ``wt`` is among the ``n`` largest in their group; ties at
    the cut are all kept (``rank() <= n``).  ``wt=None`` uses the last column.
    Rows with a NULL weight are never selected.
    """
    by = as_list(by)
    tmp = None
    if wt is None:
        wt_col = F.col(df.columns[-1])
    elif isinstance(wt, str):
        wt_col = F.col(wt)
    else:
        tmp = "_top_n_wt"
        df = df.withColumn(tmp, wt)
        wt_col = F.col(tmp)
    window = (Window.partitionBy(*by) if by else Window).orderBy(wt_col.desc())
    out = (df.filter(wt_col.isNotNull())
             .withColumn("_top_n_rank", F.rank().over(window))
             .filter(F.col("_top_n_rank") <= n)
             .drop("_top_n_rank"))
    return out.drop(tmp) if tmp else out


def share(df: DataFrame, value: str = "n", by: str | Sequence[str] | None = None,
          out: str = "proportion") -> DataFrame:
    """``value / sum(value)`` within each group (whole table when ``by`` is
    empty).  The totals are a partial aggregate joined back on the group key.
    Eager: the totals are computed and counted (``measured``).
    """
    by = as_list(by)
    if not by:
        total = df.select(F.sum(value)).scalar()
        return df.withColumn(out, F.col(value) / total)
    totals = df.groupBy(*by).agg(F.sum(value).alias("_share_total"))
    joined = null_safe_join(df, measured(totals), by, "inner")
    return (joined.withColumn(out, F.col(value) / F.col("_share_total"))
                  .select(*df.columns, out))


def group_total(df: DataFrame, value: str, by: str | Sequence[str], out: str) -> DataFrame:
    """Repeat the group sum of ``value`` on every row of the group.
    Eager: the totals are computed and counted (``measured``)."""
    by = as_list(by)
    totals = df.groupBy(*by).agg(F.sum(value).alias(out))
    return null_safe_join(df, measured(totals), by, "inner").select(*df.columns, out)


# --------------------------------------------------------------------------- reshape

def spread(df: DataFrame, key: str, value: str, values: Sequence | None = None, fill=None) -> DataFrame:
    """Long to wide: one column per value of ``key``, in sorted order (Spark
    reads the distinct values in a job of its own).

    ``values`` fixes the columns instead, so that the schema does not depend
    on the data; a row of any other key then belongs to no column.
    """
    rest = [c for c in df.columns if c not in (key, value)]
    wide = df.groupBy(*rest).pivot(key, list(values) if values is not None else None).agg(F.first(value))
    if fill is not None:
        wide = wide.fillna(fill, subset=[c for c in wide.columns if c not in rest])
    return wide


def gather(df: DataFrame, key: str, value: str, cols: Sequence[str]) -> DataFrame:
    """Wide to long over ``cols``; other columns stay as identifiers and
    NULL cells are kept."""
    ids = [c for c in df.columns if c not in cols]
    return df.unpivot(ids, list(cols), key, value)


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """Stack tables by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def separate(df: DataFrame, col: str, into: Sequence[str], sep: str = " ",
             convert: Mapping[str, str] | None = None, remove: bool = True) -> DataFrame:
    """Split a string column on a literal separator into named columns.

    Missing pieces are NULL.  ``convert`` maps output columns to a type,
    with unconvertible values becoming NULL.
    """
    import re

    parts = F.split(F.col(col), re.escape(sep))
    exprs = []
    for i, name in enumerate(into):
        piece = F.get(parts, i)
        if convert and name in convert:
            piece = piece.try_cast(convert[name])
        exprs.append(piece.alias(name))
    idx = df.columns.index(col)
    before = df.columns[:idx] if remove else df.columns[:idx + 1]
    return df.select(*before, *exprs, *df.columns[idx + 1:])


def unite(df: DataFrame, out: str, cols: Sequence[str], sep: str = "_",
          remove: bool = True) -> DataFrame:
    """Paste columns into one string column (NULL pieces are skipped)."""
    united = F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias(out)
    first = df.columns.index(cols[0])
    before = [c for c in df.columns[:first] if not (remove and c in cols)]
    after = [c for c in df.columns[first:] if not (remove and c in cols)]
    return df.select(*before, united, *after)


def complete(df: DataFrame, a: str | Sequence[str], b: str | Sequence[str],
             fill: Mapping[str, object] | None = None) -> DataFrame:
    """Every combination of the observed ``a`` and ``b`` values.

    Existing rows (duplicates included) are kept; new combinations get NULL
    or the ``fill`` value.  The grid is built by ``block_product``.  Eager:
    the table is read three times, so it is computed once and counted.
    """
    a, b = as_list(a), as_list(b)
    rows = measured(df)
    grid = block_product(rows.select(*a).distinct(), rows.select(*b).distinct())
    out = null_safe_join(grid, rows, a + b, "left")
    for c, v in (fill or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out.select(*a, *b, *[c for c in df.columns if c not in a + b])


# --------------------------------------------------------------------------- filters and joins

def keep_frequent(df: DataFrame, col: str, min_n: int) -> DataFrame:
    """Rows of values that occur at least ``min_n`` times (HAVING, rows
    kept): counted keys semi-joined back, never a window over the group.
    Eager: the frequent values are computed and counted; where they are too
    many to broadcast, only rows of the rarer ones are shuffled (``hot_join``)."""
    frequent = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_n)
    return hot_join(df, frequent, col, "_n", "left_semi")


def grep(df: DataFrame, col: str, pattern: str, ignore_case: bool = False,
         keep: Sequence[str] | None = None) -> DataFrame:
    """Rows whose ``col`` matches ``pattern`` anywhere (case-sensitive by
    default), optionally projected to ``keep``."""
    out = df.filter(F.col(col).rlike(("(?i)" if ignore_case else "") + pattern))
    return out.select(*keep) if keep else out


def extract(df: DataFrame, col: str, out: str, pattern: str = r"(\d+)", to: str | None = "long",
            remove: bool = True) -> DataFrame:
    """First capture of ``pattern`` in ``col`` as column ``out`` (converted
    to ``to``; no match or a failed conversion gives NULL), replacing ``col``
    by default."""
    value = F.nullif(F.regexp_extract(F.col(col), pattern, 1), F.lit(""))
    if to:
        value = value.try_cast(to)
    idx = df.columns.index(col)
    before = df.columns[:idx] if remove else df.columns[:idx + 1]
    return df.select(*before, value.alias(out), *df.columns[idx + 1:])


def drop_non_ascii(df: DataFrame, col: str = "word") -> DataFrame:
    """Drop rows whose ``col`` has a character outside ASCII."""
    return df.filter(~F.col(col).rlike(r"[^\x00-\x7F]") | F.col(col).isNull())


def _distinct_key(table: DataFrame, key: str, as_name: str) -> DataFrame:
    return table.select(F.col(key).alias(as_name)).distinct()


def remove_stop_words(df: DataFrame, stop: DataFrame, on: str = "word",
                      stop_key: str = "word") -> DataFrame:
    """Anti join against a stop list (rows with a NULL word are kept)."""
    return df.join(_distinct_key(stop, stop_key, on), on, "left_anti").select(*df.columns)


def drop_stop_ngrams(df: DataFrame, cols: Sequence[str], stop: DataFrame,
                     stop_key: str = "word") -> DataFrame:
    """Drop n-grams with a stop word in any of ``cols``; NULL words are kept
    (an anti join per column, unlike ``~isin`` which drops NULLs)."""
    out = df
    for c in cols:
        out = out.join(_distinct_key(stop, stop_key, c), c, "left_anti")
    return out.select(*df.columns)


def join_lexicon(df: DataFrame, lex: DataFrame, on: str | tuple[str, str] = "word") -> DataFrame:
    """Inner join with a lexicon.  A word with k entries yields k rows; the
    lexicon is never de-duplicated.  ``on=(left, right)`` joins differently
    named keys."""
    left_key, right_key = (on, on) if isinstance(on, str) else on
    if right_key != left_key:
        lex = lex.withColumnRenamed(right_key, left_key)
    extra = [c for c in lex.columns if c != left_key and c not in df.columns]
    return df.join(lex, left_key, "inner").select(*df.columns, *extra)


def keep_in_lexicon(df: DataFrame, lex: DataFrame, on: str | tuple[str, str] = "word") -> DataFrame:
    """Semi join: rows whose key is in the lexicon, no fan-out."""
    left_key, right_key = (on, on) if isinstance(on, str) else on
    return df.join(_distinct_key(lex, right_key, left_key), left_key, "left_semi").select(*df.columns)


# --------------------------------------------------------------------------- order columns

def with_order(df: DataFrame, wt: str, key: str, by: str | Sequence[str] | None = None,
               out: str = "ord") -> DataFrame:
    """Display order (1 = smallest ``wt``, ties by ``key``), optionally within
    facets.  The numbers come from a range sort (``row_number_by``), so a
    table of any size is spread over all tasks.  Eager."""
    by = as_list(by)
    return row_number_by(df, by, [F.col(wt), F.col(key)], out).select(*df.columns, out)


# --------------------------------------------------------------------------- skew-safe blocks

def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_number") -> DataFrame:
    """1-based row number over the whole table in ``order`` (must be a total
    order).

    A range-partitioned sort spreads the rows over all tasks; each row's
    number is its partition's offset plus its place in the partition.  The
    offset table has one row per partition, so broadcasting it is bounded
    by the partition count.  Eager: the sorted table is checkpointed once.
    """
    from textmine.session import stored

    sorted_df = df.orderBy(*order)
    # The sizes and the rows must come from one and the same sorted
    # partitioning: recomputed separately, each branch would sample its own
    # range boundaries.  So the tagged table is stored (shared folder) once
    # and both branches read it.
    tagged = stored(sorted_df.withColumn("_mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS)) \
                   .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    numbered = tagged.join(F.broadcast(offsets), "_pid")
    return numbered.withColumn(out, F.col("_offset") + F.col("_local") + 1) \
                   .drop("_mid", "_pid", "_local", "_offset")


def row_number_by(df: DataFrame, by: str | Sequence[str], order: Sequence[str | Column],
                  out: str = "row_number") -> DataFrame:
    """1-based row number within each ``by`` group in ``order`` (a total
    order within the group), without gathering a group into one task:
    global number minus the group's first global number."""
    by = as_list(by)
    if not by:
        return global_row_number(df, order, out)
    numbered = global_row_number(df, [*[F.col(c).asc_nulls_first() for c in by], *order], "_g")
    first = numbered.groupBy(*by).agg(F.min("_g").alias("_g0"))
    joined = null_safe_join(numbered, measured(first), by, "inner")
    return joined.withColumn(out, F.col("_g") - F.col("_g0") + 1).drop("_g", "_g0")


def running_sum(df: DataFrame, value: str | Column, by: str | Sequence[str], order: str,
                out: str, chunk: int = 65536) -> DataFrame:
    """Cumulative sum of ``value`` within ``by`` in the order of the integer
    column ``order`` (a line number).

    Two-level prefix sum: a window inside each (group, ``order %/% chunk``)
    piece plus the sum of all earlier pieces, so no task holds more than
    ``chunk`` rows of one group.  Eager: the sums of the pieces are computed
    and counted (``measured``).
    """
    by = as_list(by)
    val = F.col(value) if isinstance(value, str) else value
    piece = F.floor(F.col(order) / chunk).cast("long")
    base = df.withColumn("_rs_v", val).withColumn("_rs_piece", piece)
    local = F.sum("_rs_v").over(Window.partitionBy(*by, "_rs_piece").orderBy(order)
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    with_local = base.withColumn("_rs_local", local)
    pieces = base.groupBy(*by, "_rs_piece").agg(F.sum("_rs_v").alias("_rs_tot"))
    earlier = F.sum("_rs_tot").over(Window.partitionBy(*by).orderBy("_rs_piece")
                                    .rowsBetween(Window.unboundedPreceding, -1))
    prefix = pieces.select(*by, "_rs_piece", F.coalesce(earlier, F.lit(0)).alias("_rs_prefix"))
    joined = null_safe_join(with_local, measured(prefix), [*by, "_rs_piece"], "inner")
    return joined.withColumn(out, F.col("_rs_local") + F.col("_rs_prefix")) \
                 .select(*df.columns, out)


def block_product(left: DataFrame, right: DataFrame, block_rows: int = 2048) -> DataFrame:
    """All combinations of the rows of two (distinct-row) tables.

    Instead of a cartesian join, each side is cut into hash blocks of about
    ``block_rows`` rows and replicated to every block of the other side;
    the combinations are then a sort-merge equi-join on the (left block,
    right block) pair.  A join group, and so what a task holds in memory, is
    about ``block_rows`` rows a side; a partition may hold several groups,
    which its task builds one after the other.  Column names of the two
    sides must differ.

    Eager: both sides are computed once (checkpointed) and counted to size
    the grid.
    """
    from textmine.session import stored

    left, right = stored(left), stored(right)
    b_left = max(1, math.ceil(left.count() / block_rows))
    b_right = max(1, math.ceil(right.count() / block_rows))
    lcols, rcols = left.columns, right.columns
    lhs = left.withColumn("_bl", F.pmod(F.xxhash64(*lcols), F.lit(b_left))) \
              .withColumn("_br", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(b_right - 1).cast("long"))))
    rhs = right.withColumn("_br", F.pmod(F.xxhash64(*rcols), F.lit(b_right))) \
               .withColumn("_bl", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(b_left - 1).cast("long"))))
    # at least one task a block pair up to the tasks a job can usefully have
    parts = min(b_left * b_right, 1 << 16)
    lhs, rhs = lhs.repartition(parts, "_bl", "_br"), rhs.repartition(parts, "_bl", "_br")
    return lhs.hint("merge").join(rhs, ["_bl", "_br"]).select(*lcols, *rcols)
