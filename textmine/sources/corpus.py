"""Corpus tables: load, select by catalogue, attach metadata, split into
lines, flatten nested corpora, and save/reload intermediates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine.functions.text import html_text, html_title


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A corpus or catalogue table stored as parquet under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Make sure the per-row text work can use every core.

    A table read as fewer splits than the session's default parallelism
    (one small file, one row group) is spread round-robin over that many
    partitions; a table that already has enough splits (any large corpus)
    is returned unchanged, so big inputs are never reshuffled.  Round-robin
    (not a key) keeps the next aggregation's own shuffle, which Spark then
    reuses for every branch that reads the same counts instead of
    re-tokenising per branch.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def spread_by(df: DataFrame, key: str) -> DataFrame:
    """Deal a corpus over many tasks by ``key``, so that what is later grouped
    by ``key`` and more (the words of each document) is grouped where it lies:
    the texts are shuffled once, their words and counts are not.  All rows of
    one key go to one task, so the key must be one of documents."""
    session = df.sparkSession
    parts = max(2 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")),
                4 * df.rdd.getNumPartitions())
    return df.repartition(parts, key)


def select_corpus(docs: DataFrame, meta: DataFrame, predicate: Column,
                  key: str | Sequence[str]) -> DataFrame:
    """Documents whose catalogue row satisfies ``predicate`` (semi join).

    No fan-out and no catalogue columns are added; the catalogue side is
    reduced to distinct keys first so its size is that of the selection.
    """
    keys = [key] if isinstance(key, str) else list(key)
    chosen = meta.filter(predicate).select(*keys).distinct()
    return docs.join(chosen, keys, "left_semi")


def _shard(key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int").alias("_shard")


def save_corpus(docs: DataFrame, path: str, key: str, shards: int = 256) -> DataFrame:
    """Store a corpus in ``shards`` partitions by a hash of ``key`` and return
    the re-read table (with its ``_shard`` column), for ``select_stored``."""
    dealt = docs.withColumn("_shard", _shard(key, shards))
    return save_table(dealt.repartition(shards, "_shard"), path, partition_by=["_shard"])


def select_stored(stored: DataFrame, meta: DataFrame, predicate: Column, key: str, shards: int = 256) -> DataFrame:
    """Like ``select_corpus``, over a corpus stored by ``save_corpus`` with
    the same ``key`` and ``shards``: the chosen keys also tell their shards, so
    Spark prunes the scan to these at run time (dynamic partition pruning;
    it takes a comparison as ``predicate``, not a bare boolean column)."""
    chosen = meta.filter(predicate & F.col(key).isNotNull()).select(key).distinct()
    chosen = chosen.withColumn("_shard", _shard(key, shards))
    return stored.join(chosen, [key, "_shard"], "left_semi").drop("_shard")


def with_meta(docs: DataFrame, meta: DataFrame, key: str | Sequence[str],
              fields: Sequence[str], how: str = "left") -> DataFrame:
    """Attach catalogue columns (``meta_fields``) to each document row.
    Documents that the catalogue does not list get NULLs, or go with
    ``how="inner"``."""
    keys = [key] if isinstance(key, str) else list(key)
    return docs.join(meta.select(*keys, *fields), keys, how)


def lines(docs: DataFrame, text: str = "text", out: str = "text",
          number: str = "line_no") -> DataFrame:
    """One row per line of each document, numbered from 1 in reading order.

    The numbering comes from the position in the split text, so it needs no
    shuffle and no window; every other column of ``docs`` is kept.
    """
    others = [c for c in docs.columns if c != text]
    exploded = docs.select(*others, F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line"))
    return exploded.select(*others, (F.col("_pos") + 1).cast("long").alias(number),
                           F.col("_line").alias(out))


def nest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], out: str = "corpus",
         order: str | None = None, chunk: int | None = None) -> DataFrame:
    """Pack rows into an ``ARRAY<STRUCT>`` column per key (a list column).

    With ``chunk`` and an integer ``order`` column each packed row holds at
    most ``chunk`` entries (key plus ``order %/% chunk``), so one very large
    key never becomes one very large row.
    """
    group = list(keys)
    if chunk:
        if not order:
            raise ValueError("chunk needs an order column")
        group.append(F.floor(F.col(order) / chunk).cast("long").alias("_chunk"))
    packed = df.groupBy(*group).agg(F.collect_list(F.struct(*fields)).alias(out))
    return packed.drop("_chunk") if chunk else packed


def map_nested(df: DataFrame, col: str = "corpus", **fields: Callable[[Column], Column]) -> DataFrame:
    """Add fields to every entry of an ``ARRAY<STRUCT>`` column without
    un-nesting it: each value is a function of the entry.  A field of the same
    name gives way; a null array stays null, an empty one empty.  The work
    is done in the row, so a key's chunks (``nest``) stay spread over tasks."""
    names = [n for n in df.schema[col].dataType.elementType.names if n not in fields]
    return df.withColumn(col, F.transform(col, lambda e: F.struct(
        *[e[n].alias(n) for n in names], *[make(e).alias(n) for n, make in fields.items()])))


def flatten_corpus(df: DataFrame, col: str = "corpus") -> DataFrame:
    """One row per element of an ``ARRAY<STRUCT>`` column, struct fields
    becoming columns (``unnest`` of a list column)."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.inline(F.col(col)))


def tidy_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """A web-page table as a corpus with metadata: ``id, heading, url, text``."""
    return pages.select(
        F.col(key).alias("id"),
        html_title("html").alias("heading"),
        F.col("url"),
        html_text("html").alias("text"),
    )


def materialize(df: DataFrame, spread_out: bool = False) -> DataFrame:
    """Compute a shared sub-result once and cut its lineage.

    The table is written to the session's checkpoint folder (a shared folder
    on a cluster, so a lost executor does not lose it) and every later
    branch reads it back instead of recomputing tokenisation and counting.
    Use it for a table read by several branches of one query (counts under
    tf-idf: totals, document frequencies, number of documents).

    ``spread_out``: adaptive execution may have coalesced a result into a
    few partitions; for a table whose readers do heavy per-row work, spread
    it over every core again (no-op when it already has enough partitions).
    Measured at sf0.1: worth ~10 s on 2.3M topic-model triplets, a loss of
    1-4 s on small count tables, hence off by default.
    """
    from textmine.session import stored

    out = stored(df)
    return spread(out) if spread_out else out


def save_table(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None) -> DataFrame:
    """Persist an intermediate as parquet and return the re-read table.

    ``path`` should live in shared storage (for example under the session's
    checkpoint folder), never on one machine's local disk.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
