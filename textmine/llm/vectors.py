"""Vectors in shards: cleaning, and searches of a stated set of queries
against all rows, a shard's index and a block of queries at a time."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmine.llm.common import checkpointed
from textmine.session import ship_package

#: Rows of one shard of candidates, and of one block of queries.
SHARD_ROWS, QUERY_ROWS = 16384, 512


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, vector`` (array of double) of the rows that take part: key and
    vector not null, every component a finite number.  Rows equal in key and
    vector count once; other rows that repeat a key are rows of their own."""
    out = df.select(F.col(f"`{key}`").cast("long").alias("key"),
                    F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return out.filter(F.col("key").isNotNull() & F.col("vector").isNotNull() & good).distinct()


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Arrays of numbers as rows, short ones filled up with 0."""
    rows = column.combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = pa.concat_arrays(rows.chunks) if rows.num_chunks else pa.array([], column.type)
    offsets = rows.offsets.to_numpy().astype(np.int64)
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(rows), width), flat.dtype)
    row = np.repeat(np.arange(len(rows)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def search_blocks(vectors: DataFrame, is_query: Column,
                  index: Callable[[np.ndarray, np.ndarray], Callable], k: int, score_type: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all rows for each
    row that ``is_query`` admits, rows of the query's own key left out.  Rows
    of one query key search together: the ``k`` best of all of them count.

    Rows are dealt to shards of about ``SHARD_ROWS``, each row to one of them;
    queries go to every shard.  A task meets a shard's rows first, builds
    ``index(ids, rows)`` once and passes the shard's queries through it,
    ``QUERY_ROWS`` at a time: it is called with (query_ids, queries, k) and
    returns arrays ``(query_id, vec_id, score)`` with at most ``k`` rows a
    query; these merge by score, ties to the smaller id.
    """
    ship_package(vectors.sparkSession)
    table = checkpointed(vectors)
    size = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("w")).first()
    width = max(1, size["w"] or 1)
    shards = max(1, math.ceil(size["n"] / SHARD_ROWS))
    rows = table.select(F.pmod(F.xxhash64("key", "vector"), F.lit(shards)).cast("int").alias("shard"),
                        F.lit(False).alias("query"), "key", "vector")
    queries = table.filter(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                                            F.lit(True).alias("query"), "key", "vector")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64() if score_type == "long" else pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, find = None, [], None
        for batch in batches:
            of, asks = batch.column("shard").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
            turn = np.flatnonzero((of[1:] != of[:-1]) | (asks[1:] != asks[:-1])) + 1
            for low, high in zip([0, *turn.tolist()], [*turn.tolist(), len(of)]):
                if not high:
                    continue
                if of[low] != shard:
                    shard, held, find = of[low], [], None
                part = batch.slice(low, high - low)
                if not asks[low]:
                    held.append(part)
                    continue
                if find is None and held:
                    whole = pa.Table.from_batches(held)
                    find, held = index(whole["key"].to_numpy(), matrix(whole["vector"], width)), []
                for at in range(0, part.num_rows if find else 0, QUERY_ROWS):
                    some = pa.Table.from_batches([part.slice(at, QUERY_ROWS)])
                    got = find(some["key"].to_numpy(), matrix(some["vector"], width), k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x).cast(f.type) for x, f in zip(got, schema, strict=True)], schema=schema)

    found = (rows.unionByName(queries).repartition("shard").sortWithinPartitions("shard", "query")
             .mapInArrow(run, f"query_id long, vec_id long, score {score_type}"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= floor)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]
