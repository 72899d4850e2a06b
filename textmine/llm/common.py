"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textmine.session import ensure_checkpoint_dir, ship_package

#: Bytes of text that one Python step works on at once; a single longer text
#: is worked on alone.
SLICE_BYTES = 2_000_000


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the session's checkpoint folder,
    which all executors share; Spark's cleaner removes it when unreferenced
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def slices(batch: pa.RecordBatch, column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes in
    ``column`` (or one row, where that alone is longer)."""
    if not batch.num_rows:
        return
    sizes = batch.column(column)
    sizes = sizes.cast(pa.large_binary()) if not pa.types.is_list(sizes.type) else sizes
    offsets = np.frombuffer(sizes.buffers()[1], np.int64 if sizes.type == pa.large_binary() else np.int32)
    offsets = offsets[sizes.offset:sizes.offset + batch.num_rows + 1].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def add_columns(df: DataFrame, column: str, fields: str | T.StructType,
                make: Callable[[pa.Array], list[pa.Array]],
                keep: Sequence[str] | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from ``column`` in Arrow batches.

    ``make`` gets the values of one slice and returns one Arrow array per
    field of ``fields`` (a DDL string).
    ``keep`` names the input columns carried along (default: all); a carried
    column whose name equals an output column gives way to the output.
    """
    ship_package(df.sparkSession)
    new = T._parse_datatype_string(fields) if isinstance(fields, str) else fields
    names = {f.name for f in new.fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    at = kept.index(column) if column in kept else len(kept)
    source = df.select(*[F.col(f"`{c}`") for c in kept],
                       *[F.col(f"`{column}`").alias("_value")] * (at == len(kept)))
    width = len(kept)
    schema = T.StructType([*source.schema.fields[:width], *new.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, limit):
                made = make(part.column(at))
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) for a, f in zip([*part.columns[:width], *made], arrow, strict=True)],
                    schema=arrow)

    return source.mapInArrow(run, schema)


def crc_fold(key: str, folds: int):
    """crc32 of a key written as text, modulo ``folds`` (null key: null)."""
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % F.lit(folds)
