"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.session import ship_package


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, carry: Sequence[str],
                    where: Column | None, rows_per_class: int) -> DataFrame:
    """``label, text`` and the ``carry`` columns of about ``rows_per_class``
    documents of each label.

    The label rows are reduced to one per key (the larger label) and drawn by
    a hash of the key before the join, so the joined side has at most about
    ``2 * rows_per_class`` rows whatever the size of the tables; a repeated
    document counts once.  ``where`` is a condition on the key.
    """
    ship_package(docs.sparkSession)
    known = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter(F.col(f"`{key}`").isNotNull() & F.col("label").isNotNull())
    if where is not None:
        known = known.filter(where)
    known = known.groupBy(F.col(f"`{key}`")).agg(F.max("label").alias("label"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in sorted(totals.items()):
        share = F.when(F.col("label") == value, F.lit(min(1.0, rows_per_class / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(draw < share)
    body = docs.select(F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                       *[F.col(f"`{c}`") for c in carry])
    return body.join(F.broadcast(chosen), key).dropDuplicates([key]).drop(key)
