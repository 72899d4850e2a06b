"""A training corpus from raw documents, in five stages.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of
``documents``: rejected documents and copies are gone, secrets are replaced
in the text, and the mix repeats or leaves out documents.  The last stage
returns the token ids of every row in training order.

The stages are models, hash orders and tokenizers, which SQL cannot express;
``ORACLE_SQL`` is None and the stages are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine.llm import bpe, mixing, neardup, quality, secrets
from textmine.llm.common import crc_fold
from textmine.session import scratch_table
from textmine.sources import load

#: Documents scored below this are rejected.
GOOD = 0.7


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    net = quality.fit(docs, load(spark, sf_dir, "labels"), where=crc_fold("doc_id", 4) != 2)
    scored = quality.score(docs, net, out="_quality")
    return scored.filter(F.col("_quality") >= GOOD).drop("_quality")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5 words, 0.8)."""
    return neardup.deduplicate(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and sizes counted again."""
    found = secrets.scan(docs, spans="_spans", redacted="_clean")
    return found.select(*[F.col("_clean").alias("text") if c == "text" else
                          F.length("_clean").cast("long").alias("n_chars") if c == "n_chars" else F.col(c)
                          for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mix(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their byte ends for every row."""
    ranks = bpe.Ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, keep=["doc_id", "lang", "source"]).withColumn(
        "n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", good_documents),
    ("minhash near-dedup", distinct_documents),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("byte-level bpe", tokenized),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Each result but the last is written to
    the session's shared folder; a stage's input is deleted when its output
    is written, and everything when a stage fails.  The result reads the
    fourth stage's table, which ``session.release`` deletes with the
    session's other tables."""
    folder = scratch_table(spark)
    docs = load(spark, sf_dir, "documents")
    try:
        for i, (_, stage) in enumerate(STAGES[:-1]):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
            if i:
                _delete(spark, f"{folder}/{i - 1}")
    except Exception:
        _delete(spark, folder)
        raise
    return STAGES[-1][1](spark, docs, sf_dir)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
