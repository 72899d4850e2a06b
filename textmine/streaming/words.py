"""Word counts over a stream of documents.

Tokenising, stop-word removal and lexicon labelling are stateless, so the
same operators run unchanged on a streaming DataFrame; the count is
Structured Streaming's stateful aggregation.  The stop list is a static
table (stream-static anti join).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textmine.operators.tokens import unnest_tokens
from textmine.operators.verbs import count_by, remove_stop_words
from textmine.session import ensure_checkpoint_dir


def document_stream(spark: SparkSession, folder: str, schema: str, glob: str = "*.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` (names matching ``glob``) as a
    stream of documents; each batch takes all new files, or as many as
    ``max_files_per_trigger`` says."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def stream_word_counts(docs: DataFrame, stop: DataFrame, text: str = "text",
                       by: Sequence[str] = ("lang",)) -> DataFrame:
    """Running counts of non-stop words per group."""
    words = remove_stop_words(unnest_tokens(docs.select(*by, text), "word", text), stop)
    return count_by(words, *by, "word")


def run_available(df: DataFrame, path: str, mode: str = "complete",
                  checkpoint: str | None = None) -> tuple[StreamingQuery, DataFrame]:
    """Process everything available into the Parquet table ``path`` (shared
    storage) and stop; returns the finished query and the table.

    ``complete`` replaces the table with each batch's whole result;
    ``append`` keeps one folder per batch.  A batch that runs again after a
    failure replaces what it wrote before.  Nothing passes through the
    driver.  The stream's checkpoint goes under the session's checkpoint
    folder unless ``checkpoint`` names a place: name one to go on later.
    """
    if mode not in ("complete", "append"):
        raise ValueError("mode must be 'complete' or 'append'")
    spark = df.sparkSession
    location = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    spark.createDataFrame([], df.schema).write.mode("ignore").parquet(path if mode == "complete" else f"{path}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    query = (df.writeStream.foreachBatch(write).outputMode(mode)
             .option("checkpointLocation", location)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query, spark.read.parquet(path).select(*df.columns)
