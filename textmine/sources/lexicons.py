"""Lexicon and stop-word tables.

Lexicons built from in-memory rows have a size known before any job runs,
so a small one (up to ``HINT_ROWS``) carries a broadcast hint.
Lexicons read from storage carry no hint: the planner sizes them from file
statistics and adaptive execution re-checks the real size at run time,
falling back to a sort-merge join when the table is large.
"""

from __future__ import annotations

import glob
import os
import zipfile
from collections.abc import Iterable, Sequence
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# In-memory lexicons up to this many rows carry a broadcast hint; larger ones
# are planned from their size like any other table.
HINT_ROWS = 5_000

LANGUAGES = {"en": "english", "de": "german", "fr": "french", "es": "spanish"}


def _language(lang: str) -> str:
    return LANGUAGES.get(lang, lang)


def stop_words(spark: SparkSession, langs: Iterable[str] = ("en",)) -> DataFrame:
    """``(word, lexicon)`` rows from Spark's built-in stop-word lists.

    The lists are a few hundred words each, so the result is broadcast.
    """
    from pyspark.ml.feature import StopWordsRemover

    rows = []
    for lang in langs:
        name = _language(lang)
        rows.extend((w, name) for w in StopWordsRemover.loadDefaultStopWords(name))
    return lexicon(spark, rows, ["word", "lexicon"])


def _mllib_jar() -> str | None:
    """The MLlib jar of this Spark install: under SPARK_HOME or in a ``jars``
    folder beside any parent of the pyspark package (which may itself be
    loaded from a zip inside that install)."""
    import pyspark

    here = os.path.abspath(pyspark.__file__)
    homes = [os.environ.get("SPARK_HOME", "")]
    while here != os.path.dirname(here):
        here = os.path.dirname(here)
        homes.append(here)
    for home in filter(None, homes):
        found = sorted(glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar")))
        if found:
            return found[0]
    return None


@lru_cache(maxsize=None)
def default_stop_words(lang: str) -> tuple[str, ...]:
    """The same built-in list without needing a session: read from the MLlib
    jar, or through a running session where the jar is not on this machine.
    Used only to write the equivalent SQL."""
    name = _language(lang)
    jar = _mllib_jar()
    if jar:
        with zipfile.ZipFile(jar) as z:
            text = z.read(f"org/apache/spark/ml/feature/stopwords/{name}.txt").decode("utf-8")
        return tuple(w for w in text.split("\n") if w)
    from pyspark.ml.feature import StopWordsRemover

    SparkSession.builder.getOrCreate()
    return tuple(StopWordsRemover.loadDefaultStopWords(name))


def lexicon(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str],
            schema: str | None = None) -> DataFrame:
    """A lexicon from in-memory rows; a small one carries a broadcast hint,
    a larger one leaves the join strategy to the planner."""
    rows = list(rows)
    df = spark.createDataFrame(rows, schema=schema or list(columns))
    return F.broadcast(df) if len(rows) <= HINT_ROWS else df


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon stored as parquet; join strategy left to the planner/AQE."""
    return spark.read.parquet(path)


def extend_lexicon(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Stack extra entries on top of a lexicon, by column name."""
    return extra.unionByName(base, allowMissingColumns=True)
