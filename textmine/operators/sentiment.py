"""Lexicon-based sentiment over token tables.

Labelling is an inner join with a lexicon (fan-out kept: a word with two
labels counts twice); trajectories are counts per (document, line bucket)
made wide with an explicit list of labels, so the pivot is a single
conditional aggregation with no value-discovery job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.functions.text import bucket
from textmine.operators.verbs import (
    as_list,
    bind_rows,
    count_by,
    join_lexicon,
    spread,
    top_n,
)

LABELS = ("negative", "positive")


def emotion_words(tokens: DataFrame, lex: DataFrame, emotion: str, label: str = "sentiment",
                  word: str = "word") -> DataFrame:
    """Counts of the words carrying one emotion, most frequent first."""
    chosen = lex.filter(F.col(label) == emotion)
    return count_by(join_lexicon(tokens, chosen, word), word, sort=True)


def sentiment_arc(tokens: DataFrame, lex: DataFrame, key: str | Sequence[str],
                  order: str = "line_no", size: int = 80, labels: Sequence[str] = LABELS,
                  label: str = "sentiment") -> DataFrame:
    """Per (key, ``order %/% size``) bucket: label counts (0 when absent)
    and ``sentiment = positive - negative``."""
    keys = as_list(key)
    labelled = join_lexicon(tokens, lex)
    counts = count_by(labelled, *keys, bucket(order, size).alias("index"), label)
    wide = spread(counts, label, "n", list(labels), fill=0)
    return wide.withColumn("sentiment", F.col(labels[1]) - F.col(labels[0]))


def valence_arc(tokens: DataFrame, lex: DataFrame, key: str | Sequence[str],
                order: str = "line_no", size: int = 80, value: str = "value") -> DataFrame:
    """Sum of word values per (key, bucket)."""
    keys = as_list(key)
    labelled = join_lexicon(tokens, lex)
    return labelled.groupBy(*keys, bucket(order, size).alias("index")).agg(
        F.sum(value).alias("sentiment"))


def compare_lexicons(tokens: DataFrame, valence: DataFrame, polarity: DataFrame,
                     emotion: DataFrame, key: str | Sequence[str], names: Sequence[str],
                     order: str = "line_no", size: int = 80) -> DataFrame:
    """Trajectories of three lexicons stacked with a ``method`` column that
    holds their ``names``.  The lexicons are stacked first, so the tokens
    are read, joined and aggregated once."""
    keys = as_list(key)
    labels = [lex.filter(F.col("sentiment").isin(*LABELS)).select("word", "sentiment", F.lit(name).alias("method"))
              for lex, name in zip((polarity, emotion), names[1:])]
    entries = bind_rows(valence.select("word", "value", F.lit(names[0]).alias("method")), *labels)
    found = join_lexicon(tokens.select(*keys, order, "word"), entries)
    sums = found.groupBy("method", *keys, bucket(order, size).alias("index")).agg(
        F.sum("value").alias("_value"),
        *[F.when(F.col("method") != names[0], F.count_if(F.col("sentiment") == label)).alias(label)
          for label in LABELS])
    return sums.select(*keys, "index", F.coalesce("_value", F.col("positive") - F.col("negative")).alias("sentiment"),
                       "method", *LABELS)


def lexicon_balance(lex: DataFrame, labels: Sequence[str] = LABELS, label: str = "sentiment") -> DataFrame:
    """Number of lexicon entries per label."""
    return count_by(lex.filter(F.col(label).isin(*labels)), label)


def sentiment_contrib(tokens: DataFrame, lex: DataFrame, k: int = 10,
                      by: str | Sequence[str] | None = None) -> DataFrame:
    """Word counts per label, top ``k`` words per label (ties kept)."""
    keys = as_list(by)
    counts = count_by(join_lexicon(tokens, lex), *keys, "word", "sentiment")
    return top_n(counts, k, "n", by=[*keys, "sentiment"])


def signed_contrib(triplets: DataFrame, lex: DataFrame, term: str = "term", wt: str = "count",
                   min_n: int = 200) -> DataFrame:
    """From count triplets: summed counts per (label, term) of at least
    ``min_n``, negated for the negative label."""
    labelled = join_lexicon(triplets, lex, (term, "word"))
    counts = count_by(labelled, "sentiment", term, wt=wt).filter(F.col("n") >= min_n)
    return counts.withColumn("n", F.when(F.col("sentiment") == "negative", -F.col("n")).otherwise(F.col("n")))


def comparison_terms(counts: DataFrame, k: int = 100, classes: Sequence[str] = LABELS,
                     word: str = "word", label: str = "sentiment", n: str = "n") -> DataFrame:
    """Words most over-represented in one class (comparison-cloud table).

    Each class column becomes a share of its column total; a word's score
    per class is its share minus its mean share over classes; the word goes
    to its best class and the ``k`` highest scores are kept (ties by word).
    Eager: the word x class table is checkpointed and its column totals
    (one number per class) are read once.
    """
    from textmine.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(counts.sparkSession)
    # the word x class table is read by one total per class and by the
    # scoring: compute it once
    wide = spread(counts.select(word, label, n), label, n, list(classes), fill=0).checkpoint(eager=True)
    totals = wide.agg(*[F.sum(c).alias(c) for c in classes]).first()
    scored = wide
    for c in classes:
        scored = scored.withColumn(f"_share_{c}", F.try_divide(F.col(c), F.lit(float(totals[c] or 0))))
    scored = scored.withColumn("_mean", sum(F.col(f"_share_{c}") for c in classes) / F.lit(len(classes)))
    for c in classes:
        scored = scored.withColumn(f"_diff_{c}", F.col(f"_share_{c}") - F.col("_mean"))
    scored = scored.withColumn("freq", F.greatest(*[F.col(f"_diff_{c}") for c in classes]))
    scored = scored.withColumn("group", F.coalesce(*[F.when(F.col(f"_diff_{c}") == F.col("freq"), F.lit(c))
                                                     for c in classes]))
    return scored.select(word, *classes, "freq", "group").orderBy(F.desc("freq"), word).limit(k)


def negative_ratio(tokens: DataFrame, negative: DataFrame, doc: str, section: str) -> DataFrame:
    """Share of negative words per (document, section), section 0 excluded;
    the section(s) with the highest share per document (ties kept)."""
    marked = tokens.join(negative.select("word", F.lit(1).alias("_neg")).distinct(), "word", "left")
    ratio = (marked.filter(F.col(section) != 0).groupBy(doc, section)
                   .agg(F.count("_neg").alias("negativewords"), F.count(F.lit(1)).alias("words"))
                   .filter(F.col("negativewords") > 0)
                   .withColumn("ratio", F.col("negativewords") / F.col("words")))
    return top_n(ratio, 1, "ratio", by=doc)
