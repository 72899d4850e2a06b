"""Word-frequency reports: counts without stop words, the most frequent
words, and frequencies compared across groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.functions.text import normalize_word
from textmine.operators.verbs import as_list, count_by, gather, remove_stop_words, share, spread
from textmine.sources.corpus import materialize


def word_freq(tokens: DataFrame, stop: DataFrame | None = None, by: str | Sequence[str] | None = None,
              word: str = "word", sort: bool = True) -> DataFrame:
    """Counts of words (per group), stop words removed when a list is given."""
    if stop is not None:
        tokens = remove_stop_words(tokens, stop, word)
    return count_by(tokens, *as_list(by), word, sort=sort)


def top_words(tokens: DataFrame, k: int = 100, stop: DataFrame | None = None,
              word: str = "word") -> DataFrame:
    """The ``k`` most frequent words (word-cloud input), ties at the cut
    broken by the word so the list is well defined."""
    counts = word_freq(tokens, stop, word=word, sort=False)
    return counts.orderBy(F.desc("n"), word).limit(k)


def compare_freq(tokens: DataFrame, group: str, baseline: str, word: str = "word",
                 normalize: bool = True) -> DataFrame:
    """Word shares per group, the baseline group as a column and the other
    groups (read from the data; rows without one take no part) stacked as
    ``(group, proportion)`` rows; a word missing from a group has a NULL
    share there.  Eager: the counts are computed once, then the groups read.
    """
    tokens = tokens.filter(F.col(group).isNotNull())
    if normalize:
        tokens = tokens.withColumn(word, normalize_word(word))
    props = share(materialize(count_by(tokens, group, word)), "n", by=group).drop("n")
    wide = spread(props, group, "proportion")
    if baseline not in wide.columns:
        wide = wide.withColumn(baseline, F.lit(None).cast("double"))
    return gather(wide, group, "proportion", [c for c in wide.columns if c not in (word, baseline)])
