"""Term frequency, tf-idf and Zipf tables over count tables.

All three take a count table (``document, term, n``), never raw tokens, so
the expensive part (counting) is a partial aggregation and the rest works
on one row per (document, term).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmine.operators.verbs import as_list, group_total, hot_join, measured, null_safe_join, row_number_by


def term_share(counts: DataFrame, document: str | Sequence[str], n: str = "n",
               total: str = "total") -> DataFrame:
    """Attach each document's total count (``n / total`` is the term share)."""
    return group_total(counts, n, document, total)


#: Up to so many documents a term's rows are few enough to go through one window.
FEW_DOCUMENTS = 1000


def _few(counts: DataFrame, document: str) -> tuple[int, bool]:
    """The number of documents (a NULL key counts as one), and whether it is small."""
    n_docs = counts.select(document).distinct().count()
    return n_docs, n_docs <= FEW_DOCUMENTS


def bind_tf_idf(counts: DataFrame, term: str, document: str, n: str = "n", total: str | None = None) -> DataFrame:
    """Add ``tf``, ``idf`` and ``tf_idf``.

    tf = n / sum(n) in the document; idf = ln(documents / documents with the
    term), natural log, no smoothing; tf_idf = tf * idf.  ``total`` names a
    column that already holds the document's sum (dropped); else the sums are
    an aggregate joined back, computed and counted first (``measured``:
    broadcast only when small).  Documents with a term: with few documents
    (languages), whose terms may nearly all be rare, a window over the term's
    rows, one shuffle in all; else an aggregate joined back, of which the
    frequent terms are broadcast (``hot_join``).  Eager: the documents are counted.
    """
    n_docs, few = _few(counts, document)
    if total is None:
        total = "_tfidf_total"
        joined = null_safe_join(counts, measured(counts.groupBy(document).agg(F.sum(n).alias(total))), [document])
    else:
        joined = counts
    if few:
        joined = joined.withColumn("_tfidf_df", F.count(F.lit(1)).over(Window.partitionBy(term)))
    else:
        doc_freq = counts.groupBy(term).agg(F.count(F.lit(1)).alias("_tfidf_df"))
        joined = hot_join(joined, doc_freq, term, "_tfidf_df")
    tf = F.col(n) / F.col(total)
    idf = F.log(F.lit(n_docs) / F.col("_tfidf_df"))
    return (joined.withColumn("tf", tf)
                  .withColumn("idf", idf)
                  .withColumn("tf_idf", F.col("tf") * F.col("idf"))
                  .select(*[c for c in counts.columns if c != total], "tf", "idf", "tf_idf"))


def top_tf_idf(counts: DataFrame, term: str, document: str, n: str = "n", k: int = 15) -> DataFrame:
    """tf-idf of every (document, term) and the ``k`` highest per document
    (ties kept)."""
    from textmine.operators.verbs import top_n

    return top_n(bind_tf_idf(counts, term, document, n), k, "tf_idf", by=document)


def zipf(counts: DataFrame, by: str | Sequence[str] | None, term: str = "word",
         n: str = "n", total_by: str | Sequence[str] | None = None) -> DataFrame:
    """Zipf table: ``rank`` (1 = most frequent), ``total`` and
    ``term_frequency = n / total``.

    Ranks are numbered within ``by`` (the whole table when empty), ties in
    ``n`` broken by the ``total_by`` columns then the term; totals are per
    ``total_by`` (default: ``by``).  Ranks come from ``row_number_by`` (a
    range sort), so one large group is spread over many tasks.
    """
    by = as_list(by)
    total_by = by if total_by is None else as_list(total_by)
    if total_by:
        with_total = group_total(counts, n, total_by, "total")
    else:
        with_total = counts.withColumn("total", counts.select(F.sum(n)).scalar())
    order = [F.col(n).desc(), *[F.col(c).asc() for c in total_by if c not in by], F.col(term).asc()]
    ranked = row_number_by(with_total, by, order, "rank")
    return ranked.withColumn("term_frequency", F.col(n) / F.col("total"))


def top_by_first_appearance(scored: DataFrame, k: int, term: str, document: str,
                            weight: str = "tf_idf") -> DataFrame:
    """Top ``k`` terms per document where terms are ordered by their first
    appearance in the table sorted by ``weight`` descending (a factor level
    used as the weight): the term's best weight over all documents, then the
    first document holding that best weight, then the term.

    With few documents (languages) the best weight and its first document come
    from windows over the term's rows, which ``bind_tf_idf`` has put together;
    else they are aggregates joined back."""
    if _few(scored, document)[1]:
        of_term = Window.partitionBy(term)
        keyed = scored.withColumn("_best", F.max(weight).over(of_term)).withColumn(
            "_first_doc", F.min(F.when(F.col(weight) == F.col("_best"), F.col(document))).over(of_term))
        # as the join to the terms' first documents: a term without a weight goes
        return _first_by_best(keyed.filter(F.col("_best").isNotNull()), k, term, document).select(*scored.columns)
    best = scored.groupBy(term).agg(F.max(weight).alias("_best"))
    with_best = null_safe_join(scored, measured(best), [term])
    first_doc = (with_best.filter(F.col(weight) == F.col("_best"))
                          .groupBy(term).agg(F.min(document).alias("_first_doc")))
    keyed = null_safe_join(with_best, measured(first_doc), [term])
    return _first_by_best(keyed, k, term, document).select(*scored.columns)


def _first_by_best(keyed: DataFrame, k: int, term: str, document: str) -> DataFrame:
    window = Window.partitionBy(document).orderBy(F.desc("_best"), F.col("_first_doc"), F.col(term))
    return keyed.withColumn("_rk", F.row_number().over(window)).filter(F.col("_rk") <= k)


def term_trend(triplets: DataFrame, terms: Sequence[str], year: str = "year", term: str = "term",
               value: str = "count") -> DataFrame:
    """Counts of chosen terms in every year (0 where absent) with the
    year's total over all terms: ``year, term, count, year_total``.

    Same rows as completing the whole (year x term) grid, filling 0,
    totalling per year and then keeping ``terms``, but only the chosen terms
    are completed: the grid is (all years) x (chosen terms present), each
    year carrying the listed terms, so it takes no product join.
    """
    # one row per year
    year_totals = triplets.groupBy(year).agg(F.sum(value).alias("year_total"))
    chosen = measured(triplets.filter(F.col(term).isin(*terms)).select(year, term, value))
    listed = F.array(*[F.lit(t) for t in dict.fromkeys(terms)]).cast("array<string>")
    # at most one row per listed term
    present = F.broadcast(chosen.select(term).distinct())
    grid = triplets.select(year).distinct().select(year, F.explode(listed).alias(term)).join(present, term, "left_semi")
    filled = null_safe_join(grid, chosen, [year, term], "left") \
        .withColumn(value, F.coalesce(F.col(value), F.lit(0)))
    return null_safe_join(filled, measured(year_totals), [year]).select(year, term, value, "year_total")
