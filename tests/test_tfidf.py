import math

from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import tfidf as TF


def counts_df(spark):
    data = [("A", "the", 10), ("A", "cat", 3), ("B", "the", 5), ("B", "dog", 5), ("C", "the", 1),
            ("C", "cat", 1)]
    return spark.createDataFrame(data, "book string, word string, n long")


def test_tf_idf_formula_and_zero_for_ubiquitous_terms(spark):
    out = {(r.book, r.word): r for r in TF.bind_tf_idf(counts_df(spark), "word", "book").collect()}
    assert out[("A", "the")].idf == 0.0 and out[("A", "the")].tf_idf == 0.0
    assert math.isclose(out[("A", "cat")].tf, 3 / 13)
    assert math.isclose(out[("A", "cat")].idf, math.log(3 / 2))
    assert math.isclose(out[("B", "dog")].tf_idf, 0.5 * math.log(3))


def test_tf_sums_to_one_per_document(spark):
    out = TF.bind_tf_idf(counts_df(spark), "word", "book")
    sums = out.groupBy("book").agg(F.sum("tf").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)


def test_null_document_counts_as_one_document(spark):
    df = spark.createDataFrame([(None, "x", 1), ("a", "y", 1)], "doc string, word string, n long")
    out = {r.word: r.idf for r in TF.bind_tf_idf(df, "word", "doc").collect()}
    assert math.isclose(out["x"], math.log(2))


def test_zipf_ranks(spark):
    z = TF.zipf(counts_df(spark), by="book")
    assert rows(z, "book", "word", "rank") == [("A", "cat", 2), ("A", "the", 1), ("B", "dog", 1),
                                               ("B", "the", 2), ("C", "cat", 1), ("C", "the", 2)]
    g = TF.zipf(counts_df(spark), by=None, total_by="book")
    assert sorted(r["rank"] for r in g.collect()) == list(range(1, 7))
    first = g.filter("rank = 1").first()
    assert (first.book, first.word, first.term_frequency) == ("A", "the", 10 / 13)


def test_term_trend_fills_zero_and_keeps_totals(spark):
    trip = spark.createDataFrame([(1, "god", 2), (1, "war", 3), (2, "war", 1), (3, "peace", 4)],
                                 "year long, term string, count long")
    out = TF.term_trend(trip, ["god", "war"])
    assert rows(out) == [(1, "god", 2, 5), (1, "war", 3, 5), (2, "god", 0, 1), (2, "war", 1, 1),
                         (3, "god", 0, 4), (3, "war", 0, 4)]
