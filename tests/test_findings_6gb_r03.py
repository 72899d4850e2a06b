"""Work that grew too fast towards 6 GB (F20-F36): each test failed before
its mending."""

import pytest
from pyspark.sql import functions as F

from textmine.operators import tfidf as TF
from textmine.operators import tokens as tok
from textmine.operators import topic_fit as FIT
from textmine.operators import topics as TM
from textmine.operators import verbs as V
from textmine.plans import QUERIES
from textmine.plans import queries as PQ
from textmine.sources import corpus
from textmine.sources import matrix as M
from tests.conftest import SF, rows
from tests.test_findings_r03 import stored_bytes


@pytest.fixture
def few_broadcast(monkeypatch):
    """As with a vocabulary far beyond what is broadcast."""
    monkeypatch.setattr(V, "BROADCAST_ROWS", 3)


def zipf_words(spark, n=60):
    return spark.createDataFrame([(f"w{i:02d}", j) for i in range(n) for j in range(2 + 200 // (i + 1))]
                                 + [(None, 1), (None, 2), (None, 3)], "word string, at int")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_f25_rows_of_frequent_words_are_not_shuffled(spark, few_broadcast):
    df = zipf_words(spark)
    got = V.keep_frequent(df, "word", 3)
    assert "LeftAnti" in plan(got) and "strategy=broadcast" in plan(got)
    want = df.groupBy("word").count().filter("count >= 3").collect()
    assert got.count() == sum(r["count"] for r in want) and {r["word"] for r in got.collect()} == {r["word"] for r in want}


def test_f25_hot_and_cold_share_out_every_row(spark):
    side = spark.createDataFrame([(f"w{i}", 1.0 / (i + 1) if i % 7 else None) for i in range(500)],
                                 "word string, w double")
    for limit in (0, 1, 50, 499, 500):
        hot, cold = V.hot_and_cold(side, "w", limit)
        both = hot if cold is None else hot.unionByName(cold)
        assert hot.count() <= limit and rows(both, "word") == rows(side, "word")
        assert (cold is None) == (limit == 500)


def test_f24_document_counts_take_one_shuffle_of_texts(spark, few_broadcast):
    counted = V.count_by(PQ.words_by_doc(spark, SF), "doc_id", "word")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in counted.splitlines() if "Exchange" in line]
    assert len(dealt) == 1 and "hashpartitioning(doc_id" in dealt[0] and "word" not in dealt[0]
    counts = spark.createDataFrame([(d, f"w{w}", 1 + w, 36) for d in range(1200) for w in range(8)],
                                   "doc long, word string, n long, all long")
    got = TF.bind_tf_idf(counts, "word", "doc", "n", total="all")
    assert got.columns == ["doc", "word", "n", "tf", "idf", "tf_idf"]
    assert got.count() == 9600 and got.agg(F.max("idf")).first()[0] == 0
    assert rows(got, "doc", "word", "tf") == rows(TF.bind_tf_idf(counts.drop("all"), "word", "doc", "n"), "doc", "word", "tf")


def test_f30_f26_terms_of_few_documents_take_one_shuffle(spark):
    counts = corpus.materialize(spark.createDataFrame(
        [("en", "a b", 3), ("de", "a b", 1), ("en", "c d", 2), (None, "c d", 1), ("de", None, 4)],
        "lang string, bigram string, n long"))
    scored = TF.bind_tf_idf(counts, "bigram", "lang", "n")
    assert exchanges(scored) == 1
    assert {(r["lang"], r["bigram"]): round(r["idf"], 6) for r in scored.collect()} == {
        ("en", "a b"): 0.405465, ("de", "a b"): 0.405465, ("en", "c d"): 0.405465, (None, "c d"): 0.405465,
        ("de", None): 1.098612}
    top = TF.top_by_first_appearance(scored, 1, "bigram", "lang")
    assert exchanges(top) == 2  # by term, then by language
    assert rows(top, "lang", "bigram") == [(None, "c d"), ("de", None), ("en", "c d")]


def test_f27_cells_of_frequent_terms_are_not_shuffled_for_the_vocabulary(spark, few_broadcast):
    trip = zipf_words(spark).filter("word is not null").select(
        F.col("at").alias("document"), F.col("word").alias("term"), (F.col("at") + 1).alias("count"))
    vectors, vocab, size = M.cast_dtm(trip)
    back = M.tidy_dtm(vectors, vocab)
    assert size == 60 and "strategy=broadcast" in plan(back)
    assert [(d, t, int(c)) for d, t, c in rows(back, "document", "term", "count")] == rows(trip, "document", "term", "count")


def test_f34_word_arrays_are_stored_once(spark):
    lines = spark.range(400).select(F.lit(1).alias("doc_id"), F.col("id").alias("line_no"),
                                    F.repeat(F.lit("some words here "), 200).alias("text"))
    before = stored_bytes(spark)
    got = tok.line_ngrams(lines, "doc_id", n=3, output="gram", position="pos")
    assert stored_bytes(spark) - before < 500_000
    assert got.count() == 400 * 600 - 2 and got.agg(F.max("pos")).first()[0] == 400 * 600 - 2


def test_f20_confusion_goes_through_the_cells_once(spark):
    cells = spark.createDataFrame([("en_1", "a", 2, 1), ("en_1", "b", 1, 2), ("de_2", "a", 5, 2)],
                                  "document string, term string, count long, assigned_topic long")
    books = spark.createDataFrame([("en", 1), ("de", 2)], "consensus string, topic long")
    got = TM.confusion(cells, books)
    assert "assigned_topic" not in plan(got)
    assert rows(got) == [("de", "de", 5, 1.0), ("en", "de", 1, 1 / 3), ("en", "en", 2, 2 / 3)]


def test_f21_blocks_are_packed_without_collected_rows(spark):
    trip = spark.createDataFrame([("b", "y", 2), ("a", "x", 1), ("b", "y", 3), ("b", "w", 1), (None, "x", 1)],
                                 "document string, term string, count long")
    blocks = FIT.packed(trip)
    got = [tuple(r) for r in blocks.collect()]
    assert got == [(0, ["a", "b"], [0, 1, 1], ["w", "x", "y"], [1, 0, 2], [1, 1, 5])]
    seen = []
    real = FIT.materialize
    FIT.materialize = lambda df: seen.append(df) or real(df)
    try:
        FIT.packed(trip)
    finally:
        FIT.materialize = real
    assert "collect_list" not in plan(seen[0])


@pytest.mark.parametrize("name", ["topic_top_terms", "topic_log_ratio", "topic_classify", "topic_misclassified",
                                  "topic_consensus", "topic_order", "gamma_five_number", "topic_augment",
                                  "topic_wrong_words"])
def test_topic_queries_alike_with_a_vocabulary_too_large_to_broadcast(spark, monkeypatch, name):
    whole = rows(QUERIES[name](spark, SF))
    monkeypatch.setattr(V, "BROADCAST_ROWS", 50)
    assert rows(QUERIES[name](spark, SF)) == whole


def test_topic_cells_of_frequent_terms_stay_where_they_are(spark, few_broadcast):
    trip, beta, gamma = PQ.lang_model(spark, SF)
    got = TM.augment(trip, beta, gamma, distinct=True)
    assert "LeftAnti" in plan(got)
    assert rows(got) == rows(TM.augment(trip, beta, gamma))
    assert PQ.named_once(spark, SF)
