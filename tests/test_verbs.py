import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import verbs as V
from textmine.sources import lexicons


def test_count_by_and_sort(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "word string")
    out = V.count_by(df, "word", sort=True)
    assert [tuple(r) for r in out.collect()] == [("a", 2), (None, 1), ("b", 1)] or \
        [tuple(r) for r in out.collect()][0] == ("a", 2)
    assert rows(out) == [(None, 1), ("a", 2), ("b", 1)]
    wt = spark.createDataFrame([("a", 3), ("a", 4), ("b", 1)], "term string, count long")
    assert rows(V.count_by(wt, "term", wt="count")) == [("a", 7), ("b", 1)]


def test_top_n_keeps_ties_and_uses_last_column(spark):
    df = spark.createDataFrame([("x", "a", 5), ("x", "b", 5), ("x", "c", 4), ("y", "d", None),
                                ("y", "e", 1)], "g string, word string, n long")
    assert rows(V.top_n(df, 1, by="g")) == [("x", "a", 5), ("x", "b", 5), ("y", "e", 1)]
    assert rows(V.top_n(df, 2, "n")) == [("x", "a", 5), ("x", "b", 5)]
    by_abs = spark.createDataFrame([("a", -9), ("b", 3), ("c", 8)], "w string, c long")
    assert rows(V.top_n(by_abs, 2, F.abs(F.col("c")))) == [("a", -9), ("c", 8)]


def test_share_sums_to_one_with_null_group(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), (None, "x", 2), (None, "z", 2)],
                               "g string, w string, n long")
    out = V.share(df, "n", by="g")
    sums = {}
    for r in out.collect():
        sums[r.g] = sums.get(r.g, 0) + r.proportion
    assert sums == {"a": 1.0, None: 1.0}
    whole = V.share(df, "n")
    assert abs(sum(r.proportion for r in whole.collect()) - 1.0) < 1e-12


def test_spread_gather_round_trip_is_complete(spark):
    df = spark.createDataFrame([("w1", "a", 1.0), ("w1", "b", 2.0), ("w2", "a", 3.0)],
                               "word string, author string, p double")
    wide = V.spread(df, "author", "p", ["a", "b"])
    assert rows(wide) == [("w1", 1.0, 2.0), ("w2", 3.0, None)]
    long = V.gather(wide, "author", "p", ["a", "b"])
    comp = V.complete(df, "word", "author")
    assert rows(long, "word", "author", "p") == rows(comp, "word", "author", "p")
    filled = V.spread(df, "author", "p", ["a", "b"], fill=0.0)
    assert rows(filled)[1] == ("w2", 3.0, 0.0)


def test_complete_keeps_duplicates_and_fills(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, "b", 1)], "year long, term string, count long")
    out = V.complete(df, "year", "term", fill={"count": 0})
    assert rows(out) == [(1, "a", 5), (1, "a", 6), (1, "b", 0), (2, "a", 0), (2, "b", 1)]


def test_block_product_equals_cross_product(spark):
    left = spark.createDataFrame([(i,) for i in range(23)], "a long")
    right = spark.createDataFrame([(f"t{j}",) for j in range(11)], "b string")
    out = V.block_product(left, right, block_rows=4)
    expected = sorted((i, f"t{j}") for i in range(23) for j in range(11))
    assert rows(out) == expected


def test_global_and_grouped_row_numbers(spark):
    random.seed(7)
    data = [(random.choice("abc"), random.randint(0, 30), f"w{i}") for i in range(500)]
    df = spark.createDataFrame(data, "g string, n long, w string").repartition(7)
    order = [F.desc("n"), F.col("w")]
    got = V.global_row_number(df, order, "rn")
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert rows(got, "g", "n", "w", "rn") == rows(exp, "g", "n", "w", "rn")
    got_g = V.row_number_by(df, "g", order, "rn")
    exp_g = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(got_g, "g", "n", "w", "rn") == rows(exp_g, "g", "n", "w", "rn")


def test_stop_word_joins_keep_nulls(spark):
    stop = lexicons.lexicon(spark, [("the",), ("of",)], ["word"])
    toks = spark.createDataFrame([("the",), ("cat",), (None,)], "word string")
    assert rows(V.remove_stop_words(toks, stop)) == [(None,), ("cat",)]
    grams = spark.createDataFrame([("the", "cat"), ("big", "cat"), (None, None), ("big", "of")],
                                  "word1 string, word2 string")
    assert rows(V.drop_stop_ngrams(grams, ["word1", "word2"], stop)) == [(None, None), ("big", "cat")]


def test_lexicon_join_fans_out_and_semi_join_does_not(spark):
    lex = lexicons.lexicon(spark, [("best", "joy"), ("best", "positive"), ("bad", "negative")],
                           ["word", "sentiment"])
    toks = spark.createDataFrame([(1, "best"), (2, "bad"), (3, "cat")], "id long, word string")
    assert rows(V.join_lexicon(toks, lex)) == [(1, "best", "joy"), (1, "best", "positive"),
                                              (2, "bad", "negative")]
    assert rows(V.keep_in_lexicon(toks, lex)) == [(1, "best"), (2, "bad")]
    renamed = spark.createDataFrame([("x", "best")], "word1 string, word2 string")
    assert rows(V.join_lexicon(renamed, lex, ("word2", "word")))[0] == ("x", "best", "joy")


def test_keep_frequent_and_non_ascii(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 1 + [("é",)] * 3, "word string")
    assert rows(V.keep_frequent(df, "word", 3)) == [("a",)] * 3 + [("é",)] * 3
    assert rows(V.drop_non_ascii(df)) == [("a",)] * 3 + [("b",)]


def test_separate_unite_bind_rows(spark):
    df = spark.createDataFrame([("Emma_12", 1), ("Persuasion_x", 2), ("solo", 3)], "document string, v long")
    sep = V.separate(df, "document", ["title", "chapter"], sep="_", convert={"chapter": "long"})
    assert sep.columns == ["title", "chapter", "v"]
    assert rows(sep) == [("Emma", 12, 1), ("Persuasion", None, 2), ("solo", None, 3)]
    united = V.unite(sep, "document", ["title", "chapter"], sep="_")
    assert rows(united)[0] == ("Emma_12", 1)
    a = spark.createDataFrame([(1, "x")], "index long, method string")
    b = spark.createDataFrame([(2, 5)], "index long, positive long")
    assert rows(V.bind_rows(a, b), "index", "method", "positive") == [(1, "x", None), (2, None, 5)]


def test_global_row_number_on_sampled_range_partitioning(spark):
    # large enough that range boundaries are sampled, not taken from all rows
    df = spark.range(0, 200_000, numPartitions=8).select(
        (F.col("id") * 7919 % 100_003).alias("k"), F.col("id").alias("id"))
    got = V.global_row_number(df, [F.col("k"), F.col("id")], "rn")
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")))
    assert got.join(exp, ["k", "id", "rn"], "left_anti").count() == 0
    assert got.count() == 200_000
