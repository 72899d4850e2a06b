from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import tokens as tok
from textmine.operators import verbs as V

BOAT = ["A small boat left the Harbour -",
        "rain fell on it all day -",
        "The Crew sang, but nobody on Shore heard",
        "and Evening came"]


def boat_df(spark):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(BOAT)], "line long, text string")


def test_words_of_lines(spark):
    out = tok.unnest_tokens(boat_df(spark), "word", "text", position="pos")
    assert out.columns == ["line", "pos", "word"]
    got = [r.word for r in out.orderBy("line", "pos").collect()]
    assert got == ["a", "small", "boat", "left", "the", "harbour",
                   "rain", "fell", "on", "it", "all", "day",
                   "the", "crew", "sang", "but", "nobody", "on", "shore", "heard",
                   "and", "evening", "came"]


def test_words_keep_apostrophes_and_underscores(spark):
    df = spark.createDataFrame([(1, "Don't say _k_ 3.14, rock’n’roll!")], "id long, text string")
    got = [r.word for r in tok.unnest_tokens(df, "word").collect()]
    assert got == ["don't", "say", "_k_", "3", "14", "rock’n’roll"]


def test_empty_and_letterless_text_give_no_rows(spark):
    df = spark.createDataFrame([(1, ""), (2, " -- !"), (3, None)], "id long, text string")
    assert tok.unnest_tokens(df, "word").count() == 0


def test_bigrams_cross_line_breaks_and_short_text(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (2, "alone"), (3, "")], "id long, text string")
    out = tok.unnest_tokens(df, "bigram", "text", "ngrams", n=2, position="pos")
    assert rows(out) == [(1, 1, "a b"), (1, 2, "b c"), (2, 1, None), (3, 1, None)]
    cols = tok.unnest_tokens(df, "g", "text", "ngrams", n=3, into=["word1", "word2", "word3"])
    assert rows(cols) == [(1, "a", "b", "c"), (2, None, None, None), (3, None, None, None)]
    dropped = tok.unnest_tokens(df, "g", "text", "ngrams", n=2, keep_short=False)
    assert dropped.count() == 2


def test_sentences_and_regex_pieces(spark):
    df = spark.createDataFrame([(1, "One two. Three!\nFour")], "id long, text string")
    sents = tok.unnest_tokens(df, "s", "text", "sentences", position="i")
    assert rows(sents) == [(1, 1, "one two."), (1, 2, "three!"), (1, 3, "four")]
    df2 = spark.createDataFrame([(1, "Chapter 1 Alpha Chapter 2 Beta")], "id long, text string")
    pieces = tok.unnest_tokens(df2, "c", "text", "regex", pattern="Chapter \\d")
    assert [r.c for r in pieces.collect()] == ["alpha", "beta"]


def lines_df(spark, n_docs=3, n_lines=25):
    data = []
    for d in range(n_docs):
        for i in range(1, n_lines + 1):
            text = "Chapter %d" % i if i % 7 == 3 else "line %d of %d" % (i, d)
            data.append((d, i, text))
    return spark.createDataFrame(data, "doc long, line_no long, text string")


def test_segment_by_marker_matches_window_cumsum(spark):
    df = lines_df(spark)
    expected = df.withColumn("chapter", F.sum(F.col("text").rlike("(?i)^chapter ").cast("long")).over(
        Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    for chunk in (4, 65536):  # small chunks exercise the two-level prefix sum
        got = tok.segment_by_marker(df, "^chapter ", by="doc", chunk=chunk)
        assert rows(got) == rows(expected)
    first = tok.segment_by_marker(df, "^chapter ", by="doc").filter("line_no < 3")
    assert {r.chapter for r in first.collect()} == {0}


def test_sections_drop_first_nine_lines(spark):
    out = tok.section_by_lines(lines_df(spark, 1, 25), 10)
    assert min(r.line_no for r in out.collect()) == 10
    assert {r.section for r in out.collect()} == {1, 2}


def test_collapse_tokens_in_order(spark):
    df = spark.createDataFrame([(1, 2, 1, "c"), (1, 1, 2, "b"), (1, 1, 1, "a"), (2, 1, 1, "z")],
                               "doc long, line_no long, pos long, word string")
    out = tok.collapse_tokens(df, "doc", ["line_no", "pos"])
    assert rows(out) == [(1, "a b c"), (2, "z")]


def test_collapse_in_two_levels_equals_one(spark):
    # document 1 in many pieces; nulls: words are left out, orders come first
    df = spark.createDataFrame(
        [(1, i, p, None if i % 7 == 3 else f"w{i}.{p}") for i in range(400) for p in (2, 1)]
        + [(1, None, 1, "first"), (2, 9, 1, None), (2, 5, 1, None), (None, 1, 1, "x"), (3, -5, 1, "b"), (3, -50, 1, "a"),
           (3, 0, 1, "c"), (4, 1, 1, "same"), (4, 1, 1, "same")], "doc long, line_no long, pos long, word string")
    long = " ".join(["first", *(f"w{i}.{p}" for i in range(400) if i % 7 != 3 for p in (1, 2))])
    expected = {(1, long), (2, ""), (None, "x"), (3, "a b c"), (4, "same same")}
    for chunk in (1, 7, 50, 4096):
        out = tok.collapse_tokens(df, "doc", ["line_no", "pos"], chunk=chunk)
        assert set(map(tuple, out.collect())) == expected
    named = df.withColumn("line_no", F.concat(F.lit("n"), "line_no")).filter("doc = 3")
    assert tok.collapse_tokens(named, "doc", ["line_no", "pos"]).first()["text"] == "b a c"
    lines = df.filter("doc = 1 and pos = 1").select("doc", "line_no", F.col("word").alias("text"))
    assert rows(tok.collapse_lines(lines, ["doc"], "line_no", chunk=8)) == [(1, long_lines())]
    assert tok.collapse_tokens(df.limit(0), "doc", ["line_no"]).count() == 0


def long_lines():
    return "\n".join(["first", *(f"w{i}.1" for i in range(400) if i % 7 != 3)])


def test_collapse_gathers_pieces_not_documents(spark):
    df = spark.range(300_000).select(F.lit(1).alias("doc"), "id", F.lit("abc").alias("word"))
    out = tok.collapse_tokens(df, "doc", ["id"], chunk=1000)
    assert out.select(F.length("text")).first()[0] == 300_000 * 4 - 1
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate [") == 2 and "collect_list" in text  # rows of a piece, then pieces of a document


def test_running_sum_many_groups(spark):
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("g"), (F.col("id") + 1).alias("i"),
                                     (F.col("id") % 5).alias("v"))
    got = V.running_sum(df, "v", "g", "i", "cs", chunk=37)
    exp = df.withColumn("cs", F.sum("v").over(Window.partitionBy("g").orderBy("i")
                                              .rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(got) == rows(exp)


def test_bucket_zero_has_79_lines(spark):
    from textmine.functions.text import bucket

    df = spark.range(1, 200).select(F.col("id").alias("line_no"))
    counts = {r.b: r.n for r in df.groupBy(bucket("line_no", 80).alias("b")).count()
              .withColumnRenamed("count", "n").collect()}
    assert counts[0] == 79 and counts[1] == 80


def test_collapse_lines_before_ngrams(spark):
    lines = spark.createDataFrame([(1, 2, "c d"), (1, 1, "a b"), (2, 1, "x")],
                                  "doc long, line_no long, text string")
    per_line = tok.unnest_tokens(lines, "bigram", "text", "ngrams", n=2)
    assert "b c" not in {r.bigram for r in per_line.collect()}
    collapsed = tok.unnest_tokens(lines, "bigram", "text", "ngrams", n=2, collapse=["doc"], position="pos")
    assert rows(collapsed) == [(1, 1, "a b"), (1, 2, "b c"), (1, 3, "c d"), (2, 1, None)]


def test_spread_only_when_too_few_splits(spark):
    from textmine.sources import corpus

    one = spark.range(100).coalesce(1)
    assert corpus.spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100, numPartitions=6)
    assert corpus.spread(many, 4).rdd.getNumPartitions() == 6


def test_number_lines_within_documents(spark):
    df = spark.createDataFrame([(1, 30, "c"), (1, 10, "a"), (2, 5, "z"), (1, 20, "b")],
                               "doc long, offset long, text string")
    out = tok.number_lines(df, "doc", [F.col("offset")])
    assert rows(out, "doc", "text", "line_no") == [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "z", 1)]


def test_line_ngrams_match_document_ngrams(spark):
    import random

    random.seed(11)
    vocab = ["a", "b", "c", "d", "e"]
    data = []
    for doc in range(6):
        for ln in range(1, random.randint(1, 12)):
            words = " ".join(random.choice(vocab) for _ in range(random.choice([0, 0, 1, 2, 5])))
            data.append((doc, ln, words))
    lines = spark.createDataFrame(data, "doc long, line_no long, text string")
    for n in (2, 3):
        for chunk in (3, 65536):
            got = tok.line_ngrams(lines, "doc", n=n, position="pos", chunk=chunk)
            exp = tok.unnest_tokens(lines, "ngram", "text", "ngrams", n=n, collapse=["doc"], position="pos")
            assert rows(got, "doc", "pos", "ngram") == rows(exp, "doc", "pos", "ngram")
