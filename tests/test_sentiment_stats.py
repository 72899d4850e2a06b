import math
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import sentiment as SE
from textmine.operators import stats as S
from textmine.sources import lexicons


def tokens(spark):
    data = [(1, 1, "good"), (1, 2, "bad"), (1, 85, "good"), (1, 90, "best"), (2, 3, "bad"),
            (2, 4, "cat")]
    return spark.createDataFrame(data, "book long, line_no long, word string")


def polarity(spark):
    return lexicons.lexicon(spark, [("good", "positive"), ("best", "positive"), ("bad", "negative")],
                            ["word", "sentiment"])


def test_sentiment_arc_fills_absent_side_with_zero(spark):
    out = SE.sentiment_arc(tokens(spark), polarity(spark), "book", size=80)
    assert rows(out) == [(1, 0, 1, 1, 0), (1, 1, 0, 2, 2), (2, 0, 1, 0, -1)]


def test_lexicon_balance_and_contrib(spark):
    lex = polarity(spark)
    assert rows(SE.lexicon_balance(lex)) == [("negative", 1), ("positive", 2)]
    contrib = SE.sentiment_contrib(tokens(spark), lex, k=1)
    assert rows(contrib) == [("bad", "negative", 2), ("good", "positive", 2)]


def test_negative_ratio_keeps_ties_and_skips_section_zero(spark):
    data = [(1, 0, "bad"), (1, 1, "bad"), (1, 1, "cat"), (1, 2, "bad"), (1, 2, "dog")]
    df = spark.createDataFrame(data, "book long, chapter long, word string")
    neg = lexicons.lexicon(spark, [("bad", "negative")], ["word", "sentiment"])
    assert rows(SE.negative_ratio(df, neg, "book", "chapter")) == [(1, 1, 1, 2, 0.5), (1, 2, 1, 2, 0.5)]


def test_cor_test_and_p_value(spark):
    random.seed(1)
    data = [(float(x), 2 * x + random.gauss(0, 3)) for x in range(50)]
    df = spark.createDataFrame(data, "x double, y double")
    r = S.cor_test_p(df, "x", "y").first()
    assert math.isclose(r.estimate, np.corrcoef(*zip(*data))[0, 1], rel_tol=1e-9)
    assert r.n == 50 and r.parameter == 48
    assert r.conf_low < r.estimate < r.conf_high


def test_five_number_matches_numpy(spark):
    random.seed(2)
    data = [(g, random.random()) for g in "abc" for _ in range(random.randint(1, 40))]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r for r in S.five_number(df, "x", by="g").collect()}
    for g in "abc":
        xs = [x for k, x in data if k == g]
        q = np.percentile(xs, [0, 25, 50, 75, 100])
        r = got[g]
        assert np.allclose([r.minimum, r.lower, r.middle, r.upper, r.maximum], q, rtol=1e-12)


def test_histogram_and_fits(spark):
    df = spark.createDataFrame([(0.0,), (0.00001,), (0.00089,), (0.0009,), (0.5,)], "x double")
    assert rows(S.histogram(df, "x", bins=30, hi=0.0009)) == [(0, 2), (29, 2)]
    pts = spark.createDataFrame([(float(r), 10.0 / r) for r in range(1, 20)], "rank double, tf double")
    fit = S.loglog_fit(pts, "tf", "rank").first()
    assert math.isclose(fit.slope, -1.0, abs_tol=1e-12) and math.isclose(fit.intercept, 1.0, abs_tol=1e-12)
    tr = S.trend(pts.withColumn("y", F.col("rank") * 2 + 1), "y", "rank").first()
    assert math.isclose(tr.slope, 2.0) and math.isclose(tr.intercept, 1.0)
