import math

from conftest import rows
from textmine.operators import ngrams as NG
from textmine.operators import sentiment as SE
from textmine.operators import tfidf as TF
from textmine.sources import lexicons


def test_top_by_first_appearance_uses_best_weight_over_documents(spark):
    # "x y" is strongest in book B, so in book A it still outranks "p q"
    scored = spark.createDataFrame([
        ("A", "x y", 0.1), ("B", "x y", 0.9), ("A", "p q", 0.5), ("A", "r s", 0.2), ("B", "u v", 0.3)],
        "book string, bigram string, tf_idf double")
    top = TF.top_by_first_appearance(scored, 2, "bigram", "book", "tf_idf")
    assert rows(top, "book", "bigram") == [("A", "p q"), ("A", "x y"), ("B", "u v"), ("B", "x y")]
    top1 = TF.top_by_first_appearance(scored, 1, "bigram", "book", "tf_idf")
    assert rows(top1, "book", "bigram") == [("A", "x y"), ("B", "x y")]


def test_comparison_terms_scores_and_groups(spark):
    counts = spark.createDataFrame([("bad", "negative", 3), ("good", "positive", 1), ("ok", "negative", 1),
                                    ("ok", "positive", 3)], "word string, sentiment string, n long")
    out = {r.word: r for r in SE.comparison_terms(counts, k=2).collect()}
    # shares: negative bad .75 ok .25; positive good .25 ok .75
    assert set(out) == {"bad", "ok"}
    assert out["bad"].group == "negative" and math.isclose(out["bad"].freq, 0.375)
    assert out["ok"].group == "positive" and math.isclose(out["ok"].freq, 0.25)


def test_negation_contributions_and_cuts(spark):
    grams = spark.createDataFrame([("not", "good"), ("not", "good"), ("not", "bad"), ("no", "bad"),
                                   ("no", "fun"), ("very", "good")], "word1 string, word2 string")
    valence = lexicons.lexicon(spark, [("good", 3), ("bad", -3), ("fun", 1)], ["word", "value"],
                               schema="word string, value long")
    contrib = NG.negation_contrib(grams, valence, ["not", "no"])
    assert rows(contrib) == [("no", "bad", -3, 1, -3), ("no", "fun", 1, 1, 1), ("not", "bad", -3, 1, -3),
                             ("not", "good", 3, 2, 6)]
    assert [tuple(r) for r in NG.top_contrib(contrib, 2).collect()] == [("not", "good", 3, 2, 6),
                                                                       ("no", "bad", -3, 1, -3)]
    assert rows(NG.top_contrib_by(contrib, 1), "word1", "word2") == [("no", "bad"), ("not", "good")]
