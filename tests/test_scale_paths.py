"""The same results by every path: listed items and a lower bound against
all pairs, counted sides broadcast or merged, groups read from the data."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_pairwise import brute_counts, random_sections
from textmine.operators import frequency as FQ
from textmine.operators import pairwise as P
from textmine.operators import stats as S
from textmine.operators import tfidf as TF
from textmine.operators import topics as TM
from textmine.operators import verbs as V
from textmine.session import release, scratch_table
from textmine.sources import matrix as M


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pair_counts_of_listed_items(spark):
    data = random_sections(seed=9)
    df = spark.createDataFrame(data, "word string, section long")
    expected = sorted((a, b, n) for (a, b), n in brute_counts(data).items() if a in ("w1", "w7"))
    for block in (3, 2048):
        got = P.pairwise_count(df, "word", "section", block_items=block, items=["w1", "w7", "absent"])
        assert rows(got) == expected


def test_correlations_of_listed_items_and_above_a_bound(spark):
    df = spark.createDataFrame(random_sections(seed=11, hot=0), "word string, section long")
    whole = [r for r in rows(P.pairwise_cor(df, "word", "section"))]
    listed = rows(P.pairwise_cor(df, "word", "section", items=["w3"], block_items=4))
    assert [r[:2] for r in listed] == [r[:2] for r in whole if r[0] == "w3"]
    assert np.allclose([r[2] for r in listed], [r[2] for r in whole if r[0] == "w3"])
    above = rows(P.pairwise_cor(df, "word", "section", min_cor=0.1))
    assert [r[:2] for r in above] == [r[:2] for r in whole if r[2] is not None and r[2] > 0.1]
    with pytest.raises(ValueError):
        P.pairwise_cor(df, "word", "section", min_cor=-0.5)


def test_null_items_and_features_take_no_part_in_pairs(spark):
    clean = [("a", 1), ("b", 1), ("a", 2), ("c", 3), ("b", 2)]
    df = spark.createDataFrame([*clean, ("a", None), ("b", None), (None, 1)], "word string, section long")
    base = spark.createDataFrame(clean, "word string, section long")
    for op in (P.pairwise_count, P.pairwise_cor):
        assert rows(op(df, "word", "section")) == rows(op(base, "word", "section"))
    empty = base.filter("false")
    assert P.pairwise_count(empty, "word", "section").count() == 0
    assert P.pairwise_cor(empty, "word", "section", items=["a"]).count() == 0


def test_counted_sides_are_broadcast_or_merged_with_equal_rows(spark, monkeypatch):
    counts = spark.createDataFrame([(d, f"w{(d * 7 + i) % 11}", i + 1) for d in range(6) for i in range(8)],
                                   "doc long, word string, n long")
    small = TF.bind_tf_idf(counts, "word", "doc")
    monkeypatch.setattr(V.measured, "__defaults__", (2,))
    large = TF.bind_tf_idf(counts, "word", "doc")
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" not in plan(small)
    assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
    assert rows(small) == rows(large)
    grid = V.complete(counts.select("doc", "word").distinct().withColumn("n", F.lit(1)), "doc", "word", {"n": 0})
    assert grid.count() == 6 * 11


def test_frequencies_of_every_language_in_the_data(spark):
    tokens = spark.createDataFrame([("en", "sea"), ("en", "sun"), ("pt", "sea"), ("xx", "only"), (None, "sea")],
                                   "lang string, word string")
    got = rows(FQ.compare_freq(tokens, "lang", "en"), "word", "en", "lang", "proportion")
    assert got == [("only", None, "pt", None), ("only", None, "xx", 1.0), ("sea", 0.5, "pt", 1.0),
                   ("sea", 0.5, "xx", None), ("sun", 0.5, "pt", None), ("sun", 0.5, "xx", None)]
    no_base = FQ.compare_freq(tokens, "lang", "zz")
    assert no_base.filter("zz IS NOT NULL").count() == 0


def test_five_numbers_with_one_value_in_most_rows(spark):
    data = [(g, float(x)) for g, xs in (("a", [5] * 500 + [1, 9, 7]), ("b", [2])) for x in xs]
    df = spark.createDataFrame([*data, ("a", None)], "g string, x double")
    for by in ("g", None):
        for r in S.five_number(df, "x", by=by).collect():
            xs = [x for g, x in data if by is None or g == r.g]
            assert np.allclose(tuple(r)[-5:], np.percentile(xs, [0, 25, 50, 75, 100]))


def test_t_tail_against_closed_forms(spark):
    t = np.array([0.0, 0.5, 2.0, 30.0])
    cases = [*((float(x), 1) for x in t), *((float(x), 2) for x in t), (float("nan"), 3), (1.0, 0), (float("inf"), 5),
             (None, 4), (-2.228138851986, 10), (1.959963984540054, 10**7), (3.0, 10**9)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t double, dof long")
    p = [r["p"] for r in df.select("i", S.t_two_sided_p(F.col("t"), F.col("dof")).alias("p")).orderBy("i").collect()]
    assert np.allclose(p[:4], 1 - 2 / np.pi * np.arctan(t), rtol=1e-9)
    assert np.allclose(p[4:8], 1 - t / np.sqrt(2 + t * t), rtol=1e-9)
    assert np.isnan(p[8]) and p[9] is None and p[10] == 0.0 and p[11] is None
    assert np.isclose(p[12], 0.05, rtol=1e-6) and np.isclose(p[13], 0.05, rtol=1e-6)
    assert np.isclose(p[14], 0.0026997960632601866, rtol=1e-6)  # the normal tail


def test_assigned_topics_with_missing_cells(spark):
    trip = spark.createDataFrame([("d1", "x", 2), ("d1", "x", 1), ("d1", "z", 4), ("d2", "x", 1), ("d3", "x", 1)],
                                 "document string, term string, count long")
    beta = spark.createDataFrame([(1, "x", 0.5), (2, "x", 0.5), (3, "x", 1.0)],
                                 "topic long, term string, beta double")
    gamma = spark.createDataFrame([("d1", 1, 0.5), ("d1", 2, 0.5), ("d2", 2, 0.1), ("d2", 4, 0.9)],
                                  "document string, topic long, gamma double")
    # ties go to the lowest topic; terms and documents without a model row leave
    assert rows(TM.augment(trip, beta, gamma)) == [("d1", "x", 3, 1), ("d2", "x", 1, 2)]


def test_dense_and_empty_vectors_read_back(spark):
    from pyspark.ml.linalg import Vectors

    vectors = spark.createDataFrame([("d", Vectors.dense([0.0, 2.0])), ("s", Vectors.sparse(2, [0], [3.0])),
                                     ("e", Vectors.sparse(2, [], []))], ["document", "features"])
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "term string, index int")
    assert rows(M.tidy_dtm(vectors, vocab)) == [("d", "b", 2.0), ("s", "a", 3.0)]


def test_display_order_of_a_table_without_groups(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "word string, n long")
    assert rows(V.with_order(df, "n", "word")) == [("a", 2, 2), ("b", 2, 3), ("c", 1, 1)]


def test_scratch_tables_are_deleted_on_release(spark):
    release(spark)
    path = scratch_table(spark)
    spark.range(5).write.parquet(path)
    local = path.removeprefix("file:")
    assert glob.glob(os.path.join(local, "*.parquet"))
    assert release(spark) == 1 and not os.path.exists(local)
    assert release(spark) == 0


def test_measured_side_is_bounded_by_rows_and_by_bytes(spark):
    def hint(df, **bounds):
        return V.measured(df, **bounds)._jdf.queryExecution().logical().toString().splitlines()[0]

    df = spark.range(50).select("id", F.repeat(F.lit("x"), 100).alias("text"),
                                F.create_map(F.lit("a"), F.col("id")).alias("m"))
    assert "broadcast" in hint(df)
    assert "merge" in hint(df, limit=49) and "merge" in hint(df, max_bytes=5_000)
    assert "broadcast" in hint(df.limit(0), limit=0, max_bytes=0)
    assert rows(V.measured(df).select("id")) == rows(df.select("id"))


def test_partner_summary_matches_brute_force(spark):
    data = random_sections(7)
    df = spark.createDataFrame([*data, (None, 1), ("alone", 999)], "word string, section long")
    want = {}
    for (a, _), n in brute_counts(data).items():
        p, t, m = want.get(a, (0, 0, 0))
        want[a] = (p + 1, t + n, max(m, n))
    for block in (3, 2048):
        got = {r.item1: (r.partners, r.together, r.strongest)
               for r in P.partner_summary(df, "word", "section", block_items=block).collect()}
        assert got == want
    assert P.partner_summary(df.limit(0), "word", "section").count() == 0


def test_term_trend_completes_listed_terms_that_occur(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "b", 4), (None, "c", 5)],
                               "year long, term string, count long")
    got = {tuple(r) for r in TF.term_trend(df, ["a", "b", "a", "absent"]).collect()}
    assert got == {(1, "a", 2, 5), (1, "b", 3, 5), (2, "a", 0, 4), (2, "b", 4, 4), (None, "a", 0, 5), (None, "b", 0, 5)}
    assert TF.term_trend(df, ["absent"]).count() == 0 and TF.term_trend(df, []).count() == 0
