"""Local regression against numpy, and correlations above a bound against the
whole table."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import pairwise as P
from textmine.operators import stats as S


def own_smooth(points, at, span, degree):
    x, y = np.array(points, float).T
    q = max(1, int(span * len(x) + 1e-5))
    out = []
    for a in at:
        d = np.abs(x - a)
        h = np.sort(d)[q - 1]
        w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0) if d.min() < h else (d == h).astype(float)
        use = w > 0
        k = min(degree, len(set(x[use])) - 1)
        z = (x[use] - a) / (h or 1)
        basis = np.vander(z, k + 1, increasing=True) * np.sqrt(w[use])[:, None]
        out.append(np.linalg.lstsq(basis, y[use] * np.sqrt(w[use]), rcond=None)[0][0])
    return out


@pytest.mark.parametrize("span, degree", [(0.75, 2), (0.3, 1), (1.0, 2), (0.5, 0)])
def test_smooth_equals_numpy(spark, span, degree):
    rng = random.Random(1)
    data = [(g, float(x), float(np.sin(x / 5)) + rng.random()) for g in ("a", None) for x in range(40) for _ in range(rng.randint(1, 3))]
    data += [("one", 3.0, 5.0), ("two", 1.0, 2.0), ("two", 2.0, 4.0), ("a", None, 1.0), ("a", 1.0, None), ("same", 7.0, 1.0), ("same", 7.0, 3.0)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = {}
    for r in S.smooth(df, "y", "x", by="g", span=span, degree=degree, points=9).orderBy("x").collect():
        got.setdefault(r["g"], []).append((r["x"], r["fitted"]))
    for g in ("a", None, "one", "two", "same"):
        points = [(x, y) for k, x, y in data if k == g and x is not None and y is not None]
        lo, hi = min(points)[0], max(points)[0]
        at = [lo + (hi - lo) * i / 8 for i in range(9)]
        assert np.allclose([x for x, _ in got[g]], at)
        assert np.allclose([f for _, f in got[g]], own_smooth(points, at, span, degree), atol=1e-7), g
    whole = S.smooth(df.filter("g = 'a'"), F.col("y") * 2, "x", span=span, degree=degree, points=9).orderBy("x").collect()
    assert np.allclose([r["fitted"] for r in whole], [2 * f for _, f in got["a"]])
    assert S.smooth(df.limit(0), "y", "x").count() == 0


@pytest.mark.parametrize("min_cor", [0.05, 0.3, 0.8, 0.999])
@pytest.mark.parametrize("block_items", [2048, 4])
def test_bounded_correlations_equal_the_whole_table(spark, min_cor, block_items):
    rng = random.Random(2)
    data = [(f"w{i}", s) for i in range(40) for s in range(60) if rng.random() < (i + 1) / 45]
    data += [("twin", s) for k, s in data if k == "w3"] + [("always", s) for s in range(60)] + [(None, 1), ("w1", None)]
    df = spark.createDataFrame(data, "item string, section int")
    whole = P.pairwise_cor(df, "item", "section").filter(F.col("correlation") > min_cor)
    got = P.pairwise_cor(df, "item", "section", min_cor=min_cor, block_items=block_items)
    assert [r[:2] for r in rows(got)] == [r[:2] for r in rows(whole)] and len(rows(got)) > 0
    assert np.allclose([r[2] for r in rows(got)], [r[2] for r in rows(whole)])
    counts = P.candidate_pairs(df, "item", "section", min_cor, block_items).first()
    assert got.count() / 2 <= counts["built"] <= counts["together"]


def test_the_bound_leaves_few_pairs_of_unlike_supports(spark):
    rng = random.Random(3)
    # supports from 2 to 2,000 of 4,000 sections
    data = [(f"w{i}", s) for i in range(60) for s in rng.sample(range(4000), int(2 * 1000 ** (i / 59)))]
    df = spark.createDataFrame(data, "item string, section int")
    counts = P.candidate_pairs(df, "item", "section", 0.6).first()
    assert counts["built"] < 0.25 * counts["together"]


def test_sketches_merge_and_keep_their_rank_error(spark, tmp_path):
    rng = np.random.default_rng(1)
    values = {g: rng.lognormal(size=60_000) for g in "ab"}
    data = [(g, i % 7, float(v)) for g, x in values.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(data + [("a", 0, None), ("none", 0, None)], "g string, part int, x double").repartition(6)
    path = str(tmp_path / "sketches")
    S.quantile_sketches(df, "x", ["g", "part"], k=1024).write.parquet(path)
    merged = S.merge_sketches(spark.read.parquet(path), "g", k=1024)
    assert sum(len(r["sketch"]) for r in merged.collect()) < 60_000  # not the values themselves
    for by_group in (S.sketched_five_number(merged, "g"), S.sketched_five_number(S.quantile_sketches(df, "x", "g", 1024), "g")):
        got = {r["g"]: r for r in by_group.collect()}
        assert set(got) == {"a", "b"}
        for g, x in values.items():
            r = got[g]
            assert (r["minimum"], r["maximum"]) == (x.min(), x.max())
            for p, name in ((0.25, "lower"), (0.5, "middle"), (0.75, "upper")):
                assert abs((x <= r[name]).mean() - p) < 0.01
    few = S.sketched_five_number(S.quantile_sketches(spark.createDataFrame([(float(i),) for i in range(1, 9)], "x double"), "x"))
    assert tuple(few.first()) == (1.0, 2.0, 4.0, 6.0, 8.0)
