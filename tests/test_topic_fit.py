"""Topic models on tables: against a numpy version, on planted topics, and by
invariants."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import topic_fit as TF

TRIPLETS = "document string, term string, count long"


def planted(spark, seed=1, docs=60, k=3):
    """Documents of one topic each: topic j uses words j0..j9 and a few common ones."""
    rng = random.Random(seed)
    data = []
    for d in range(docs):
        words = [f"t{d % k}w{i}" for i in range(10)] + ["c0", "c1"]
        data += [(f"d{d}", w, rng.randint(1, 9)) for w in words if rng.random() < 0.8]
    return spark.createDataFrame(data, TRIPLETS)


def own_variational(cells, start, alpha, iterations, inner):
    """The same updates document by document."""
    beta = {w: np.array(x, float) for w, x in start.items()}
    k = len(next(iter(beta.values())))
    docs = sorted({d for d, _, _ in cells})
    gamma = {d: np.full(k, alpha + sum(n for x, _, n in cells if x == d) / k) for d in docs}
    h = 1e-5
    slope = lambda x: (math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h)
    for _ in range(iterations):
        total = sum(beta.values())
        new = {w: np.zeros(k) for w in beta}
        for d in docs:
            mine = [(w, n) for x, w, n in cells if x == d]
            for _ in range(inner):
                expect = np.exp([slope(g) - slope(gamma[d].sum()) for g in gamma[d]])
                part = {w: n * beta[w] / total * expect / (beta[w] / total * expect).sum() for w, n in mine}
                gamma[d] = alpha + sum(part.values())
            for w in part:
                new[w] += part[w]
        beta = new
    return beta, gamma


@pytest.mark.parametrize("cells", [10**6, 25])
def test_variational_rounds_equal_numpy(spark, cells):
    trip = planted(spark, docs=15)
    k, words = 3, sorted({r["term"] for r in trip.collect()})
    rng = np.random.default_rng(0)
    start = {w: (1 + rng.random(k)).tolist() for w in words}
    table = spark.createDataFrame([(w, *x) for w, x in start.items()], "term string, c0 double, c1 double, c2 double")
    model = TF.fit_variational(trip, k, iterations=3, inner=2, alpha=0.7, estimate_alpha=False, tolerance=0,
                               start=table, cells=cells)
    beta, gamma = own_variational([tuple(r) for r in trip.collect()], start, 0.7, 3, 2)
    for r in model.topic_terms.collect():
        assert np.allclose([r["c0"], r["c1"], r["c2"]], beta[r["term"]], atol=1e-6)
    for r in model.gamma().collect():
        want = gamma[r["document"]]
        assert abs(r["gamma"] - want[r["topic"] - 1] / want.sum()) < 1e-7
    assert all(b >= a - 1e-9 for a, b in zip(model.merits, model.merits[1:]))


def owners(model, k):
    best = {}
    for r in model.gamma().collect():
        best.setdefault(r["document"], []).append((r["gamma"], r["topic"]))
    return {d: max(x)[1] for d, x in best.items()}


def found_all(model, k):
    by_topic = {}
    for d, topic in owners(model, k).items():
        by_topic.setdefault(int(d[1:]) % k, set()).add(topic)
    return sorted(map(len, by_topic.values())) == [1] * k and len(set.union(*by_topic.values())) == k


def sums_to_one(model):
    for table, by in ((model.beta(), "topic"), (model.gamma(), "document")):
        value = [c for c in table.columns if c in ("beta", "gamma")][0]
        assert all(abs(r["s"] - 1) < 1e-9 for r in table.groupBy(by).agg(F.sum(value).alias("s")).collect())


def test_variational_finds_planted_topics_and_estimates_the_prior(spark):
    models = [TF.fit_variational(planted(spark), 3, seed=s, iterations=15, alpha=0.5) for s in (1, 2, 3)]
    best = max(models, key=lambda m: m.merits[-1])
    sums_to_one(best)
    assert found_all(best, 3)
    for model in models:
        assert all(b >= a - 1e-6 * abs(a) for a, b in zip(model.merits, model.merits[1:]))


def test_best_alpha_maximises_the_bound():
    gamma = np.random.default_rng(1).dirichlet([0.3] * 4, 500) * 50 + 0.01
    logs = float((TF.digamma(gamma) - TF.digamma(gamma.sum(1, keepdims=True))).sum())
    bound = lambda a: 500 * (math.lgamma(4 * a) - 4 * math.lgamma(a)) + a * logs
    best = TF.best_alpha(12.5, 4, 500, logs)
    assert all(bound(best) >= bound(best * f) for f in (0.5, 0.99, 1.01, 2))


def test_digamma():
    for x in (0.01, 0.5, 1.0, 3.3, 50.0, 1e4):
        h = 1e-5 * x
        assert abs(float(TF.digamma(x)) - (math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h)) < 1e-4 * max(1, 1 / x)
    assert abs(float(TF.digamma(1.0)) + 0.5772156649015329) < 1e-9


def test_gibbs_keeps_tokens_and_agrees_on_reruns(spark):
    trip = planted(spark)
    first = TF.fit_gibbs(trip, 3, seed=7, sweeps=30, cells=150)
    again = TF.fit_gibbs(trip.repartition(7, "term"), 3, seed=7, sweeps=30, cells=150)
    assert rows(first.topic_terms) == rows(again.topic_terms) and np.allclose(first.merits, again.merits)
    per_term = {r["term"]: r["n"] for r in trip.groupBy("term").agg(F.sum("count").alias("n")).collect()}
    assert {r["term"]: r["c0"] + r["c1"] + r["c2"] for r in first.topic_terms.collect()} == per_term
    per_doc = {r["document"]: r["n"] for r in trip.groupBy("document").agg(F.sum("count").alias("n")).collect()}
    for r in first.state.select("docs", "doc_state").collect():
        for d, weights in zip(r["docs"], np.reshape(r["doc_state"], (-1, 3))):
            assert weights.sum() == per_doc[d] and (weights >= 0).all()
    assert np.mean(first.merits[-5:]) > np.mean(first.merits[:2])
    assert found_all(first, 3)
    sums_to_one(first)
    assert TF.fit_gibbs(trip, 3, seed=8, sweeps=1).merits != first.merits[:1]


def test_token_batches_take_a_document_once_a_turn():
    doc = np.repeat([0, 1, 2], [5, 1, 3])
    order, cuts = TF.token_batches(doc, least=1)
    assert sorted(order.tolist()) == list(range(9))
    parts = np.split(order, cuts)
    assert [sorted(doc[p].tolist()) for p in parts] == [[0, 1, 2], [0, 2], [0, 2], [0], [0]]


def test_awkward_cells(spark):
    data = [(None, "a", 1), ("d", None, 1), ("d", "a", 0), ("d", "b", 2), ("d", "b", 1), ("e", "b", 4)]
    trip = spark.createDataFrame([(*r, "x", "y") for r in data], TRIPLETS + ", docs string, block string")
    for model in (TF.fit_variational(trip, 2, iterations=2), TF.fit_gibbs(trip, 2, sweeps=2)):
        assert rows(model.gamma().groupBy("document").count()) == [("d", 2), ("e", 2)]
        assert rows(model.beta().select("term").distinct()) == [("b",)]
    assert TF.fit_gibbs(trip, 2, sweeps=2).topic_terms.selectExpr("c0 + c1").first()[0] == 7
    none = spark.createDataFrame([], TRIPLETS)
    for model in (TF.fit_variational(none, 2), TF.fit_gibbs(none, 2)):
        assert model.beta().count() == 0 and model.gamma().count() == 0
