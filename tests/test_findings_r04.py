"""Faults reported after round 4: each test failed before its mending."""

import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from conftest import rows
from test_pairwise import brute_counts
from textmine.operators import pairwise as P
from textmine.operators import topic_fit as FIT
from textmine.plans import queries as PQ


def planted(spark, docs=40, k=2):
    """Documents of one topic each, with two words that all share."""
    return spark.createDataFrame([(f"d{d}", w, 1 + (d * 7 + i) % 5) for d in range(docs)
                                  for i, w in enumerate([f"t{d % k}w{j}" for j in range(8)] + ["c0", "c1"])],
                                 "document string, term string, count long")


def test_f7_to_f13_rounds_move_packed_numbers_one_block_a_partition(spark):
    blocks = FIT.packed_blocks(planted(spark), cells=100)
    links = FIT.linked(blocks)
    kinds = dict(links.dtypes)
    assert [kinds[c] for c in ("docs", "terms", "sizes", "term_of", "counts")] == ["int", "int", *["binary"] * 3]
    assert not links.storageLevel.useMemory and links.storageLevel.useDisk
    held = links.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == links.count() > 1 and {r["count"] for r in held} == {1}
    assert FIT.distinct_terms(links) == 18
    links.unpersist()


def test_partition_keys_are_dealt_one_to_a_partition(spark):
    for parts in (1, 7, 300):
        keys = spark.createDataFrame([(x,) for x in FIT.partition_keys(parts)], "key int")
        at = keys.repartition(parts, "key").select("key", F.spark_partition_id().alias("at")).collect()
        assert {r["key"]: r["at"] for r in at} == {x: i for i, x in enumerate(FIT.partition_keys(parts))}


def test_f3_to_f6_a_few_rounds_are_one_job(spark, monkeypatch):
    stored, real = [], FIT.scratch_table
    monkeypatch.setattr(FIT, "scratch_table", lambda *a: stored.append(1) or real(*a))
    many = FIT.fit_gibbs(planted(spark), 2, seed=3, sweeps=9, cells=100)
    assert len(stored) == 3
    monkeypatch.setattr(FIT, "FEW_BLOCKS", 0)  # a job for each round
    one = FIT.fit_gibbs(planted(spark), 2, seed=3, sweeps=9, cells=100)
    assert len(stored) == 13 and np.allclose(one.merits, many.merits)
    assert sorted(one.topic_terms.collect()) == sorted(many.topic_terms.collect())


def test_f17_start_weights_of_a_table_meet_terms_in_shards(spark):
    blocks = FIT.packed_blocks(planted(spark), cells=100)
    start = spark.createDataFrame([("c0", 1.0, 2.0), ("t0w3", 3.0, 4.0), ("other", 5.0, 6.0)], "term string, c0 double, c1 double")
    first = FIT._first_weights(blocks, start)
    assert "collect_list" not in first._jdf.queryExecution().optimizedPlan().toString()
    got = {r["block"]: np.reshape(r["first"], (-1, 2)) for r in first.collect()}
    want = {"c0": [1, 2], "t0w3": [3, 4]}
    for r in blocks.collect():
        assert got[r["block"]].tolist() == [want.get(t, [0, 0]) for t in r["terms"]]


def test_f14_to_f18_a_tile_holds_a_bounded_part_of_the_presence_rows(spark, monkeypatch):
    rng = random.Random(6)
    data = [(f"w{int(rng.paretovariate(0.8)) % 90}", s) for s in range(80) for _ in range(rng.randint(1, 20))]
    data += [(f"v{i}", 1000 + i) for i in range(5)]  # these meet nothing
    df = spark.createDataFrame(data, "word string, section long")
    want = sorted((a, b, n) for (a, b), n in brute_counts(data).items())
    partners = {}
    for a, _, n in want:
        seen = partners.setdefault(a, [0, 0, 0])
        partners[a] = [seen[0] + 1, seen[1] + n, max(seen[2], n)]
    for most in (16_000_000, 150):
        monkeypatch.setattr(P, "TILE_IDS", most)
        assert rows(P.pairwise_count(df, "word", "section")) == want
        assert rows(P.partner_summary(df, "word", "section")) == sorted((a, *x) for a, x in partners.items())
        grid = P.pairwise_cor(df, "word", "section")
        names = {w for w, _ in data}
        assert grid.count() == grid.distinct().count() == len(names) * (len(names) - 1)
        ids, pres = P._indexed(df, "word", ["section"], 2048)
        assert rows(P._pair_counts(pres, ["section"]).agg(F.sum("n"))) == [(sum(n for a, b, n in want if a < b),)]
    ids, pres = P._indexed(df, "word", ["section"], 2048)
    lists = [sorted(r["_list"]) for r in pres.groupBy("section").agg(F.collect_list("_id").alias("_list")).collect()]
    flat, sizes = np.concatenate(lists), [len(x) for x in lists]
    g = -(-2 * len(flat) // 150)
    sent = list(P._split(sizes, flat, g, int(flat.max()) + 1, list(range(g * (g + 1) // 2))))
    assert max(len(r["ids_a"]) + len(r.get("ids_b", b"")) for r in sent) < 2 * 150
    assert len(sent) > g


def test_f1_the_grid_is_sent_as_lists(spark):
    df = spark.createDataFrame([(f"w{i}", s) for s in range(9) for i in range(s % 4, 12, 2)], "word string, section long")
    _, pres = P._indexed(df, "word", ["section"], 2048)
    grid = P._pair_grid(pres, ["section"], 12)
    assert dict(grid.dtypes)["ns"] == "array<int>" and grid.count() < 12 * 11
    got = [(r["id1"], r["low"] + i * r["step"], n) for r in grid.collect() for i, n in enumerate(r["ns"])]
    assert sorted((a, b) for a, b, _ in got) == [(a, b) for a in range(1, 13) for b in range(1, 13)]
    plan = P.pairwise_cor(df, "word", "section")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("MapInArrow")


def test_f1_rounding_equals_sparks(spark):
    rng = random.Random(2)
    values = [0.0, -0.0, 0.1234565, -0.1234565, 1e-7, -1e-7, 5e-7, -5e-7, 0.9999995, 999.9999995, 1234.5678915, 1e300,
              float("nan"), float("inf"), -float("inf"), None]
    values += [rng.uniform(-1, 1) for _ in range(3000)] + [round(rng.uniform(-1, 1), 7) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for digits in (4, 6):
        both = df.select(F.round("x", digits).alias("want"), PQ.round_half_up(F.col("x"), digits, DoubleType()).alias("got"))
        assert both.filter("not (want <=> got)").count() == 0
        spelled = both.filter("want = 0").selectExpr("cast(got as string) s").distinct().collect()
        assert [r["s"] for r in spelled] == ["0.0"]
