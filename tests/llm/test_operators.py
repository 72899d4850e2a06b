"""The numbered operators against brute force, public libraries or held-out
labels, and on awkward rows: nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns with clashing names."""

import hashlib
import itertools
import math
import os
import random
import re
import time
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

import corpus_pipeline
from textmine.llm import bpe, forest, langid, masked_lm, maxscore, mixing, neardup, quality, secrets, toxicity
from textmine.llm import queries as Q
from textmine.llm.graph import components
from textmine.llm.vectors import usable
from textmine.session import release

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ", score string, ids string, size string, component_id string, spans string, _value string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def awkward(spark):
    rows = [(None, "some words here", "en", "a"), (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "b"),
            (4, "one", "en", "b"), (5, "x" * 60_000, "de", None), (6, "word " * 30_000, None, "a"),
            (7, "same text twice over and over", "en", "a"), (7, "same text twice over and over", "en", "a"),
            (8, "!!! ??? 123", "fr", "c")]
    return spark.createDataFrame([(*r, None, *["x"] * 6) for r in rows], DOCS + CLASH)


def empty(spark):
    return spark.createDataFrame([], DOCS + CLASH)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ------------------------------------------------------------------ 1


def reference_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                             special_tokens={})


def test_bpe_equals_the_public_library_on_random_texts():
    own, other, rng = bpe.Vocabulary(bpe.read_ranks(RANKS)), reference_encoding(), random.Random(1)
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", "1", "é", "!", "A", "　", "\x1c",
             "中", "½", "\x85", "'re", " 's", "''", "\U00016d40", "á"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", None, "a" * 5000, "ab'" * 700, "\n" * 300, "the cat's  hat"]
    ids, ends = own.encode(texts)
    for text, piece in zip(texts, np.split(ids, ends[:-1])):
        assert piece.tolist() == other.encode_ordinary(text or "")
        assert own.decode(piece).tobytes() == (text or "").encode()


def test_bpe_scan_equals_stepping_the_automaton():
    of, after, apply, _ = bpe.automaton()
    kinds = np.random.default_rng(0).integers(0, bpe.CUT + 1, 5000)
    state, want = bpe.AT_CUT, []
    for k in kinds:
        state = bpe._step(state, k)
        want.append(state)
    assert apply[bpe.scan(of[kinds], after, 16), bpe.AT_CUT].tolist() == want


def test_bpe_query_digests(spark):
    other = reference_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op1_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = other.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_awkward_rows_and_offsets(spark):
    ranks = bpe.Ranks(spark, RANKS)
    out = bpe.encode(awkward(spark), ranks)
    assert out.columns.count("ids") == 1 and "score" in out.columns  # a clashing column gives way
    for r in bpe.decode(out, ranks).collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert not r["ends"] or r["ends"][-1] == len((r["text"] or "").encode())
    bad = spark.createDataFrame([(1, [0, None, -5, 10**8]), (2, None)], "k int, ids array<int>")
    assert [len(r["decoded"]) for r in bpe.decode(bad, ranks).orderBy("k").collect()] == [1, 0]
    assert bpe.encode(empty(spark), ranks).count() == 0


# ------------------------------------------------------------------ 2 and 6


def vectors(spark, n=600, width=16, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(width).tolist()) for i in range(n)]
    rows[7] = (7, rows[0][1])
    rows[8] = (8, rows[0][1])  # ties
    rows += [(1000, None), (1050, [float("nan")] * width), (1100, [float("inf")] * width), (None, [1.0] * width),
             (1150, [None] * width), (5, rows[5][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def brute(df, scale=None, k=5):
    rows = {}
    for r in df.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            rows[r["vec_id"]] = np.floor(np.array(v) * scale) if scale else np.array(v) / np.linalg.norm(v)
    out = {}
    for q in rows:
        if q % 50 == 0:
            best = sorted((-float(rows[q] @ rows[c]), c) for c in rows if c != q)[:k]
            out[q] = [(c, -s) for s, c in best]
    return out


def test_maxscore_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr("textmine.llm.vectors.SHARD_ROWS", 100)
    monkeypatch.setattr("textmine.llm.vectors.QUERY_ROWS", 5)
    df = vectors(spark)
    got = {}
    for r in maxscore.search(df, F.col("key") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute(df, 256.0)


def test_maxscore_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    got = Q.op2_maxscore(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(Q.ORACLE["op2_maxscore"]).fetchall())


def test_forest_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute(df)
    hits = total = 0
    for r in Q.op6_hash_forest(spark, "/root/testdata/sf0.01").collect():
        scores = dict(want[r["query_id"]])
        hits += r["score"] >= min(scores.values()) - 1e-12
        total += 1
        if r["vec_id"] in scores:
            assert abs(scores[r["vec_id"]] - r["score"]) < 1e-12
    assert total == sum(map(len, want.values())) and hits / total >= 0.9


def test_vector_searches_on_awkward_tables(spark):
    schema = "vec_id long, embedding array<float>, score string, key string"
    none = spark.createDataFrame([], schema)
    two = spark.createDataFrame([(0, [1.0, 2.0], "x", "y"), (50, [1.0], "x", "y"), (100, [0.0, 0.0], "x", "y")], schema)
    for module, rows in ((maxscore, 6), (forest, 2)):
        assert module.search(none, F.col("key") % 50 == 0).count() == 0
        assert module.search(two, F.col("key") % 50 == 0).count() == rows  # zero vectors have no cosine
    assert usable(vectors(spark), "vec_id", "embedding").count() == 600


# ------------------------------------------------------------------ 3


def test_forward_sums_all_segmentations():
    pieces = langid.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    lattice, index = langid.Lattice(pieces), {p: i for i, p in enumerate(pieces)}
    prob = np.random.default_rng(0).random((len(pieces), 2))
    prob /= prob.sum(axis=0)

    def total(word, at=0):
        if at == len(word):
            return np.ones(2)
        out = sum((prob[index[word[at:end]]] * total(word, end) for end in range(at + 1, len(word) + 1)
                   if word[at:end] in index), np.zeros(2))
        spelled = np.prod([prob[index[f"<0x{b:02X}>"]] for b in word[at].encode()], axis=0)
        return out + spelled * total(word, at + 1)

    for word in ("▁the", "▁élan!", "▁中x"):
        assert np.allclose(langid.forward(lattice, [word], prob)[0], np.log(total(word)))
    assert np.isfinite(langid.forward(lattice, ["▁" + "a" * 3000], prob)).all()


def test_expected_counts_equal_enumeration():
    pieces = langid.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    lattice, index = langid.Lattice(pieces), {p: i for i, p in enumerate(pieces)}
    prob = np.random.default_rng(3).random((len(pieces), 2))
    prob /= prob.sum(axis=0)

    def ways(word):
        if not word:
            yield []
        for end in range(1, len(word) + 1):
            for rest in ways(word[end:]):
                if word[:end] in index:
                    yield [index[word[:end]], *rest]
                if end == 1:
                    yield [*(index[f"<0x{b:02X}>"] for b in word[0].encode()), *rest]

    for word, weight in (("▁then", [1.0, 3.0]), ("▁é🜁e", [2.0, 0.5])):
        want, total = np.zeros((2, len(pieces))), np.zeros(2)
        for way in ways(word):
            chance = prob[way].prod(axis=0)
            total += chance
            for piece in way:
                want[:, piece] += chance
        got = langid.forward(lattice, [word], prob, np.array([weight]))
        assert np.allclose(got, want / total[:, None] * np.array(weight)[:, None], atol=1e-12)


def test_long_words_in_runs_equal_one_recursion():
    pieces = langid.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    lattice, rng = langid.Lattice(pieces), random.Random(6)
    prob = np.random.default_rng(1).random((len(pieces), 3)) ** 8 + 1e-6
    prob /= prob.sum(axis=0)
    for letters, n in (("thequickingeren", 300), ("中文字的是一", 257), ("🜁中a", 400), ("a", 1000), ("in", 64)):
        word = "▁" + "".join(rng.choice(letters) for _ in range(n - 1))
        want = langid.forward(lattice, [word], prob)[0]
        for limits in ({}, {"step": 16, "part": 48}, {"step": 5, "part": 10}):
            assert np.allclose(langid.long_forward(lattice, word, prob, **limits), want, rtol=1e-9)
    model, begun = langid.Model(["a", "b", "c"], lattice, prob, np.ones(3) / 3), time.process_time()
    assert np.isfinite(model.log_scores(["".join(rng.choice("etaoin") for _ in range(200_000))])).all()
    assert time.process_time() - begun < 30  # one recursion takes more


def test_langid_held_out_accuracy(spark, documents):
    rows = Q.op3_langid(spark, SF).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_langid_awkward_rows(spark):
    pieces = langid.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = langid.fit(awkward(spark), pieces, rounds=1)
    out = [(r["doc_id"], r["lang_pred"]) for r in langid.predict(awkward(spark), model, keep=["doc_id"]).collect()]
    assert len(out) == 10 and {d: p for d, p in out if d in (1, 2, 3, 8)} == dict.fromkeys((1, 2, 3, 8), "und")
    untaught = langid.fit(empty(spark), pieces)
    assert langid.predict(awkward(spark), untaught).count() == 10


# ------------------------------------------------------------------ 4 and 7


def accuracy(spark, rows, label, at):
    known = {r["doc_id"]: r[label] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    pairs = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= at) for r in rows)
    return np.mean([a == b for a, b in pairs])


def test_toxicity_held_out_accuracy(spark):
    assert accuracy(spark, Q.op4_toxicity(spark, "/root/testdata/sf0.01").collect(), "toxic", 0.5) >= 0.8


def test_quality_held_out_accuracy(spark):
    assert accuracy(spark, Q.op7_quality(spark, "/root/testdata/sf0.01").collect(), "quality", 0.7) >= 0.9


def test_convolution_equals_the_definition_and_steps_against_the_gradient():
    rng, texts = np.random.default_rng(2), ["one two three two", "a", "", "you you BAD word here", "x y"]
    ids, at = toxicity.word_ids(texts, 6)
    assert at.tolist() == [0, 4, 5, 5, 10, 12] and (ids[1] == ids[3]).all()
    net, floor = toxicity.Network.start(6, 4, 3, 1), toxicity.FLOOR

    def maxima(net):
        vectors, rows = net.embedding[ids].sum(axis=1).astype(float), []
        for low, high in zip(at[:-1], at[1:]):
            rows.append([max([floor, *(vectors[i:i + k].ravel() @ w[:, f].astype(float) + b[f]
                                       for i in range(low, high - k + 1))])
                         for k, w, b in zip(toxicity.WIDTHS, net.filters, net.biases) for f in range(w.shape[1])])
        return np.array(rows)

    assert np.allclose(net.maxima(ids, at)[0], maxima(net), atol=1e-5)
    y = np.array([0, 1, 0, 1, 0])

    def loss(net):
        z = maxima(net) @ net.out.astype(float) + net.bias
        return float(((np.logaddexp(0, z) - y * z) * np.where(y, 1.5, 1)).mean())  # 3 of class 0 to 2 of class 1

    docs = [(ids[low:high], int(v)) for low, high, v in zip(at[:-1], at[1:], y)]
    rate = 1e-3
    after = toxicity.train(docs, bits=6, dim=4, filters=3, epochs=1, rate=rate, batch=8, seed=1)
    checked = 0
    for part in (lambda n: n.embedding, lambda n: n.filters[0], lambda n: n.filters[2], lambda n: n.biases[1],
                 lambda n: n.out):
        value, moved = part(net), part(after)
        for spot in map(tuple, rng.permutation(np.argwhere(np.ones(value.shape, bool)))[:60]):
            kept, ends = value[spot], []
            for change in (1e-3, -1e-3):
                value[spot] = kept + change
                ends.append(loss(net))
            value[spot] = kept
            slope = (ends[0] - ends[1]) / 2e-3
            if abs(slope) > 3e-3:
                assert abs(moved[spot] - kept + rate * np.sign(slope)) < rate / 10
                checked += 1
    assert checked > 30


def test_passage_features_equal_the_definition():
    texts = ["The the THE x9 -- " * 30, "", None, "Élan a a b a " + "q" * 50 + " 12,5 ...", "\u4e2d\u6587 ok"]
    got, at = quality.passages(texts)
    assert at.tolist() == [0, 4, 5, 6, 7, 8]  # 150 words are four passages

    def kind(c):
        if unicodedata.category(c)[0] not in "LMN":
            return 0
        return 2 if c.isupper() else 3 if c.isdecimal() else 1

    for t, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for p in range(at[t + 1] - at[t]):
            part = words[48 * p:48 * p + 48]
            n, spots = len(part), range(48 * p, 48 * p + len(part))
            mean = lambda f: sum(f([kind(c) for c in w], len(w)) for w in part) / max(1, n)
            want = [np.log1p(n) / 4, len(set(part)) / max(1, n),
                    sum(i > 0 and words[i] == words[i - 1] for i in spots) / max(1, n),
                    sum(i > 1 and words[i] == words[i - 2] for i in spots) / max(1, n),
                    mean(lambda k, s: s) / 8, mean(lambda k, s: k.count(2) / max(1, k.count(1) + k.count(2))),
                    mean(lambda k, s: k.count(3) / s), mean(lambda k, s: k.count(0) / s),
                    mean(lambda k, s: k.count(0) == s), mean(lambda k, s: min(4, k.count(0)) / 4),
                    mean(lambda k, s: k.count(2) > 1), mean(lambda k, s: s > 20)]
            row = got[at[t] + p]
            assert np.allclose(row[:12], want, atol=1e-6)
            assert np.isclose(row[12:].sum(), n > 0)


def test_attention_weights_and_learning():
    rng = np.random.default_rng(0)
    bags = [(rng.random((n, quality.FEATURES)).astype(np.float32), n % 2) for n in (1, 3, 4, 2)]
    net = quality.Network.start()
    x, at = np.concatenate([b for b, _ in bags]), np.cumsum([0, *(len(b) for b, _ in bags)])
    weights = net.forward(x, at)["a"]
    assert np.allclose(np.add.reduceat(weights, at[:-1]), 1)
    trained = quality.train(bags * 20, epochs=60)
    assert ((trained.forward(x, at)["p"] > 0.5) == [y for _, y in bags]).all()


def test_attention_steps_against_the_gradient_by_differences():
    rng = np.random.default_rng(5)
    bags = [(rng.random((n, quality.FEATURES)), n % 2) for n in (1, 3, 4, 2, 5)]
    x, at = np.concatenate([b for b, _ in bags]), np.cumsum([0, *(len(b) for b, _ in bags)])
    y, net = np.array([v for _, v in bags]), quality.Network.start()

    def loss():
        out, w = [], net.w
        for low, high in zip(at[:-1], at[1:]):
            h = np.maximum(0, x[low:high] @ w["enc"] + w["enc_b"])
            gate = np.tanh(h @ w["tanh"]) / (1 + np.exp(-h @ w["sig"])) @ w["att"]
            a = np.exp(gate) / np.exp(gate).sum()
            out.append(a @ h @ w["out"] + w["out_b"][0])
        z = np.array(out)
        return float((np.logaddexp(0, z) - y * z).mean())

    rate, checked = 1e-4, Counter()
    after = quality.train(bags, epochs=1, rate=rate, batch=8)
    for name, value in net.w.items():
        for spot in map(tuple, rng.permutation(np.argwhere(np.ones(value.shape, bool)))[:40]):
            kept, ends = value[spot], []
            for change in (1e-5, -1e-5):
                value[spot] = kept + change
                ends.append(loss())
            value[spot] = kept
            slope = (ends[0] - ends[1]) / 2e-5
            if abs(slope) > 1e-6:
                assert abs(after.w[name][spot] - kept + rate * np.sign(slope)) < rate / 10, name
                checked[name] += 1
    assert len(checked) == len(net.w) and sum(checked.values()) > 60


def test_classifiers_on_awkward_rows(spark):
    rows, some = awkward(spark), labels(spark, [(4, 1, 0), (5, 0, 1), (7, None, 1), (None, 1, 1), (4, 0, 1)])
    for module in (toxicity, quality):
        for known in (some, labels(spark)):
            net = module.fit(rows, known)
            out = module.score(rows, net, keep=["doc_id", "score", "ids"]).collect()
            assert len(out) == 10 and all(0 <= r["score"] <= 1 for r in out)
        assert module.score(empty(spark), net).count() == 0


# ------------------------------------------------------------------ 5


def partition(docs, words, key="doc_id"):
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j:j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in sets}


def copies(spark, groups=6, size=40, seed=4):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(60)]
        for _ in range(size):
            mine = list(base)
            for _ in range(rng.randrange(4)):
                mine[rng.randrange(60)] = f"v{rng.randrange(9999)}"
            rows.append(" ".join(mine))
    rows += [" ".join(f"u{rng.randrange(9999)}" for _ in range(30)) for _ in range(50)]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_equal_brute_force(spark, small):
    docs = copies(spark)
    limits = {"node_rows": 16, "block": 3000} if small else {}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           neardup.near_duplicates(df, words=4, **limits).collect()}
    assert got == partition(docs, 4)


def test_near_duplicates_compare_a_loose_family_in_bounded_groups(spark, monkeypatch):
    # texts of one template, most at 0.55 to 0.75, with some links among them
    rng, docs = random.Random(8), []
    base = [f"w{i}" for i in range(200)]
    for i in range(240):
        mine = list(base) if i % 12 else list(docs[-3] if docs else base)
        for at in range(rng.randrange(5), 200, 30 if i % 12 else 90):
            mine[at] = f"v{rng.randrange(10 ** 6)}"
        docs.append(mine)
    docs += [list(docs[17]) for _ in range(3)]
    for j, d in enumerate(docs[-3:]):
        d[100 + j] = "z"
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    sizes, run = [], GroupedData.applyInPandas

    def watched(self, func, schema):
        if "block" in self._df.columns:
            sizes.append(self._df.groupBy("cluster", "block").count().agg(F.max("count")).first()[0])
        return run(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", watched)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = partition(docs, 4)
    assert 5 < sum(i != c for i, (_, c) in want.items()) < 100
    for block, hot in ((12_000, 2_000), (12_000, 5)):
        monkeypatch.setattr(neardup, "HOT_ROWS", hot, raising=False)
        got = neardup.near_duplicates(df, words=4, block=block).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert 0 < max(sizes) <= 80  # 30 in a block in the mean, 243 in the family


def family(spark, docs=400, pairs=120, alike=0.81, kept=0.5, seed=3):
    """Signatures of a loose family, and of pairs in it that agree in a share
    ``alike`` of the coordinates and have no other near partner."""
    rng = np.random.default_rng(seed)
    base = rng.integers(1, 1 << 32, neardup.COORDINATES, dtype=np.uint32)
    new = lambda n: rng.integers(1, 1 << 32, (n, neardup.COORDINATES), dtype=np.uint32)
    sig = np.where(rng.random((docs, neardup.COORDINATES)) < kept, base, new(docs))
    changed = np.argsort(rng.random((pairs, neardup.COORDINATES)), axis=1) >= round(alike * neardup.COORDINATES)
    sig = np.vstack([sig, np.where(changed, new(pairs), sig[:pairs])])
    rows = [(i, bytearray(s.tobytes())) for i, s in enumerate(sig)]
    return spark.createDataFrame(rows, "doc long, sig binary"), [(i, docs + i) for i in range(pairs)]


def test_trees_follow_the_depth(spark, monkeypatch):
    assert all(neardup.parted(n) ** neardup.trees_for(n) <= neardup.MISS for n in range(1, 41))
    assert neardup.trees_for(16) == 10 and neardup.trees_for(40) == 22
    reps, planted = family(spark)
    recall = []
    for by_depth in (True, False):
        if not by_depth:
            monkeypatch.setattr(neardup, "trees_for", lambda levels: 1)
        links = {(max(r), min(r)) for r in map(tuple, neardup.candidate_links(reps, trees=1, node_rows=4).collect())}
        part = {r["vertex"]: r["component"] for r in components(
            spark.createDataFrame(sorted(links), "a long, b long")).collect()} if links else {}
        recall.append(np.mean([part.get(a, a) == part.get(b, b) for a, b in planted]))
    print("recall by depth, fixed", recall)
    assert recall[0] >= 0.9 and recall[0] > recall[1]


def test_near_duplicates_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = Q.op5_near_duplicates(spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(Q.ORACLE["op5_near_duplicates"]).fetchall())


def test_near_duplicates_awkward_rows(spark):
    out = neardup.near_duplicates(awkward(spark)).collect()
    assert len(out) == 10
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out} >= {
        (None, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (4, 1, 4, True), (7, 2, 7, True)}
    assert neardup.near_duplicates(empty(spark)).count() == 0
    kept = neardup.deduplicate(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == 9  # the repeated row once
    # rows of one key are one vertex: 1 links with 3 through its second text
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "p q r s t u"), (3, "P Q r s t u"), (2, "a b c d e f")],
                               "doc_id long, text string")
    assert {r["component_id"] for r in neardup.near_duplicates(df).collect()} == {1}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "a long, b long")
    got = {r["vertex"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, 501: 500}


# ------------------------------------------------------------------ 8


def base_brute(text):
    out, text = [], text or ""
    for kind, pattern, group, least in (
            ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}")
                for m in re.finditer(pattern, text, re.ASCII) if len(m.group(group)) >= least]
    return ",".join(x for _, _, x in sorted(out))


def test_secret_base_spans_equal_the_patterns(spark):
    for r in Q.op8_secrets(spark, "/root/testdata/sf0.01").join(
            spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        want = base_brute(r["text"])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len(want.split(",")) * bool(want)


def test_secret_lexing_propagates_constants():
    text = 'key1 = "Ab3$kd92kQ"\nuser: bob\ndb.pass_phrase = ${key1}\ncolor = "red-green"\nmy_credential => \'Zk9!pQ27xx\''
    found = {text[a:b] for a, k, b in secrets.spans_of(text) if k == 3}
    assert found == {"Ab3$kd92kQ", "Zk9!pQ27xx"}
    assert secrets.spans_of("The cat: it = here, and so on: nothing") == []
    assert secrets.redact("a KEY b", [(2, 0, 5)], "#") == "a # b"
    long = "password=" + "x" * 300_000 + " a=" * 50_000
    assert secrets.spans_of(long)[0] == (0, 0, 300_009)


def test_secret_literals_with_slashes_blanks_and_letters():
    def clean(text):
        return secrets.redact(text, secrets.spans_of(text), "#")

    assert clean("aws_secret_access_key = wJalr//XUtnFEMI/K7MDENG/bPxRfiCYEXAMPLE1") == "aws_secret_access_key = #"
    assert clean('passphrase = "three plain words"; x') == 'passphrase = "#"; x'
    assert clean('password = "correct horse battery"; x') == '#"; x'
    assert clean("pwd=abcdefgh next") == "pwd=# next"
    for text in ('auth_url = "https://host/path/Ab3"', 'title = "three plain words"', "pwd = readpassword()"):
        assert clean(text) == text


def test_secret_sums_are_one_literal():
    def literals(text):
        return [text[a:b] for a, k, b in secrets.spans_of(text) if k == 3]

    text = "part = \"Zk9!pQ\"\nmy_credential = \"Ab3$\" + part + 'kd92' + other\ncolor = \"a\" + \"b\""
    assert literals(text) == ["Zk9!pQ", "Ab3$", "kd92"]
    assert literals('db_credential = "Ab3$" +\n    "kd92kQ" \\\n  + "x1"\nn = 1') == ["Ab3$", "kd92kQ", "x1"]
    assert literals('credential_count = one + two + 3') == []
    assert secrets.redact(text, secrets.spans_of(text), "#").count("#") == 3


def test_secrets_in_linear_time():
    text = "\n".join(f'api_key_{i} = "Ab3kd9{i}2kQxx"' for i in range(30_000))
    begun = time.process_time()
    assert len(secrets.spans_of(text)) == 30_000
    assert time.process_time() - begun < 20  # some 70 s where each literal is held against each base span
    # a name that holds a sum is not followed in another sum, so sums do not grow
    chain = "s = 'abc1'\n" + "s = s + 'x9Kd7'\n" * 20_000 + "credential = s"
    begun = time.process_time()
    assert len(secrets.spans_of(chain)) <= 2
    assert time.process_time() - begun < 20
    text = "a = 'Zk9!'\nb = a + 'pQ2'\nmy_credential = b"
    assert [text[x:y] for x, k, y in secrets.spans_of(text) if k == 3] == ["Zk9!", "pQ2"]


def test_secrets_awkward_rows(spark):
    out = secrets.scan(awkward(spark), redacted="clean").collect()
    assert len(out) == 10 and all(r["spans"] == [] and r["clean"] == r["text"] for r in out)
    assert secrets.scan(empty(spark)).count() == 0


# ------------------------------------------------------------------ 9


def test_mixing_targets_and_words(spark, documents):
    rows = Q.op9_mixing(spark, SF).join(documents.select("doc_id", "text", "source"), "doc_id").collect()
    by = {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    names = sorted(by)
    sizes = [sum(r["size"] for r in by[s]) for s in names]
    want = mixing.targets(sizes, [i % 3 + 1 for i in range(len(names))], 3)
    assert abs(sum(want) - sum(sizes)) < 1e-6
    for s, size, target in zip(names, sizes, want):
        assert all(r["source_size"] == size and abs(r["target"] - target) < 1e-6 for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - target) <= 1


def test_mixing_caps_are_reshared():
    assert mixing.targets([10, 1000], [3, 1], 3) == [30.0, 980.0]
    assert mixing.targets([], [], 3) == [] and mixing.targets([0, 0], [1, 2], 3) == [0.0, 0.0]


def test_mixing_positions_follow_the_schedule(spark):
    rows = [(i, "a b c d", None, s) for s in "ab" for i in range(400)]
    df = spark.createDataFrame([(i + 400 * (s == "b"), t, n, s) for i, t, n, s in rows],
                               "doc_id long, text string, lang string, source string")
    rising = {"a": [(0.0, 0.0), (1.0, 2.0)], "b": [(0.0, 1.0), (0.5, 1.0), (1.0, 1.0)]}
    out = mixing.plan(df, schedules=rising).collect()
    a = sorted(p for r in out if r["source"] == "a" for p in r["positions"])
    assert np.allclose(a, np.sqrt(np.arange(400) / 400), atol=1e-6)  # cumulative demand is t squared


def test_mixing_emits_equal_rows_as_planned(spark, monkeypatch):
    # null keys, repeated rows and large groups: as many copies of each group as plan() has positions
    rows = [(None, f"{a} b c d", "a") for a in "pqrst" * 30] + [(1, "x y", "a")] * 40
    rows += [(i + 10, "u v w", "b") for i in range(300)] + [(None, "k l m", None)] * 20 + [(None, "", "b")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for chunk in (1_000, 7):
        monkeypatch.setattr(mixing, "CHUNK_ROWS", chunk, raising=False)
        monkeypatch.setattr(mixing, "BUCKET_ROWS", chunk)
        planned = mixing.plan(df).collect()
        assert len(planned) == len(rows)
        want, got = {}, {}
        for r in planned:
            at = (r["doc_id"], r["source"], r["size"])
            want[at] = want.get(at, 0) + len(r["positions"])
        for r in mixing.mix(df).collect():
            at = (r["doc_id"], r["source"], len(r["text"].split()))
            got[at] = got.get(at, 0) + 1
        assert got == {k: n for k, n in want.items() if n}


def test_mixing_reruns_and_awkward_rows(spark):
    first = sorted(map(str, mixing.plan(awkward(spark)).collect()))
    assert first == sorted(map(str, mixing.plan(awkward(spark)).collect())) and len(first) == 10
    assert mixing.plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    assert mixing.mix(awkward(spark)).columns == awkward(spark).columns


# ------------------------------------------------------------------ 10


def test_masked_lm_scores_equal_the_definition(spark, documents):
    model = masked_lm.fit(documents, fraction=0.5, words=300)
    text = documents.filter("length(text) < 900").first()["text"]
    h, ending, at = masked_lm.tokens([text])
    kind, log = model.vocab.classify(h, ending)
    rows = masked_lm.windows(h, kind, at, model.vocab.own)
    net, total = model.net, 0.0
    for i in range(len(h)):
        group, place = divmod(int(kind[i]), model.vocab.side)
        hidden = net.embed[rows[i]].reshape(-1) @ net.inner.reshape(-1, masked_lm.HIDDEN) + net.inner_b
        for logit, mine in ((np.tanh(hidden) @ net.outer + net.outer_b, group),
                            (np.tanh(hidden + net.group[group]) @ net.place + net.place_b, place)):
            total += logit[mine] - np.log(np.exp(logit).sum())
        total += log[i]
    n, score = model.scores([text, None, ""])
    assert n.tolist() == [len(h), 0, 0] and abs(score[0] - total) < 1e-2 and score[1:].tolist() == [0, 0]


def test_masked_lm_counts_and_learning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = masked_lm.count_words(docs, "text")
    vocab = masked_lm.vocabulary(counts, 2000)
    h, ending, at = masked_lm.tokens([r["text"] for r in docs.collect()])
    assert counts.agg(F.sum("n")).first()[0] == len(h) and len(vocab.words) <= 2000
    kind, log = vocab.classify(h, ending)
    # words of a class share its probability out over the corpus
    for c in np.unique(kind[kind >= vocab.own]):
        _, first = np.unique(h[kind == c], return_index=True)
        assert abs(np.exp(log[kind == c][first]).sum() - 1) < 1e-3
    net = masked_lm.train(docs.select("text"), vocab)
    share = np.log(np.bincount(kind, minlength=vocab.side ** 2)[kind] / len(kind)).mean()
    assert masked_lm.class_logs(net, masked_lm.windows(h, kind, at, vocab.own), kind).mean() > share


def test_masked_lm_classes_grow_and_gradients_match_differences():
    sides = [masked_lm.class_numbers(10**p)[0] for p in (3, 6, 8, 10)]
    assert sides == sorted(sides) and sides[-1] > 5 * sides[0]
    rng = np.random.default_rng(0)
    net = masked_lm.Network.start(4, 12)
    rows, kind = rng.integers(0, 40, (50, 4)), rng.integers(0, 16, 50)
    loss = lambda: -masked_lm.class_logs(net, rows, kind).mean()
    before = net.copy()
    trainer = masked_lm.Trainer(net.copy(), 0.01)
    trainer.learn(rows, kind)
    for name in masked_lm.Network.NAMES:
        values, moved = getattr(net, name), getattr(trainer.net, name) - getattr(before, name)
        slope = -np.sign(moved) * np.sqrt(np.maximum(trainer.memory[name] - 1e-6, 0))
        for _ in range(6):
            at = tuple(rng.integers(0, min(n, 40)) for n in values.shape)
            old = values[at]
            values[at] = old + 2e-2
            up = loss()
            values[at] = old - 2e-2
            down = loss()
            values[at] = old
            assert abs((up - down) / 4e-2 - slope[at]) < 2e-3 + 0.02 * abs(slope[at]), name


def test_masked_lm_awkward_rows(spark):
    model = masked_lm.fit(awkward(spark), fraction=1.0, words=50)
    assert masked_lm.score(awkward(spark), model).count() == 10
    assert masked_lm.score(awkward(spark), masked_lm.fit(empty(spark))).count() == 10


def test_masked_lm_scores_every_word_by_its_own_count(spark):
    # "abzz" is counted more often than "cdzz" of the same ending; neither is in the list
    rows = [(i, " ".join(["the of and"] * 9 + ["abzz abzz abzz" if i < 8 else "cdzz"])) for i in range(9)]
    df = spark.createDataFrame([*rows, (9, None), (10, "abzz"), (11, "cdzz"), (12, "newzz")],
                               "doc_id long, text string")
    model = masked_lm.fit(df.filter("doc_id < 12"), words=3)
    assert len(model.vocab.words) == 3
    got = {r["doc_id"]: r for r in masked_lm.score(df, model).collect()}
    assert len(got) == 13 and (got[9]["n_tokens"], got[9]["log_likelihood"]) == (0, 0.0)
    assert got[0]["n_tokens"] == 30
    # alone in a text, both have one window and one class: counts of 25 and 2
    assert abs(got[10]["log_likelihood"] - got[11]["log_likelihood"] - math.log(25 / 2)) < 1e-6
    text = rows[0][1]
    h, ending, at = masked_lm.tokens([text])
    kind, log = model.vocab.classify(h, ending)
    n = np.array([25.0 if w == "abzz" else np.nan for w in text.split()])
    log = np.where(np.isnan(n), log, np.log(n / 27))
    want = masked_lm.class_logs(model.net, masked_lm.windows(h, kind, at, model.vocab.own), kind) + log
    assert abs(got[0]["log_likelihood"] - want.sum()) < 1e-3


def test_masked_lm_trains_on_every_row(spark, monkeypatch):
    # every third row holds one text; each row counts in exactly one round
    rows = [(i, "one text again" if i % 3 == 0 else f"text number {i} of some") for i in range(60)]
    df = spark.createDataFrame([*rows, (None, None), (60, "")], "doc_id long, text string")
    seen, run = [], type(df).mapInArrow

    def watched(self, func, schema, *rest, **more):
        if "weight binary" in str(schema):
            seen.append([r["text"] for r in self.collect()])
        return run(self, func, schema, *rest, **more)

    monkeypatch.setattr(type(df), "mapInArrow", watched)
    model = masked_lm.fit(df)
    assert sorted(t for part in seen for t in part if t) == sorted(t for _, t in rows)
    assert all(5 < part.count("one text again") for part in seen)  # not all in one round
    assert np.abs(model.net.outer - masked_lm.Network.start(model.vocab.side, model.vocab.own).outer).max() > 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, documents):
    columns, at = documents.columns, documents
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF).cache()
        sizes.append(out.count())
        if name == "secret scans":
            assert all(not secrets.spans_of(r["text"]) for r in out.collect())
            assert {r["n_chars"] - len(r["text"]) for r in out.collect()} == {0}
        if name == "minhash near-dedup":
            left = [(r["doc_id"], r["text"]) for r in out.collect()]
            assert all(i == c for i, (_, c) in partition(left, 5).items())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        at = out
    assert sizes[0] <= 200 and sizes[1] <= sizes[0] and sizes[2] == sizes[1] and sizes[4] == sizes[3]
    other = reference_encoding()
    texts = {r["doc_id"]: r["text"] for r in stage_input(spark, documents)}
    assert all(r["ids"] == other.encode_ordinary(texts[r["doc_id"]]) for r in at.collect())


def stage_input(spark, documents):
    """Texts as the last stage sees them: the redacted ones by key."""
    return corpus_pipeline.without_secrets(spark, documents, SF).collect()


def pipeline_tables(spark):
    """Folders that the session holds for ``release``, and those that still exist."""
    paths = [p for p in getattr(spark.sparkContext, "_textmine_tables", [])]
    return [p for p in paths if os.path.exists(p.removeprefix("file:"))]


def test_pipeline_run_on_awkward_rows_and_release(spark, tmp_path):
    good = " ".join(f"plain{i} words{i % 7} of a calm report" for i in range(60))
    rows = [*[(i, f"{good} number {i} {'abc' * i}", "en", "a", None) for i in range(20, 60)],
            (90, good, None, None, 5), (91, good, None, None, 5)]
    docs = awkward(spark).unionByName(spark.createDataFrame(rows, DOCS), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(i, int(i % 3 > 0), 0) for i in range(2, 60)]).write.parquet(f"{tmp_path}/labels.parquet")
    release(spark)
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = out.collect()
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns)
    assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in docs.collect()}
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert len(pipeline_tables(spark)) == 1
    assert release(spark) >= 1 and not pipeline_tables(spark)


def test_pipeline_run_on_an_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    release(spark)


def test_pipeline_failure_leaves_no_tables(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise ValueError("broken stage")

    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    kept = [("kept", lambda spark, docs, sf_dir: docs), ("broken", broken)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*kept, ("last", broken)])
    release(spark)
    with pytest.raises(ValueError, match="broken stage"):
        corpus_pipeline.run(spark, str(tmp_path))
    assert not pipeline_tables(spark)
