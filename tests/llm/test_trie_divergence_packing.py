"""Prefix trie, divergence audit and packing against brute force, SQL and the
public tokenizer, and on awkward rows; vector searches on repeated keys."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmine.llm import divergence, forest, maxscore, packing, trie
from textmine.llm import queries as Q

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
CONV = "conv_id long, turn long, role string, text string, place string, key string, depth string"
DOCS = "doc_id long, text string, lang string, source string, df string, length string, piece string, _row string"


def sql(name, **tables):
    con = duckdb.connect()
    for table, path in tables.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    rel = con.sql(Q.ORACLE[name])
    return rel.columns, sorted(map(tuple, rel.fetchall()), key=str)


# ------------------------------------------------------------------ 11


def brute_trie(rows, group=100, heads=6):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (*x[:3], hashlib.md5(
        f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()))] for c, v in said.items()}
    paths = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % heads
        paths[c] = said.get(c - int(math.fmod(c, group)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for node, convs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(n) == len(node) + 1 for n in under),
                    sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in under) for n in under),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in under if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=1, n=120):
    rng = random.Random(seed)
    rows = [(None, 0, "user", "x"), (300, None, None, None), (300, 0, "user", "é😀"), (301, 0, "user", ""),
            (301, 0, "user", "tie"), (301, 0, "system", "tie"), (302, 1, "user", "twice"), (302, 1, "user", "twice")]
    for c in [*range(n), 199, 205, 206, 207, 208, -5, -105, 10**12 + 7]:
        rows += [(c, i, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "cc" * 9, None]))
                 for i in range(rng.randint(0, 9) or 40)]
    return rows


@pytest.mark.parametrize("piece, screened", [(65536, True), (3, True), (3, False)])
def test_trie_equals_brute_force(spark, monkeypatch, piece, screened):
    monkeypatch.setattr(trie, "PIECE", piece)
    if not screened:  # nothing is proved: all is grouped exactly
        monkeypatch.setattr(trie, "screen", lambda keyed, width: [np.full(width // 8, 255, np.uint8)] * 2)
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], CONV).repartition(5)
    got = trie.trie(*trie.grafted(trie.turns(df))).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(rows)


def test_trie_matches_sql_and_screens(spark):
    df = Q.op11_prefix_trie(spark, SF)
    columns, want = sql("op11_prefix_trie", conversations=f"{SF}/conversations.parquet")
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == want


def test_sketch_never_proves_a_shared_prefix(spark):
    rng = random.Random(3)
    x = [rng.getrandbits(63) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in x + x[:500]], "x long").repartition(7)
    bits = trie.screen(df, 1 << 17, flush=100)
    alone = np.zeros(3000, bool)
    for cells, row in zip(trie._cells(np.array(x, np.int64), 1 << 17), bits):
        alone |= (row[cells >> 3] >> (7 - (cells & 7))) & 1 == 0
    assert not alone[:500].any() and alone[500:].mean() > 0.99


def test_trie_on_empty_table(spark):
    none = spark.createDataFrame([], CONV)
    assert trie.trie(*trie.grafted(trie.turns(none))).count() == 0


# ------------------------------------------------------------------ 12


def brute_audit(rows, min_docs=10, top=10, scale=10**9):
    docs = [((lang or ""), (source or ""), [m.translate({c: c + 32 for c in range(65, 91)}) for m in re.findall(
        "[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        groups = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in mine}}
        share = lambda c: {t: 1 + scale * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        whole, p = share(sum(groups.values(), Counter())), {s: share(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(t, sum(f(p[s][w], p[t][w]) for w in kept)) for t in groups if t != s]
            terms = [(w, f(p[s][w], whole[w])) for w in kept if groups[s][w] and p[s][w] > whole[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found)
                        if part == "pair" or i < top]
    return sorted(out)


def texts(seed=2, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "ÄRGER", "Ärger", "ärger", "x1y", "don't", "中文", "ﬀ", "z" * 300] + [f"w{'abcdefghij'[i]}" for i in range(10)]
    rows = [(None, None, None), ("", "en", "lonely"), ("only once here", "fr", "a"), ("", "fr", "b"), ("\x00\x7f", "", "a")]
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 60))), lang, rng.choice(["a", "a", "b", "B", None, "é", "z"])))
    return rows + rows[20:30]


@pytest.mark.parametrize("most, pack, cells", [(10**6, 2048, 1 << 21), (40, 3, 20)])
def test_audit_equals_brute_force(spark, monkeypatch, most, pack, cells):
    rows = texts()
    df = spark.createDataFrame([(i, *r, *"xxxx") for i, r in enumerate(rows)], DOCS).repartition(6)
    got = divergence.audit(df, most=most, pack=pack, cells=cells).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows)


def test_audit_matches_sql(spark):
    columns, want = sql("op12_divergence", documents=f"{SF}/documents.parquet")
    assert sorted(map(tuple, Q.op12_divergence(spark, SF).select(*columns).collect()), key=str) == want


def test_audit_on_empty_table_and_long_text(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0
    text = b"abc De\xc3\xa9 1" * 1000 + b"q" * 5000
    whole = Counter(t for part in divergence.terms_of(text, piece=37) for t in part)
    assert whole == Counter(divergence.TERM.findall(text.lower())) and whole[b"q" * 5000] == 1


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 1, 10**12, 4 * 10**15], np.int64)
    got = divergence.shares(counts, 5 * 10**15, 10**8)
    assert got.tolist() == [1 + 10**9 * (int(c) + 2) // (5 * 10**15 + 2 * 10**8) for c in counts]


# ------------------------------------------------------------------ 13


def library():
    own = Tokenizer.from_file(WORDS)
    own.encode_special_tokens = True
    return own


def test_tokenizer_equals_the_library_on_random_texts():
    own, rng = library(), random.Random(0)
    tokenizer = packing.WordTokenizer(WORDS, most=900)  # forgets several times
    signs = [*"abzIT ' . , 1 \n\t'stHreVe-=!İẞß中é̸̱́ \x85　\x1c½ǅ", "<|endoftext|>", "'re", "'s", "H̱", "ẖ"]
    lines = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [None, "", "x" * 5000]
    for low in range(0, len(lines), 250):
        flat, stops = tokenizer.encode(lines[low:low + 250])
        for text, ids in zip(lines[low:low + 250], np.split(flat, stops[:-1])):
            assert ids.tolist() == [*own.encode(text or "", add_special_tokens=False).ids, 1], text


def check_plan(counts, capacity):
    runs = packing.plan(np.array(counts), capacity)
    fill, seen = defaultdict(list), Counter()
    for length, before, n, m, base, offset in runs.tolist():
        assert before == seen[length]
        seen[length] += n * m
        for i in range(n * m):
            fill[base + i // n].append((offset + i % n * length, length))
    assert [seen[i] for i in range(capacity + 1)] == list(counts)
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(fill) == list(range(len(fill)))
    return len(fill)


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def go(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for j in {r: j for j, r in enumerate(room) if r >= lengths[i]}.values():
            go(i + 1, [r - lengths[i] * (j == x) for x, r in enumerate(room)])
        go(i + 1, [*room, capacity - lengths[i]])

    go(0, [])
    return best


def test_plan_is_whole_and_near_the_fewest():
    rng = random.Random(5)
    excess = 0
    for _ in range(150):
        capacity = rng.choice([7, 12, 20])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        got = check_plan([lengths.count(i) for i in range(capacity + 1)], capacity)
        excess += got - fewest(lengths, capacity)
    assert excess <= 4
    for counts in ([0] * 21, [0, *[1000] * 20], [0, 5 * 10**3] + [0] * 19):
        full = sum(i * c for i, c in enumerate(counts))
        assert check_plan(counts, 20) - -(-full // 20) <= 1


def test_plan_finds_exact_triples():
    # 10 = 5 + 2 + 2 + 1 only when triples are looked up
    counts = [0] * 11
    counts[5], counts[2], counts[1] = 4, 8, 4
    assert check_plan(counts, 10) == 4


def test_plan_work_does_not_follow_the_number_of_pieces():
    counts = np.zeros(4097, np.int64)
    counts[1:] = np.random.default_rng(1).integers(0, 10**12, 4096)
    began = time.time()
    runs = packing.plan(counts)
    assert time.time() - began < 20 and len(runs) < 100_000
    assert (runs[:, 3] + runs[:, 4]).max() < 1.01 * (counts * np.arange(4097)).sum() / 4096


def test_packing_query(spark):
    own = library()
    want = {r["doc_id"]: [*own.encode(r["text"] or "", add_special_tokens=False).ids, 1]
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_pieces(Q.op13_packing(spark, SF).collect(), want)


def check_pieces(rows, want, capacity=4096):
    seen, room = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == capacity * r["piece"] and r["length"] == min(capacity, len(want[r["doc_id"]]) - r["start"])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen[r["doc_id"]].append(r["piece"])
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(-(-len(v) // capacity))) for k, v in want.items()}
    for parts in room.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert len(room) <= math.ceil(sum(map(len, want.values())) / capacity) + 1


def test_packing_awkward_rows_and_whole_sequences(spark):
    rows = [(0, None), (1, ""), (2, "one"), (3, "word " * 30_000), (4, "x" * 70_000)] + [(10 + i, "a b c") for i in range(50)]
    df = spark.createDataFrame([(k, t, "en", "s", *"xxxx") for k, t in rows], DOCS).repartition(4)
    own = library()
    want = {k: [*own.encode(t or "", add_special_tokens=False).ids, 1] for k, t in rows}
    placed = packing.place(packing.pieces(df, WORDS))
    check_pieces(placed.collect(), want)
    packed = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert packed[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    again = spark.createDataFrame([(None, "same text", "en", "s", *"xxxx")] * 20, DOCS)
    same = packing.place(packing.pieces(again, WORDS)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in same}) == 20
    assert packing.place(packing.pieces(spark.createDataFrame([], DOCS), WORDS)).count() == 0


# ------------------------------------------------------------------ 2 and 6


@pytest.mark.parametrize("module", [maxscore, forest])
def test_searches_take_every_vector_of_a_repeated_key(spark, monkeypatch, module):
    monkeypatch.setattr("textmine.llm.vectors.SHARD_ROWS", 40)
    monkeypatch.setattr("textmine.llm.vectors.QUERY_ROWS", 2)
    rng = np.random.default_rng(4)
    rows = [(i // 2, np.round(rng.standard_normal(6), 3).tolist()) for i in range(300)] + [(50, [1.0] * 6), (50, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in module.search(df, F.col("key") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    kept = list({(k, tuple(v)) for k, v in rows})
    measure = {maxscore: lambda a, b: int(np.floor(256 * np.array(a)) @ np.floor(256 * np.array(b))),
               forest: lambda a, b: float(np.array(a) @ b / np.linalg.norm(a) / np.linalg.norm(b))}[module]
    for q in (0, 50, 100):
        best = sorted((-round(measure(a, b), 9), c) for k, a in kept if k == q for c, b in kept if c != q)[:5]
        assert found[q] == [(c, -s) for s, c in best]
    assert set(found) == {0, 50, 100}


def test_maxscore_sql_takes_every_vector_of_a_repeated_key(spark, tmp_path):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [6.0, 256.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = Q.op2_maxscore(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(Q.ORACLE["op2_maxscore"]).fetchall()) and len(got) == 3
