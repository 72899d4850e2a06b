"""Registered queries of the numbered operators and, where SQL can express
one, its SQL.  Each query applies its operator with production parameters to
the whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmine.llm import (
    bpe,
    divergence,
    forest,
    langid,
    masked_lm,
    maxscore,
    mixing,
    neardup,
    packing,
    quality,
    secrets,
    toxicity,
    trie,
)
from textmine.llm.common import crc_fold
from textmine.sources import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def sha256(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    ranks = bpe.Ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(load(spark, sf_dir, "documents"), ranks, keep=["doc_id"])
    decoded = bpe.decode(encoded, ranks, keep=["doc_id", "ids"])
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                          sha256(F.col("decoded")).alias("decoded_sha256"))


@query
def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector."""
    return maxscore.search(load(spark, sf_dir, "embeddings"), F.col("key") % 50 == 0)


ORACLE["op2_maxscore"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS w
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
         vec_id, score FROM scored)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5"""


@query
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = load(spark, sf_dir, "documents")
    pieces = langid.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = langid.fit(docs, pieces, where=crc_fold("doc_id", 5) != 0)
    held = docs.select("doc_id", "text", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    return langid.predict(held, model, keep=["doc_id", "held_out"])


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold;
    ``flagged`` uses the thresholds calibrated by language."""
    docs = load(spark, sf_dir, "documents")
    net = toxicity.fit(docs, load(spark, sf_dir, "labels"), where=crc_fold("doc_id", 5) != 0)
    held = docs.select("doc_id", "text", "lang", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    scored = toxicity.score(held, net, keep=["doc_id", "held_out", "lang"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.col("score") >= toxicity.threshold(net, F.col("lang"))).cast("int").alias("flagged"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links at 0.8 of 4-word shingles."""
    return neardup.near_duplicates(load(spark, sf_dir, "documents"), words=4)


ORACLE["op5_near_duplicates"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM sizes
  UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.v),
least AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN least ON v = doc_id"""


@query
def op6_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every 50th vector."""
    return forest.search(load(spark, sf_dir, "embeddings"), F.col("key") % 50 == 0)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned outside the held-out fold."""
    docs = load(spark, sf_dir, "documents")
    net = quality.fit(docs, load(spark, sf_dir, "labels"), where=crc_fold("doc_id", 4) != 2)
    held = docs.select("doc_id", "text", F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    scored = quality.score(held, net, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, counted by base kind and digested."""
    found = secrets.scan(load(spark, sf_dir, "documents"), keep=["doc_id"])
    join = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS[:3]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    return found.select("doc_id", *counts, sha256(join(base)).alias("base_sha256"), join(F.col("spans")).alias("spans"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, in training order."""
    planned = mixing.range_sorted(mixing.plan(load(spark, sf_dir, "documents")))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "position")


@query
def op10_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo log-likelihood of every document."""
    docs = load(spark, sf_dir, "documents")
    return masked_lm.score(docs, masked_lm.fit(docs), keep=["doc_id"])


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return trie.trie(*trie.grafted(trie.turns(load(spark, sf_dir, "conversations"))))


ORACLE["op11_prefix_trie"] = """
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce([4294967295] || [ord(x) FOR x IN string_split(CAST(c AS VARCHAR), '')],
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM ordered), crc_table),
turns AS (
  SELECT convs.c, n AS place, role, text FROM convs JOIN ordered o ON o.c = convs.base AND n <= h
  UNION ALL
  SELECT convs.c, 1000000 + n, role, text FROM convs JOIN ordered o ON o.c = convs.c AND n > h),
paths AS (
  SELECT convs.c, CASE WHEN count(place) = 0 THEN [] ELSE list({r: role, t: text} ORDER BY place) END AS p
  FROM convs LEFT JOIN turns ON turns.c = convs.c GROUP BY convs.c),
prefixes AS (SELECT c, d, p[1:d] AS k, d = len(p) AS last FROM paths, range(0, 100000) r(d) WHERE d <= len(p)),
nodes AS (
  SELECT k, d, min(c) AS c, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '') AS e
  FROM prefixes GROUP BY k, d),
below AS (
  SELECT a.k, a.d, count(*) FILTER (b.d = a.d + 1) AS children,
         count(*) FILTER (NOT EXISTS (SELECT 1 FROM nodes x WHERE x.d = b.d + 1 AND x.k[1:b.d] = b.k)) AS leaves,
         sum(CASE WHEN b.d = 0 THEN 0 ELSE (b.n - 1) * length(b.k[b.d].t) END) AS saved
  FROM nodes a JOIN nodes b ON b.d >= a.d AND b.k[1:a.d] = a.k GROUP BY a.k, a.d)
SELECT nodes.c AS conv_id, nodes.d AS depth, parent.c AS parent_conv_id, nodes.n AS n_convs, children AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(nodes.e) AS ends_sha256
FROM nodes JOIN below ON below.d = nodes.d AND below.k = nodes.k
LEFT JOIN nodes parent ON parent.d = nodes.d - 1 AND parent.k = nodes.k[1:nodes.d - 1]"""


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of every language and their leading terms."""
    return divergence.audit(load(spark, sf_dir, "documents"))


ORACLE["op12_divergence"] = """
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
occ AS (SELECT id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(total) + 2 * any_value(v)) AS q
  FROM counts JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN sizes USING (lang)
  GROUP BY lang, term),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v) AS p
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes ON sizes.lang = g.lang
  LEFT JOIN totals ON totals.lang = g.lang AND totals.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS xs, y.source AS ys, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS s
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND xs = a.source AND ys = b.source),
terms AS (
  SELECT p.lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS "rank"
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, "rank" FROM ranked
WHERE part = 'pair' OR "rank" <= 10"""


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    cut = packing.pieces(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                         keep=["doc_id"], ids=False)
    return packing.place(cut)
