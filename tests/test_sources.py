import io
import contextlib
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF, rows
from textmine.sources import corpus, lexicons


def test_tidy_pages_strips_scripts_styles_and_tags(spark):
    html = ("<html><head><title>Big News</title><style>p{x:1}</style><script>var a='<p>';</script></head>"
            "<body><p>Hello   <b>world</b></p>\n<p>again</p></body></html>")
    pages = spark.createDataFrame([(7, "http://x", html)], "page_id long, url string, html string")
    out = corpus.tidy_pages(pages).first()
    assert (out.id, out.heading, out.url) == (7, "Big News", "http://x")
    assert out.text == "Big News Hello world again"


def test_nest_in_chunks_and_flatten_round_trip(spark):
    conv = spark.createDataFrame([(1, t, "user", f"t{t}") for t in range(40)] + [(2, 0, "bot", "x")],
                                 "conv_id long, turn long, role string, text string")
    nested = corpus.nest(conv, ["conv_id"], ["turn", "role", "text"], order="turn", chunk=16)
    assert nested.count() == 4  # 16 + 16 + 8 turns, plus one conversation
    assert max(len(r.corpus) for r in nested.collect()) == 16
    assert rows(corpus.flatten_corpus(nested), "conv_id", "turn", "role", "text") == rows(conv)


def test_select_corpus_and_with_meta(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string")
    meta = spark.createDataFrame([(1, 1, "x"), (1, 1, "x"), (2, 0, "y")], "doc_id long, quality int, author string")
    assert rows(corpus.select_corpus(docs, meta, F.col("quality") == 1, "doc_id")) == [(1, "a")]
    attached = corpus.with_meta(docs, meta.dropDuplicates(), "doc_id", ["author"])
    assert rows(attached) == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    listed = corpus.with_meta(docs, meta.dropDuplicates(), "doc_id", ["author"], how="inner")
    assert rows(listed) == [(1, "a", "x"), (2, "b", "y")]


def test_save_table_partitions_and_prunes(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="textmine-save-"), "t")
    df = spark.createDataFrame([("en", "a"), ("de", "b"), ("en", "c")], "lang string, word string")
    saved = corpus.save_table(df, path, partition_by=["lang"])
    en = saved.filter(F.col("lang") == "en")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        en.explain()
    assert "PartitionFilters: [isnotnull(lang" in buf.getvalue()
    assert rows(en, "word") == [("a",), ("c",)]


def test_lexicons_and_extension(spark):
    stop = lexicons.stop_words(spark, ["en", "de"])
    assert stop.filter("lexicon = 'english'").count() == len(lexicons.default_stop_words("en")) == 181
    custom = lexicons.lexicon(spark, [("miss", "custom")], ["word", "lexicon"])
    extended = lexicons.extend_lexicon(stop, custom)
    assert extended.first().word == "miss"
    assert extended.count() == stop.count() + 1


def test_lines_are_numbered_from_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(3)
    lines = corpus.lines(docs)
    firsts = lines.groupBy("doc_id").agg(F.min("line_no").alias("m")).collect()
    assert all(r.m == 1 for r in firsts)


def test_map_nested_keeps_entries_and_adds_fields(spark):
    from textmine.sources import corpus

    df = spark.sql("""SELECT 1 AS k, array(named_struct('t', 'a b', 'n', 5), named_struct('t', NULL, 'n', 6)) AS corpus
                      UNION ALL SELECT 2, array() UNION ALL SELECT 3, NULL""")
    out = corpus.map_nested(df, size=lambda e: F.size(F.split(e["t"], " ")), n=lambda e: e["n"] * 2)
    got = {r["k"]: r["corpus"] for r in out.collect()}
    assert [tuple(e) for e in got[1]] == [("a b", 2, 10), (None, None, 12)] and got[2] == [] and got[3] is None
    assert out.schema["corpus"].dataType.elementType.names == ["t", "size", "n"]
    chunks = corpus.nest(spark.range(10).selectExpr("'x' AS k", "id AS o"), ["k"], ["o"], order="o", chunk=4)
    again = corpus.flatten_corpus(corpus.map_nested(chunks, twice=lambda e: e["o"] * 2))
    assert sorted((r["o"], r["twice"]) for r in again.collect()) == [(i, 2 * i) for i in range(10)]


def test_stored_corpus_reads_only_the_shards_of_chosen_documents(spark, tmp_path):
    from textmine.sources import corpus

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)] + [(None, "none")], "doc_id long, text string")
    stored = corpus.save_corpus(docs, str(tmp_path / "corpus"), "doc_id", 32)
    spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(500)] + [(None, 1), (0, 1)], "doc_id long, wanted int") \
        .write.parquet(str(tmp_path / "meta"))
    meta = spark.read.parquet(str(tmp_path / "meta"))
    chosen = corpus.select_stored(stored, meta, F.col("wanted") == 1, "doc_id", 32)
    assert sorted(chosen.collect()) == [(i, f"text {i}") for i in (0, 100, 200, 300)]
    assert "dynamicpruning" in chosen._jdf.queryExecution().executedPlan().toString().lower()
    assert corpus.select_stored(stored, meta, F.lit(False), "doc_id", 32).count() == 0
