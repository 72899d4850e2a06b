import hashlib
import os
import sys

import duckdb
import pytest

from conftest import SF, rows
from textmine.operators import tokens as tok
from textmine.operators import verbs as V
from textmine.sources import lexicons
from textmine.streaming import document_stream, run_available, stream_word_counts

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402


def test_streaming_counts_equal_batch_counts(spark, tmp_path):
    stop = lexicons.stop_words(spark, ["en"])
    docs = document_stream(spark, SF, "doc_id long, text string, lang string, source string, n_chars long",
                           glob="documents.parquet")
    q, streamed = run_available(stream_word_counts(docs, stop), str(tmp_path / "counts"))
    batch_docs = spark.read.parquet(f"{SF}/documents.parquet")
    batch = V.count_by(V.remove_stop_words(tok.unnest_tokens(batch_docs.select("lang", "text"), "word"),
                                           stop), "lang", "word")
    assert rows(streamed) == rows(batch)
    assert not q.isActive


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "word", "n"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: "∅" if v is None else repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)
    lines = sorted("|".join(norm(r[i]) for i in order) for r in data)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


SAMPLE = ["tok_words", "word_freq_by_lang", "segments", "zipf", "tf_idf", "top_bigram_tf_idf",
          "sentiment_arc", "negation_by_negator", "bigrams", "pairwise_cor", "tidy_dtm", "term_trend",
          "five_number", "topic_confusion", "complete_grid"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_queries_match_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_streaming_appends_equal_batch_tokens(spark, tmp_path):
    folder = tmp_path / "in"
    for i, text in enumerate(["a b", "c", ""]):
        spark.createDataFrame([(i, text)], "doc_id long, text string").coalesce(1).write.mode("append") \
            .parquet(str(folder))
    docs = document_stream(spark, str(folder), "doc_id long, text string", max_files_per_trigger=1)
    tokens = tok.unnest_tokens(docs, "word")
    for _ in range(2):  # run again from the same checkpoint: nothing new, nothing doubled
        _, table = run_available(tokens, str(tmp_path / "out"), "append", str(tmp_path / "state"))
        assert rows(table) == [(0, "a"), (0, "b"), (1, "c")]
    with pytest.raises(ValueError):
        run_available(tokens, str(tmp_path / "x"), "update")


def test_streaming_lexicon_labels_equal_batch(spark, tmp_path):
    lex = lexicons.lexicon(spark, [("the", "positive"), ("of", "negative"), ("and", "positive")],
                           ["word", "sentiment"])
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = document_stream(spark, SF, schema, glob="documents.parquet")
    labelled = V.count_by(V.join_lexicon(tok.unnest_tokens(docs.select("lang", "text"), "word"), lex),
                          "lang", "sentiment")
    _, streamed = run_available(labelled, str(tmp_path / "labels"))
    batch_docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text")
    batch = V.count_by(V.join_lexicon(tok.unnest_tokens(batch_docs, "word"), lex), "lang", "sentiment")
    assert rows(streamed) == rows(batch)
