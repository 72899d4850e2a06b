"""Registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the test tables.  Shared sub-results and join sides whose
size must be known are computed while a query is built.

Every computed column is aliased to the name used by the SQL equivalent in
``textmine.plans.oracle``; double columns are rounded to 6 decimals at the
end so both engines can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

from textmine.functions import text as T
from textmine.operators import tokens as tok
from textmine.operators import verbs as V
from textmine.plans import fixtures as FX
from textmine.sources import corpus, lexicons

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def round_half_up(x: Column, digits: int, kind: DataType) -> Column:
    """``F.round``, which spells a double out in decimals for every value:
    here only large ones and those next to the middle between two results."""
    if not isinstance(kind, DoubleType):
        return F.round(x, digits)
    unit = F.lit(float(10 ** digits))
    scaled = F.abs(x) * unit
    whole = F.floor(scaled).cast("double")
    over = scaled - whole - F.lit(0.5)
    near = F.when(over > 0, whole + F.lit(1.0)).otherwise(whole) / unit
    plain = (scaled < F.lit(1e9)) & (F.abs(over) > F.lit(1e-5))
    return F.when(plain, F.when(x < 0, F.lit(0.0) - near).otherwise(near) + F.lit(0.0)).otherwise(F.round(x, digits))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating-point column (for cross-engine comparison)."""
    return df.select(*[round_half_up(F.col(f.name), digits, f.dataType).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# --------------------------------------------------------------------------- shared inputs

def documents(spark: SparkSession, d: str) -> DataFrame:
    docs = corpus.load(spark, d, "documents").select("doc_id", "lang", "source", "text")
    return corpus.spread(docs)


def documents_by_id(spark: SparkSession, d: str) -> DataFrame:
    """The documents dealt by ``doc_id``, for counts within documents."""
    return corpus.spread_by(corpus.load(spark, d, "documents").select("doc_id", "lang", "source", "text"), "doc_id")


def stop(spark: SparkSession) -> DataFrame:
    return lexicons.stop_words(spark, FX.STOP_LANGS)


def doc_tokens(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, lang, source, word`` for every word of every document."""
    return tok.unnest_tokens(documents(spark, d), "word", "text")


def words_by_doc(spark: SparkSession, d: str) -> DataFrame:
    """``doc_tokens`` from documents dealt by ``doc_id``: groups of
    ``doc_id`` and more are formed without a further shuffle."""
    return tok.unnest_tokens(documents_by_id(spark, d), "word", "text")


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return corpus.lines(documents(spark, d))


def line_tokens(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, lang, source, line_no, pos, word``."""
    return tok.unnest_tokens(doc_lines(spark, d), "word", "text", position="pos")


def clean_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Line tokens without stop words."""
    return V.remove_stop_words(line_tokens(spark, d), stop(spark))


# --------------------------------------------------------------------------- step 1: words

@query
def top_words_by_lang(spark, d):
    """Ten most frequent non-stop words per language (ties kept)."""
    counts = V.count_by(V.remove_stop_words(doc_tokens(spark, d), stop(spark)), "lang", "word")
    return V.top_n(counts, 10, "n", by="lang")


@query
def tok_words(spark, d):
    return line_tokens(spark, d).select("doc_id", "line_no", "pos", "word")


@query
def word_freq(spark, d):
    from textmine.operators import frequency as FQ

    return FQ.word_freq(doc_tokens(spark, d), stop(spark))


@query
def word_freq_by_lang(spark, d):
    from textmine.operators import frequency as FQ

    return FQ.word_freq(doc_tokens(spark, d), stop(spark), by="lang")


@query
def top_words(spark, d):
    """The 100 most frequent non-stop words (word-cloud input)."""
    from textmine.operators import frequency as FQ

    return FQ.top_words(doc_tokens(spark, d), 100, stop(spark))


# --------------------------------------------------------------------------- step 2: lines, windows, filters

@query
def line_numbers(spark, d):
    return doc_lines(spark, d).select("doc_id", "line_no", "text")


@query
def segments(spark, d):
    seg = tok.segment_by_marker(doc_lines(spark, d), FX.MARKER, by="doc_id")
    return seg.select("doc_id", "line_no", "chapter")


@query
def sections(spark, d):
    return tok.section_by_lines(doc_lines(spark, d), FX.SECTION_LINES).select("doc_id", "line_no", "section")


@query
def line_buckets(spark, d):
    return V.count_by(line_tokens(spark, d), "doc_id", T.bucket("line_no", FX.BUCKET_LINES).alias("index"))


@query
def share_by_lang(spark, d):
    counts = V.count_by(V.remove_stop_words(doc_tokens(spark, d), stop(spark)), "lang", "word")
    return rounded(V.share(counts, "n", by="lang"))


@query
def keep_frequent(spark, d):
    frequent = V.keep_frequent(clean_tokens(spark, d), "word", FX.FREQUENT_ITEM)
    return frequent.select("doc_id", "line_no", "pos", "word")


@query
def drop_non_ascii(spark, d):
    counts = V.count_by(doc_tokens(spark, d), "word")
    return V.drop_non_ascii(counts, "word")


@query
def normalize_words(spark, d):
    normalized = doc_tokens(spark, d).withColumn("word", T.normalize_word("word"))
    return V.count_by(normalized, "lang", "word")


@query
def grep_lines(spark, d):
    return V.grep(doc_lines(spark, d), "text", "stupid", keep=["doc_id", "line_no", "text"])


# --------------------------------------------------------------------------- step 3: reshape, Zipf, statistics

from textmine.operators import frequency as FQ  # noqa: E402
from textmine.operators import stats as S  # noqa: E402
from textmine.operators import tfidf as TF  # noqa: E402

def lang_counts(spark, d, clean: bool = False) -> DataFrame:
    """Word counts per language, computed once (several branches read them)."""
    tokens = doc_tokens(spark, d)
    if clean:
        tokens = V.remove_stop_words(tokens, stop(spark))
    return corpus.materialize(V.count_by(tokens, "lang", "word"))


def frequency_table(spark, d) -> DataFrame:
    """Word shares per language, wide for English, long for the others."""
    tokens = V.remove_stop_words(doc_tokens(spark, d), stop(spark))
    return FQ.compare_freq(tokens.select("lang", "word"), "lang", "en")


@query
def compare_freq(spark, d):
    return rounded(frequency_table(spark, d))


@query
def cor_test(spark, d):
    return rounded(S.cor_test(frequency_table(spark, d), "proportion", "en", by="lang"))


@query
def cor_test_p(spark, d):
    return rounded(S.cor_test_p(frequency_table(spark, d), "proportion", "en", by="lang"))


@query
def zipf(spark, d):
    return rounded(TF.zipf(lang_counts(spark, d), by="lang"))


def zipf_all(spark, d) -> DataFrame:
    """Ranks over all languages together, shares of each language's total."""
    return TF.zipf(lang_counts(spark, d), by=None, total_by="lang")


@query
def zipf_global(spark, d):
    return rounded(zipf_all(spark, d))


@query
def loglog_fit(spark, d):
    z = TF.zipf(lang_counts(spark, d), by="lang").filter((F.col("rank") < 500) & (F.col("rank") > 10))
    return rounded(S.loglog_fit(z, "term_frequency", "rank", by="lang"))


@query
def loglog_fit_rev(spark, d):
    z = zipf_all(spark, d).filter((F.col("rank") < 500) & (F.col("rank") > 10))
    pooled = S.loglog_fit(z, "rank", "term_frequency")
    per_lang = S.loglog_fit(z, "rank", "term_frequency", by="lang")
    return rounded(V.bind_rows(pooled, per_lang))


@query
def hist_share(spark, d):
    counts = TF.term_share(lang_counts(spark, d), "lang")
    return S.histogram(counts, F.col("n") / F.col("total"), bins=FX.SHARE_BINS, hi=FX.SHARE_LIMIT, by="lang")


@query
def complete_grid(spark, d):
    return V.complete(lang_counts(spark, d, clean=True), "lang", "word", fill={"n": 0})


# --------------------------------------------------------------------------- step 4: tf-idf

def lang_tf_idf(spark, d) -> DataFrame:
    return TF.bind_tf_idf(lang_counts(spark, d), "word", "lang", "n")


@query
def tf_idf(spark, d):
    return rounded(lang_tf_idf(spark, d))


@query
def tf_idf_docs(spark, d):
    counts = V.count_by(words_by_doc(spark, d), "doc_id", "word")
    # a document's counts lie in one task: their sum is taken there
    with_total = counts.withColumn("total", F.sum("n").over(Window.partitionBy("doc_id")))
    return rounded(TF.bind_tf_idf(corpus.materialize(with_total), "word", "doc_id", "n", total="total"))


@query
def top_tf_idf(spark, d):
    return rounded(TF.top_tf_idf(lang_counts(spark, d), "word", "lang", "n", 15))


@query
def tf_idf_refiltered(spark, d):
    domain = lexicons.lexicon(spark, [(w,) for w in FX.DOMAIN_STOP], ["word"])
    counts = V.remove_stop_words(lang_counts(spark, d), domain)
    scored = TF.bind_tf_idf(counts, "word", "lang", "n").withColumn("word", T.clean_text("word"))
    return rounded(V.top_n(scored, 15, "tf_idf", by="lang"))


def bigram_counts_by_lang(spark, d) -> DataFrame:
    from textmine.operators import ngrams as NG

    grams = V.drop_stop_ngrams(NG.ngram_words(documents(spark, d), 2), ["word1", "word2"], stop(spark))
    united = V.unite(grams, "bigram", ["word1", "word2"], sep=" ")
    return corpus.materialize(V.count_by(united, "lang", "bigram"))


@query
def bigram_tf_idf(spark, d):
    return rounded(TF.bind_tf_idf(bigram_counts_by_lang(spark, d), "bigram", "lang", "n"))


@query
def top_bigram_tf_idf(spark, d):
    scored = TF.bind_tf_idf(bigram_counts_by_lang(spark, d), "bigram", "lang", "n")
    return rounded(TF.top_by_first_appearance(scored, 15, "bigram", "lang", "tf_idf"))


# --------------------------------------------------------------------------- step 5: sentiment

from textmine.operators import sentiment as SE  # noqa: E402


def polarity(spark):
    return lexicons.lexicon(spark, FX.POLARITY, ["word", "sentiment"])


def emotion(spark):
    return lexicons.lexicon(spark, FX.EMOTION, ["word", "sentiment"])


def valence(spark):
    return lexicons.lexicon(spark, FX.VALENCE, ["word", "value"], schema="word string, value long")


@query
def emotion_words(spark, d):
    en = doc_tokens(spark, d).filter(F.col("lang") == "en")
    return SE.emotion_words(en, emotion(spark), FX.EMOTION_NAME)


@query
def sentiment_arc(spark, d):
    return SE.sentiment_arc(line_tokens(spark, d), polarity(spark), "doc_id", size=FX.BUCKET_LINES)


@query
def valence_arc(spark, d):
    return SE.valence_arc(line_tokens(spark, d), valence(spark), "doc_id", size=FX.BUCKET_LINES)


@query
def compare_lexicons(spark, d):
    en = line_tokens(spark, d).filter(F.col("lang") == "en")
    return SE.compare_lexicons(en, valence(spark), polarity(spark), emotion(spark), "doc_id",
                               FX.LEXICON_NAMES, size=FX.BUCKET_LINES)


@query
def sentiment_contrib(spark, d):
    return SE.sentiment_contrib(doc_tokens(spark, d), polarity(spark), k=10)


@query
def sentiment_contrib_by_lang(spark, d):
    return SE.sentiment_contrib(doc_tokens(spark, d), polarity(spark), k=10, by="lang")


def chapter_tokens(spark, d) -> DataFrame:
    """``doc_id, chapter, word`` for every word."""
    seg = tok.segment_by_marker(doc_lines(spark, d), FX.MARKER, by="doc_id")
    return tok.unnest_tokens(seg, "word", "text").select("doc_id", "chapter", "word")


@query
def negative_ratio(spark, d):
    negative = polarity(spark).filter(F.col("sentiment") == "negative")
    return rounded(SE.negative_ratio(chapter_tokens(spark, d), negative, "doc_id", "chapter"))


def polarity_counts(spark, d) -> DataFrame:
    return V.count_by(V.join_lexicon(doc_tokens(spark, d), polarity(spark)), "word", "sentiment")


@query
def comparison_terms(spark, d):
    return rounded(SE.comparison_terms(polarity_counts(spark, d), k=100))


@query
def sentiment_matrix(spark, d):
    return V.spread(polarity_counts(spark, d), "sentiment", "n", list(SE.LABELS), fill=0)


# --------------------------------------------------------------------------- step 6: n-grams

from textmine.operators import ngrams as NG  # noqa: E402


@query
def bigrams(spark, d):
    return tok.unnest_tokens(documents(spark, d), "bigram", "text", "ngrams", n=2, position="pos") \
        .select("doc_id", "pos", "bigram")


@query
def bigram_counts_raw(spark, d):
    grams = tok.unnest_tokens(documents(spark, d), "bigram", "text", "ngrams", n=2)
    return V.count_by(grams, "bigram", sort=True)


@query
def count_bigrams(spark, d):
    return NG.count_bigrams(documents(spark, d), stop(spark))


@query
def count_trigrams(spark, d):
    return NG.count_ngrams(documents(spark, d), 3, stop(spark))


def bigram_edges(spark, d, min_n: int = FX.EDGE_MIN) -> DataFrame:
    edges, _ = P.to_graph(NG.count_bigrams(documents(spark, d), stop(spark)), "n", min_n, "word1", "word2")
    return edges


@query
def bigram_graph(spark, d):
    return bigram_edges(spark, d)


@query
def bigram_graph_nodigits(spark, d):
    edges = bigram_edges(spark, d, FX.EDGE_MIN_NODIGITS)
    return edges.filter(~T.has_digit("word1") & ~T.has_digit("word2"))


@query
def graph_vertices(spark, d):
    return P.graph_degrees(bigram_edges(spark, d), "word1", "word2")


@query
def graph_summary(spark, d):
    return P.graph_summary(bigram_edges(spark, d), "word1", "word2")


def split_bigrams(spark, d) -> DataFrame:
    return NG.ngram_words(documents(spark, d), 2)


@query
def modifiers(spark, d):
    filtered = V.drop_stop_ngrams(split_bigrams(spark, d), ["word1", "word2"], stop(spark))
    return NG.modifiers(filtered, FX.HEAD_WORD, by="lang")


@query
def not_words(spark, d):
    return V.count_by(split_bigrams(spark, d).filter(F.col("word1") == FX.NEGATORS[0]),
                      "word1", "word2", sort=True)


def negation_table(spark, d) -> DataFrame:
    return NG.negation_contrib(split_bigrams(spark, d), valence(spark), FX.NEGATORS)


@query
def negation_contrib(spark, d):
    return negation_table(spark, d)


@query
def negation_top20(spark, d):
    return NG.top_contrib(negation_table(spark, d), 20)


@query
def negation_by_negator(spark, d):
    return NG.top_contrib_by(negation_table(spark, d), 10)


@query
def sentences(spark, d):
    return tok.unnest_tokens(documents(spark, d), "sentence", "text", "sentences", position="sentence_no") \
        .select("doc_id", "sentence_no", "sentence")


def regex_pieces(spark, d) -> DataFrame:
    return tok.unnest_tokens(documents(spark, d), "chapter", "text", "regex", pattern=FX.SPLIT_PATTERN,
                             position="piece_no")


@query
def regex_split(spark, d):
    return regex_pieces(spark, d).select("doc_id", "piece_no", "chapter")


@query
def chapters_per_doc(spark, d):
    return regex_pieces(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("chapters"))


@query
def collapse_tokens(spark, d):
    words = clean_tokens(spark, d).withColumn("word", T.remove_first("word", "'"))
    return tok.collapse_tokens(words, "doc_id", ["line_no", "pos"])


# --------------------------------------------------------------------------- step 7: pairwise

from textmine.operators import pairwise as P  # noqa: E402


def section_words(spark, d) -> DataFrame:
    """Stop-free words of English documents with their 10-line section
    (section 0 dropped)."""
    en_lines = doc_lines(spark, d).filter(F.col("lang") == "en")
    sec = tok.section_by_lines(en_lines, FX.SECTION_LINES)
    words = V.remove_stop_words(tok.unnest_tokens(sec, "word", "text"), stop(spark))
    return corpus.materialize(words.select("word", "doc_id", "section"))


@query
def pairwise_count(spark, d):
    """Every ordered pair of words that share a section, most frequent first."""
    return P.pairwise_count(section_words(spark, d), "word", ["doc_id", "section"], sort=True)


@query
def pairwise_with(spark, d):
    """Partners of one word, most frequent first."""
    return P.pairwise_count(section_words(spark, d), "word", ["doc_id", "section"], sort=True,
                            items=[FX.PAIR_WORD])


@query
def pairwise_partners(spark, d):
    """From the counts of all pairs: each word's number of partners, its
    shared sections in all, and its largest count with one partner."""
    return P.partner_summary(section_words(spark, d), "word", ["doc_id", "section"])


@query
def pairwise_frequent(spark, d):
    """Every pair of frequent words that share a section, most frequent first."""
    frequent = V.keep_frequent(section_words(spark, d), "word", FX.FREQUENT_ITEM)
    return P.pairwise_count(frequent, "word", ["doc_id", "section"], sort=True)


@query
def cor_candidates(spark, d):
    """How many pairs of frequent words meet, and how many of them the bound
    on the correlation leaves to count."""
    frequent = V.keep_frequent(section_words(spark, d), "word", FX.FREQUENT_ITEM)
    return P.candidate_pairs(frequent, "word", ["doc_id", "section"], FX.EDGE_MIN_COR)


def word_cors(spark, d, **chosen) -> DataFrame:
    frequent = V.keep_frequent(section_words(spark, d), "word", FX.FREQUENT_ITEM)
    return P.pairwise_cor(frequent, "word", ["doc_id", "section"], **chosen)


@query
def pairwise_cor(spark, d):
    return rounded(word_cors(spark, d))


@query
def associates(spark, d):
    cors = word_cors(spark, d, items=FX.ASSOCIATE_WORDS)
    return rounded(P.associates(cors, FX.ASSOCIATE_WORDS, 6))


@query
def cor_graph(spark, d):
    cors = word_cors(spark, d, min_cor=FX.EDGE_MIN_COR)
    edges, _ = P.to_graph(cors, "correlation", FX.EDGE_MIN_COR)
    return rounded(edges)


# --------------------------------------------------------------------------- step 8: matrices, corpora, trends

from textmine.sources import matrix as M  # noqa: E402


def doc_triplets(spark, d) -> DataFrame:
    counts = V.count_by(words_by_doc(spark, d), "doc_id", "word")
    return corpus.materialize(counts.select(F.col("doc_id").alias("document"), F.col("word").alias("term"),
                                            F.col("n").alias("count")))


@query
def tidy_dtm(spark, d):
    vectors, vocab, _ = M.cast_dtm(doc_triplets(spark, d))
    return M.tidy_dtm(vectors, vocab)


@query
def vocabulary(spark, d):
    return M.vocabulary(doc_triplets(spark, d)).orderBy("index").limit(6)


@query
def flatten_corpus(spark, d):
    conv = corpus.spread(corpus.load(spark, d, "conversations"))
    nested = corpus.nest(conv, ["conv_id"], ["turn", "role", "text"], order="turn", chunk=16)
    flat = corpus.flatten_corpus(nested, "corpus")
    return tok.unnest_tokens(flat, "word", "text").select("conv_id", "turn", "role", "word")


@query
def nested_word_counts(spark, d):
    """Turns and words of every conversation, counted inside the nested
    column and added up over its chunks."""
    conv = corpus.spread(corpus.load(spark, d, "conversations"))
    nested = corpus.nest(conv, ["conv_id"], ["turn", "role", "text"], order="turn", chunk=4)
    counted = corpus.map_nested(nested, words=lambda e: F.coalesce(F.size(T.word_array(e["text"])), F.lit(0)))
    words = F.aggregate("corpus", F.lit(0).cast("long"), lambda n, e: n + e["words"])
    return counted.groupBy("conv_id").agg(F.sum(F.size("corpus")).alias("turns"), F.sum(words).alias("words"))


def pages_corpus(spark, d) -> DataFrame:
    return corpus.tidy_pages(corpus.spread(corpus.load(spark, d, "pages")))


@query
def tidy_pages(spark, d):
    return pages_corpus(spark, d)


@query
def corpus_word_freq(spark, d):
    words = tok.unnest_tokens(pages_corpus(spark, d).drop("heading", "url"), "word", "text")
    return V.count_by(V.remove_stop_words(words, stop(spark)), "word", sort=True)


@query
def corpus_tf_idf(spark, d):
    words = tok.unnest_tokens(pages_corpus(spark, d).drop("heading", "url"), "word", "text")
    counts = corpus.materialize(V.count_by(V.remove_stop_words(words, stop(spark)), "id", "word"))
    return rounded(TF.bind_tf_idf(counts, "word", "id", "n"))


@query
def signed_contrib(spark, d):
    return SE.signed_contrib(doc_triplets(spark, d), polarity(spark), "term", "count", min_n=200)


def year_trend(spark, d) -> DataFrame:
    counts = V.count_by(doc_tokens(spark, d), "source", "word")
    triplets = corpus.materialize(V.extract(counts, "source", "year")
                                  .select("year", F.col("word").alias("term"), F.col("n").alias("count")))
    return TF.term_trend(triplets, FX.TREND_TERMS)


@query
def term_trend(spark, d):
    return year_trend(spark, d)


@query
def trend(spark, d):
    tt = year_trend(spark, d)
    return rounded(S.trend(tt, F.col("count") / F.col("year_total"), "year", by="term"))


@query
def smooth_trend(spark, d):
    """Yearly share of the followed terms, smoothed by local regression."""
    tt = year_trend(spark, d)
    return rounded(S.smooth(tt, F.col("count") / F.col("year_total"), "year", by="term", span=FX.SMOOTH_SPAN,
                            points=FX.SMOOTH_POINTS))


@query
def five_number(spark, d):
    lengths = V.count_by(doc_tokens(spark, d), "lang", "doc_id")
    return rounded(S.five_number(lengths, "n", by="lang"))


@query
def sketched_five_number(spark, d):
    """Quartiles of document lengths by language from saved sketches by
    language and source."""
    from textmine.session import scratch_table

    lengths = V.count_by(doc_tokens(spark, d), "lang", "source", "doc_id")
    saved = corpus.save_table(S.quantile_sketches(lengths, "n", ["lang", "source"]), scratch_table(spark))
    return S.sketched_five_number(S.merge_sketches(saved, "lang"), "lang")


@query
def select_corpus(spark, d):
    labels = corpus.load(spark, d, "labels")
    chosen = corpus.select_corpus(documents(spark, d), labels, F.col("quality") == 1, "doc_id")
    words = V.remove_stop_words(tok.unnest_tokens(chosen, "word", "text"), stop(spark))
    return V.count_by(words, "word", sort=True)


@query
def select_stored_corpus(spark, d):
    """Words of the documents marked toxic, fetched from a corpus stored by
    document key: only the shards of chosen documents are read."""
    from textmine.session import scratch_table

    stored = corpus.save_corpus(documents(spark, d), scratch_table(spark), "doc_id", FX.CORPUS_SHARDS)
    chosen = corpus.select_stored(stored, corpus.load(spark, d, "labels"), F.col("toxic") == 1, "doc_id",
                                  FX.CORPUS_SHARDS)
    return V.count_by(V.remove_stop_words(tok.unnest_tokens(chosen, "word", "text"), stop(spark)), "word", sort=True)


@query
def meta_tf_idf(spark, d):
    labels = corpus.load(spark, d, "labels")
    docs = corpus.with_meta(documents(spark, d), labels, "doc_id", ["toxic"])
    counts = corpus.materialize(V.count_by(tok.unnest_tokens(docs, "word", "text"), "toxic", "word"))
    return rounded(TF.bind_tf_idf(counts, "word", "toxic", "n"))


@query
def saved_word_freq(spark, d):
    """Tokens saved as a table partitioned by language in the session's
    checkpoint folder, re-read, and counted by word."""
    from textmine.session import scratch_table

    saved = corpus.save_table(doc_tokens(spark, d).select("doc_id", "lang", "word"), scratch_table(spark),
                              partition_by=["lang"])
    return V.count_by(saved, "word", sort=True)


# --------------------------------------------------------------------------- public break rules

@query
def unicode_words(spark, d):
    """Words by the public word-break rules, counted by language."""
    return V.count_by(tok.unnest_tokens(documents(spark, d), "word", "text", rules="unicode"), "lang", "word")


@query
def unicode_sentences(spark, d):
    """Sentences of every document by the public break rules."""
    return tok.unnest_tokens(documents(spark, d), "sentence", "text", token="sentences", rules="unicode",
                             position="pos").select("doc_id", "pos", "sentence")


# --------------------------------------------------------------------------- step 9: topic models

from textmine.operators import topic_fit as FIT  # noqa: E402
from textmine.operators import topics as TM  # noqa: E402


def chapter_triplets(spark, d) -> DataFrame:
    """Stop-free counts per "title_chapter" document (title = language,
    chapter = document id)."""
    counts = V.count_by(V.remove_stop_words(words_by_doc(spark, d), stop(spark)), "lang", "doc_id", "word")
    return corpus.materialize(
        counts.select(F.concat_ws("_", "lang", F.col("doc_id").cast("string")).alias("document"),
                      "lang", F.col("word").alias("term"), F.col("n").alias("count")), spread_out=True)


def lang_model(spark, d):
    """Triplets with the beta and gamma of a deterministic stand-in for a
    topic model, so that every step after a fit can be checked: topic i is
    the i-th language of the data, beta the term's share in the language,
    gamma a document's normalised sum of ``count * beta``.  Each table is
    computed once (several branches read them)."""
    trip = chapter_triplets(spark, d).filter(F.col("lang").isNotNull())
    groups = V.global_row_number(trip.select("lang").distinct(), ["lang"], "topic")
    counts = V.count_by(trip, "lang", "term", wt="count").join(V.measured(groups), "lang")
    beta = corpus.materialize(V.share(corpus.materialize(counts), "n", by="topic", out="beta")
                              .select("topic", "term", "beta"))
    met = V.hot_join(trip.select("document", "term", "count"), TM.by_term(beta), "term", "_weight")
    scored = (met.select("document", "count", F.inline("_beta"))
              .groupBy("document", "topic").agg(F.sum(F.col("count") * F.col("beta")).alias("_s")))
    gamma = V.share(corpus.materialize(scored), "_s", by="document", out="gamma")
    return trip.drop("lang"), beta, corpus.materialize(gamma.select("document", "topic", "gamma"))


def named_once(spark, d) -> bool:
    """Whether every "title_chapter" name stands for one document, so that
    ``chapter_triplets`` holds each (document, term) once.  Only a missing id
    could make two names alike ("x_5" alone, and "x" with 5)."""
    return corpus.load(spark, d, "documents").filter(F.col("doc_id").isNull()).isEmpty()


@query
def topic_top_terms(spark, d):
    _, beta, _ = lang_model(spark, d)
    return rounded(TM.top_terms(beta, 5))


@query
def topic_log_ratio(spark, d):
    _, beta, _ = lang_model(spark, d)
    return rounded(TM.topic_log_ratio(beta, 1, 2))


@query
def topic_classify(spark, d):
    _, _, gamma = lang_model(spark, d)
    return rounded(TM.classify(gamma))


@query
def topic_consensus(spark, d):
    _, _, gamma = lang_model(spark, d)
    return TM.consensus(TM.classify(gamma))


@query
def topic_misclassified(spark, d):
    _, _, gamma = lang_model(spark, d)
    classes = TM.classify(gamma)
    return rounded(TM.misclassified(classes, TM.consensus(classes)))


@query
def topic_augment(spark, d):
    trip, beta, gamma = lang_model(spark, d)
    return TM.augment(trip, beta, gamma, distinct=named_once(spark, d))


@query
def topic_confusion(spark, d):
    trip, beta, gamma = lang_model(spark, d)
    book_topics = TM.consensus(TM.classify(gamma))
    return rounded(TM.confusion(TM.augment(trip, beta, gamma, distinct=named_once(spark, d)), book_topics))


@query
def topic_wrong_words(spark, d):
    trip, beta, gamma = lang_model(spark, d)
    book_topics = TM.consensus(TM.classify(gamma))
    return TM.wrong_words(TM.augment(trip, beta, gamma, distinct=named_once(spark, d)), book_topics)


def gamma_split(spark, d) -> DataFrame:
    _, _, gamma = lang_model(spark, d)
    return V.separate(gamma, "document", ["title", "chapter"], sep="_", convert={"chapter": "long"})


@query
def gamma_five_number(spark, d):
    return rounded(S.five_number(gamma_split(spark, d), "gamma", by=["title", "topic"]))


@query
def topic_order(spark, d):
    return TM.topic_order(gamma_split(spark, d))


@query
def chapter_counts(spark, d):
    """Word counts of "title_chapter" documents: each text is cut into
    chapters at its headings, the part before the first one is dropped, and
    stop words are removed."""
    words = V.remove_stop_words(chapter_tokens(spark, d).filter(F.col("chapter") > 0), stop(spark))
    named = V.unite(words, "document", ["doc_id", "chapter"])
    return V.count_by(named, "document", "word", sort=True)


@query
def inspect_document(spark, d):
    """The words of one chapter document, most frequent first."""
    return TM.inspect_document(chapter_counts(spark, d), FX.INSPECTED, term="word", value="n")


_FITTED: dict = {}


def fitted(spark, d, kind: str, k: int = 4) -> FIT.TopicModel:
    """A topic model of the session, fitted when a query first asks for it
    and kept as its checkpointed tables."""
    key = (spark.sparkContext.applicationId, d, kind, k)
    if key not in _FITTED:
        if kind == "variational":
            model = FIT.fit_variational(chapter_triplets(spark, d), k, seed=FX.LDA_SEED, iterations=FX.LDA_ITERATIONS)
        else:
            model = FIT.fit_gibbs(reassembled_triplets(spark, d), k, seed=FX.LDA_SEED, sweeps=FX.LDA_ITERATIONS)
        _FITTED[key] = model
    return _FITTED[key]


@query
def lda_beta(spark, d):
    return fitted(spark, d, "variational").beta()


@query
def lda_gamma(spark, d):
    return fitted(spark, d, "variational").gamma()


@query
def lda_top_terms(spark, d):
    return TM.top_terms(fitted(spark, d, "variational").beta(), 10)


@query
def lda_classify(spark, d):
    return TM.classify(fitted(spark, d, "variational").gamma())


@query
def lda_log_ratio(spark, d):
    """Terms that tell the two topics of a fitted model apart."""
    return TM.topic_log_ratio(fitted(spark, d, "variational", k=2).beta(), 1, 2)


def fitted_assignments(spark, d):
    """Cells of the matrix with their topic under a fitted model, and the
    topic of each title."""
    model = fitted(spark, d, "variational")
    gamma = corpus.materialize(model.gamma())
    return TM.augment(chapter_triplets(spark, d).drop("lang"), model.beta(), gamma), TM.classify(gamma)


@query
def lda_misclassified(spark, d):
    classes = corpus.materialize(TM.classify(fitted(spark, d, "variational").gamma()))
    return TM.misclassified(classes, TM.consensus(classes))


@query
def lda_confusion(spark, d):
    assigned, classes = fitted_assignments(spark, d)
    return TM.confusion(assigned, TM.consensus(classes))


@query
def lda_wrong_words(spark, d):
    assigned, classes = fitted_assignments(spark, d)
    return TM.wrong_words(assigned, TM.consensus(classes))


@query
def lda_rounds(spark, d):
    """Expected counts by topic after two variational rounds from a stated
    start: a topic per language, a term's weight 1 more than its count in the
    language."""
    trip = chapter_triplets(spark, d).filter(F.col("lang").isNotNull())
    start = (trip.groupBy("term").pivot("lang", list(FX.STOP_LANGS)).agg(F.sum("count")).fillna(0)
             .select("term", *[(F.col(lang) + 1.0).alias(c) for lang, c in zip(FX.STOP_LANGS, FIT.columns(4))]))
    model = FIT.fit_variational(trip, 4, iterations=2, inner=1, alpha=FX.LDA_PRIOR, estimate_alpha=False,
                               tolerance=0, start=start)
    each = F.array(*[F.struct(F.lit(j + 1).cast("long").alias("topic"), F.col(c).alias("weight"))
                     for j, c in enumerate(FIT.columns(4))])
    return rounded(model.topic_terms.select("term", F.inline(each)), 4)


def reassembled_triplets(spark, d) -> DataFrame:
    """Word counts of texts put together again from their clean words."""
    words = V.remove_stop_words(line_tokens(spark, d), stop(spark))
    texts = tok.collapse_tokens(words, "doc_id", ["line_no", "pos"])
    counts = V.count_by(tok.unnest_tokens(texts, "term", "text"), "doc_id", "term", name="count")
    return corpus.materialize(counts.withColumnRenamed("doc_id", "document"), spread_out=True)


@query
def lda_gibbs_beta(spark, d):
    """Topics of the sampling trainer on re-assembled texts."""
    return fitted(spark, d, "gibbs").beta()


@query
def lda_gibbs_gamma(spark, d):
    return fitted(spark, d, "gibbs").gamma()


@query
def lda_gibbs_assignments(spark, d):
    """Every (document, term) with its topic under the sampled model."""
    model = fitted(spark, d, "gibbs")
    trip = reassembled_triplets(spark, d).withColumn("document", F.col("document").cast("string"))
    return TM.augment(trip, model.beta(), model.gamma())


@query
def lda_em_beta(spark, d):
    """The EM trainer on texts put together again from their clean words."""
    model, _, vocab = TM.fit_lda(reassembled_triplets(spark, d), k=4, seed=FX.LDA_SEED, optimizer="em", max_iter=FX.LDA_ITERATIONS)
    return TM.tidy_beta(model, vocab)


# --------------------------------------------------------------------------- display orders, custom lists, clean-ups

@query
def ordered_top_words(spark, d):
    """Words above a count threshold with their display order (1 = least
    frequent), as used to order a bar chart."""
    counts = V.count_by(V.remove_stop_words(doc_tokens(spark, d), stop(spark)), "word")
    return V.with_order(counts.filter(F.col("n") > 600), "n", "word")


@query
def ordered_within_lang(spark, d):
    """Top 15 tf-idf words per language, ordered within each language."""
    top = V.top_n(lang_tf_idf(spark, d), 15, "tf_idf", by="lang")
    return rounded(V.with_order(top, "tf_idf", "word", by="lang"))


@query
def custom_stop_freq(spark, d):
    """Word counts after removing the stop lists extended with custom words."""
    custom = lexicons.lexicon(spark, [(w, "custom") for w in FX.CUSTOM_STOP], ["word", "lexicon"])
    extended = lexicons.extend_lexicon(stop(spark), custom)
    return V.count_by(V.remove_stop_words(doc_tokens(spark, d), extended), "word", sort=True)


@query
def whitelist_words(spark, d):
    """Word counts after replacing every character outside letters, digits,
    blanks and ``? & / -`` by a space."""
    docs = documents(spark, d).withColumn("text", T.clean_text("text", "whitelist"))
    return V.count_by(tok.unnest_tokens(docs, "word", "text"), "lang", "word")


@query
def piped_bigram_counts(spark, d):
    """A user pipeline function applied with ``DataFrame.transform``."""
    return documents(spark, d).transform(NG.count_bigrams, stop(spark))


@query
def line_bigrams(spark, d):
    """Bigrams across line breaks computed from the line table (no document
    gathered); same rows as ``bigrams`` from whole texts."""
    return tok.line_ngrams(doc_lines(spark, d), "doc_id", n=2, output="bigram", position="pos") \
        .select("doc_id", "pos", "bigram")
