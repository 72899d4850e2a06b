"""SQL equivalents of the registered queries, for DuckDB over the same
parquet tables (views ``documents``, ``pages``, ``conversations`` ...).

They are written independently of the Spark code, in plain SQL idioms
(``unnest``, window functions, ``NOT EXISTS``), so agreement means the
operators are right, not merely consistent.  Doubles are rounded to 6
decimals and integer sums cast to BIGINT to line up with Spark's types.
"""

from __future__ import annotations

from textmine.functions.text import WORD_PATTERN
from textmine.plans import fixtures as FX
from textmine.sources.lexicons import default_stop_words

ORACLE: dict[str, str] = {}


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


PAT = q(WORD_PATTERN)

STOP = values([(w,) for lang in FX.STOP_LANGS for w in default_stop_words(lang)], ["word"])
POLARITY = values(FX.POLARITY, ["word", "sentiment"])
EMOTION = values(FX.EMOTION, ["word", "sentiment"])
VALENCE = f"(SELECT word, CAST(value AS BIGINT) AS value FROM {values(FX.VALENCE, ['word', 'value'])})"

DOC_TOKENS = f"""doc_tokens AS (
  SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), {PAT})) AS word
  FROM documents)"""

LINES = """lines AS (
  SELECT doc_id, lang, source,
         unnest(generate_series(1, len(string_split(text, chr(10))))) AS line_no,
         unnest(string_split(text, chr(10))) AS text
  FROM documents)"""

LINE_TOKENS = f"""line_tokens AS (
  SELECT doc_id, lang, source, line_no,
         unnest(generate_series(1, len(regexp_extract_all(lower(text), {PAT})))) AS pos,
         unnest(regexp_extract_all(lower(text), {PAT})) AS word
  FROM lines)"""

STOP_CTE = f"stop AS {STOP}"

CLEAN_DOC_TOKENS = """clean_doc_tokens AS (
  SELECT * FROM doc_tokens t WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word))"""

CLEAN_LINE_TOKENS = """clean_line_tokens AS (
  SELECT * FROM line_tokens t WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


# --------------------------------------------------------------------------- step 1

sql("top_words_by_lang", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS, """counts AS (
  SELECT lang, word, count(*) AS n FROM clean_doc_tokens GROUP BY lang, word)""") + """
SELECT lang, word, n FROM (
  SELECT *, rank() OVER (PARTITION BY lang ORDER BY n DESC) AS rk FROM counts) WHERE rk <= 10""")

sql("tok_words", with_(LINES, LINE_TOKENS) + "SELECT doc_id, line_no, pos, word FROM line_tokens")

sql("word_freq", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS) +
    "SELECT word, count(*) AS n FROM clean_doc_tokens GROUP BY word")

sql("word_freq_by_lang", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS) +
    "SELECT lang, word, count(*) AS n FROM clean_doc_tokens GROUP BY lang, word")

sql("top_words", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS) +
    "SELECT word, count(*) AS n FROM clean_doc_tokens GROUP BY word ORDER BY n DESC, word LIMIT 100")

# --------------------------------------------------------------------------- step 2

sql("line_numbers", with_(LINES) + "SELECT doc_id, line_no, text FROM lines")

sql("segments", with_(LINES) + f"""
SELECT doc_id, line_no,
       sum(CASE WHEN regexp_matches(text, {q('(?i)' + FX.MARKER)}) THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT
         AS chapter
FROM lines""")

sql("sections", with_(LINES) + f"""
SELECT doc_id, line_no, line_no // {FX.SECTION_LINES} AS section FROM lines
WHERE line_no // {FX.SECTION_LINES} > 0""")

sql("line_buckets", with_(LINES, LINE_TOKENS) + f"""
SELECT doc_id, line_no // {FX.BUCKET_LINES} AS "index", count(*) AS n
FROM line_tokens GROUP BY 1, 2""")

sql("share_by_lang", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS, """counts AS (
  SELECT lang, word, count(*) AS n FROM clean_doc_tokens GROUP BY lang, word)""") + """
SELECT lang, word, n, round(n / sum(n) OVER (PARTITION BY lang), 6) AS proportion FROM counts""")

sql("keep_frequent", with_(LINES, LINE_TOKENS, STOP_CTE, CLEAN_LINE_TOKENS) + """
SELECT doc_id, line_no, pos, word FROM clean_line_tokens
WHERE word IN (SELECT word FROM clean_line_tokens GROUP BY word HAVING count(*) >= 20)""")

sql("drop_non_ascii", with_(DOC_TOKENS) + """
SELECT word, count(*) AS n FROM doc_tokens GROUP BY word
HAVING NOT regexp_matches(word, '[^\\x00-\\x7F]')""")

sql("normalize_words", with_(DOC_TOKENS) + """
SELECT lang, nullif(regexp_extract(word, '[a-z'']+', 0), '') AS word, count(*) AS n
FROM doc_tokens GROUP BY 1, 2""")

sql("grep_lines", with_(LINES) + "SELECT doc_id, line_no, text FROM lines WHERE regexp_matches(text, 'stupid')")

# --------------------------------------------------------------------------- step 3

LANG_COUNTS = """lang_counts AS (SELECT lang, word, count(*) AS n FROM doc_tokens GROUP BY lang, word)"""
CLEAN_LANG_COUNTS = """clean_lang_counts AS (
  SELECT lang, word, count(*) AS n FROM clean_doc_tokens GROUP BY lang, word)"""

FREQUENCY = """norm_counts AS (
  SELECT lang, nullif(regexp_extract(word, '[a-z'']+', 0), '') AS word, count(*) AS n
  FROM clean_doc_tokens WHERE lang IS NOT NULL GROUP BY 1, 2),
props AS (SELECT lang, word, n / sum(n) OVER (PARTITION BY lang) AS proportion FROM norm_counts),
others AS (SELECT DISTINCT lang FROM props WHERE lang <> 'en'),
frequency AS (
  SELECT w.word, e.proportion AS en, o.lang, p.proportion
  FROM (SELECT DISTINCT word FROM props) w CROSS JOIN others o
  LEFT JOIN props e ON e.lang = 'en' AND e.word IS NOT DISTINCT FROM w.word
  LEFT JOIN props p ON p.lang = o.lang AND p.word IS NOT DISTINCT FROM w.word)"""

FREQ_BASE = with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS, FREQUENCY)

sql("compare_freq", FREQ_BASE + """
SELECT word, round(en, 6) AS en, lang, round(proportion, 6) AS proportion FROM frequency""")

sql("cor_test", FREQ_BASE + """, ct AS (
  SELECT lang, corr(proportion, en) AS r, count(*) AS n FROM frequency
  WHERE proportion IS NOT NULL AND en IS NOT NULL GROUP BY lang)
SELECT lang, round(r, 6) AS estimate, n,
       round(r * sqrt((n - 2) / (1.0 - r * r)), 6) AS statistic, n - 2 AS parameter,
       round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS conf_low,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS conf_high
FROM ct""")

# The tail of the t-distribution for whole degrees of freedom n, a finite
# series in the angle whose tangent is t / sqrt(n).
sql("cor_test_p", FREQ_BASE + """, ct AS (
  SELECT lang, corr(proportion, en) AS r, count(*) AS n FROM frequency
  WHERE proportion IS NOT NULL AND en IS NOT NULL GROUP BY lang),
tt AS (
  SELECT *, n - 2 AS v, r * sqrt((n - 2) / (1.0 - r * r)) AS t, atan(abs(r * sqrt((n - 2) / (1.0 - r * r))) / sqrt(n - 2)) AS a
  FROM ct),
within AS (
  SELECT *, CASE
    WHEN v <= 0 THEN NULL
    WHEN v % 2 = 0 THEN sin(a) * list_sum([exp(lgamma(j + 0.5) - lgamma(j + 1) - 0.5 * ln(pi()) + 2 * j * ln(cos(a)))
                                           FOR j IN range(0, v // 2)])
    ELSE 2 / pi() * (a + coalesce(sin(a) * list_sum([0.5 * sqrt(pi()) * exp(lgamma(j + 1) - lgamma(j + 1.5) + (2 * j + 1) * ln(cos(a)))
                                                     FOR j IN range(0, (v - 1) // 2)]), 0)) END AS inside
  FROM tt)
SELECT lang, round(r, 6) AS estimate, n, round(t, 6) AS statistic, v AS parameter,
       round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS conf_low,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS conf_high, round(1 - inside, 6) AS p_value
FROM within""")

ZIPF = """zipf AS (
  SELECT lang, word, n, sum(n) OVER (PARTITION BY lang)::BIGINT AS total,
         row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank,
         n / sum(n) OVER (PARTITION BY lang) AS term_frequency
  FROM lang_counts)"""

ZIPF_GLOBAL = """zipf_global AS (
  SELECT lang, word, n, sum(n) OVER (PARTITION BY lang)::BIGINT AS total,
         row_number() OVER (ORDER BY n DESC, lang, word) AS rank,
         n / sum(n) OVER (PARTITION BY lang) AS term_frequency
  FROM lang_counts)"""

sql("zipf", with_(DOC_TOKENS, LANG_COUNTS, ZIPF) + """
SELECT lang, word, n, total, rank, round(term_frequency, 6) AS term_frequency FROM zipf""")

sql("zipf_global", with_(DOC_TOKENS, LANG_COUNTS, ZIPF_GLOBAL) + """
SELECT lang, word, n, total, rank, round(term_frequency, 6) AS term_frequency FROM zipf_global""")

sql("loglog_fit", with_(DOC_TOKENS, LANG_COUNTS, ZIPF) + """
SELECT lang,
       round(regr_intercept(log10(term_frequency), log10(rank)), 6) AS intercept,
       round(regr_slope(log10(term_frequency), log10(rank)), 6) AS slope,
       round(regr_r2(log10(term_frequency), log10(rank)), 6) AS r2,
       regr_count(log10(term_frequency), log10(rank))::BIGINT AS n
FROM zipf WHERE rank < 500 AND rank > 10 GROUP BY lang""")

sql("loglog_fit_rev", with_(DOC_TOKENS, LANG_COUNTS, ZIPF_GLOBAL) + """, sub AS (
  SELECT * FROM zipf_global WHERE rank < 500 AND rank > 10)
SELECT NULL AS lang,
       round(regr_intercept(log10(rank), log10(term_frequency)), 6) AS intercept,
       round(regr_slope(log10(rank), log10(term_frequency)), 6) AS slope,
       round(regr_r2(log10(rank), log10(term_frequency)), 6) AS r2,
       regr_count(log10(rank), log10(term_frequency))::BIGINT AS n
FROM sub
UNION ALL
SELECT lang,
       round(regr_intercept(log10(rank), log10(term_frequency)), 6),
       round(regr_slope(log10(rank), log10(term_frequency)), 6),
       round(regr_r2(log10(rank), log10(term_frequency)), 6),
       regr_count(log10(rank), log10(term_frequency))::BIGINT
FROM sub GROUP BY lang""")

HIST_WIDTH = repr(0.0009 / 30)
sql("hist_share", with_(DOC_TOKENS, LANG_COUNTS) + f""", shares AS (
  SELECT lang, n / sum(n) OVER (PARTITION BY lang) AS x FROM lang_counts)
SELECT lang, least(floor(x / {HIST_WIDTH}), 29)::BIGINT AS bin, count(*) AS count
FROM shares WHERE x <= 0.0009 GROUP BY 1, 2""")

sql("complete_grid", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS, CLEAN_LANG_COUNTS) + """
SELECT l.lang, w.word, coalesce(c.n, 0) AS n
FROM (SELECT DISTINCT lang FROM clean_lang_counts) l
CROSS JOIN (SELECT DISTINCT word FROM clean_lang_counts) w
LEFT JOIN clean_lang_counts c ON c.lang = l.lang AND c.word = w.word""")

# --------------------------------------------------------------------------- step 4


def tf_idf_cte(name: str, counts: str, term: str, doc: str) -> str:
    return f"""{name} AS (
  SELECT *, n / sum(n) OVER (PARTITION BY {doc}) AS tf,
         ln((SELECT count(*) FROM (SELECT DISTINCT {doc} FROM {counts})) / count(*) OVER (PARTITION BY {term})) AS idf
  FROM {counts})"""


def tf_idf_out(name: str, cols: str) -> str:
    return f"SELECT {cols}, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tf_idf FROM {name}"


sql("tf_idf", with_(DOC_TOKENS, LANG_COUNTS, tf_idf_cte("t", "lang_counts", "word", "lang")) +
    tf_idf_out("t", "lang, word, n"))

sql("tf_idf_docs", with_(DOC_TOKENS, """doc_counts AS (
  SELECT doc_id, word, count(*) AS n FROM doc_tokens GROUP BY doc_id, word)""",
                         tf_idf_cte("t", "doc_counts", "word", "doc_id")) + tf_idf_out("t", "doc_id, word, n"))

sql("top_tf_idf", with_(DOC_TOKENS, LANG_COUNTS, tf_idf_cte("t", "lang_counts", "word", "lang")) + """
SELECT lang, word, n, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tf_idf FROM (
  SELECT *, rank() OVER (PARTITION BY lang ORDER BY tf * idf DESC) AS rk FROM t) WHERE rk <= 15""")

DOMAIN = values([(w,) for w in FX.DOMAIN_STOP], ["word"])
sql("tf_idf_refiltered", with_(DOC_TOKENS, LANG_COUNTS, f"""kept AS (
  SELECT * FROM lang_counts c WHERE NOT EXISTS (SELECT 1 FROM {DOMAIN} s WHERE s.word = c.word))""",
                               tf_idf_cte("t", "kept", "word", "lang")) + """
SELECT lang, replace(word, '_', '') AS word, n, round(tf, 6) AS tf, round(idf, 6) AS idf,
       round(tf * idf, 6) AS tf_idf FROM (
  SELECT *, rank() OVER (PARTITION BY lang ORDER BY tf * idf DESC) AS rk FROM t) WHERE rk <= 15""")

DOC_WORDS = f"""doc_words AS (
  SELECT doc_id, lang, source, regexp_extract_all(lower(text), {PAT}) AS w FROM documents)"""

POS_TOKENS = """pos_tokens AS (
  SELECT doc_id, lang, source, unnest(generate_series(1, len(w))) AS pos, unnest(w) AS word FROM doc_words)"""

# Consecutive word pairs per document (across line breaks); a document with
# fewer than two words gives one NULL bigram.
BIGRAMS = """bigram_words AS (
  SELECT * FROM (
    SELECT doc_id, lang, source, pos, word AS word1,
           lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS word2 FROM pos_tokens)
  WHERE word2 IS NOT NULL
  UNION ALL
  SELECT doc_id, lang, source, 1, NULL, NULL FROM doc_words WHERE len(w) < 2)"""

FILTERED_BIGRAMS = """filtered_bigrams AS (
  SELECT * FROM bigram_words b
  WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = b.word1)
    AND NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = b.word2))"""

BIGRAM_LANG_COUNTS = """bigram_counts AS (
  SELECT lang, concat_ws(' ', word1, word2) AS bigram, count(*) AS n FROM filtered_bigrams GROUP BY 1, 2)"""

BIGRAM_BASE = (DOC_WORDS, POS_TOKENS, BIGRAMS, STOP_CTE, FILTERED_BIGRAMS, BIGRAM_LANG_COUNTS,
               tf_idf_cte("bt", "bigram_counts", "bigram", "lang"))

sql("bigram_tf_idf", with_(*BIGRAM_BASE) + tf_idf_out("bt", "lang, bigram, n"))

sql("top_bigram_tf_idf", with_(*BIGRAM_BASE, """best AS (
  SELECT bigram, max(tf * idf) AS best FROM bt GROUP BY bigram)""", """first_lang AS (
  SELECT b.bigram, min(b.lang) AS first_lang FROM bt b JOIN best USING (bigram)
  WHERE b.tf * b.idf = best.best GROUP BY b.bigram)""") + """
SELECT lang, bigram, n, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tf_idf FROM (
  SELECT bt.*, row_number() OVER (PARTITION BY lang ORDER BY best.best DESC, first_lang, bigram) AS rk
  FROM bt JOIN best USING (bigram) JOIN first_lang USING (bigram)) WHERE rk <= 15""")

# --------------------------------------------------------------------------- step 5

sql("emotion_words", with_(DOC_TOKENS) + f"""
SELECT word, count(*) AS n FROM doc_tokens JOIN {EMOTION} e USING (word)
WHERE lang = 'en' AND e.sentiment = {q(FX.EMOTION_NAME)} GROUP BY word""")

ARC = f"""arc AS (
  SELECT doc_id, line_no // {FX.BUCKET_LINES} AS idx, p.sentiment
  FROM line_tokens JOIN {POLARITY} p USING (word))"""

sql("sentiment_arc", with_(LINES, LINE_TOKENS, ARC) + """
SELECT doc_id, idx AS "index",
       count(*) FILTER (WHERE sentiment = 'negative') AS negative,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment = 'positive') - count(*) FILTER (WHERE sentiment = 'negative') AS sentiment
FROM arc GROUP BY 1, 2""")

sql("valence_arc", with_(LINES, LINE_TOKENS) + f"""
SELECT doc_id, line_no // {FX.BUCKET_LINES} AS "index", sum(v.value)::BIGINT AS sentiment
FROM line_tokens JOIN {VALENCE} v USING (word) GROUP BY 1, 2""")

sql("compare_lexicons", with_(LINES, LINE_TOKENS, """en AS (SELECT * FROM line_tokens WHERE lang = 'en')""",
                              f"""labelled AS (
  SELECT {q(FX.LEXICON_NAMES[1])} AS method, doc_id, line_no // {FX.BUCKET_LINES} AS idx, p.sentiment
  FROM en JOIN {POLARITY} p USING (word)
  UNION ALL
  SELECT {q(FX.LEXICON_NAMES[2])}, doc_id, line_no // {FX.BUCKET_LINES}, e.sentiment
  FROM en JOIN {EMOTION} e USING (word) WHERE e.sentiment IN ('positive', 'negative'))""") + f"""
SELECT doc_id, line_no // {FX.BUCKET_LINES} AS "index", sum(v.value)::BIGINT AS sentiment, {q(FX.LEXICON_NAMES[0])} AS method,
       NULL::BIGINT AS negative, NULL::BIGINT AS positive
FROM en JOIN {VALENCE} v USING (word) GROUP BY 1, 2
UNION ALL
SELECT doc_id, idx,
       count(*) FILTER (WHERE sentiment = 'positive') - count(*) FILTER (WHERE sentiment = 'negative'),
       method, count(*) FILTER (WHERE sentiment = 'negative'), count(*) FILTER (WHERE sentiment = 'positive')
FROM labelled GROUP BY doc_id, idx, method""")

POL_COUNTS = f"""pol_counts AS (
  SELECT lang, word, p.sentiment, count(*) AS n FROM doc_tokens JOIN {POLARITY} p USING (word) GROUP BY 1, 2, 3)"""

sql("sentiment_contrib", with_(DOC_TOKENS, POL_COUNTS, """c AS (
  SELECT word, sentiment, sum(n)::BIGINT AS n FROM pol_counts GROUP BY 1, 2)""") + """
SELECT word, sentiment, n FROM (
  SELECT *, rank() OVER (PARTITION BY sentiment ORDER BY n DESC) AS rk FROM c) WHERE rk <= 10""")

sql("sentiment_contrib_by_lang", with_(DOC_TOKENS, POL_COUNTS) + """
SELECT lang, word, sentiment, n FROM (
  SELECT *, rank() OVER (PARTITION BY lang, sentiment ORDER BY n DESC) AS rk FROM pol_counts) WHERE rk <= 10""")

SEG_LINES = f"""seg AS (
  SELECT *, sum(CASE WHEN regexp_matches(text, {q('(?i)' + FX.MARKER)}) THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT
         AS chapter
  FROM lines)"""

SEG_TOKENS = f"""seg_tokens AS (
  SELECT doc_id, chapter, unnest(regexp_extract_all(lower(text), {PAT})) AS word FROM seg)"""

sql("negative_ratio", with_(LINES, SEG_LINES, SEG_TOKENS, """words AS (
  SELECT doc_id, chapter, count(*) AS words FROM seg_tokens GROUP BY 1, 2)""", f"""neg AS (
  SELECT doc_id, chapter, count(*) AS negativewords FROM seg_tokens
  WHERE word IN (SELECT word FROM {POLARITY} WHERE sentiment = 'negative') GROUP BY 1, 2)""", """r AS (
  SELECT n.doc_id, n.chapter, negativewords, words, negativewords / words AS ratio
  FROM neg n LEFT JOIN words w USING (doc_id, chapter) WHERE n.chapter <> 0)""") + """
SELECT doc_id, chapter, negativewords, words, round(ratio, 6) AS ratio FROM (
  SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY ratio DESC) AS rk FROM r) WHERE rk = 1""")

POL_WIDE = """wide AS (
  SELECT word,
         coalesce(sum(n) FILTER (WHERE sentiment = 'negative'), 0)::BIGINT AS negative,
         coalesce(sum(n) FILTER (WHERE sentiment = 'positive'), 0)::BIGINT AS positive
  FROM pol_counts GROUP BY word)"""

sql("comparison_terms", with_(DOC_TOKENS, POL_COUNTS, POL_WIDE, """sh AS (
  SELECT *, negative / (SELECT sum(negative) FROM wide) AS sn, positive / (SELECT sum(positive) FROM wide) AS sp
  FROM wide)""", """d AS (
  SELECT *, sn - (sn + sp) / 2 AS dn, sp - (sn + sp) / 2 AS dp FROM sh)""") + """
SELECT word, negative, positive, round(greatest(dn, dp), 6) AS freq,
       CASE WHEN dn = greatest(dn, dp) THEN 'negative' ELSE 'positive' END AS "group"
FROM d ORDER BY greatest(dn, dp) DESC, word LIMIT 100""")

sql("sentiment_matrix", with_(DOC_TOKENS, POL_COUNTS, POL_WIDE) + "SELECT word, negative, positive FROM wide")

# --------------------------------------------------------------------------- step 6

sql("bigrams", with_(DOC_WORDS, POS_TOKENS, BIGRAMS) + """
SELECT doc_id, pos, CASE WHEN word1 IS NULL THEN NULL ELSE word1 || ' ' || word2 END AS bigram FROM bigram_words""")

sql("bigram_counts_raw", with_(DOC_WORDS, POS_TOKENS, BIGRAMS) + """
SELECT CASE WHEN word1 IS NULL THEN NULL ELSE word1 || ' ' || word2 END AS bigram, count(*) AS n
FROM bigram_words GROUP BY 1""")

COUNT_BIGRAMS = """bigram_pairs AS (SELECT word1, word2, count(*) AS n FROM filtered_bigrams GROUP BY 1, 2)"""
BIGRAM_PAIRS = (DOC_WORDS, POS_TOKENS, BIGRAMS, STOP_CTE, FILTERED_BIGRAMS, COUNT_BIGRAMS)

sql("count_bigrams", with_(*BIGRAM_PAIRS) + "SELECT word1, word2, n FROM bigram_pairs")

sql("count_trigrams", with_(DOC_WORDS, POS_TOKENS, STOP_CTE, """tri AS (
  SELECT * FROM (
    SELECT doc_id, word AS word1, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS word2,
           lead(word, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS word3 FROM pos_tokens)
  WHERE word3 IS NOT NULL
  UNION ALL SELECT doc_id, NULL, NULL, NULL FROM doc_words WHERE len(w) < 3)""") + """
SELECT word1, word2, word3, count(*) AS n FROM tri t
WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word1)
  AND NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word2)
  AND NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word3)
GROUP BY 1, 2, 3""")

sql("bigram_graph", with_(*BIGRAM_PAIRS) + "SELECT word1, word2, n FROM bigram_pairs WHERE n > 20")

sql("bigram_graph_nodigits", with_(*BIGRAM_PAIRS) + """
SELECT word1, word2, n FROM bigram_pairs
WHERE n > 40 AND NOT regexp_matches(word1, '\\d') AND NOT regexp_matches(word2, '\\d')""")

EDGES = """edges AS (SELECT word1, word2, n FROM bigram_pairs WHERE n > 20)"""
sql("graph_vertices", with_(*BIGRAM_PAIRS, EDGES) + """
SELECT coalesce(o.name, i.name) AS name, coalesce(o.out_degree, 0) AS out_degree, coalesce(i.in_degree, 0) AS in_degree
FROM (SELECT word1 AS name, count(*) AS out_degree FROM edges GROUP BY 1) o
FULL JOIN (SELECT word2 AS name, count(*) AS in_degree FROM edges GROUP BY 1) i ON o.name = i.name""")

sql("graph_summary", with_(*BIGRAM_PAIRS, EDGES) + """
SELECT (SELECT count(*) FROM (SELECT word1 FROM edges UNION SELECT word2 FROM edges)) AS vertices,
       count(*) AS edges FROM edges""")

sql("modifiers", with_(DOC_WORDS, POS_TOKENS, BIGRAMS, STOP_CTE, FILTERED_BIGRAMS) + f"""
SELECT lang, word1, count(*) AS n FROM filtered_bigrams WHERE word2 = {q(FX.HEAD_WORD)} GROUP BY 1, 2""")

sql("not_words", with_(DOC_WORDS, POS_TOKENS, BIGRAMS) + f"""
SELECT word1, word2, count(*) AS n FROM bigram_words WHERE word1 = {q(FX.NEGATORS[0])} GROUP BY 1, 2""")

NEGATORS = ", ".join(q(w) for w in FX.NEGATORS)
NEGATION = f"""negation AS (
  SELECT word1, word2, v.value, count(*) AS n, count(*) * v.value AS contribution
  FROM bigram_words b JOIN {VALENCE} v ON v.word = b.word2
  WHERE word1 IN ({NEGATORS}) GROUP BY word1, word2, v.value)"""
NEG_BASE = (DOC_WORDS, POS_TOKENS, BIGRAMS, NEGATION)

sql("negation_contrib", with_(*NEG_BASE) + "SELECT word1, word2, value, n, contribution FROM negation")

sql("negation_top20", with_(*NEG_BASE) + """
SELECT word1, word2, value, n, contribution FROM negation ORDER BY abs(contribution) DESC, word1, word2 LIMIT 20""")

sql("negation_by_negator", with_(*NEG_BASE) + """
SELECT word1, word2, value, n, contribution FROM (
  SELECT *, rank() OVER (PARTITION BY word1 ORDER BY abs(contribution) DESC) AS rk FROM negation) WHERE rk <= 10""")

sql("sentences", """WITH s AS (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(lower(text), '[^.!?]+[.!?]*'),
                                            lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
                             lambda x: x <> '') AS pieces
  FROM documents)
SELECT doc_id, unnest(generate_series(1, len(pieces))) AS sentence_no, unnest(pieces) AS sentence FROM s""")

TRIMMED = "list_transform({}, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(12) || chr(13)))".format(
    f"regexp_split_to_array(text, {q(FX.SPLIT_PATTERN)})")
REGEX_PIECES = f"""pieces AS (
  SELECT doc_id, unnest(generate_series(1, len({TRIMMED}))) AS piece_no, lower(unnest({TRIMMED})) AS chapter
  FROM documents)"""

sql("regex_split", with_(REGEX_PIECES) + "SELECT doc_id, piece_no, chapter FROM pieces WHERE chapter <> ''")

sql("chapters_per_doc", with_(REGEX_PIECES) + """
SELECT doc_id, count(*) AS chapters FROM pieces WHERE chapter <> '' GROUP BY doc_id""")

sql("collapse_tokens", with_(LINES, LINE_TOKENS, STOP_CTE, CLEAN_LINE_TOKENS) + """
SELECT doc_id, string_agg(regexp_replace(word, '''', ''), ' ' ORDER BY line_no, pos) AS text
FROM clean_line_tokens GROUP BY doc_id""")

# --------------------------------------------------------------------------- step 7

SECTION_WORDS = f"""section_words AS (
  SELECT word, doc_id, line_no // {FX.SECTION_LINES} AS section FROM clean_line_tokens
  WHERE lang = 'en' AND line_no // {FX.SECTION_LINES} > 0)"""
SEC_BASE = (LINES, LINE_TOKENS, STOP_CTE, CLEAN_LINE_TOKENS, SECTION_WORDS)

PAIRS = (*SEC_BASE, """pres AS (SELECT DISTINCT word, doc_id, section FROM section_words)""", """pairs AS (
  SELECT a.word AS item1, b.word AS item2, count(*) AS n
  FROM pres a JOIN pres b ON a.doc_id = b.doc_id AND a.section = b.section AND a.word <> b.word GROUP BY 1, 2)""")

sql("pairwise_count", with_(*PAIRS) + "SELECT item1, item2, n FROM pairs")

sql("pairwise_with", with_(*SEC_BASE, """pres AS (SELECT DISTINCT word, doc_id, section FROM section_words)""") + f"""
SELECT a.word AS item1, b.word AS item2, count(*) AS n
FROM pres a JOIN pres b ON a.doc_id = b.doc_id AND a.section = b.section AND a.word <> b.word
WHERE a.word = {q(FX.PAIR_WORD)} GROUP BY 1, 2""")

sql("pairwise_partners", with_(*PAIRS) + """
SELECT item1, count(*) AS partners, sum(n)::BIGINT AS together, max(n) AS strongest FROM pairs GROUP BY item1""")

WORD_CORS = """frequent AS (
  SELECT * FROM section_words WHERE word IN (SELECT word FROM section_words GROUP BY word HAVING count(*) >= 20)),
pres AS (SELECT DISTINCT word, doc_id, section FROM frequent),
nf AS (SELECT count(*)::DOUBLE AS nf FROM (SELECT DISTINCT doc_id, section FROM pres)),
c AS (SELECT word, count(*)::DOUBLE AS c FROM pres GROUP BY word),
co AS (
  SELECT a.word AS w1, b.word AS w2, count(*)::DOUBLE AS n11
  FROM pres a JOIN pres b ON a.doc_id = b.doc_id AND a.section = b.section AND a.word <> b.word GROUP BY 1, 2),
word_cors AS (
  SELECT c1.word AS item1, c2.word AS item2,
         (nf * coalesce(n11, 0) - c1.c * c2.c) / sqrt(c1.c * (nf - c1.c) * c2.c * (nf - c2.c)) AS correlation
  FROM c c1 JOIN c c2 ON c1.word <> c2.word CROSS JOIN nf
  LEFT JOIN co ON co.w1 = c1.word AND co.w2 = c2.word)"""

sql("pairwise_frequent", with_(*SEC_BASE, WORD_CORS) + "SELECT w1 AS item1, w2 AS item2, n11::BIGINT AS n FROM co")

sql("cor_candidates", with_(*SEC_BASE, WORD_CORS) + f"""
SELECT count(*) AS together,
       count(*) FILTER (a.c < nf AND b.c < nf AND least(a.c / (nf - a.c), b.c / (nf - b.c))
                        >= {FX.EDGE_MIN_COR ** 2} * (1 - 1e-9) * greatest(a.c / (nf - a.c), b.c / (nf - b.c))) AS built
FROM co JOIN c a ON a.word = w1 JOIN c b ON b.word = w2 CROSS JOIN nf WHERE w1 < w2""")

sql("pairwise_cor", with_(*SEC_BASE, WORD_CORS) + "SELECT item1, item2, round(correlation, 6) AS correlation FROM word_cors")

ASSOC = ", ".join(q(w) for w in FX.ASSOCIATE_WORDS)
sql("associates", with_(*SEC_BASE, WORD_CORS) + f"""
SELECT item1, item2, round(correlation, 6) AS correlation FROM (
  SELECT *, rank() OVER (PARTITION BY item1 ORDER BY correlation DESC) AS rk FROM word_cors
  WHERE item1 IN ({ASSOC}) AND correlation IS NOT NULL) WHERE rk <= 6""")

sql("cor_graph", with_(*SEC_BASE, WORD_CORS) + """
SELECT item1, item2, round(correlation, 6) AS correlation FROM word_cors WHERE correlation > 0.15""")

# --------------------------------------------------------------------------- step 8

DOC_TRIPLETS = """doc_triplets AS (
  SELECT doc_id AS document, word AS term, count(*) AS count FROM doc_tokens GROUP BY 1, 2)"""

sql("tidy_dtm", with_(DOC_TOKENS, DOC_TRIPLETS) + "SELECT document, term, count::DOUBLE AS count FROM doc_triplets")

sql("vocabulary", with_(DOC_TOKENS, DOC_TRIPLETS) + """
SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS "index"
FROM (SELECT DISTINCT term FROM doc_triplets) ORDER BY term LIMIT 6""")

sql("nested_word_counts", f"""
SELECT conv_id, count(*) AS turns, sum(coalesce(len(regexp_extract_all(lower(text), {PAT})), 0))::BIGINT AS words
FROM conversations GROUP BY conv_id""")

sql("flatten_corpus", f"""
SELECT conv_id, turn, role, unnest(regexp_extract_all(lower(text), {PAT})) AS word FROM conversations""")

PAGES = r"""pages_corpus AS (
  SELECT page_id AS id,
         nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS heading,
         url,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
           '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
           '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
           '<[^>]*>', ' ', 'g'),
           '\s+', ' ', 'g'),
           '^ | $', '', 'g') AS text
  FROM pages)"""

PAGE_TOKENS = f"""page_tokens AS (
  SELECT id, unnest(regexp_extract_all(lower(text), {PAT})) AS word FROM pages_corpus),
clean_page_tokens AS (
  SELECT * FROM page_tokens t WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word))"""

sql("tidy_pages", with_(PAGES) + "SELECT id, heading, url, text FROM pages_corpus")

sql("corpus_word_freq", with_(PAGES, STOP_CTE, PAGE_TOKENS) +
    "SELECT word, count(*) AS n FROM clean_page_tokens GROUP BY word")

sql("corpus_tf_idf", with_(PAGES, STOP_CTE, PAGE_TOKENS, """page_counts AS (
  SELECT id, word, count(*) AS n FROM clean_page_tokens GROUP BY id, word)""",
                           tf_idf_cte("t", "page_counts", "word", "id")) + tf_idf_out("t", "id, word, n"))

sql("signed_contrib", with_(DOC_TOKENS, DOC_TRIPLETS) + f"""
SELECT p.sentiment, t.term,
       (CASE WHEN p.sentiment = 'negative' THEN -sum(t.count) ELSE sum(t.count) END)::BIGINT AS n
FROM doc_triplets t JOIN {POLARITY} p ON p.word = t.term
GROUP BY 1, 2 HAVING sum(t.count) >= 200""")

TERMS = ", ".join(q(w) for w in FX.TREND_TERMS)
TERM_TREND = r"""tc AS (
  SELECT CAST(nullif(regexp_extract(source, '(\d+)', 1), '') AS BIGINT) AS year, word AS term, count(*) AS count
  FROM doc_tokens GROUP BY source, word),
grid AS (
  SELECT y.year, t.term FROM (SELECT DISTINCT year FROM tc) y CROSS JOIN (SELECT DISTINCT term FROM tc) t),
completed AS (
  SELECT g.year, g.term, coalesce(tc.count, 0) AS count FROM grid g LEFT JOIN tc USING (year, term)),
year_term AS (
  SELECT *, sum(count) OVER (PARTITION BY year)::BIGINT AS year_total FROM completed)"""

sql("term_trend", with_(DOC_TOKENS, TERM_TREND) + f"""
SELECT year, term, count, year_total FROM year_term WHERE term IN ({TERMS})""")

sql("trend", with_(DOC_TOKENS, TERM_TREND) + f"""
SELECT term, round(regr_slope(count / year_total, year), 6) AS slope,
       round(regr_intercept(count / year_total, year), 6) AS intercept,
       regr_count(count / year_total, year)::BIGINT AS n
FROM year_term WHERE term IN ({TERMS}) GROUP BY term""")


# Rows by place and year; the reach is the distance within which the nearest
# share of rows lies; a square is fitted by weighted least squares.
sql("smooth_trend", with_(DOC_TOKENS, TERM_TREND) + f""", pts AS (
  SELECT term, CAST(year AS DOUBLE) AS x, count / year_total AS y FROM year_term
  WHERE term IN ({TERMS}) AND year IS NOT NULL AND count / year_total IS NOT NULL),
places AS (
  SELECT term, greatest(1, CAST(floor(count(*) * {FX.SMOOTH_SPAN} + 1e-5) AS BIGINT)) AS q,
         min(x) AS lo, max(x) AS hi FROM pts GROUP BY term),
spots AS (SELECT term, q, i, lo + (hi - lo) * i / {FX.SMOOTH_POINTS - 1}.0 AS x0 FROM places, range({FX.SMOOTH_POINTS}) r(i)),
near AS (
  SELECT g.term, i, x0, q, x, y, abs(x - x0) AS d,
         row_number() OVER (PARTITION BY g.term, i ORDER BY abs(x - x0), x, y) AS r
  FROM spots g JOIN pts USING (term)),
reach AS (SELECT term, i, max(d) FILTER (r <= q) AS h, min(d) AS m FROM near GROUP BY term, i),
weighted AS (
  SELECT n.term, i, x0, x, y, CASE WHEN h > 0 THEN (x - x0) / h ELSE 0 END AS z,
         CASE WHEN m < h THEN pow(1 - pow(least(d / h, 1), 3), 3) WHEN d = h THEN 1 ELSE 0 END AS w
  FROM near n JOIN reach USING (term, i)),
sums AS (
  SELECT term, i, any_value(x0) AS x, count(DISTINCT x) AS v, sum(w) AS s0, sum(w * z) AS s1, sum(w * z * z) AS s2,
         sum(w * z * z * z) AS s3, sum(w * z * z * z * z) AS s4, sum(w * y) AS t0, sum(w * z * y) AS t1, sum(w * z * z * y) AS t2
  FROM weighted WHERE w > 0 GROUP BY term, i)
SELECT term, round(x, 6) AS year, round(CASE
    WHEN v > 2 THEN (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - t2 * s3) + s2 * (t1 * s3 - t2 * s2))
                    / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2))
    WHEN v = 2 THEN (t0 * s2 - t1 * s1) / (s0 * s2 - s1 * s1) ELSE t0 / s0 END, 6) AS fitted
FROM sums""")


def five_numbers(x: str) -> str:
    names = ["minimum", "lower", "middle", "upper", "maximum"]
    return ", ".join(f"round(quantile_cont({x}, {p})::DOUBLE, 6) AS {n}"
                     for p, n in zip(("0.0", "0.25", "0.5", "0.75", "1.0"), names))


sql("sketched_five_number", with_(DOC_TOKENS) + f"""
SELECT lang, {', '.join(f"quantile_disc(n::DOUBLE, {p}) AS {name}" for p, name in
                        zip(("0.0", "0.25", "0.5", "0.75", "1.0"), ("minimum", "lower", "middle", "upper", "maximum")))}
FROM (SELECT lang, doc_id, count(*) AS n FROM doc_tokens GROUP BY 1, 2) GROUP BY lang""")

sql("five_number", with_(DOC_TOKENS) + f"""
SELECT lang, {five_numbers('n')}
FROM (SELECT lang, doc_id, count(*) AS n FROM doc_tokens GROUP BY 1, 2) GROUP BY lang""")

sql("select_corpus", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS) + """
SELECT word, count(*) AS n FROM clean_doc_tokens
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY word""")

sql("select_stored_corpus", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS) + """
SELECT word, count(*) AS n FROM clean_doc_tokens
WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY word""")

sql("meta_tf_idf", with_(DOC_TOKENS, """meta_counts AS (
  SELECT l.toxic, t.word, count(*) AS n FROM doc_tokens t LEFT JOIN labels l USING (doc_id) GROUP BY 1, 2)""",
                         tf_idf_cte("t", "meta_counts", "word", "toxic")) + tf_idf_out("t", "toxic, word, n"))

sql("saved_word_freq", with_(DOC_TOKENS) + "SELECT word, count(*) AS n FROM doc_tokens GROUP BY word")

# --------------------------------------------------------------------------- public break rules
# Written from the rules, not from the patterns of the Spark code: every code
# point gets a class, and whether a word goes on is decided from the classes on
# both sides.

sql("unicode_words", r"""
WITH points AS (
  SELECT doc_id, lang, unnest(string_split(lower(text), '')) AS c, unnest(range(1, length(lower(text)) + 1)) AS i
  FROM documents),
classes AS (
  SELECT *, CASE WHEN regexp_full_match(c, '[\p{M}\p{Cf}]') THEN 'extend'
    WHEN regexp_full_match(c, '[\p{Katakana}]') THEN 'kana'
    WHEN regexp_full_match(c, '[\p{Han}\p{Hiragana}\p{Thai}\p{Lao}\p{Myanmar}\p{Khmer}]') THEN 'alone'
    WHEN regexp_full_match(c, '[\p{L}\p{Nl}]') THEN 'letter'
    WHEN regexp_full_match(c, '\p{Nd}') THEN 'digit'
    WHEN regexp_full_match(c, '\p{Pc}') THEN 'joint'
    WHEN c IN (',', ';') THEN 'between digits'
    WHEN c = chr(183) THEN 'between letters'
    WHEN c IN ('.', chr(39), chr(8216), chr(8217)) THEN 'between' ELSE 'other' END AS k
  FROM points),
bases AS (SELECT * FROM classes WHERE k <> 'extend'),
around AS (
  SELECT doc_id, lang, i, k, lag(k, 2) OVER w AS k2, lag(k) OVER w AS k1, lead(k) OVER w AS n1
  FROM bases WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
starts AS (
  SELECT doc_id, lang, i, k, CASE
    WHEN k IN ('letter', 'digit') AND k1 IN ('letter', 'digit', 'joint') THEN 0
    WHEN k = 'kana' AND k1 IN ('kana', 'joint') THEN 0
    WHEN k = 'joint' AND k1 IN ('letter', 'digit', 'kana', 'joint') THEN 0
    WHEN k IN ('between', 'between letters') AND k1 = 'letter' AND n1 = 'letter' THEN 0
    WHEN k IN ('between', 'between digits') AND k1 = 'digit' AND n1 = 'digit' THEN 0
    WHEN k = 'letter' AND k1 IN ('between', 'between letters') AND k2 = 'letter' THEN 0
    WHEN k = 'digit' AND k1 IN ('between', 'between digits') AND k2 = 'digit' THEN 0
    ELSE 1 END AS s
  FROM around),
numbered AS (
  SELECT c.doc_id, c.lang, c.i, c.c, coalesce(b.k, 'extend') AS k,
         sum(coalesce(s, 0)) OVER (PARTITION BY c.doc_id ORDER BY c.i) AS word_no
  FROM classes c LEFT JOIN starts b ON b.doc_id = c.doc_id AND b.i = c.i),
words AS (
  SELECT doc_id, lang, string_agg(c, '' ORDER BY i) AS word
  FROM numbered GROUP BY doc_id, lang, word_no HAVING bool_or(k IN ('letter', 'digit', 'kana', 'alone')))
SELECT lang, word, count(*) AS n FROM words GROUP BY lang, word""")

sql("unicode_sentences", r"""
WITH atoms AS (
  SELECT doc_id, unnest(a) AS a, unnest(range(1, len(a) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(regexp_replace(text, '[\s\p{Z}]', ' ', 'g'),
          '[^.!?]+|[.!?][\p{M}\p{Cf}]*(?:[\p{Ps}\p{Pe}\p{Pi}\p{Pf}"''][\p{M}\p{Cf}]*)* *') AS a FROM documents)),
around AS (
  SELECT doc_id, i, a, lead(a) OVER w AS n, right(lag(a) OVER w, 1) AS p FROM atoms
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ends AS (
  SELECT doc_id, i, a, CASE
    WHEN n IS NULL OR NOT regexp_matches(a, '^[.!?]') THEN 0
    WHEN regexp_matches(n, '^[.!?,:\-\x{2013}\x{2014}]') THEN 0
    WHEN a = '.' AND regexp_matches(n, '^\p{Nd}') THEN 0
    WHEN a = '.' AND regexp_matches(n, '^\p{Lu}') AND regexp_matches(p, '[\p{Lu}\p{Ll}]') THEN 0
    WHEN a[1] = '.' AND regexp_matches(n, '^[^\p{L}]*\p{Ll}') THEN 0
    ELSE 1 END AS e
  FROM around),
numbered AS (
  SELECT doc_id, i, a,
         coalesce(sum(e) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM ends),
joined AS (SELECT doc_id, s, trim(string_agg(a, '' ORDER BY i)) AS sentence FROM numbered GROUP BY doc_id, s)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS pos, lower(sentence) AS sentence
FROM joined WHERE sentence <> ''""")

# --------------------------------------------------------------------------- step 9

LANG_MODEL = """trip AS (
  SELECT lang || '_' || CAST(doc_id AS VARCHAR) AS document, lang, word AS term, count(*) AS count
  FROM clean_doc_tokens WHERE lang IS NOT NULL GROUP BY lang, doc_id, word),
beta AS (
  SELECT topic, term, n / sum(n) OVER (PARTITION BY topic) AS beta
  FROM (SELECT dense_rank() OVER (ORDER BY lang) AS topic, term, n
        FROM (SELECT lang, term, sum(count) AS n FROM trip GROUP BY 1, 2))),
gamma AS (
  SELECT document, topic, s / sum(s) OVER (PARTITION BY document) AS gamma
  FROM (SELECT t.document, b.topic, sum(t.count * b.beta) AS s FROM trip t JOIN beta b USING (term) GROUP BY 1, 2)),
classes AS (
  SELECT title, chapter, topic, gamma FROM (
    SELECT split_part(document, '_', 1) AS title, TRY_CAST(split_part(document, '_', 2) AS BIGINT) AS chapter,
           topic, gamma,
           rank() OVER (PARTITION BY split_part(document, '_', 1), split_part(document, '_', 2)
                        ORDER BY gamma DESC) AS rk
    FROM gamma) WHERE rk = 1),
book_topics AS (
  SELECT title AS consensus, topic FROM (
    SELECT title, topic, n, rank() OVER (PARTITION BY title ORDER BY n DESC) AS rk
    FROM (SELECT title, topic, count(*) AS n FROM classes GROUP BY 1, 2)) WHERE rk = 1),
assignments AS (
  SELECT document, term, count, topic AS assigned_topic FROM (
    SELECT t.document, t.term, t.count, g.topic,
           row_number() OVER (PARTITION BY t.document, t.term ORDER BY g.gamma * b.beta DESC, g.topic) AS rk
    FROM trip t JOIN gamma g USING (document) JOIN beta b ON b.topic = g.topic AND b.term = t.term)
  WHERE rk = 1)"""
TOPIC_BASE = (DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS, LANG_MODEL)

def digamma_sql(x: str) -> str:
    """Derivative of log gamma: the recurrence to ``x + 8``, then five terms
    of the asymptotic series."""
    shifted = f"(({x}) + 8)"
    below = " + ".join(f"1 / (({x}) + {i})" for i in range(8))
    tail = " ".join(f"{sign} 1 / ({n} * pow({shifted}, {p}))" for sign, n, p in
                    (("-", 12, 2), ("+", 120, 4), ("-", 252, 6), ("+", 240, 8), ("-", 132, 10)))
    return f"(ln({shifted}) - 1 / (2 * {shifted}) {tail} - ({below}))"


sql("lda_rounds", with_(*TOPIC_BASE) + f""", topic_names AS (
  SELECT * FROM (VALUES {', '.join(f"({i + 1}, {q(lang)})" for i, lang in enumerate(FX.STOP_LANGS))}) AS t(topic, lang)),
start AS (
  SELECT CAST(n.topic AS BIGINT) AS topic, t.term, 1 + coalesce(sum(trip.count), 0) AS w
  FROM topic_names n CROSS JOIN (SELECT DISTINCT term FROM trip) t
  LEFT JOIN trip ON trip.lang = n.lang AND trip.term = t.term GROUP BY n.topic, t.term),
share0 AS (SELECT topic, term, w / sum(w) OVER (PARTITION BY topic) AS b FROM start),
part0 AS (
  SELECT document, t.term, topic, count * b / sum(b) OVER (PARTITION BY document, t.term) AS m
  FROM trip t JOIN share0 s ON s.term = t.term),
gamma0 AS (SELECT document, topic, {FX.LDA_PRIOR} + sum(m) AS g FROM part0 GROUP BY document, topic),
log0 AS (SELECT document, topic, exp({digamma_sql('g')} - {digamma_sql('sum(g) OVER (PARTITION BY document)')}) AS e
         FROM gamma0),
share1 AS (SELECT topic, term, sum(m) / sum(sum(m)) OVER (PARTITION BY topic) AS b FROM part0 GROUP BY topic, term),
part1 AS (
  SELECT t.term, s.topic, count * b * e / sum(b * e) OVER (PARTITION BY t.document, t.term) AS m
  FROM trip t JOIN share1 s ON s.term = t.term JOIN log0 l ON l.document = t.document AND l.topic = s.topic)
SELECT term, topic, round(sum(m), 4) AS weight FROM part1 GROUP BY term, topic""")

sql("topic_top_terms", with_(*TOPIC_BASE) + """
SELECT topic, term, round(beta, 6) AS beta FROM (
  SELECT *, rank() OVER (PARTITION BY topic ORDER BY beta DESC) AS rk FROM beta) WHERE rk <= 5""")

sql("topic_log_ratio", with_(*TOPIC_BASE) + """, wide AS (
  SELECT term, max(beta) FILTER (WHERE topic = 1) AS topic1, max(beta) FILTER (WHERE topic = 2) AS topic2
  FROM beta WHERE topic IN (1, 2) GROUP BY term)
SELECT term, round(topic1, 6) AS topic1, round(topic2, 6) AS topic2, round(log2(topic2 / topic1), 6) AS log_ratio
FROM wide WHERE topic1 > 0.001 OR topic2 > 0.001""")

sql("topic_classify", with_(*TOPIC_BASE) + "SELECT title, chapter, topic, round(gamma, 6) AS gamma FROM classes")

sql("topic_consensus", with_(*TOPIC_BASE) + "SELECT consensus, topic FROM book_topics")

sql("topic_misclassified", with_(*TOPIC_BASE) + """
SELECT c.topic, c.title, c.chapter, round(c.gamma, 6) AS gamma, b.consensus
FROM classes c JOIN book_topics b USING (topic) WHERE c.title <> b.consensus""")

sql("topic_augment", with_(*TOPIC_BASE) + 'SELECT document, term, count, assigned_topic FROM assignments')

sql("topic_confusion", with_(*TOPIC_BASE) + """, cm AS (
  SELECT split_part(a.document, '_', 1) AS title, b.consensus, sum(a.count)::BIGINT AS n
  FROM assignments a JOIN book_topics b ON b.topic = a.assigned_topic GROUP BY 1, 2)
SELECT title, consensus, n, round(n / sum(n) OVER (PARTITION BY title), 6) AS percent FROM cm""")

sql("topic_wrong_words", with_(*TOPIC_BASE) + """
SELECT split_part(a.document, '_', 1) AS title, b.consensus, a.term, sum(a.count)::BIGINT AS n
FROM assignments a JOIN book_topics b ON b.topic = a.assigned_topic
WHERE split_part(a.document, '_', 1) <> b.consensus GROUP BY 1, 2, 3""")

sql("gamma_five_number", with_(*TOPIC_BASE) + f"""
SELECT split_part(document, '_', 1) AS title, topic, {five_numbers('gamma')}
FROM gamma GROUP BY 1, 2""")

sql("topic_order", with_(*TOPIC_BASE) + """
SELECT title, row_number() OVER (ORDER BY m, title) AS ord FROM (
  SELECT split_part(document, '_', 1) AS title, avg(gamma * topic) AS m FROM gamma GROUP BY 1)""")

CHAPTER_COUNTS = f"""chaptered AS (
  SELECT doc_id, text, sum(CASE WHEN regexp_matches(text, {q('(?i)' + FX.MARKER)}) THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT
         AS chapter
  FROM lines),
chapter_words AS (
  SELECT doc_id::VARCHAR || '_' || chapter::VARCHAR AS document,
         unnest(regexp_extract_all(lower(text), {PAT})) AS word
  FROM chaptered WHERE chapter > 0),
chapter_counts AS (
  SELECT document, word, count(*) AS n FROM chapter_words w
  WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = w.word) GROUP BY document, word)"""

sql("chapter_counts", with_(LINES, STOP_CTE, CHAPTER_COUNTS) + "SELECT document, word, n FROM chapter_counts")

sql("inspect_document", with_(LINES, STOP_CTE, CHAPTER_COUNTS) +
    f"SELECT document, word, n FROM chapter_counts WHERE document = {q(FX.INSPECTED)}")

# --------------------------------------------------------------------------- orders, custom lists, clean-ups

sql("ordered_top_words", with_(DOC_TOKENS, STOP_CTE, CLEAN_DOC_TOKENS) + """
SELECT word, n, row_number() OVER (ORDER BY n, word) AS ord FROM (
  SELECT word, count(*) AS n FROM clean_doc_tokens GROUP BY word) WHERE n > 600""")

sql("ordered_within_lang", with_(DOC_TOKENS, LANG_COUNTS, tf_idf_cte("t", "lang_counts", "word", "lang")) + """
SELECT lang, word, n, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tf_idf,
       row_number() OVER (PARTITION BY lang ORDER BY tf * idf, word) AS ord FROM (
  SELECT *, rank() OVER (PARTITION BY lang ORDER BY tf * idf DESC) AS rk FROM t) WHERE rk <= 15""")

sql("custom_stop_freq", with_(DOC_TOKENS, STOP_CTE) + f"""
SELECT word, count(*) AS n FROM doc_tokens t
WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.word = t.word)
  AND NOT EXISTS (SELECT 1 FROM {values([(w,) for w in FX.CUSTOM_STOP], ["word"])} c WHERE c.word = t.word)
GROUP BY word""")

sql("whitelist_words", f"""
SELECT lang, word, count(*) AS n FROM (
  SELECT lang, unnest(regexp_extract_all(lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}} \\t?&/\\-]', ' ', 'g')),
                                         {PAT})) AS word
  FROM documents) GROUP BY 1, 2""")

sql("piped_bigram_counts", with_(DOC_WORDS, POS_TOKENS, BIGRAMS, STOP_CTE, FILTERED_BIGRAMS) + """
SELECT word1, word2, count(*) AS n FROM filtered_bigrams GROUP BY 1, 2""")

sql("line_bigrams", ORACLE["bigrams"])
