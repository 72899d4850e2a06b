"""Tokenising and text shaping: one row per token, n-gram, sentence or piece.

Tokenising is a Generate over an array built by built-in regex functions:
it runs inside the scan's task, keeps all other columns, and needs no
shuffle.  N-grams are built inside each row from the word array with
higher-order functions, so a document's n-grams never leave its task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmine.functions.text import (
    NGRAM_SEP,
    UNICODE_WORD_PATTERN,
    sentence_pieces,
    unicode_sentences,
    word_array,
)
from textmine.operators.verbs import running_sum

TOKENS = ("words", "ngrams", "sentences", "regex", "lines")
# Trimmed from both ends of a regex piece.
BLANKS = " \t\n\f\r"


def _ngram_array(words: Column, n: int, into: Sequence[str] | None, keep_short: bool) -> Column:
    """Array of the n-grams of ``words`` (strings, or structs when ``into``
    names one field per word).  Too-short input gives one NULL n-gram when
    ``keep_short``, else none."""
    size = F.size(words)
    if into:
        grams = F.arrays_zip(*[F.slice(words, k + 1, size - n + 1).alias(name) for k, name in enumerate(into)])
        empty_value = F.struct(*[F.lit(None).cast("string").alias(name) for name in into])
    else:
        starts = F.sequence(F.lit(1), size - n + 1)
        grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), NGRAM_SEP))
        empty_value = F.lit(None).cast("string")

    fallback = F.array(empty_value) if keep_short else F.filter(F.array(empty_value), lambda x: F.lit(False))
    return F.when(size >= n, grams).otherwise(fallback)


def unnest_tokens(df: DataFrame, output: str, input: str = "text", token: str = "words", *,
                  to_lower: bool = True, drop: bool = True, n: int = 2,
                  pattern: str | None = None, keep_underscore: bool = True,
                  position: str | None = None, into: Sequence[str] | None = None,
                  keep_short: bool = True, collapse: Sequence[str] | None = None,
                  order: str = "line_no", rules: str = "regex",
                  abbreviations: Sequence[str] = ()) -> DataFrame:
    """One row per token of ``input``; every other column is carried along.

    token:
      ``words``     lower-cased words, punctuation removed;
      ``ngrams``    ``n`` consecutive words joined by a space (or, with
                    ``into``, one column per word), across line breaks of the
                    row's text;
      ``sentences`` sentences (lower-cased, trimmed);
      ``regex``     pieces between matches of ``pattern`` (split first, then
                    trimmed and lower-cased; blank pieces dropped);
      ``lines``     lines of the text.
    ``rules``: ``regex`` (words of letters, digits and inner apostrophes;
    every stop ends a sentence) or ``unicode``, the public word and sentence
    break rules (``3.14`` is one word and ends no sentence, and neither does
    ``Dr. X`` with ``abbreviations=["Dr."]``).
    ``position`` names an optional 1-based token-number column.
    ``collapse`` (with ``order``) first joins a line table's lines per key
    in line order, so n-grams, sentences and pieces run across line breaks;
    only the key columns are kept then.  This gathers each document into one
    row; for n-grams of large documents use ``line_ngrams`` instead.
    Rows whose text yields no token produce no row (except the NULL n-gram
    of a too-short text).
    """
    if token not in TOKENS:
        raise ValueError(f"token must be one of {TOKENS}")
    if collapse:
        df = collapse_lines(df, list(collapse), order, text=input)
    if rules not in ("regex", "unicode"):
        raise ValueError("rules must be 'regex' or 'unicode'")
    if rules == "unicode" and not pattern and token in ("words", "ngrams"):
        pattern = UNICODE_WORD_PATTERN
    others = [c for c in df.columns if not (drop and c == input) and c != output]
    if token == "words":
        arr = word_array(input, to_lower=to_lower, keep_underscore=keep_underscore, pattern=pattern)
    elif token == "ngrams":
        # The word array becomes a column first: the n-gram lambda then reads
        # it instead of re-running the regex for every element.
        df = df.withColumn("_tok_words", word_array(input, to_lower=to_lower,
                                                    keep_underscore=keep_underscore, pattern=pattern))
        arr = _ngram_array(F.col("_tok_words"), n, into, keep_short)
    elif token == "sentences":
        arr = (unicode_sentences(input, to_lower, tuple(abbreviations)) if rules == "unicode"
               else sentence_pieces(input, to_lower=to_lower))
    elif token == "regex":
        if not pattern:
            raise ValueError("token='regex' needs a pattern")
        pieces = F.transform(F.split(F.col(input), pattern), lambda s: F.btrim(s, F.lit(BLANKS)))
        arr = F.transform(pieces, lambda s: F.lower(s)) if to_lower else pieces
    else:
        arr = F.split(F.col(input), "\n")

    exploded = df.select(*others, F.posexplode(arr).alias("_tok_pos", "_tok"))
    if token == "regex":
        exploded = exploded.filter(F.col("_tok") != "")
    cols = [F.col(c) for c in others]
    if position:
        cols.append((F.col("_tok_pos") + 1).cast("long").alias(position))
    if token == "ngrams" and into:
        cols.extend(F.col(f"_tok.{name}").alias(name) for name in into)
    else:
        cols.append(F.col("_tok").alias(output))
    return exploded.select(*cols)


def _joined_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, sep: str,
                     chunk: int) -> DataFrame:
    """``value`` of each key joined in the order of ``order``, in two levels:
    the rows of each ``chunk`` numbers of the first order column make one
    string, then a key's strings are joined.  So a key's rows are never
    gathered as such, only its pieces, and a hot key is many groups of the
    first shuffle.  A first order column that holds no numbers makes one
    piece.  Null values are left out; null orders come first."""
    piece = F.floor(F.col(order[0]).try_cast("double") / chunk)
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]

    def join(rows: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda x: x["v"]), sep)

    # a piece of null values alone is null, so that it adds no separator
    some = F.when(F.count(value) > 0, join(F.struct(*fields, F.col(value).alias("v"))))
    pieces = df.withColumn("_piece", piece).groupBy(*keys, "_piece").agg(some.alias("_joined"))
    return pieces.groupBy(*keys).agg(join(F.struct(F.col("_piece").alias("p"), F.col("_joined").alias("v"))).alias(out))


def collapse_lines(df: DataFrame, keys: Sequence[str], order: str, text: str = "text",
                   sep: str = "\n", chunk: int = 4096) -> DataFrame:
    """Re-assemble a line table into one text per key, in line order (the
    unit a document-level tokeniser works on), ``chunk`` lines at a time."""
    return _joined_in_order(df, keys, [order], text, text, sep, chunk)


def collapse_tokens(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                    word: str = "word", out: str = "text", sep: str = " ", chunk: int = 4096) -> DataFrame:
    """Paste each document's tokens back into one string in token order; the
    tokens of ``chunk`` lines (or positions, whichever ``order`` begins with)
    are pasted first."""
    keys = [key] if isinstance(key, str) else list(key)
    return _joined_in_order(df, keys, list(order), word, out, sep, chunk)


def segment_by_marker(lines_df: DataFrame, pattern: str, by: str | Sequence[str],
                      order: str = "line_no", text: str = "text", out: str = "chapter",
                      ignore_case: bool = True, chunk: int = 65536) -> DataFrame:
    """Running count of marker lines (chapter headings) within each document;
    lines before the first marker are segment 0."""
    flag = F.col(text).rlike(("(?i)" if ignore_case else "") + pattern).cast("long")
    return running_sum(lines_df, flag, by, order, out, chunk=chunk)


def number_lines(lines_df: DataFrame, by: str | Sequence[str], order: Sequence, out: str = "line_no") -> DataFrame:
    """``row_number()`` of each line within its document for a line table
    that has no position yet (``sources.lines`` numbers split text without
    this).  Uses the distributed row numbering, so a very long document is
    not numbered in one task."""
    from textmine.operators.verbs import row_number_by

    return row_number_by(lines_df, by, list(order), out)


def section_by_lines(lines_df: DataFrame, size: int = 10, order: str = "line_no",
                     out: str = "section", drop_first: bool = True) -> DataFrame:
    """``section = line number %/% size``; section 0 (the first size-1
    lines) is dropped when ``drop_first``."""
    out_df = lines_df.withColumn(out, F.floor(F.col(order) / size).cast("long"))
    return out_df.filter(F.col(out) > 0) if drop_first else out_df


def line_ngrams(lines_df: DataFrame, by: str | Sequence[str], n: int = 2, order: str = "line_no",
                text: str = "text", output: str = "ngram", position: str | None = None,
                keep_short: bool = True, chunk: int = 65536) -> DataFrame:
    """N-grams of a line table across line breaks, without gathering a
    document into one row or one task.

    Every token gets its position in the document from a two-level running
    sum of words per line.  The words that continue a line's last n-grams
    are always among the first n-1 words of the following lines, so they
    are fetched by an equi-join on (document, position), which has no hot
    key.  Each line then builds the n-grams that start in it from its own
    words plus at most n-1 continuation words.  ``position`` is the
    n-gram's start in the document; a document with fewer than ``n`` words
    gives one NULL n-gram when ``keep_short``.  Eager: the lines' word arrays
    are stored once, so the regex runs once however many branches read them.
    Positions and continuations are found on narrow rows (a line's number of
    words and its first n-1 words); the word arrays are shuffled once, to
    meet them.
    """
    from textmine.session import stored

    keys = [by] if isinstance(by, str) else list(by)
    words = stored(lines_df.select(*keys, order, word_array(text).alias("_w"))
                   .withColumn("_s", F.size("_w").cast("long"))
                   .withColumn("_id", F.monotonically_increasing_id()))
    narrow = words.select(*keys, order, "_id", "_s", F.slice("_w", 1, n - 1).alias("_head"))
    ends = stored(running_sum(narrow, "_s", keys, order, "_end", chunk=chunk)
                  .withColumn("_start", F.col("_end") - F.col("_s")).filter(F.col("_s") > 0))
    heads = ends.select(*keys, "_start", F.posexplode("_head").alias("_k", "_word")) \
        .select(*keys, (F.col("_start") + F.col("_k") + 1).alias("_p"), "_word")
    needs = ends.select(*keys, "_id", "_end", F.explode(F.sequence(F.lit(1), F.lit(n - 1))).alias("_k")) \
        .select(*keys, "_id", "_k", (F.col("_end") + F.col("_k")).alias("_p"))
    cont = (needs.join(heads, [*keys, "_p"])
            .groupBy("_id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_word"))),
                             lambda x: x["_word"]).alias("_cont")))
    placed = ends.select("_id", "_start").join(cont, "_id", "left")
    lines_cont = words.join(placed.hint("shuffle_hash"), "_id") \
        .withColumn("_all", F.concat("_w", F.coalesce("_cont", F.array().cast("array<string>"))))
    here = F.greatest(F.least(F.col("_s").cast("int"), F.size("_all") - (n - 1)), F.lit(0))
    pieces = F.arrays_zip(*[F.slice("_all", k + 1, here).alias(f"w{k}") for k in range(n)])
    out = lines_cont.select(*keys, "_start", F.posexplode(pieces).alias("_i", "_g"))
    result = out.select(*keys, *([(F.col("_start") + F.col("_i") + 1).alias(position)] if position else []),
                        F.concat_ws(" ", *[F.col(f"_g.w{k}") for k in range(n)]).alias(output))
    if keep_short:
        totals = words.groupBy(*keys).agg(F.sum("_s").alias("_total"))
        short = totals.filter(F.col("_total") < n).select(
            *keys, *([F.lit(1).cast("long").alias(position)] if position else []),
            F.lit(None).cast("string").alias(output))
        result = result.unionByName(short)
    return result
