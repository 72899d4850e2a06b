"""Column-level helpers: all built on ``pyspark.sql.functions``, so they stay
inside whole-stage code generation."""

from textmine.functions.text import (
    NGRAM_SEP,
    WORD_PATTERN,
    WORD_PATTERN_NO_UNDERSCORE,
    bucket,
    clean_text,
    extract_number,
    has_digit,
    has_non_ascii,
    html_text,
    html_title,
    matches,
    normalize_word,
    remove_first,
    sentence_pieces,
    word_array,
)

__all__ = [
    "NGRAM_SEP", "WORD_PATTERN", "WORD_PATTERN_NO_UNDERSCORE", "bucket", "clean_text",
    "extract_number", "has_digit", "has_non_ascii", "html_text", "html_title", "matches",
    "normalize_word", "remove_first", "sentence_pieces", "word_array",
]
