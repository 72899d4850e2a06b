"""Sources and sinks: corpus tables, lines, lexicons, stop words and
document-term matrices."""

from textmine.sources.corpus import (
    flatten_corpus,
    lines,
    load,
    materialize,
    nest,
    save_table,
    select_corpus,
    spread,
    tidy_pages,
    with_meta,
)
from textmine.sources.lexicons import (
    default_stop_words,
    extend_lexicon,
    lexicon,
    read_lexicon,
    stop_words,
)

__all__ = [
    "default_stop_words", "extend_lexicon", "flatten_corpus", "lexicon", "lines", "load",
    "materialize", "nest", "read_lexicon", "save_table", "select_corpus", "spread", "stop_words", "tidy_pages",
    "with_meta",
]
