"""Scalar text helpers as Spark Column expressions.

Everything here is a built-in Catalyst expression (regexp, lower, floor,
try_cast...), so it is code-generated and runs on the executors with no
Python in the loop.  The regular expressions are written so that the same
pattern text also runs in RE2-based engines (no look-behind, no
back-references), which is what the SQL cross-checks rely on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters/digits (and underscores, which Unicode word
# segmentation treats as word characters), optionally joined by inner
# apostrophes: "don't", "rock’n’roll".
WORD_PATTERN = r"[\p{L}\p{N}_]+(?:['’][\p{L}\p{N}_]+)*"
WORD_PATTERN_NO_UNDERSCORE = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"

# n-gram words are joined with one space, as ``separate`` expects.
NGRAM_SEP = " "

# A sentence is a run of non-terminators followed by its terminators.
SENTENCE_PATTERN = r"[^.!?]+[.!?]*"


# --- fixed values: code points by their part in the public word and sentence
# break rules (Unicode Standard Annex 29) ---------------------------------------
# Signs between two letters, between two digits, and between either.  A colon
# joins letters in the annex, but not in the common locale data.
MID_LETTER = "··՟״‧︓"
MID_NUMBER = ",;;։،؍٬߸⁄︐︔﹐﹔，；"
MID_EITHER = ".'‘’․﹒＇．"
KANA_SIGNS = "〱-〵゛゜゠ーｰ"
# Scripts whose letters do not run together without a dictionary.
APART = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Myanmar", "Khmer")
# Ends of sentences: full stops, which may be part of a word or number, and
# others; signs that may follow them, and signs that go on after them.
STOPS = ".․﹒．"
ENDS = "!?։؝؟۔‼‽⁇-⁉。﹖﹗！？｡"
CLOSERS = "\"'«»"
GOES_ON = (",:\\-՝،؍߸᠂᠈–—、︐︑︓︱︲﹐﹑"
           "﹕﹘﹣，－：､")
# --- end of fixed values --------------------------------------------------------


def _unicode_words() -> str:
    """Words by the public break rules without a dictionary, as one pattern.

    Letters and digits run together; one sign of its kind may stand between
    two letters or two digits; marks and joiners belong to what they follow;
    Katakana runs together; connector signs join all of these; other letters
    of scripts written without blanks stand alone.
    """
    on = r"[\p{M}\p{Cf}]*+"
    apart = "".join(rf"\p{{Is{s}}}" for s in APART)
    joined = r"[\p{Pc}\x{202F}]" + on
    hebrew = r"[\p{L}&&\p{IsHebrew}]" + on
    letter = rf"(?:{hebrew}(?:\"{on}{hebrew})*+'?+|[\p{{L}}\p{{Nl}}\x{{24B6}}-\x{{24E9}}&&[^{apart}{KANA_SIGNS}]]{on})"
    digit = r"[\p{Nd}\x{66B}]" + on
    letters = f"{letter}(?:(?:[{MID_LETTER}{MID_EITHER}]{on})?{letter})*+"
    digits = f"{digit}(?:(?:[{MID_NUMBER}{MID_EITHER}]{on})?{digit})*+"
    kana = rf"(?:[\p{{IsKatakana}}{KANA_SIGNS}]{on})++"
    part = f"(?:(?:{letters}|{digits})++|{kana})"
    alone = rf"[\p{{L}}\p{{Nl}}&&[{apart}]]{on}"
    return f"(?:{joined})*+{part}(?:(?:{joined})++{part})*+(?:{joined})*+|{alone}"


UNICODE_WORD_PATTERN = _unicode_words()


def _sentence_end(abbreviations: tuple[str, ...]) -> str:
    """A sentence's last signs and the blanks behind them, by the public break
    rules (blanks are spaces).  A full stop ends no sentence before a digit,
    between a letter and a capital, before a small letter (signs and digits
    between) or behind one of ``abbreviations``; neither stop nor other end
    does before another one or a sign that goes on."""
    on = r"[\p{M}\p{Cf}]*+"
    tail = rf"(?:[\p{{Ps}}\p{{Pe}}\p{{Pi}}\p{{Pf}}{CLOSERS}]{on})*+ *+"
    not_behind = "".join(rf"(?<!(?<![\p{{L}}\p{{N}}])\Q{a.rstrip('.')}\E)" for a in abbreviations)
    stop = (rf"{not_behind}[{STOPS}]{on}(?!\p{{Nd}})(?!(?<=[\p{{Lu}}\p{{Ll}}][{STOPS}])\p{{Lu}})"
            rf"(?!{tail}[^\p{{L}}{STOPS}{ENDS}]*+\p{{Ll}})")
    return rf"(?:{stop}|[{ENDS}]{on}){tail}(?![{GOES_ON}{STOPS}{ENDS}])(?!$)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_array(text, to_lower: bool = True, keep_underscore: bool = True,
               pattern: str | None = None) -> Column:
    """Array of word tokens of ``text`` in reading order."""
    src = _col(text)
    if to_lower:
        src = F.lower(src)
    pat = pattern or (WORD_PATTERN if keep_underscore else WORD_PATTERN_NO_UNDERSCORE)
    return F.regexp_extract_all(src, F.lit(pat), 0)


def sentence_pieces(text, to_lower: bool = True) -> Column:
    """Array of trimmed, non-empty sentences of ``text``."""
    src = _col(text)
    if to_lower:
        src = F.lower(src)
    pieces = F.regexp_extract_all(src, F.lit(SENTENCE_PATTERN), 0)
    trimmed = F.transform(pieces, lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda s: s != F.lit(""))


def unicode_sentences(text, to_lower: bool = True, abbreviations: tuple[str, ...] = ()) -> Column:
    """Array of trimmed, non-empty sentences of ``text`` by the public break
    rules; white space counts as spaces.  ``abbreviations`` ("Dr.", matched
    in this case) end no sentence.  Two passes over the text: the ends are
    marked by a line break, which cannot occur any more, then the text is
    split there."""
    spaced = F.regexp_replace(_col(text), r"[\s\x{85}\p{Z}]", " ")
    marked = F.split(F.regexp_replace(spaced, _sentence_end(tuple(abbreviations)), "$0\n"), "\n")
    trimmed = F.transform(marked, lambda s: F.lower(F.trim(s)) if to_lower else F.trim(s))
    return F.filter(trimmed, lambda s: s != F.lit(""))


def bucket(col, size: int) -> Column:
    """``col %/% size`` (floor division) as BIGINT."""
    return F.floor(_col(col) / F.lit(size)).cast("long")


def normalize_word(col) -> Column:
    """First run of ``[a-z']`` in the word, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(col), "[a-z']+", 0), F.lit(""))


def has_non_ascii(col) -> Column:
    return _col(col).rlike(r"[^\x00-\x7F]")


def has_digit(col) -> Column:
    return _col(col).rlike(r"\d")


def matches(col, pattern: str, ignore_case: bool = False) -> Column:
    """Partial regex match, like a ``str_detect``."""
    return _col(col).rlike(("(?i)" if ignore_case else "") + pattern)


def extract_number(col, pattern: str = r"(\d+)", group: int = 1) -> Column:
    """First capture of ``pattern`` converted to BIGINT; NULL when absent."""
    raw = F.nullif(F.regexp_extract(_col(col), pattern, group), F.lit(""))
    return raw.try_cast("long")


def remove_first(col, literal: str) -> Column:
    """Remove the first occurrence of ``literal`` only."""
    c = _col(col)
    idx = F.instr(c, literal)
    return F.when(idx > 0, F.concat(F.substring(c, F.lit(1), idx - 1),
                                    F.substring(c, idx + len(literal), F.lit(1 << 30)))
                  ).otherwise(c)


def clean_text(col, mode: str = "underscore") -> Column:
    """Character clean-ups used before counting.

    ``underscore``: drop every ``_``;
    ``whitelist``: every character outside letters, digits, blanks and
    ``? & / -`` becomes a space.
    """
    c = _col(col)
    if mode == "underscore":
        return F.replace(c, F.lit("_"), F.lit(""))
    if mode == "whitelist":
        return F.regexp_replace(c, r"[^\p{L}\p{N} \t?&/\-]", " ")
    raise ValueError(f"unknown clean_text mode {mode!r}")


def html_title(col) -> Column:
    """Text of the ``<title>`` element, NULL when missing."""
    return F.nullif(F.regexp_extract(_col(col), r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def html_text(col) -> Column:
    """Visible text of an HTML page: scripts, styles and tags removed,
    whitespace runs collapsed."""
    c = _col(col)
    c = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>", " ")
    c = F.regexp_replace(c, r"(?is)<style[^>]*>.*?</style>", " ")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    c = F.regexp_replace(c, r"\s+", " ")
    return F.regexp_replace(c, r"^ | $", "")
