"""Fixed parameters of the registered queries.

The test corpus (``documents``) is invented prose; real sentiment lexicons
are user-supplied tables.  The lexicons below are small test tables made of
words that occur in the corpus (FIXTURES.md section 3).  The same rows are
written as SQL ``VALUES`` on the oracle side.
"""

# --- fixed values: test lexicons ------------------------------------------------
POLARITY = [
    ("best", "positive"), ("idiot", "negative"), ("trash", "negative"),
    ("worthless", "negative"), ("moron", "negative"), ("stupid", "negative"),
    ("scum", "negative"), ("pathetic", "negative"), ("the", "positive"), ("of", "negative"),
]
EMOTION = [
    ("best", "joy"), ("best", "positive"), ("trash", "disgust"), ("trash", "negative"),
    ("stupid", "anger"), ("stupid", "negative"),
]
VALENCE = [
    ("best", 3), ("idiot", -3), ("trash", -2), ("worthless", -2), ("moron", -3),
    ("stupid", -2), ("and", 1), ("is", -1),
]
# Labels of the three lexicons where they are compared.
LEXICON_NAMES = ("valence", "polarity", "emotion")
# Emotion counted in English documents ("trash" carries it).
EMOTION_NAME = "disgust"
# Stand-ins for negation words ("not", "no", "never", "without" do not start
# bigrams in the test corpus).
NEGATORS = ["the", "of", "to"]
# Thresholds of the reports the queries rebuild.
SHARE_LIMIT, SHARE_BINS = 0.0009, 30
FREQUENT_ITEM, EDGE_MIN, EDGE_MIN_NODIGITS = 20, 20, 40
EDGE_MIN_COR = 0.15
LDA_SEED, LDA_ITERATIONS = 1234, 100
# --- end of fixed values --------------------------------------------------------

# Share of points and places of the smoothed trend.
SMOOTH_SPAN, SMOOTH_POINTS = 0.75, 80
# Partitions of the corpus stored by key.
CORPUS_SHARDS = 64
# Document prior of the checked variational rounds.
LDA_PRIOR = 0.5

# Stop-word lists removed in the multi-language queries.
STOP_LANGS = ("en", "de", "fr", "es")

# Heading marker for chapter segmentation: no line of the corpus starts with
# "chapter", while "the " starts several hundred lines.
MARKER = r"^the "
# The corpus has no headings: pieces end at an article before a noun in "of".
SPLIT_PATTERN = r"(?:the|The) [a-z]+ of "

# Only one document has 80+ lines, so buckets and sections use 10 lines.
BUCKET_LINES = 10
SECTION_LINES = 10

# Words followed in the head-noun and associate queries.
HEAD_WORD = "thing"
ASSOCIATE_WORDS = ["thing", "th", "nd", "re"]
# Item followed in the co-occurrence query.
PAIR_WORD = "thing"
# Document whose terms are listed.
INSPECTED = "106_1"
TREND_TERMS = ["the", "and", "of", "best", "idiot", "trash"]
# Frequent corpus words added to the stop lists (like adding "miss").
CUSTOM_STOP = ["thing", "th", "nd", "re"]
DOMAIN_STOP = ["the", "and", "of", "de", "la", "le", "und", "der", "die", "el", "en", "y"]
