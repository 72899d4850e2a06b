"""Word and sentence boundaries: rows made by hand from the public rules, and
random texts against the rules applied pair by pair."""

import random
import unicodedata

import pytest

from textmine.operators import tokens as tok

WORDS = [
    ("It costs 3.14 or 1,234.5 dollars.", ["it", "costs", "3.14", "or", "1,234.5", "dollars"]),
    ("can’t CAN'T o'clock 'quoted'", ["can’t", "can't", "o'clock", "quoted"]),
    ("see www.example.com/a_b?x=1", ["see", "www.example.com", "a_b", "x", "1"]),
    ("a.b.c. e.g. U.S.A.", ["a.b.c", "e.g", "u.s.a"]),
    ("v2.0b 3a a3 1.a a.1", ["v2.0b", "3a", "a3", "1", "a", "a", "1"]),
    ("x;y 1;2 x,y 1:2 a:b", ["x", "y", "1;2", "x", "y", "1", "2", "a", "b"]),
    ("カタカナ日本語ひらがな", ["カタカナ", "日", "本", "語", "ひ", "ら", "が", "な"]),
    ("abc日x カa", ["abc", "日", "x", "カ", "a"]),
    ("_under_score_ __ カ_a", ["_under_score_", "カ_a"]),
    ("été soft­hyphen zero‍join", ["été", "soft­hyphen", "zero‍join"]),
    ("צה\"ל ג'ירפה א' א\"", ["צה\"ל", "ג'ירפה", "א'", "א"]),
    ("😀 👩‍👩‍👧 ok 🇩🇪", ["ok"]),
    ("l·l l:l -5 +x a--b", ["l·l", "l", "l", "5", "x", "a", "b"]),
    ("привет мир. Γειά, κόσμε", ["привет", "мир", "γειά", "κόσμε"]),
    ("", []), (" .,;:!? ", []),
]

SENTENCES = [
    ("One. Two! Three? Four", ["One.", "Two!", "Three?", "Four"]),
    ("Pi is 3.14 now. Yes.", ["Pi is 3.14 now.", "Yes."]),
    ("Dr. Xu met Mr. Wu. They left.", ["Dr. Xu met Mr. Wu.", "They left."]),
    ("He said \"Stop.\" Then (he left.) Fine", ["He said \"Stop.\"", "Then (he left.)", "Fine"]),
    ("etc. and so on. Next", ["etc. and so on.", "Next"]),
    ("The U.S.A. Is big.Really", ["The U.S.A.", "Is big.Really"]),
    ("what?No! wait ... 12 no", ["what?", "No!", "wait ... 12 no"]),
    ("A line.\nNext\nline. “Quoted.” End?!  \t Last", ["A line.", "Next line.", "“Quoted.”", "End?!", "Last"]),
    ("Stop., go. - no. 5 x. 5 X", ["Stop., go. - no. 5 x.", "5 X"]),
    ("終わり。次の文。", ["終わり。", "次の文。"]),
    ("", []), (" \n ", []), ("...", ["..."]), ("No end", ["No end"]),
]


def one(spark, text, **how):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    return [r["t"] for r in tok.unnest_tokens(df, "t", "text", rules="unicode", position="p", **how)
            .orderBy("p").collect()]


def test_words_by_the_public_rules(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in WORDS)), "id int, text string")
    got = {}
    for r in tok.unnest_tokens(df, "w", "text", rules="unicode", position="p").orderBy("id", "p").collect():
        got.setdefault(r["id"], []).append(r["w"])
    for i, (text, want) in enumerate(WORDS):
        assert got.get(i, []) == want, text


def test_sentences_by_the_public_rules(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in SENTENCES)), "id int, text string")
    got = {}
    for r in tok.unnest_tokens(df, "s", "text", token="sentences", rules="unicode", to_lower=False, position="p",
                               abbreviations=["Dr.", "Mr."]).orderBy("id", "p").collect():
        got.setdefault(r["id"], []).append(r["s"])
    for i, (text, want) in enumerate(SENTENCES):
        assert got.get(i, []) == want, text


def test_without_abbreviations_a_capital_ends(spark):
    assert one(spark, "Dr. Xu left.", token="sentences") == ["dr.", "xu left."]
    assert one(spark, "UnDr. Xu", token="sentences", to_lower=False, abbreviations=["Dr."]) == ["UnDr.", "Xu"]


def kind(c):
    cat, name = unicodedata.category(c), unicodedata.name(c, "")
    if cat in ("Mn", "Mc", "Me", "Cf"):
        return "extend"
    if "KATAKANA" in name:
        return "kana"
    if "CJK" in name or "HIRAGANA" in name:
        return "alone"
    if cat == "Pc":
        return "joint"
    if cat == "Nd":
        return "digit"
    if cat[0] == "L" or cat == "Nl":
        return "letter"
    return {".": "either", "'": "either", "’": "either", ",": "number", ";": "number", "·": "mid"}.get(c, "other")


def words_by_pairs(text):
    """Whether a word goes on between two code points, from the kinds on both
    sides without marks."""
    base = [(i, kind(c)) for i, c in enumerate(text) if kind(c) != "extend"]
    ks = [k for _, k in base]
    at = lambda j: ks[j] if 0 <= j < len(ks) else None
    starts = {0}
    for j in range(len(ks)):
        a, b = at(j - 1), at(j)
        run, ln = ("letter", "digit"), {"letter": ("mid", "either"), "digit": ("number", "either")}
        joins = (a in run and b in run or a == b == "kana" or b == "joint" and a in (*run, "kana", "joint")
                 or a == "joint" and b in (*run, "kana"))
        for k, between in ln.items():
            joins |= a == k and b in between and at(j + 1) == k or at(j - 2) == k and a in between and b == k
        if not joins:
            starts.add(base[j][0])
    cuts = [*sorted(starts), len(text)]
    parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    return [p for p in parts if any(kind(c) in ("letter", "digit", "kana", "alone") for c in p)]


def test_words_equal_the_rules_on_random_texts(spark):
    rng = random.Random(1)
    signs = "aB1 .,;'’·_-é́‍カー日ひß2x"
    lines = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, text string")
    got = {}
    for r in tok.unnest_tokens(df, "w", "text", rules="unicode", to_lower=False, position="p").orderBy("id", "p").collect():
        got.setdefault(r["id"], []).append(r["w"])
    for i, line in enumerate(lines):
        # a mark after a blank or at the start belongs to no word
        assert [w.strip("́‍") for w in got.get(i, [])] == [w.strip("́‍") for w in words_by_pairs(line)], line


@pytest.mark.parametrize("text, n", [("x" * 200_000, 1), ("a.b" * 50_000, 1), ("1,2" * 50_000, 1), ("日" * 100_000, 100_000),
                                     ("é" * 100_000, 1), ("_a" * 80_000, 1), ("カ" * 100_000, 1)])
def test_long_texts_without_blanks(spark, text, n):
    assert len(one(spark, text)) == n


def test_long_texts_for_sentences(spark):
    assert len(one(spark, "a. 1 " * 40_000, token="sentences")) == 2  # a small letter follows all stops but the last
    assert len(one(spark, "A. B " * 40_000, token="sentences")) == 40_001
    assert len(one(spark, "." * 100_000, token="sentences")) == 1
    assert len(one(spark, "!)" * 50_000, token="sentences")) == 1


def test_regex_rules_stay_the_default_and_ngrams_take_rules(spark):
    df = spark.createDataFrame([(1, "pi 3.14 ok")], "id int, text string")
    assert [r["w"] for r in tok.unnest_tokens(df, "w", "text").collect()] == ["pi", "3", "14", "ok"]
    assert [r["g"] for r in tok.unnest_tokens(df, "g", "text", token="ngrams", rules="unicode").collect()] == ["pi 3.14", "3.14 ok"]
    with pytest.raises(ValueError):
        tok.unnest_tokens(df, "w", "text", rules="other")
