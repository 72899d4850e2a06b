"""Secret scanning by assignment-aware lexing.

Besides three fixed patterns, every text is lexed for assignments of source
and configuration syntax (``name = "literal"``, ``"name": literal``,
``name := literal``, ``name => literal``).  Names that hold a literal are
constants; a later assignment from such a name (bare, ``$name`` or
``${name}``) stands for that literal.  A sum (``"a" + name + "b"``, also over
line ends) is one literal of several spans; a name in it counts if it holds a
single literal.  A literal counts as a secret by
the sensitivity of the names it reaches and by its own form.

Offsets are code points, ends exclusive.  Null and empty texts have no
spans; repeated rows are scanned each by itself; texts are read whole, and
every step is linear in their length.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from textmine.llm.common import add_columns

# The patterns of the three base kinds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "literal")
#: Text that a match of ASSIGN holds in some case; a cheap test before it.
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: How sensitive a part of a target name is.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0,
             "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "pass": 0.8, "auth": 0.7, "bearer": 0.8,
             "private": 0.6, "access": 0.4, "key": 0.5, "signing": 0.4, "api": 0.4, "client": 0.1, "salt": 0.5}
#: From this score on, a name's quoted literals count with white space in
#: them, and its bare ones of letters only.
STRONG = 0.8
#: Literals that name nothing secret.
PLACEHOLDERS = frozenset({"none", "null", "true", "false", "undefined", "changeme", "example", "required",
                          "optional", "string", "redacted", "placeholder"})

_OPERATOR = re.compile(r"[=:]+>?")
_NAME_END = re.compile(r"[A-Za-z0-9_.$-]")
_VALUE = re.compile(r"""[ \t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|(\$\{[^}\s]*\}|[^\s,;"'(){}\[\]<>]+))""")
_PLUS = re.compile(r"[ \t]*(?:\\?\r?\n[ \t]*)?\+(?![+=])[ \t]*(?:\\?\r?\n[ \t]*)?(?=[\"'A-Za-z_$])")
_REFERENCE = re.compile(r"\$\{([A-Za-z_][\w.]*)\}|\$?([A-Za-z_][\w.]*)", re.ASCII)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns."""
    out = []
    low = text.lower()
    if any(name in low for name in ASSIGN_NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def pairs(text: str) -> list[tuple[str, list[tuple[int, int, bool]]]]:
    """The name of every assignment and the parts ``(start, end, quoted)`` of
    its value, in order; a value has several parts where it is a sum."""
    out, done = [], 0
    for m in _OPERATOR.finditer(text):
        if m.start() < done or m.end() - m.start() > 2 or m.group() in ("==", "::"):
            continue
        stop = m.start()
        while stop > done and text[stop - 1] in " \t":
            stop -= 1
        if stop > done and text[stop - 1] in "\"'":
            stop -= 1
        begin = stop
        while begin > done and _NAME_END.match(text[begin - 1]):
            begin -= 1
        value = _VALUE.match(text, m.end())
        if begin == stop or not value:
            continue
        kind = value.lastindex
        parts = [(*value.span(kind), kind < 3)]
        done = value.end(kind) if kind < 3 else m.end()
        # a sum begins with a literal or a name; its bare parts are names
        named = kind < 3 or _REFERENCE.fullmatch(text, *value.span(kind))
        end = value.end()
        while named and (plus := _PLUS.match(text, end)) and (value := _VALUE.match(text, plus.end())):
            kind, end = value.lastindex, value.end()
            named = kind < 3 or _REFERENCE.fullmatch(text, *value.span(kind))
            if named:
                parts.append((*value.span(kind), kind < 3))
                done = end
        out.append((text[begin:stop], parts))
    return out


def name_score(name: str) -> float:
    """The sum over the name's parts, at most 1."""
    return min(1.0, sum(SENSITIVE.get(part.lower(), 0.0) for part in _PARTS.findall(name)))


def literal_score(value: str, blanks: bool = False) -> float:
    """0 to 1 by length, character variety and mixture of kinds; with white
    space only where ``blanks`` allows it."""
    if len(value) < 6 or value.lower() in PLACEHOLDERS or "://" in value:
        return 0.0
    if not blanks and any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit))
    kinds += any(not c.isalnum() for c in value)
    return min(1.0, bits / 3.5) * (0.4 + 0.2 * min(3, kinds))


def literal_spans(text: str, least: float = 0.5) -> list[tuple[int, int, int]]:
    """Literals that reach a sensitive name, directly or through constants."""
    values: list[list[tuple[int, int]]] = []  # the spans of every literal, sums included
    scores: list[float] = []
    constants: dict[str, int] = {}

    def held(start: int, end: int, quoted: bool) -> int | None:
        """The literal that a bare name stands for."""
        ref = None if quoted else _REFERENCE.fullmatch(text, start, end)
        return constants.get(ref.group(1) or ref.group(2)) if ref else None

    def whole(parts: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
        """The spans of a sum; names that hold no single literal add none."""
        spans = []
        for a, b, quoted in parts:
            known = held(a, b, quoted)
            if quoted:
                spans.append((a, b))
            elif known is not None and len(values[known]) == 1:
                spans += values[known]
        return spans

    for name, parts in pairs(text):
        start, end, quoted = parts[0]
        known, letters = None, False
        if not (len(parts) > 1 and (spans := whole(parts))):
            known, spans = held(start, end, quoted), [(start, end)]
            letters = not quoted and known is None and text[start:end].isalpha()
        if known is None:
            known = len(values)
            values.append(spans)
            scores.append(0.0)
        if not letters:
            constants[name.rpartition(".")[2]] = constants[name] = known
        # bare letters may name a variable or call; those of strong names count
        if not letters or (name_score(name) >= STRONG and text[end:end + 1] not in ("(", "[")):
            scores[known] = max(scores[known], name_score(name))
    secret = [spans for spans, s in zip(values, scores)
              if s and s * literal_score("".join(text[a:b] for a, b in spans), s >= STRONG) >= least]
    return [(a, 3, b) for a, b in dict.fromkeys(span for spans in secret for span in spans) if a < b]


def spans_of(text: str | None) -> list[tuple[int, int, int]]:
    """All spans of one text by start, then kind.  A literal inside a base
    span adds nothing and is left out."""
    if not text:
        return []
    found = base_spans(text)
    if "=" in text or ":" in text:
        found = sorted(found)
        at, reach, extra = 0, 0, []
        for x in sorted(literal_spans(text)):
            while at < len(found) and found[at][0] <= x[0]:
                reach = max(reach, found[at][2])  # of the base spans that begin no later
                at += 1
            if x[2] > reach:
                extra.append(x)
        found += extra
    return sorted(found)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """``text`` with each span (overlapping ones together) replaced."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None, spans: str = "spans",
         redacted: str | None = None, mark: str = "[secret]") -> DataFrame:
    """Append the spans of ``text`` (array of kind, start, end) and, where
    ``redacted`` names a column, the text with its spans replaced."""
    fields = f"`{spans}` array<struct<kind:string,start:int,end:int>>"
    if redacted:
        fields += f", `{redacted}` string"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make(column: pa.Array) -> list[pa.Array]:
        texts = column.to_pylist()
        found = [spans_of(t) for t in texts]
        made = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in row] for row in found], kind)]
        if redacted:
            made.append(pa.array([redact(t, s, mark) if s else t for t, s in zip(texts, found)], pa.string()))
        return made

    return add_columns(df, text, fields, make, keep)
