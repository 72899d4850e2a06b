"""Audit of how far the sources of a language diverge, by in-mapper stripes.

1. ``stripes``: each task folds whole documents into hash stripes, one for a
   (language, term): the documents that hold the term and its occurrences by
   source.  A task that holds ``most`` cells writes its stripes out and
   begins anew.
2. ``merged``: the stripes are dealt and sorted by (language, term); a task
   adds up equal keys as they stream past, keeps the terms of at least
   ``min_docs`` documents and packs them, up to ``pack`` terms to a row.
3. ``audit``: the packed stripes meet the sizes of their language's sources
   and emit divergences directly: sums for every pair of sources, and the
   leading terms of each source, which are then added up and ranked.

No task holds more than one merged stripe and one pack.  A frequent term
comes once from each task and writing, a frequent source is a cell of each
stripe.  The pairs of a language are its result: sources x (sources - 1)
rows; one row per language lists its sources.

All arithmetic is in whole numbers.  A term's share is
``1 + floor(SCALE * (count + 2) / (N + 2 V))``, N the count of all kept terms
and V their number; the divergence of two shares is
``floor((p - q)**2 / (p + q))``.

Defined results: null text, language and source are empty ones and groups of
their own; a (language, source) without terms stays a group; a language
without kept terms has divergences of 0 and no terms; an empty table gives an
empty result; further columns of any name are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmine.llm.common import checkpointed, slices
from textmine.session import ship_package

SCALE = 10**9
TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lower-cased UTF-8: ASCII letters and all beyond ASCII
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
_DIGIT = 1000  # SCALE is a power of it

_STRIPE = pa.schema([("lang", pa.binary()), ("term", pa.binary()), ("df", pa.int64()),
                     ("sources", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])
_PACK = pa.schema([("lang", pa.binary()), ("terms", pa.list_(pa.binary())), ("cells", pa.list_(pa.int32())),
                   ("sources", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def terms_of(text: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text; a long text comes in pieces that end between
    terms."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + piece) if at + piece < len(text) else None
        end = gap.end() if gap else len(text)
        yield TERM.findall((text if not at and end == len(text) else text[at:end]).lower())
        at = end


# ---------------------------------------------------------------- stripes


class Stripes:
    """Stripes of each language, held by column: term -> documents, and for
    every source term -> occurrences."""

    def __init__(self):
        self.documents: dict[bytes, Counter] = {}
        self.sources: dict[bytes, dict[bytes, Counter]] = {}
        self.cells = 0

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        documents = self.documents.setdefault(lang, Counter())
        counts = self.sources.setdefault(lang, {}).setdefault(source, Counter())
        before = len(documents) + len(counts)
        seen: set[bytes] = set()
        for terms in terms_of(text):
            counts.update(terms)
            seen.update(terms)
        documents.update(seen)
        self.cells += len(documents) + len(counts) - before

    def write_out(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        """All stripes, sorted by nothing; the table is empty afterwards."""
        for lang, documents in self.documents.items():
            terms = list(documents)
            place = dict(zip(terms, range(len(terms))))
            names = list(self.sources[lang])
            at, source, n = [], [], []
            for i, name in enumerate(names):
                counts = self.sources[lang].pop(name)
                at.append(np.fromiter(map(place.__getitem__, counts), np.int64, len(counts)))
                source.append(np.full(len(counts), i, np.int32))
                n.append(np.fromiter(counts.values(), np.int64, len(counts)))
            if not terms:
                continue
            at, source, n = np.concatenate(at), np.concatenate(source), np.concatenate(n)
            order = np.argsort(at, kind="stable")
            source, n = source[order], n[order]
            begins = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(terms)))]).astype(np.int32)
            df = np.fromiter(documents.values(), np.int64, len(documents))
            documents.clear()
            named = pa.array(names, pa.binary())
            for low in range(0, len(terms), rows):
                high = min(len(terms), low + rows)
                here = slice(begins[low], begins[high])
                offsets = pa.array(begins[low:high + 1] - begins[low])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (high - low), pa.binary()), pa.array(terms[low:high], pa.binary()),
                     pa.array(df[low:high]), pa.ListArray.from_arrays(offsets, named.take(pa.array(source[here]))),
                     pa.ListArray.from_arrays(offsets, pa.array(n[here]))], schema=_STRIPE)
        self.__init__()


def stripes(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
            most: int = 1_500_000) -> DataFrame:
    """Stripes of every task: ``lang``, ``term`` (both as bytes), ``df``,
    ``sources``, ``counts``; a key may come several times."""
    ship_package(docs.sparkSession)
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).cast("binary").alias(c)
    found = docs.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            for part in slices(batch, 2):
                for values in zip(*(c.to_pylist() for c in part.columns)):
                    held.add(*values)
                    if held.cells >= most:
                        yield from held.write_out()
        yield from held.write_out()

    return found.mapInArrow(run, "lang binary, term binary, df long, sources array<binary>, counts array<long>")


class Merge:
    """Sorted stripes in, packs of kept terms out.  Of a batch only the terms
    of enough documents are looked into; the last term stays open, since its
    stripes may go on in the next batch."""

    def __init__(self, min_docs: int, pack: int):
        self.min_docs, self.pack = min_docs, pack
        self.key: tuple[bytes, bytes] | None = None
        self.df, self.stripe = 0, Counter()
        self.held: list[list] = [[], [], [], []]

    def row(self, lang: bytes) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([lang, *self.held], _PACK)],
                                          schema=_PACK)
        for column in self.held:
            column.clear()
        return made

    def close(self, next_lang: bytes | None) -> Iterator[pa.RecordBatch]:
        """Keep the open term if it is frequent enough; its language's pack
        goes out where it is full or the language ends."""
        if self.key is None:
            return
        if self.df >= self.min_docs:
            self.held[0].append(self.key[1])
            self.held[1].append(len(self.stripe))
            self.held[2].extend(self.stripe)
            self.held[3].extend(self.stripe.values())
        if self.held[0] and (next_lang != self.key[0] or len(self.held[0]) >= self.pack
                             or len(self.held[2]) >= 64 * self.pack):
            yield self.row(self.key[0])

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        lang, term = batch.column(0), batch.column(1)
        new = pc.or_(pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)),
                     pc.not_equal(lang.slice(1), lang.slice(0, len(lang) - 1))).to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.flatnonzero(new) + 1])
        df = np.add.reduceat(batch.column(2).to_numpy(), first)
        stop = np.append(first[1:], batch.num_rows)
        sources, counts = batch.column(3), batch.column(4)
        # the first and the last term may be parts of terms
        looked = np.flatnonzero((df >= self.min_docs) | (np.arange(len(df)) % max(1, len(df) - 1) == 0))
        for i in looked.tolist():
            a, n = int(first[i]), int(stop[i] - first[i])
            key = (lang[a].as_py(), term[a].as_py())
            if key != self.key:
                yield from self.close(key[0])
                self.key, self.df, self.stripe = key, 0, Counter()
            self.df += int(df[i])
            names = sources.slice(a, n).flatten().to_pylist()
            for name, c in zip(names, counts.slice(a, n).flatten().to_pylist()):
                self.stripe[name] += c


def merged(found: DataFrame, min_docs: int = 10, pack: int = 2048) -> DataFrame:
    """Equal keys added up, terms of fewer than ``min_docs`` documents left
    out, up to ``pack`` terms of a language to a row: ``lang``, ``terms``, the
    number of ``cells`` of each and all their ``sources`` and ``counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = Merge(min_docs, pack)
        for batch in batches:
            yield from merge.add(batch)
        yield from merge.close(None)

    return (found.repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(run, "lang binary, terms array<binary>, cells array<int>, sources array<binary>,"
                             " counts array<long>"))


# ---------------------------------------------------------------- divergences


def shares(counts: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 2) / (total + 2 * terms))`` by long
    division, exact up to totals of 9e15."""
    rest, below = counts + 2, total + 2 * terms
    out = np.zeros_like(rest)
    scale = 1
    while scale < SCALE:
        rest = rest * _DIGIT
        out = out * _DIGIT + rest // below
        rest, scale = rest % below, scale * _DIGIT
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _leading(values: np.ndarray, terms: list[bytes], n: int) -> list[int]:
    """The ``n`` largest values, ties to the lesser term."""
    if len(values) > n:
        least = np.partition(values, len(values) - n)[len(values) - n]
        chosen = np.flatnonzero(values >= least)
    else:
        chosen = np.arange(len(values))
    return sorted(chosen.tolist(), key=lambda i: (-values[i], terms[i]))[:n]


class Divergences:
    """What a task adds up for one language: for every source the sums of
    divergences to all later sources, and the leading terms."""

    def __init__(self, groups: list[dict], total: int, n_terms: int, top: int):
        self.names = [g["source"] for g in groups]
        self.place = {s: i for i, s in enumerate(self.names)}
        self.totals = np.array([g["total"] for g in groups], np.int64)[:, None]
        self.total, self.n_terms, self.top = total, n_terms, top
        self.sums = [np.zeros(len(self.names) - i - 1, np.int64) for i in range(len(self.names))]
        self.best: list[list[tuple[int, bytes]]] = [[] for _ in self.names]

    def add(self, terms: list[bytes], row: np.ndarray, col: np.ndarray, n: np.ndarray) -> None:
        counts = np.zeros((len(self.names), len(terms)), np.int64)
        counts[col, row] = n
        whole = shares(counts.sum(0), self.total, self.n_terms)
        p = shares(counts, self.totals, self.n_terms)
        for i, sums in enumerate(self.sums):
            sums += divergence(p[i], p[i + 1:]).sum(1)
            seen = np.flatnonzero((counts[i] > 0) & (p[i] > whole))
            value = divergence(p[i][seen], whole[seen])
            found = [terms[j] for j in seen.tolist()]
            lead = [(int(value[j]), found[j]) for j in _leading(value, found, self.top)]
            self.best[i] = sorted([*self.best[i], *lead], key=lambda x: (-x[0], x[1]))[:self.top]

    def rows(self, lang: bytes) -> Iterator[pa.RecordBatch]:
        for i, name in enumerate(self.names):
            yield _rows(lang, name, "pair", self.names[i + 1:], self.sums[i])
            yield _rows(lang, name, "term", [t for _, t in self.best[i]],
                        np.array([v for v, _ in self.best[i]], np.int64))


def _emit(batches: Iterator[pa.RecordBatch], top: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Divergences of the packs of a task, added up by language while at most
    ``cells`` sums are held."""
    held: dict[bytes, Divergences] = {}
    for batch in batches:
        for low in range(batch.num_rows):
            r = batch.slice(low, 1).to_pylist()[0]
            found = held.get(r["lang"])
            if found is None:
                found = held[r["lang"]] = Divergences(r["groups"], int(r["total"]), r["n_terms"], top)
            terms = r["terms"] or []
            row = np.repeat(np.arange(len(terms)), r["cells"] or [])
            col = np.array([found.place[s] for s in r["sources"] or []], np.int64)
            n = np.array(r["counts"] or [], np.int64)
            step = max(1, cells // max(1, len(found.names)))
            for at in range(0, len(terms), step):
                here = slice(*np.searchsorted(row, [at, at + step]))
                found.add(terms[at:at + step], row[here] - at, col[here], n[here])
            if sum(len(d.names) ** 2 for d in held.values()) > cells:
                for lang in list(held):
                    yield from held.pop(lang).rows(lang)
    for lang, found in held.items():
        yield from found.rows(lang)


_FOUND = pa.schema([("lang", pa.binary()), ("source", pa.binary()), ("part", pa.string()), ("item", pa.binary()),
                    ("value", pa.int64())])


def _rows(lang: bytes, source: bytes, part: str, items: list[bytes], values: np.ndarray) -> pa.RecordBatch:
    n = len(items)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.binary()), pa.array([source] * n, pa.binary()), pa.array([part] * n, pa.string()),
         pa.array(items, pa.binary()), pa.array(values, pa.int64())], schema=_FOUND)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = 10, top: int = 10, most: int = 1_500_000, pack: int = 2048, cells: int = 1 << 21) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` holds the
    divergence of a source from each other source of its language, summed
    over the kept terms; part ``term`` the ``top`` terms that it uses more
    than its language does.  Eager: merged stripes are checkpointed."""
    packs = checkpointed(merged(stripes(docs, text, lang, source, most), min_docs, pack))
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).cast("binary")
    counted = (packs.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
               .groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("total")))
    groups = (docs.select(plain(lang).alias("lang"), plain(source).alias("source")).distinct()
              .withColumn("total", F.lit(0).cast("long")).unionByName(counted)
              .groupBy("lang", "source").agg(F.sum("total").alias("total")))
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"),
                                       F.sum("total").alias("total"))
    kept = packs.groupBy("lang").agg(F.sum(F.size("terms")).cast("long").alias("n_terms"))
    langs = checkpointed(langs.join(kept, "lang", "left").fillna(0, ["n_terms"]))
    nothing = langs.select("lang", *[F.lit(None).cast(packs.schema[c].dataType).alias(c)
                                     for c in ("terms", "cells", "sources", "counts")])
    # a task adds up many packs before it sends sums, so there are as few deals as terms need; the packs of a large
    # language go to all of them, and its sources with them
    deals = math.ceil((langs.agg(F.sum("n_terms")).first()[0] or 0) / (8 * pack)) + 1
    dealt = langs.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    met = (packs.unionByName(nothing)
           .withColumn("_deal", F.pmod(F.xxhash64("terms"), F.lit(deals)).cast("int"))
           .join(dealt, ["lang", "_deal"]).drop("_deal"))
    ship_package(docs.sparkSession)
    found = met.mapInArrow(lambda b: _emit(b, top, cells),
                           "lang binary, source binary, part string, item binary, value long")
    added = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = F.when(F.col("part") == "pair", F.array(F.struct("source", "item"),
                                                   F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    both = both.otherwise(F.array(F.struct("source", "item")))
    turned = added.select("lang", "part", "value", F.explode(both).alias("s")).select("lang", "s.source", "part",
                                                                                     "s.item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    word: dict[str, Column] = {c: F.col(c).cast("string") for c in ("lang", "source", "item")}
    return (turned.withColumn("rank", place).filter((F.col("part") == "pair") | (F.col("rank") <= top))
            .select(word["lang"].alias("lang"), word["source"].alias("source"), "part", word["item"].alias("item"),
                    "value", "rank"))
