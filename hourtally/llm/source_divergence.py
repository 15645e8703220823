"""How the vocabularies of sources differ, by stripes folded in the mappers.

Each task folds whole documents into stripes: a term of a language, with the occurrences and the
documents that each source has of it. Stripes stay in hash tables until these hold ``ENTRIES``
counts or have read ``BYTES`` of text, then all are written to the shuffle and the tables start
empty. Stripes of one term meet in one task, which adds them up and keeps the term if enough
documents of its language hold it. One pass over the merged stripes, which are written down, gives
what each term adds to the divergence of every two sources and to the terms that set a source
apart from its language. A term costs its sources times all sources of the language, not all pairs:
where neither of two sources has it, its share is the same for all such terms and is added once.

No text leaves the task that reads it. Partial results are summed in tasks before they are shuffled: a
task gives one row for each pair of sources and ``TOP`` rows for each group. The driver holds one
row for each pair of language and source, whose total number of occurrences every task needs; the
result holds the square of their number. All arithmetic is on integers.

Terms are runs of characters other than those of ASCII that are no letters, with A-Z lower-cased.

Defined results: null texts, languages and sources are empty ones, and an empty language or source
is a group as any other. Repeated rows and rows without an id all count, each as a document. A
language without a kept term has pairs of value 0 and no terms. A source alone in its language has
no pairs. Equal values are ranked by item. A very long text is cut where its terms end, so memory
grows with its distinct terms only. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourtally.llm.tables import materialised, table

# Documents of a language that a kept term is in, the rank up to which terms are told, what is added
# to each count, and the unit of shares.
LEAST_DOCS, TOP, SMOOTH, UNIT = 30, 50, 5, 10**9

# Parts of a group's terms that are ranked each for itself.
SALTS = 8

# What a task holds before it writes its stripes: counts, and bytes of text read for them.
ENTRIES, BYTES = 400_000, 128 << 20
# Bytes of one text that are cut into terms at a time, and cells of the table of terms by sources.
PIECE, CELLS = 1 << 20, 1 << 21

# ASCII letters lower-cased, bytes of other characters as they are, all else a blank.
_LETTERS = bytes(
    c if c > 127 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)

_ENTRY = "struct<source:string,n:bigint,docs:bigint>"
_STRIPES = f"lang string, term string, entries array<{_ENTRY}>"
_PARTS = "lang string, source string, part string, item string, value bigint"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    plain = text.translate(_LETTERS)
    lo = 0
    while lo < len(plain):
        hi = lo + PIECE
        if hi < len(plain):
            end = plain.find(b" ", hi)
            hi = len(plain) if end < 0 else end
        yield plain[lo:hi].split()
        lo = hi


class _Stripes:
    """Counts by language and source; a term's stripe are its entries in all of a language's."""

    def __init__(self):
        self.counts = defaultdict(Counter)
        self.docs = defaultdict(Counter)
        self.read = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, seen = self.counts[lang, source], set()
        for terms in _terms(text):
            counts.update(terms)
            seen.update(terms)
        docs = self.docs[lang, source]
        docs.update(seen)
        docs[b""] += 1  # the group itself, which may have no terms
        self.read += len(text)

    def full(self) -> bool:
        return self.read > BYTES or sum(map(len, self.docs.values())) > ENTRIES

    def batches(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        for lang in sorted({g[0] for g in self.docs}):
            stripes = defaultdict(list)
            for group, docs in self.docs.items():
                if group[0] == lang:
                    n, source = self.counts[group], group[1]
                    for term, d in docs.items():
                        stripes[term].append((source, n[term], d))
            terms = list(stripes)
            for lo in range(0, len(terms), rows):
                part = terms[lo : lo + rows]
                lists = [stripes.pop(t) for t in part]
                flat = [e for entries in lists for e in entries]
                source, n, d = zip(*flat)
                entries = pa.StructArray.from_arrays(
                    [pa.array(source, pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                    ["source", "n", "docs"],
                )
                offsets = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(e) for e in lists], out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string(), safe=False),
                        pa.ListArray.from_arrays(pa.array(offsets), entries),
                    ],
                    ["lang", "term", "entries"],
                )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes, tick = _Stripes(), 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            stripes.add(langs[i], sources[i], text)
            tick += len(text) + 100
            if tick > PIECE:  # looks now and then
                tick = 0
                if stripes.full():
                    yield from stripes.batches()
                    stripes = _Stripes()
    yield from stripes.batches()


def term_stripes(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, entries`` of the kept terms, written down; the entries are structs ``source,
    n, docs`` by source. The empty term has all groups of its language, with no occurrences."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    stripes = texts.mapInArrow(_fold, _STRIPES)
    # By term alone, so that adding up the sources and gathering them needs no second exchange.
    entries = stripes.repartition("lang", "term").select("lang", "term", F.inline("entries"))
    added = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    merged = added.groupBy("lang", "term").agg(
        F.sum("docs").alias("n_docs"), F.sort_array(F.collect_list(F.struct("source", "n", "docs"))).alias("entries")
    )
    kept = merged.where((F.col("n_docs") >= least_docs) | (F.col("term") == ""))
    return materialised(kept.select("lang", "term", "entries"), "stripes")


def _shares(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * kept)), exact for totals to 9 * 10^15."""
    whole = total + SMOOTH * kept
    rest, out = n + SMOOTH, np.zeros_like(n)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


class _Language:
    """Sources of a language in order, their totals, and what terms have added up to so far."""

    def __init__(self, name: str, sources: list[str], totals: np.ndarray, kept: int):
        self.name, self.sources, self.totals, self.kept = name, sources, totals, kept
        self.index = {s: i for i, s in enumerate(sources)}
        self.all = np.array([totals.sum()])
        self.absent = _shares(np.zeros_like(totals), totals, kept) if kept else np.zeros_like(totals)
        self.sums: dict[int, np.ndarray] = {}
        self.best: list[list] = [[] for _ in sources]
        self.bar = np.zeros(len(sources), np.int64)

    def empty(self) -> _Language:
        return _Language(self.name, self.sources, self.totals, self.kept)

    def distances(self, i: int) -> np.ndarray:
        """From source i to all, if no term were in either."""
        return self.kept * np.abs(self.absent - self.absent[i])

    def add(self, terms: list[str], row: np.ndarray, column: np.ndarray, n: np.ndarray) -> None:
        step = max(1, CELLS // len(self.sources))
        for lo in range(0, len(terms), step):
            part = slice(*np.searchsorted(row, [lo, min(lo + step, len(terms))]))
            self._add(terms[lo : lo + step], row[part] - lo, column[part], n[part])

    def _add(self, terms: list[str], row: np.ndarray, column: np.ndarray, n: np.ndarray) -> None:
        share = _shares(n, self.totals[column], self.kept)
        table = np.repeat(self.absent[None], len(terms), 0)
        table[row, column] = share
        here = np.zeros(table.shape, bool)
        here[row, column] = True
        order = np.argsort(column, kind="stable")
        bounds = np.searchsorted(column[order], np.arange(len(self.sources) + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            mine = order[bounds[i] : bounds[i + 1]]
            apart = np.abs(table[row[mine]] - share[mine, None]) - np.abs(self.absent - self.absent[i])
            # A term that both have counts once for the two: in the row of the first.
            apart[:, : i + 1][here[row[mine], : i + 1]] = 0
            self.sums[i] = self.sums.get(i, 0) + apart.sum(0)
        together = np.zeros(len(terms), np.int64)
        np.add.at(together, row, n)
        above = share - _shares(together, self.all, self.kept)[row]
        for e in np.flatnonzero((above > 0) & (above >= self.bar[column])):
            self._offer(column[e], (-int(above[e]), terms[row[e]].encode()))

    def _offer(self, i: int, found: tuple[int, bytes]) -> None:
        best = self.best[i]
        best.append(found)
        if len(best) >= 20 * TOP:
            best.sort()
            del best[TOP:]
            self.bar[i] = -best[-1][0]

    def rows(self) -> Iterator[tuple]:
        for i, sums in self.sums.items():
            for j in np.flatnonzero(sums):
                for a, b in ((i, j), (j, i)):
                    yield self.name, self.sources[a], "pair", self.sources[b], int(sums[j])
        self.sums = {}
        for i, best in enumerate(self.best):
            for value, term in sorted(best)[:TOP]:
                yield self.name, self.sources[i], "term", term.decode(), -value


def _batches(rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PARTS.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int64()]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _languages(stripes: DataFrame) -> dict[str, _Language]:
    """One row for each language and source comes to the driver."""
    kept = {
        r["lang"]: r["kept"]
        for r in stripes.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("kept")).collect()
    }
    groups: dict[str, list[tuple[str, int]]] = defaultdict(list)
    entries = stripes.select("lang", F.inline("entries"))
    for r in entries.groupBy("lang", "source").agg(F.sum("n").alias("n")).toLocalIterator():
        groups[r["lang"]].append((r["source"], r["n"]))
    out = {}
    for lang, found in groups.items():
        found.sort()
        totals = np.array([n for _, n in found], np.int64)
        out[lang] = _Language(lang, [s for s, _ in found], totals, kept[lang])
    return out


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs(text, lang, source)``.

    Part ``pair``: the divergence from each other source of the language, in units of 1 to
    ``UNIT``. Part ``term``: the ``TOP`` terms of which the source has more than its language.
    """
    stripes = term_stripes(docs, least_docs)
    languages = _languages(stripes)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: x.empty() for name, x in languages.items()}
        for batch in batches:
            terms, langs = batch.column("term").to_pylist(), np.array(batch.column("lang").to_pylist(), object)
            lists = batch.column("entries")
            sizes = np.diff(lists.offsets.to_numpy())
            entries = lists.flatten()
            row = np.repeat(np.arange(len(terms)), sizes)
            source, n = entries.field("source").to_pylist(), entries.field("n").to_numpy()
            for lang in sorted(set(langs.tolist())):
                language = sums[lang]
                wanted = np.array([x == lang and t != "" for x, t in zip(langs, terms)], bool)
                places = np.cumsum(wanted) - 1
                mine = np.flatnonzero(wanted[row])
                if not len(mine):
                    continue
                column = np.array([language.index[source[e]] for e in mine])
                language.add(
                    [t for t, w in zip(terms, wanted) if w], places[row[mine]], column, n[mine]
                )
            if sum(len(x.sums) * len(x.sources) for x in sums.values()) > CELLS:
                yield from _batches(r for x in sums.values() for r in x.rows())
        yield from _batches(r for x in sums.values() for r in x.rows())

    def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for lang, source in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
                    language = languages[lang]
                    i = language.index[source]
                    for j, value in enumerate(language.distances(i)):
                        if j != i:
                            yield lang, source, "pair", language.sources[j], int(value)

        yield from _batches(rows())

    groups = stripes.where("term = ''").select("lang", F.inline("entries")).select("lang", "source").repartition("lang", "source")
    parts = stripes.select("lang", "term", "entries").mapInArrow(emit, _PARTS).union(groups.mapInArrow(unlike, _PARTS))
    key = ("lang", "source", "part", "item")
    # Flushed more than once, a term may come twice; its value is the same.
    value = F.when(F.col("part") == "pair", F.sum("value")).otherwise(F.max("value"))
    summed = parts.groupBy(*key).agg(value.alias("value"))
    # Parts of a group are ranked first: how many terms reach its last ranking does not grow with the
    # number of tasks.
    first = F.desc("value"), "item"
    some = Window.partitionBy("lang", "source", "part", F.pmod(F.xxhash64("item"), F.lit(SALTS))).orderBy(*first)
    best = summed.withColumn("rank", F.row_number().over(some)).where((F.col("part") == "pair") | (F.col("rank") <= TOP))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*first)))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP12_SQL = f"""
  WITH docs AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text
    FROM documents),
  found AS (
    SELECT rid, lang, source,
           unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM docs),
  kept AS (
    SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST_DOCS}),
  groups AS (SELECT DISTINCT lang, source FROM docs),
  counts AS (
    SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term)
    GROUP BY lang, source, term),
  cells AS (
    SELECT lang, source, term, coalesce(n, 0) AS n
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
  shares AS (
    SELECT lang, source, term, n, (1 + ({UNIT}::HUGEINT * (n + {SMOOTH}))
           // (sum(n) OVER (PARTITION BY lang, source) + {SMOOTH} * count(*) OVER (PARTITION BY lang, source)))::BIGINT AS p
    FROM cells),
  whole AS (
    SELECT lang, term, (1 + ({UNIT}::HUGEINT * (n + {SMOOTH}))
           // (sum(n) OVER (PARTITION BY lang) + {SMOOTH} * count(*) OVER (PARTITION BY lang)))::BIGINT AS q
    FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term)),
  apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
  parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term)
    WHERE n > 0 AND p > q),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
    FROM parts)
  SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
