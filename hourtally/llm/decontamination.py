"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits of any alphabet, in lower case and without differences of
width or composition (``text.plain``): typographic quotes, dashes and spaces part words as plain ones
do. A seed mask looks at some of ``SPAN`` consecutive words and ignores the others, so passages with
replaced words still share the seeds whose ignored places cover the replacements. ``MASKS`` meet
every ``SPAN`` words of which two differ, so no overlap of ``OVERLAP`` words, or with a whole item of
at least ``SPAN``, is missed. Shorter items are met by ``SHORT_MASKS``, which look at the whole item
and cover as many replaced words as ``EQUAL_PERCENT`` allows (one of 8 or 9, two of 10), and items of
fewer than ``LEAST_WORDS`` words by one seed of all their words, which texts give for their short
lines.

The seeds of the benchmark and those of the documents are joined: neither the driver nor a task holds
the benchmark, and one pass over the texts makes their seeds however large it is. Where these are made, a filter of
the benchmark's seeds drops nearly all of them: one bit for each slot of a table of at most
``2^FILTER_BITS``, which is all that the driver gets. A hit names a text by its digest, an item, and
how the one lies on the other. The texts that have hits, each once however many documents have it,
are then compared with the items word by word at those places: each stretch in which every
``OVERLAP`` words have at least ``EQUAL_PERCENT`` equal ones is an overlap. Words that several items
share only cost more comparisons.

Defined results: null and empty texts overlap with nothing, nor do items without a word. Items of
fewer than ``OVERLAP`` words are sought as a whole. Items of fewer than ``LEAST_WORDS`` words are no
evidence within a sentence; they are found where they are the whole text or a whole line of it, word
by word. Repeated items and repeated rows are each reported. Rows without id are judged like others.
A very long text is one piece of work. Without items nothing overlaps, without documents there are no
rows. ``benchmark_overlaps`` reads id and text alone; ``drop_contaminated`` keeps all columns as
they are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.tables import digest_set, materialised, table
from hourtally.llm.text import (
    PUNCTUATION,
    U64,
    Words,
    encoded,
    mix,
    per_piece,
    split_words,
    word_hashes,
)

# Masks over SPAN words; a 0 is a word that may differ.
MASKS = (
    "11010010101", "10110001011", "11001010011", "11100100101",
    "00001111110", "01110111000", "01111000110", "10011100101",
)
SPAN = 11
# Masks over whole items of fewer than SPAN words, by their number.
SHORT_MASKS = {
    8: ("00111111", "11001111", "11110011", "11111100"),
    9: ("000111111", "111000111", "111111000"),
    10: (
        "0000111111", "0111000111", "0111111000", "1001011011", "1001101101",
        "1001110110", "1110001110", "1110110001", "1111001001",
    ),
}
OVERLAP, EQUAL_PERCENT = 13, 80
LEAST_WORDS = 8
# Bits of the filter for each seed of the benchmark, and the power of two that it is bounded by.
BITS_A_SEED, FILTER_BITS = 256, 28


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each word that has as many others behind it as the mask needs."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.full(n, int("1" + mask, 2), U64)
    for i, used in enumerate(mask):
        if used == "1":
            out *= U64(0x9E3779B97F4A7C15)
            out += hashes[i : i + n]
    return mix(out)


def line_seed(hashes: np.ndarray) -> int:
    """The seed of all words of a short item or line, unlike that of any mask."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little")


def item_seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of an item, and the word of the item that each begins at."""
    if not len(hashes):
        return np.empty(0, U64), np.empty(0, np.int64)
    if len(hashes) < LEAST_WORDS:
        return np.array([line_seed(hashes)], U64), np.zeros(1, np.int64)
    found = [seeds(hashes, mask) for mask in SHORT_MASKS.get(len(hashes), MASKS)]
    return np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])


def short_lines(words: Words) -> np.ndarray:
    """Beginning and end, in words, of whole lines and whole texts of fewer than ``LEAST_WORDS``
    words; a row for each."""
    ends = np.flatnonzero(words.data == 10)
    edges = np.unique(np.concatenate([words.first, np.searchsorted(words.start, ends)]))
    lines = np.column_stack([edges[:-1], edges[1:]])
    spans = np.concatenate([lines, np.column_stack([words.first[:-1], words.first[1:]])])
    size = spans[:, 1] - spans[:, 0]
    return np.unique(spans[(size > 0) & (size < LEAST_WORDS)], axis=0)


def overlaps(item: np.ndarray, text: np.ndarray, start: int) -> Iterator[tuple[int, int, int, int]]:
    """``(first word, first word of the item, words, equal words)`` of the overlaps of an item that
    lies on a text with its first word at ``start``, which may be before the text."""
    lo, hi = max(0, -start), min(len(item), len(text) - start)
    size = min(OVERLAP, len(item))
    if hi - lo < size:
        return
    equal = item[lo:hi] == text[start + lo : start + hi]
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[size:] - total[:-size] >= -(-size * EQUAL_PERCENT // 100))
    for run in np.split(good, np.flatnonzero(np.diff(good) > 1) + 1) if len(good) else ():
        a, b = int(run[0]), int(run[-1]) + size
        yield start + lo + a, lo + a, b - a, int(total[b] - total[a])


# --- the benchmark's side ---

_ITEM_TYPE = "item_id bigint, words array<bigint>"
_SEED_TYPE = "seed bigint, item bigint, word int"


def _item_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = split_words(encoded(batch.column("text"), lower=True), PUNCTUATION)
    hashes = word_hashes(words).view(np.int64)
    own = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("item_id"), pa.array(own, pa.list_(pa.int64()))], names=["item_id", "words"]
    )


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, words in zip(batch.column("item").to_pylist(), batch.column("words"), strict=True):
            found, place = item_seeds(words.values.to_numpy().view(U64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64)),
                    pa.array(np.full(len(found), item)),
                    pa.array(place.astype(np.int32)),
                ],
                names=["seed", "item", "word"],
            )


class SeedFilter:
    """Which slots of a table of ``2^bits`` the seeds of the benchmark have; two for each seed, from
    its first bits and from its last."""

    def __init__(self, bits: int, packed: np.ndarray | None = None):
        self.bits = bits
        self.packed = np.zeros(1 << max(bits - 3, 0), np.uint8) if packed is None else packed

    def _first(self, found: np.ndarray) -> np.ndarray:
        return found >> U64(64 - self.bits)

    def _last(self, found: np.ndarray) -> np.ndarray:
        return found & U64((1 << self.bits) - 1)

    def add(self, found: np.ndarray) -> None:
        for slot in (self._first(found), self._last(found)):
            bit = np.left_shift(np.uint8(1), (slot & U64(7)).astype(np.uint8))
            np.bitwise_or.at(self.packed, (slot >> U64(3)).astype(np.int64), bit)

    def _set(self, slot: np.ndarray) -> np.ndarray:
        byte = self.packed[(slot >> U64(3)).astype(np.int64)]
        return np.flatnonzero(np.right_shift(byte, (slot & U64(7)).astype(np.uint8)) & np.uint8(1))

    def likely(self, found: np.ndarray) -> np.ndarray:
        """Where ``found`` may have seeds of the benchmark."""
        some = self._set(self._first(found))
        return some[self._set(self._last(found[some]))]


def _seed_filter(bench_seeds: DataFrame, count: int) -> SeedFilter:
    bits = min(max(count * BITS_A_SEED, 8).bit_length(), FILTER_BITS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SeedFilter(bits)
        for batch in batches:
            own.add(batch.column("seed").to_numpy().view(U64))
        yield pa.RecordBatch.from_arrays([pa.array([own.packed.tobytes()], pa.binary())], names=["packed"])

    # A table of bits, at most 2^FILTER_BITS / 8 bytes, from each of a few tasks.
    parts = bench_seeds.select("seed").coalesce(8).mapInArrow(add, "packed binary")
    total = SeedFilter(bits)
    for row in parts.toLocalIterator():
        total.packed |= np.frombuffer(bytes(row["packed"]), np.uint8)
    return total


# --- the documents' side ---

_HIT_TYPE = "content binary, seed bigint, at int"
_FOUND_TYPE = (
    "content binary, item_id bigint, doc_word bigint, item_word bigint, n_words bigint, n_equal bigint"
)
_OVERLAP_TYPE = _FOUND_TYPE.replace("content binary", "doc_id bigint")


def _likely_seeds(known: SeedFilter, masks: list[str], lines: bool):
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(encoded(batch.column("text"), lower=True), PUNCTUATION)
        hashes = word_hashes(words)
        at, found = [np.empty(0, np.int64)], [np.empty(0, U64)]
        for mask in masks:
            every = seeds(hashes, mask)
            here = known.likely(every)
            end = words.first[np.searchsorted(words.first, here, "right")]
            here = here[here + len(mask) <= end]  # not into the next text
            at.append(here)
            found.append(every[here])
        if lines:
            spans = short_lines(words)
            every = np.array([line_seed(hashes[a:b]) for a, b in spans], U64)
            here = known.likely(every)
            at.append(spans[here, 0])
            found.append(every[here])
        place = np.concatenate(at)
        text = np.searchsorted(words.first, place, "right") - 1
        return pa.RecordBatch.from_arrays(
            [
                batch.column("content").take(pa.array(text)),
                pa.array(np.concatenate(found).view(np.int64)),
                pa.array((place - words.first[text]).astype(np.int32)),
            ],
            names=["content", "seed", "at"],
        )

    return rows


def _confirmed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The overlaps of each text with the items that it may have, at the places where it may."""
    words = split_words(encoded(batch.column("text"), lower=True), PUNCTUATION)
    hashes = word_hashes(words)
    lines = {(int(a), int(b)) for a, b in short_lines(words)}
    contents, out = batch.column("content").to_pylist(), []
    for i, places in enumerate(batch.column("places")):
        first = int(words.first[i])
        text = hashes[first : int(words.first[i + 1])]
        for place in places.as_py():
            item = np.array(place["words"], np.int64).view(U64)
            start = place["start"]
            if len(item) >= LEAST_WORDS:
                found = list(overlaps(item, text, start))
            else:
                end = start + len(item)
                same = (first + start, first + end) in lines and (item == text[start:end]).all()
                found = [(start, 0, len(item), len(item))] if same else []
            out += [(contents[i], place["item_id"], *f) for f in found]
    columns = list(zip(*out, strict=True)) or [()] * 6
    kinds = [pa.binary(), *[pa.int64()] * 5]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=[field.split()[0] for field in _FOUND_TYPE.split(", ")],
    )


def _content() -> Column:
    """What tells texts apart; documents with the same text have the same overlaps."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """The overlaps by ``content``, written down; None if the benchmark has no words."""
    given = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    numbered = given.mapInArrow(per_piece(_item_rows), _ITEM_TYPE).where(F.size("words") > 0)
    # Numbers that stay, as the rows are written down with them.
    items = materialised(numbered.withColumn("item", F.monotonically_increasing_id()), "items")
    bench_seeds = materialised(items.select("item", "words").mapInArrow(_seed_rows, _SEED_TYPE), "seeds")
    count = bench_seeds.count()
    if not count:
        return None
    known = _seed_filter(bench_seeds, count)
    # Lengths up to SPAN, which say what kinds of seeds there are.
    sizes = sorted(
        r["n"] for r in items.select(F.least(F.size("words"), F.lit(SPAN)).alias("n")).distinct().collect()
    )
    masks = [m for n in sizes if n >= LEAST_WORDS for m in SHORT_MASKS.get(n, MASKS)]

    texts = docs.select(_content().alias("content"), F.coalesce("text", F.lit("")).alias("text"))
    likely = per_piece(_likely_seeds(known, masks, sizes[0] < LEAST_WORDS))
    places = (
        texts.mapInArrow(likely, _HIT_TYPE)
        .distinct()
        .join(bench_seeds, "seed")
        .select("content", "item", (F.col("at") - F.col("word")).alias("start"))
        .distinct()
    )
    places = materialised(places, "places")
    # The items that a text may have, and where: as many as it has hits.
    wanted = (
        places.join(items, "item")
        .groupBy("content")
        .agg(F.collect_list(F.struct("start", "item_id", "words")).alias("places"))
    )
    # Only texts that have hits go on, and one of each.
    some = texts.join(digest_set(places.select("content").distinct(), "hits"), "content", "left_semi")
    once = some.groupBy("content").agg(F.first("text").alias("text"))
    found = once.join(wanted, "content").mapInArrow(per_piece(_confirmed), _FOUND_TYPE)
    return materialised(found, "overlaps")


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each overlap of a row of ``docs(doc_id, text)`` with an item: where it begins in
    both, in words, how long it is and how many words are equal."""
    found = _found(docs, benchmark)
    if found is None:
        return docs.sparkSession.createDataFrame([], _OVERLAP_TYPE)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _content().alias("content"))
    return rows.join(found, "content").drop("content")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap with an item, all columns kept."""
    found = _found(docs, benchmark)
    if found is None:
        return docs
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(whole.alias("doc"), _content().alias("content"))
    dirty = digest_set(found.select("content").distinct(), "contaminated")
    return rows.join(dirty, "content", "left_anti").select("doc.*")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return benchmark_overlaps(docs, benchmark)
