"""Removal of passages that an earlier document already has, by repeated-phrase automata.

A window is ``WINDOW`` consecutive words. A word goes if a window over it also starts in a
document with a smaller id.

0. Copies. A document whose every text an earlier document has as a whole has nothing of its own.
   It is settled by digest and takes no part in what follows.
1. Anchors. The ``ANCHOR``-word phrase with the least hash within a window belongs to the window
   wherever it occurs, so a window can only recur if its anchor does. Documents give their
   distinct anchors, about a quarter of their windows; those that come twice recur.
2. Confirmation. Only windows with a recurring anchor are counted themselves. A window that has
   two different ids recurs, and its first document owns it.
3. Passages. Each window that must go names the block of ``BLOCK`` windows around it in its first
   document. The owner gives the words of that block.
4. Automata. Documents and the blocks they need meet by id. A task cuts its documents into shards
   of bounded size, compiles the phrases of a shard's blocks into one Aho-Corasick automaton and
   streams all documents of the shard through it. Blocks are cut into consecutive phrases of
   ``ANCHOR`` words, and every window holds one whole phrase. A hit is extended to both sides,
   word by word; an occurrence of at least one window is removed. So hashes only select:
   what is removed from a document in part has been compared letter by letter. (Whole copies are
   settled by their digest alone.)

No group is gathered: a passage in very many documents is a block that is sent to each of them,
and a document gets each block once. What is known of a group goes back to its rows by joins that
Spark can cut where a key is hot.

Defined results: a null text has no words. A document without id is neither first nor changed.
Rows with one id are one document: their windows are not compared with each other, and each of
their texts may own a block of the same number. Repeated rows are each returned. Of equal passages
the one in the smallest id stays. A very long text is one piece of work. An empty
table gives no rows. Other columns are carried in ``rest`` and come back under their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourtally.llm.tables import dealt, joined, materialised, table
from hourtally.llm.text import (
    U64,
    Words,
    encoded,
    per_piece,
    split_words,
    window_hashes,
    word_hashes,
)

WINDOW, ANCHOR = 13, 7
BLOCK = 64


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word that starts a window: its number, and the hash of the window's anchor."""
    hashes = word_hashes(words)
    phrases = window_hashes(hashes, ANCHOR)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = phrases[:n].copy()
    for i in range(1, WINDOW - ANCHOR + 1):
        np.minimum(least, phrases[i : i + n], out=least)
    text_end = np.repeat(words.first[1:], words.counts())
    at = np.flatnonzero(np.arange(n) + WINDOW <= text_end[:n])
    return at, least[at]


def _short(anchor: np.ndarray) -> np.ndarray:
    """The 48 bits of an anchor that are shuffled: enough to select windows."""
    return (anchor >> U64(16)).view(np.int64)


def _anchor_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The distinct anchors of each text that is no copy."""
    words = split_words(encoded(batch.column("text")))
    at, anchor = anchors(words)
    anchor = _short(anchor)
    bounds = np.searchsorted(at, words.first)
    found, ids = [np.empty(0, np.int64)], []
    for i, (doc_id, copy) in enumerate(
        zip(batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist(), strict=True)
    ):
        if not copy:
            own = np.unique(anchor[bounds[i] : bounds[i + 1]])
            found.append(own)
            ids.append(np.full(len(own), doc_id, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(found)), pa.array(np.concatenate([found[0], *ids]))],
        names=["anchor", "doc_id"],
    )


def _window_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The first of each document's windows that have a recurring anchor."""
    words = split_words(encoded(batch.column("text")))
    at, anchor = anchors(words)
    # An anchor that recurs is listed for every document that has it, so one list will do.
    recurring = np.unique(batch.column("anchors").flatten().to_numpy(zero_copy_only=False))
    anchor = _short(anchor)
    place = np.minimum(np.searchsorted(recurring, anchor), len(recurring) - 1)
    at = at[recurring[place] == anchor] if len(recurring) else at[:0]
    hashes = window_hashes(word_hashes(words), WINDOW)[at]
    bounds = np.searchsorted(at, words.first)
    # In the order of the text, where neighbours have the same block: that packs well.
    block = (at - np.repeat(words.first[:-1], np.diff(bounds))) // BLOCK
    chosen, lengths = [np.empty(0, np.int64)], []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        own = np.arange(lo, hi)
        if len(np.unique(hashes[lo:hi])) < hi - lo:
            own = lo + np.sort(np.unique(hashes[lo:hi], return_index=True)[1])
        chosen.append(own)
        lengths.append(len(own))
    kept = np.concatenate(chosen)
    ids = np.repeat(batch.column("doc_id").to_numpy(), lengths)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hashes[kept].view(np.int64)),
            pa.array(ids),
            pa.array(block[kept].astype(np.int32)),
        ],
        names=["window", "doc_id", "block"],
    )


def _block_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    owners, numbers, phrases = [], [], []
    for doc_id, text, blocks in zip(
        batch.column("doc_id").to_pylist(),
        encoded(batch.column("text")),
        batch.column("blocks").to_pylist(),
        strict=True,
    ):
        words = text.split()
        for number in blocks:
            lo = number * BLOCK
            owners.append(doc_id)
            numbers.append(number)
            phrases.append(b" ".join(words[lo : lo + BLOCK + WINDOW - 1]).decode())
    return pa.RecordBatch.from_arrays(
        [pa.array(owners, pa.int64()), pa.array(numbers, pa.int32()), pa.array(phrases, pa.string())],
        names=["owner", "block", "words"],
    )


def _automaton(blocks: list[list[str]]) -> ahocorasick.Automaton | None:
    """Finds the phrases that the blocks consist of; a hit tells (block, word) pairs."""
    phrases: dict[str, list[tuple[int, int]]] = {}
    for number, words in enumerate(blocks):
        for lo in range(0, len(words) - ANCHOR + 1, ANCHOR):
            phrase = f" {' '.join(words[lo : lo + ANCHOR])} "
            phrases.setdefault(phrase, []).append((number, lo))
    if not phrases:
        return None
    automaton = ahocorasick.Automaton()
    for phrase, places in phrases.items():
        automaton.add_word(phrase, (len(phrase), places))
    automaton.make_automaton()
    return automaton


def occurrences(
    line: str, automaton: ahocorasick.Automaton, blocks: list[list[str]]
) -> Iterator[tuple[int, int, int]]:
    """``(block, lo, hi)`` for each stretch of at least ``WINDOW`` words that is in a block.

    The words of ``line`` are parted by one space.
    """
    words: list[str] = []
    number_at: dict[int, int] = {}
    done: dict[tuple[int, int], int] = {}
    for last, (length, places) in automaton.iter(f" {line} "):
        if not words:
            words = line.split(" ")
            starts = accumulate((len(word) + 1 for word in words), initial=0)
            number_at = dict(zip(starts, range(len(words)), strict=False))
        d = number_at[last - length + 1]
        for number, p in places:
            # A stretch is met once for each of its phrases.
            if done.get((number, d - p), -1) >= d:
                continue
            block = blocks[number]
            lo = 0
            while lo < min(d, p) and words[d - lo - 1] == block[p - lo - 1]:
                lo += 1
            hi = ANCHOR
            while d + hi < len(words) and p + hi < len(block) and words[d + hi] == block[p + hi]:
                hi += 1
            done[number, d - p] = d + hi - 1
            if lo + hi >= WINDOW:
                yield number, d - lo, d + hi


def _cut(text: bytes, gone: np.ndarray) -> bytes:
    """``text`` without the words marked in ``gone`` and the space behind them."""
    words = split_words([text])
    edges = np.append(words.start, len(text))
    runs = np.flatnonzero(np.diff((~gone).view(np.int8), prepend=0, append=0)).reshape(-1, 2)
    return text[: edges[0]] + b"".join(text[edges[lo] : edges[hi]] for lo, hi in runs)


def _cleaned(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_pylist()
    texts = encoded(batch.column("text"))
    needed = batch.column("passages").to_pylist()
    copies = batch.column("copy").to_pylist()
    index: dict[tuple[int, int, str], int] = {}
    blocks: list[list[str]] = []
    owners: list[int] = []
    for passages in needed:
        for passage in passages or ():
            key = (passage["owner"], passage["block"], passage["words"])
            if key not in index:
                index[key] = len(blocks)
                blocks.append(passage["words"].split(" "))
                owners.append(passage["owner"])
    automaton = _automaton(blocks)
    counts, spans, cleaned = [], [], batch.column("text").to_pylist()
    for i, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
        words = text.split()
        counts.append(len(words))
        gone = np.zeros(len(words), bool)
        if copies[i]:
            gone[:] = len(words) >= WINDOW
        elif automaton is not None and doc_id is not None and len(words) >= WINDOW:
            for block, lo, hi in occurrences(b" ".join(words).decode(), automaton, blocks):
                if owners[block] < doc_id:
                    gone[lo:hi] = True
        edges = np.flatnonzero(np.diff(gone.view(np.int8), prepend=0, append=0))
        spans.append([{"first": lo, "end": hi} for lo, hi in edges.reshape(-1, 2).tolist()])
        if gone.any():
            cleaned[i] = _cut(text, gone).decode()
    arrays = [batch.column("doc_id"), pa.array(cleaned, pa.string()), batch.column("rest")]
    arrays += [pa.array(counts, pa.int64()), pa.array(spans, _SPANS)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "rest", "n_words", "removed"])


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)``: ``doc_id``, the ``text`` that is left, ``rest``
    (a structure of the other columns), ``n_words`` of the whole text, and the word spans that
    were ``removed``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    # Without a new name where none is needed: that alone would make a second exchange.
    if dict(docs.dtypes)["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs.select("doc_id", "text", rest.alias("rest"))
    named = docs.where("doc_id is not null")

    digests = named.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    first = (
        digests.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
    )
    later = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    copies = materialised(
        digests.join(dealt(first, "digest"), "digest", "left")
        .groupBy("doc_id")
        .agg(F.bool_and(later).alias("copy"))
        .where("copy")
        .select("doc_id"),
        "copies",
    )
    copies = copies.withColumn("copy", F.lit(True))

    anchor = (
        named.select("doc_id", "text")
        .join(copies, "doc_id", "left")
        .mapInArrow(per_piece(_anchor_rows), "anchor bigint, doc_id bigint")
    )
    often = anchor.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    by_doc = materialised(
        joined(anchor, often.select("anchor"), "anchor")
        .groupBy("doc_id")
        .agg(F.collect_set("anchor").alias("anchors")),
        "anchors",
    )

    # From here on all joins with the texts are on the id and take whole rows, so that they read
    # one and the same exchange.
    windows = named.join(by_doc, "doc_id").mapInArrow(
        per_piece(_window_rows), "window bigint, doc_id bigint, block int"
    )
    owned = (
        windows.groupBy("window")
        .agg(
            F.min("doc_id").alias("first"),
            F.max("doc_id").alias("last"),
            F.min_by("block", "doc_id").alias("block"),
        )
        .where("first < last")
        .select("window", F.col("first").alias("owner"), "block")
    )
    needs = (
        joined(windows.drop("block"), owned, "window")
        .where("owner < doc_id")
        .select("doc_id", "owner", "block")
        .distinct()
    )
    wanted = needs.groupBy(F.col("owner").alias("doc_id")).agg(F.collect_set("block").alias("blocks"))
    blocks = named.join(wanted, "doc_id").mapInArrow(
        per_piece(_block_rows), "owner bigint, block int, words string"
    )
    passages = (
        needs.join(blocks, ["owner", "block"])
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("owner", "block", "words")).alias("passages"))
    )

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_words", T.LongType()),
            T.StructField(
                "removed",
                T.ArrayType(
                    T.StructType(
                        [T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]
                    )
                ),
            ),
        ]
    )
    unnamed = docs.where("doc_id is null").withColumns(
        {
            "copy": F.lit(None).cast("boolean"),
            "passages": F.lit(None).cast(passages.schema["passages"].dataType),
        }
    )
    both = named.join(passages, "doc_id", "left").join(copies, "doc_id", "left")
    both = both.unionByName(unnamed)
    return both.mapInArrow(per_piece(_cleaned), schema)


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out, all columns kept. Documents of which no word is
    left go, unless they had none."""
    found = substring_dedup(docs)
    left = found.where((F.size("removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    columns = {f.name: F.col(f"rest.`{f.name}`") for f in found.schema["rest"].dataType}
    columns |= {"doc_id": F.col("doc_id"), "text": F.col("text")}
    changed = F.size("removed") > 0
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("text")).otherwise(columns["n_chars"])
    kinds = {f.name: f.dataType for f in docs.schema}
    return left.select(*(columns[c].cast(kinds[c]).alias(c) for c in docs.columns))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    removed = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"]
    )
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2(kept, 256).alias("kept_sha256")
    )
