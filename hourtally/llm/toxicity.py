"""Toxicity scores by FTRL-proximal logistic regression.

Features are the distinct lower-cased word 1- and 2-grams, skip-grams (a word and the second or
third one after it) and word stems, hashed to ``2^BITS`` slots. FTRL keeps two sums for each coordinate: its rate
falls with the coordinate's own gradients, and a coordinate whose sum stays below ``L1`` is zero, so
the few weights that remain are sent to every task.

The labelled rows, a bounded sample of them (``MAX_LABELS``), are dealt into ``SHARDS`` shards by
a hash of their id, at every size alike. Each of ``PASSES`` rounds lets a task learn from each shard,
beginning with the sums that all had agreed on, and averages what the shards add to them. So the
sums see every shard in each round, and a coordinate is zero for all or for none. Within a shard
rows come in an order of hashes, another one in each round, and sums are added up in the order of the shards: the
model, and with it every score, is the same however the rows are stored. Features are made
once and written down; a task reads them a batch at a time, so no text is too long for it. A text's score is the probability
that it is toxic.

Defined results: a null or empty text has no feature and scores the constant. Without any label
every text scores one half. Repeated rows are each scored, and each learnt from if their id has a
label; of contradicting labels of one id 1 counts. Rows without an id are scored, not learnt from. A
very long text is one piece of work. An empty table gives no rows; columns other than id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.features import crc_remainder, sampled_labels, sigmoid
from hourtally.llm.tables import materialised, table
from hourtally.llm.text import (
    PUNCTUATION,
    U64,
    encoded,
    mix,
    per_piece,
    split_words,
    word_hashes,
)

BITS = 20
MAX_LABELS, SHARDS, PASSES = 32_000, 4, 6
ALPHA, BETA, L1, L2 = 4.0, 1.0, 4.0, 0.1
THRESHOLD = 0.3

_ROW = ("shard", "label", "place", "content")
_ROW_TYPE = "shard int, label int, place bigint, content bigint"

# Bytes of a word that are its stem.
STEM = 7
# Distance of the second word of each kind of pair.
_DISTANCES = (1, 2, 3)


def feature_slots(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each kind of feature the slot at each word (-1: none), and the first word of each
    text. ``texts`` are lower-cased."""
    words = split_words(texts, PUNCTUATION)
    hashes = word_hashes(words)
    n = len(hashes)
    text_end = np.repeat(words.first[1:], words.counts())
    shift = U64(64 - BITS)
    stems = word_hashes(words._replace(end=np.minimum(words.end, words.start + STEM)))
    kinds = [(h >> shift).astype(np.int64) for h in (hashes, mix(stems + U64(1)))]
    for distance in _DISTANCES:
        slots = np.full(n, -1, np.int64)
        if n > distance:
            pair = mix(hashes[:-distance] * U64(2 * distance + 1) + hashes[distance:])
            inside = np.arange(n - distance) + distance < text_end[: n - distance]
            slots[: n - distance] = np.where(inside, (pair >> shift).astype(np.int64), -1)
        kinds.append(slots)
    return kinds, words.first


def _feature_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    kinds, first = feature_slots(encoded(batch.column("text"), lower=True))
    slots = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        own = np.unique(np.concatenate([k[lo:hi] for k in kinds]))
        slots.append(own[own >= 0].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in _ROW), pa.array(slots, pa.list_(pa.int32()))],
        names=[*_ROW, "slots"],
    )


class Sums(NamedTuple):
    """FTRL's two sums by slot; the last slot is the constant, which is not regularised."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def none(cls) -> Sums:
        return cls(np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1))

    def weights(self, at: np.ndarray) -> np.ndarray:
        alone = at == 1 << BITS
        l1, l2 = np.where(alone, 0.0, L1), np.where(alone, 0.0, L2)
        z = self.z[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, label: int, at: np.ndarray) -> None:
        w = self.weights(at)
        slope = float(sigmoid(w.sum())) - label
        n = self.n[at]
        sigma = (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA
        self.z[at] += slope - sigma * w
        self.n[at] += slope * slope


def _round(sums: Broadcast, shard: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over the rows of one shard, in their order: what they add to the sums."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agreed = Sums(*sums.value)
        own = Sums(agreed.z.copy(), agreed.n.copy())
        for batch in batches:
            for label, slots in zip(batch.column("label").to_pylist(), batch.column("slots"), strict=True):
                own.learn(int(label), np.append(slots.values.to_numpy(), 1 << BITS))
        used = np.flatnonzero(own.n != agreed.n)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), shard), pa.int32()),
                    pa.array(used, pa.int32()),
                    pa.array((own.z - agreed.z)[used]),
                    pa.array((own.n - agreed.n)[used]),
                ],
                names=["shard", "slot", "z", "n"],
            )

    return learn


class ToxicityModel:
    """The slots with a weight, sorted, their weights, and the constant."""

    def __init__(self, slots: np.ndarray, weights: np.ndarray, constant: float):
        self.slots, self.weights, self.constant = slots, weights, constant

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Of the lower-cased texts."""
        weight = np.zeros((1 << BITS) + 1)  # the last one belongs to slot -1
        weight[self.slots] = self.weights
        kinds, first = feature_slots(texts)
        out = np.full(len(texts), self.constant)
        text, slot = [], []
        for slots in kinds:
            at = np.flatnonzero(weight[slots])
            text.append(np.searchsorted(first, at, "right") - 1)
            slot.append(slots[at])
        # A feature counts once in a text.
        pairs = np.unique(np.stack([np.concatenate(text), np.concatenate(slot)]), axis=1)
        np.add.at(out, pairs[0], weight[pairs[1]])
        return sigmoid(out)


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    sample = sampled_labels(labels, "toxic", crc_remainder("doc_id", 4) != 2, MAX_LABELS)
    # At most MAX_LABELS rows of two numbers: small enough for every executor.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample), "doc_id"
    )
    # Few files, although the rows come from all tasks.
    rows = rows.repartition(4 * SHARDS, "doc_id")
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int")
    made = rows.select(
        shard.alias("shard"),
        "label",
        F.xxhash64("doc_id").alias("place"),
        F.xxhash64("text").alias("content"),
        "text",
    ).mapInArrow(per_piece(_feature_rows), f"{_ROW_TYPE}, slots array<int>")
    # Slots of a text rise, so their differences take half the room.
    features = materialised(made, "toxic-features", **{"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"})
    shards = features.select("shard").distinct().count()
    agreed = Sums.none()
    for number in range(PASSES if shards else 0):
        # Sent once and given up after the round: 2^BITS + 1 pairs of numbers.
        sums = docs.sparkSession.sparkContext.broadcast(tuple(agreed))
        # A task for each shard, which holds one batch of it at a time. No row is shuffled.
        learnt = reduce(
            DataFrame.union,
            (
                features.where(F.col("shard") == k)
                .coalesce(1)
                .sortWithinPartitions(F.xxhash64("place", F.lit(number)), "place", "content")
                .select("label", "slots")
                .mapInArrow(_round(sums, k), "shard int, slot int, z double, n double")
                for k in range(SHARDS)
            ),
        )
        # In the order of the shards, so that rounding is the same each time.
        parts = F.sort_array(F.collect_list(F.struct("shard", "z", "n")))
        added = learnt.groupBy("slot").agg(parts.alias("parts")).select(
            "slot",
            *(F.aggregate(F.col("parts")[c], F.lit(0.0), lambda a, x: a + x).alias(c) for c in "zn"),
        )
        total = added.toArrow()  # at most 2^BITS + 1 rows, as columns
        at = total["slot"].to_numpy()
        agreed.z[at] += total["z"].to_numpy() / shards
        agreed.n[at] += total["n"].to_numpy() / shards
        sums.destroy()
    weights = agreed.weights(np.arange((1 << BITS) + 1))
    used = np.flatnonzero(weights[:-1])
    return ToxicityModel(used, weights[used], float(weights[-1]))


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``docs(doc_id, text)``."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = model.probabilities(encoded(batch.column("text"), lower=True))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"]
        )

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(per_piece(judge), "doc_id bigint, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity(docs, fit_toxicity(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )
