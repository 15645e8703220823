"""Quality rules: counted limits, then a hashed n-gram logistic regression.

Features are word 1- and 2-grams and character (code point) 3- and 4-grams, hashed to ``2^BITS`` weights. The n-grams
of a kind weigh one together, however long the text, so a text's logit is a constant plus the mean
weight of each kind, and scoring is a lookup and a sum by text.

The regression is fitted by tasks on ``SHARDS`` shards, at every size alike, of a bounded sample of
the labelled rows (``MAX_LABELS``), and the weights are averaged; a fifth of the sample is kept apart
to fit the two parameters of the probability calibration. Shards are dealt by a hash of the id and read
in the order of hashes of id and text, so the model and every probability are the same however the rows are
stored. Scoring runs over Arrow batches of whole texts.

Defined results: a null text has no words, all counts are zero, it fails the base rule. Without
labels of both kinds every text scores the share of label 1 (one half without any label). Repeated
rows are each judged, and each learnt from if their id has a label; of contradicting labels of one
id 1 counts. Rows without an id are judged, not learnt from. A very long text is one piece of
work. An empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.features import crc_remainder, sampled_labels, sigmoid
from hourtally.llm.tables import table
from hourtally.llm.text import (
    SPACES,
    U64,
    encoded,
    mix,
    per_piece,
    split_words,
    window_hashes,
    word_hashes,
)

_ROW = ("shard", "label", "place", "content")

BITS = 18
MAX_LABELS, SHARDS, PASSES = 16_000, 4, 3
SCALE, RATE = 8.0, 0.5
# Fixed limits of the rules.
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 50, 50, 0.5
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_SHIFT = U64(64 - BITS)
# Length and unit of each kind of n-gram, and odd multipliers that keep the kinds apart.
_SIZES = ((1, True), (2, True), (3, False), (4, False))
_KINDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and at which byte each begins."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[start].astype(U64)
    size = np.diff(start, append=len(data))
    out = np.where(first < 0x80, first, np.where(first < 0xE0, first & U64(0x1F), np.where(first < 0xF0, first & U64(0x0F), first & U64(7))))
    for i in range(1, 4):
        more = size > i
        following = data[np.minimum(start + i, len(data) - 1)].astype(U64) & U64(0x3F)
        out = np.where(more, (out << U64(6)) | following, out)
    return out, start


def gram_slots(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of n-gram: the slots of all n-grams, and where those of each text begin and
    end. An n-gram that reaches into the next text belongs to none."""
    words = split_words(texts)
    points, start = _code_points(words.data)
    characters, bounds = mix(points + U64(1)), np.searchsorted(start, words.offset)
    hashes = word_hashes(words)
    out = []
    for kind, (size, of_words) in zip(_KINDS, _SIZES, strict=True):
        grams = window_hashes(hashes if of_words else characters, size)
        edge = words.first if of_words else bounds
        start, end = edge[:-1], np.maximum(edge[1:] - (size - 1), edge[:-1])
        slots = (grams * U64(kind) >> _SHIFT).astype(np.int32)
        out.append((slots, np.minimum(start, len(slots)), np.minimum(end, len(slots))))
    return out


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of counts, which are exact."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[end] - total[start]


def logits(texts: list[bytes], weights: np.ndarray, constant: float) -> np.ndarray:
    out = np.full(len(texts), constant)
    for slots, start, end in gram_slots(texts):
        # Each text is added up for itself: rounding does not depend on its neighbours.
        size = end - start
        text = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(text)) + np.repeat(start - np.cumsum(size) + size, size)
        total = np.bincount(text, weights[slots[inside]], len(size))
        out += SCALE * total / np.maximum(size, 1)
    return out


def _feature_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = encoded(batch.column("text"))
    kinds = gram_slots(texts)
    slots, shares = [], []
    for i in range(len(texts)):
        parts = [k[start[i] : end[i]] for k, start, end in kinds]
        every = np.concatenate(parts)
        share = np.concatenate([np.full(len(p), SCALE / max(len(p), 1)) for p in parts])
        own, place = np.unique(every, return_inverse=True)
        slots.append(own)
        shares.append(np.bincount(place, share, len(own)).astype(np.float32))
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c) for c in _ROW),
            pa.array(slots, pa.list_(pa.int32())),
            pa.array(shares, pa.list_(pa.float32())),
        ],
        names=[*_ROW, "slots", "shares"],
    )


def _fit(shard: pa.Table) -> pa.Table:
    """Logistic regression by per-weight decreasing steps, over the rows of one shard."""
    shard = shard.sort_by([("place", "ascending"), ("content", "ascending")])
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    constant, constant_squares = 0.0, 1e-8
    rows = [
        (int(y), s.values.to_numpy(), x.values.to_numpy())
        for y, s, x in zip(
            shard["label"].to_pylist(), shard["slots"], shard["shares"], strict=True
        )
    ]
    rng = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)):
            y, slots, shares = rows[i]
            error = float(sigmoid(constant + weights[slots] @ shares)) - y
            slope = error * shares
            squares[slots] += slope * slope
            weights[slots] -= RATE * slope / np.sqrt(squares[slots])
            constant_squares += error * error
            constant -= RATE * error / np.sqrt(constant_squares)
    used = np.flatnonzero(weights)
    return pa.table(
        {
            "shard": pa.array(np.full(len(used) + 1, shard["shard"][0].as_py()), pa.int32()),
            "slot": pa.array(np.append(used, -1), pa.int32()),
            "weight": pa.array(np.append(weights[used], constant), pa.float64()),
        }
    )


def _mean_weights(fitted: DataFrame) -> tuple[np.ndarray, float]:
    """The average of the shards' weights; a weight that a shard lacks is zero there."""
    # Added in the order of the shards, so that rounding is the same each time.
    parts = F.sort_array(F.collect_list(F.struct("shard", "weight")))["weight"]
    rows = fitted.groupBy("slot").agg(parts.alias("parts")).select(
        "slot", F.aggregate("parts", F.lit(0.0), lambda a, x: a + x).alias("weight"), F.size("parts").alias("n")
    )
    rows = rows.toPandas()  # at most 2^BITS + 1
    weights, constant, shards = np.zeros(1 << BITS, np.float32), 0.0, 1
    if (alone := rows[rows["slot"] < 0]).size:
        shards = int(alone["n"].iloc[0])
        constant = float(alone["weight"].iloc[0]) / shards
    own = rows[rows["slot"] >= 0]
    weights[own["slot"].to_numpy()] = own["weight"].to_numpy() / shards
    return weights, constant


def _calibration(bins: list) -> tuple[float, float]:
    """``(slope, shift)`` of the probability as a function of the logit, by Newton's method on
    counted logits, with the usual softened targets."""
    x = np.array([r["logit"] for r in bins], float)
    one = np.array([r["ones"] for r in bins], float)
    zero = np.array([r["n"] for r in bins], float) - one
    if not one.sum() or not zero.sum():
        return 0.0, float(np.log((one.sum() + 1) / (zero.sum() + 1)))
    hit, miss = (one.sum() + 1) / (one.sum() + 2), 1 / (zero.sum() + 2)
    target, count = one * hit + zero * miss, one + zero
    beta = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)])
    for _ in range(50):
        p = sigmoid(beta @ design)
        slope = design @ (count * p - target) + 1e-3 * np.array([beta[0] - 1, 0])
        bend = (design * (count * p * (1 - p))) @ design.T + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(bend, slope)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


class QualityModel:
    def __init__(self, weights: np.ndarray, constant: float, slope: float, shift: float):
        self.weights, self.constant, self.slope, self.shift = weights, constant, slope, shift

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * logits(texts, self.weights, self.constant) + self.shift)


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    sample = sampled_labels(labels, "quality", crc_remainder("doc_id", 5) != 0, MAX_LABELS)
    # At most MAX_LABELS rows of two numbers: small enough for every executor.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample), "doc_id"
    )
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5)) == 0
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int")
    order = F.xxhash64("doc_id").alias("place"), F.xxhash64("text").alias("content")
    fitted = (
        rows.where(~apart)
        .select(shard.alias("shard"), "label", *order, "text")
        .mapInArrow(per_piece(_feature_rows), _FEATURE_TYPE)
        .groupBy("shard")
        .applyInArrow(_fit, "shard int, slot int, weight double")
    )
    weights, constant = _mean_weights(fitted)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.round(np.clip(logits(encoded(batch.column("text")), weights, constant), -40, 40), 2)
        return pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(x)], names=["label", "logit"]
        )

    bins = (
        rows.where(apart)
        .select("label", "text")
        .mapInArrow(per_piece(scored), "label int, logit double")
        .groupBy("logit")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"))
        .orderBy("logit")
        .collect()  # at most 8001 logits
    )
    return QualityModel(weights, constant, *_calibration(bins))


_FEATURE_TYPE = (
    "shard int, label int, place bigint, content bigint, slots array<int>, shares array<float>"
)
_RULE_TYPE = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, probability double"
)


def repeated_words(hashes: np.ndarray) -> int:
    """How many words lie in a 3-word window that the text has twice or more."""
    windows = window_hashes(hashes, 3)
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    often = count[place] > 1 if len(windows) else np.zeros(0, bool)
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[i : i + len(often)] |= often
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def rule_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    words = split_words(texts)
    hashes = word_hashes(words)
    bounds = words.offset[:-1], words.offset[1:]
    letters = ~SPACES[words.data] & ((words.data & 0xC0) != 0x80)
    return {
        "n_words": words.counts(),
        "word_chars": _sums(letters, *bounds).astype(np.int64),
        "n_symbols": _sums(_IS_SYMBOL[words.data], *bounds).astype(np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": np.array(
            [
                repeated_words(hashes[lo:hi])
                for lo, hi in zip(words.first[:-1], words.first[1:], strict=True)
            ],
            np.int64,
        ),
    }


def quality_rules(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: the counts, the probability of a good text,
    ``base_failed`` and ``kept``."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = encoded(batch.column("text"))
        counts = rule_counts(texts)
        arrays = [batch.column("doc_id"), *map(pa.array, counts.values())]
        arrays.append(pa.array(model.probabilities(texts)))
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *counts, "probability"])

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_piece(judge), _RULE_TYPE
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= MIN_PROBABILITY)
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_rules(docs, fit_quality(docs, table(spark, folder, "labels")))
