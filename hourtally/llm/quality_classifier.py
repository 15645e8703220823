"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

One pass over the texts gives each document a short row of statistics. The labelled rows of the
learning part give their mean and spread; ``FEATURES`` cosines with random directions then
approximate a Gaussian kernel over the standardised statistics. Every task adds up its part of the
normal equations, Spark sums the parts by entry, and the ridge weights are solved for once. A fifth
of the learning rows is kept apart: their scores, counted in steps of 1 / ``STEPS``, give the
isotonic curve from ridge score to probability. All labelled rows take part, none is sampled.

Defined results: a null or empty text has statistics of zero and is scored like any other. Without
labels every text scores one half. Repeated rows are each scored, and each learnt from if their id
has a label; of contradicting labels of one id 1 counts. Rows without an id are scored, not learnt
from. Equal scores get equal probabilities. A very long text is one piece of work. An empty table
gives no rows. Scores read id and text alone; ``drop_low_quality`` keeps all columns, whatever
their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.features import crc_remainder, isotonic
from hourtally.llm.tables import materialised, table
from hourtally.llm.text import encoded, per_piece, split_words, window_hashes, word_hashes

FEATURES, WIDTH, RIDGE = 192, 4.0, 1e-3
STEPS = 1000
THRESHOLD = 0.3

# Classes of bytes whose shares are statistics. The first is everything else.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"|", b"#*$%&<>", b".,;:?", b"\n", b" \t")
_CLASS = np.zeros(256, np.int64)
for _number, _members in enumerate(_CLASSES, 1):
    _CLASS[list(_members)] = _number
_CLASS[128:] = len(_CLASSES) + 1

N_STATISTICS = len(_CLASSES) + 1 + 9


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of numbers for each text, taken over all of it."""
    words = split_words(texts)
    hashes = word_hashes(words)
    triples = window_hashes(hashes, 3)
    lengths = (words.end - words.start).astype(float)
    out = np.zeros((len(texts), N_STATISTICS))
    for i in range(len(texts)):
        lo, hi = int(words.first[i]), int(words.first[i + 1])
        begin, size, n = int(words.offset[i]), len(texts[i]), hi - lo
        if not size:
            continue
        row = out[i]
        shares = np.bincount(_CLASS[words.data[begin : begin + size]], minlength=len(_CLASSES) + 2)
        row[: len(_CLASSES) + 1] = shares[1:] / size
        at = len(_CLASSES) + 1
        row[at] = math.log1p(size)
        if n:
            own = np.unique(hashes[lo:hi], return_counts=True)[1]
            row[at + 1 : at + 7] = (
                math.log1p(n),
                lengths[lo:hi].mean(),
                lengths[lo:hi].std(),
                len(own) / n,
                own.max() / n,
                math.log1p(lengths[lo:hi].max()),
            )
        if n > 2:
            row[at + 7] = len(np.unique(triples[lo : hi - 2])) / (n - 2)
            row[at + 8] = 1.0
    return out


def _statistic_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = statistics(encoded(batch.column("text")))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(list(rows), pa.list_(pa.float64()))],
        names=["doc_id", "statistics"],
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


class FourierRidge:
    """Ridge regression over random Fourier features, and its calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(4)
        self.mean, self.spread = mean, spread
        self.directions = rng.normal(size=(N_STATISTICS, FEATURES)) / WIDTH
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.knots = np.array([0.0]), np.array([0.5])

    def features(self, rows: np.ndarray) -> np.ndarray:
        standard = np.clip((rows - self.mean) / self.spread, -8, 8)
        waves = np.cos(standard @ self.directions + self.phases) * math.sqrt(2 / FEATURES)
        return np.column_stack([waves, np.ones(len(rows))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.features(rows) @ self.weights, -0.5, 1.5)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), *self.knots)


def fit_quality_scores(rows: DataFrame) -> FourierRidge:
    """From ``doc_id, statistics, label``."""
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5)) == 0
    learn = rows.where(~apart)
    moments = (
        learn.select(F.posexplode("statistics").alias("i", "x"))
        .groupBy("i")
        .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"))
        .collect()  # one row for each statistic
    )
    mean, spread = np.zeros(N_STATISTICS), np.ones(N_STATISTICS)
    for r in moments:
        mean[r["i"]], spread[r["i"]] = r["mean"], max(r["spread"], 1e-3)
    model = FourierRidge(mean, spread)
    if not moments:
        return model
    n = FEATURES + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((n, n)), np.zeros(n)
        for batch in batches:
            x = model.features(_matrix(batch.column("statistics")))
            left += x.T @ x
            right += x.T @ batch.column("label").to_numpy(zero_copy_only=False)
        if not left.any():
            return
        i, j = np.triu_indices(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([i, np.arange(n)]), pa.int32()),
                pa.array(np.concatenate([j, np.full(n, n)]), pa.int32()),
                pa.array(np.concatenate([left[i, j], right])),
            ],
            names=["i", "j", "x"],
        )

    sums = (
        learn.select("statistics", "label")
        .mapInArrow(part, "i int, j int, x double")
        .groupBy("i", "j")
        .agg(F.sum("x").alias("x"))
        .toPandas()  # (FEATURES + 1)^2 / 2 entries
    )
    system = np.zeros((n, n + 1))
    system[sums["i"], sums["j"]] = sums["x"]
    left, right = system[:, :n], system[:, n]
    left = left + np.triu(left, 1).T
    model.weights = np.linalg.solve(left + RIDGE * max(left[-1, -1], 1) * np.eye(n), right)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = np.round(model.raw(_matrix(batch.column("statistics"))) * STEPS) / STEPS
            yield pa.RecordBatch.from_arrays(
                [pa.array(steps), batch.column("label")], names=["x", "label"]
            )

    counted = (
        rows.where(apart)
        .select("statistics", "label")
        .mapInArrow(raw, "x double, label int")
        .groupBy("x")
        .agg(F.avg("label").alias("y"), F.count(F.lit(1)).alias("n"))
        .toPandas()  # at most 2 * STEPS + 1 rows
    )
    if len(counted):
        model.knots = isotonic(*(counted[c].to_numpy(float) for c in ("x", "y", "n")))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``docs(doc_id, text)``, learnt from ``labels``
    of documents outside the held-out fifth."""
    found = materialised(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            per_piece(_statistic_rows), "doc_id bigint, statistics array<double>"
        ),
        "statistics",
    )
    known = (
        labels.where("doc_id is not null and quality is not null")
        .where(crc_remainder("doc_id", 5) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality").cast("int")).alias("label"))
    )
    model = fit_quality_scores(found.join(known, "doc_id"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"]
            )

    return found.mapInArrow(judge, "doc_id bigint, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects, all columns kept. Documents
    without id stay."""
    rejected = quality_scores(docs, labels).where("predicted = 0").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti")


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_scores(docs, labels).select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )
