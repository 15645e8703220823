"""Labelled rows for training, and models that Spark fits on bounded samples of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_remainder(column: str, divisor: int) -> Column:
    """crc32 of an id's digits, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def sampled_labels(labels: DataFrame, kind: str, learn: Column, limit: int) -> DataFrame:
    """``doc_id, label`` of at most ``limit`` labelled documents that ``learn`` admits.

    The sample is the same on every run: the least hashes of the ids. Rows without an id or a
    label teach nothing; of contradicting labels of one document the greater counts.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(kind).isNotNull()).where(learn)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col(kind).cast("int")).alias("label")
    )
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step function of ``x`` that is nearest to ``y``."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first x, last x
    for i in order:
        blocks.append([y[i], weight[i], x[i], x[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean, w, _, last = blocks.pop()
            before = blocks[-1]
            before[0] = (before[0] * before[1] + mean * w) / (before[1] + w)
            before[1] += w
            before[3] = last
    knots = np.array([[b[2], b[0], b[3], b[0]] for b in blocks], float).reshape(-1, 2)
    return knots[:, 0], knots[:, 1]
