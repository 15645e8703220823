"""Deterministic removal of rows with equal keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtally.schemas import MEDIA_MEASURES, MEDIACOUNTS_KEY, PAGECOUNTS_KEY


def keep_greatest(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row for each key: the one whose measures are greatest, compared left to right.

    NULL keys are equal to each other; a NULL measure is the smallest value. The aggregate
    runs partially before its shuffle, so copies of a hot key collapse where they are read.
    A single measure is a plain hash aggregate. Several are compared as one struct, which
    Spark aggregates by sorting on the keys; a hash of them goes first, so the sort compares
    numbers instead of days and file names that begin alike.
    """
    if not measures:
        return df.select(*keys).distinct()
    if len(measures) == 1:
        return df.groupBy(*keys).agg(F.max(measures[0]).alias(measures[0]))
    hashed = F.xxhash64(*keys).alias("_hash")
    best = df.groupBy(hashed, *keys).agg(F.max(F.struct(*measures)).alias("_best"))
    return best.select(*keys, *(F.col("_best")[m].alias(m) for m in measures))


def dedup_pagecounts(df: DataFrame) -> DataFrame:
    return keep_greatest(df, PAGECOUNTS_KEY, ["count"])


def dedup_mediacounts(df: DataFrame) -> DataFrame:
    return keep_greatest(df, MEDIACOUNTS_KEY, MEDIA_MEASURES)
