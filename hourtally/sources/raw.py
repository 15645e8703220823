"""Scans of the raw dump files."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourtally.schemas import MEDIACOUNTS_RAW, PAGECOUNTS_RAW, TEXT_LIMITS

_log = logging.getLogger("hourtally")


def read_pagecounts_raw(
    spark: SparkSession, paths: str | Sequence[str], folders: str = ""
) -> DataFrame:
    """Space-delimited hourly files; gzip goes by the file suffix.

    ``folders`` declares columns (as DDL) held in ``name=value`` directories.
    """
    return _read_delimited(spark, paths, " ", PAGECOUNTS_RAW, folders)


def read_mediacounts_raw(
    spark: SparkSession, paths: str | Sequence[str], folders: str = ""
) -> DataFrame:
    """Tab-delimited daily files; bzip2 goes by the file suffix and is splittable."""
    return _read_delimited(spark, paths, "\t", MEDIACOUNTS_RAW, folders)


def _read_delimited(
    spark: SparkSession, paths: str | Sequence[str], sep: str, schema: StructType, folders: str
) -> DataFrame:
    if folders:
        schema = StructType(schema.fields + StructType.fromDDL(folders).fields)
    paths = [paths] if isinstance(paths, str) else list(paths)
    # quote="": a title may hold quote characters, and they are part of the title. With the
    # default a quoted title loses them and an unclosed one swallows the rest of its line.
    reader = spark.read.schema(schema).options(header=False, sep=sep, quote="", mode="PERMISSIVE")
    return reader.csv(paths)


def read_present(
    read: Callable[[SparkSession, str], DataFrame],
    spark: SparkSession,
    root: str,
    paths: Sequence[str],
) -> tuple[DataFrame, list[str]]:
    """``read`` over those of ``paths`` (all below ``root``) that exist, and which these are; the
    absent ones are logged by name. It is an error if there is none at all.

    As alternatives of one pattern, names that nothing matches are passed over. A path may be a
    folder of files.
    """
    root = root.rstrip("/")
    names = [p.removeprefix(f"{root}/") for p in paths]
    raw = read(spark, f"{root}/{{{','.join(names)}}}")
    found = {name for path in raw.inputFiles() for name in path.rsplit("/", 2)[1:]}
    present = [p for p in paths if p.rsplit("/", 1)[-1] in found]
    absent = sorted(set(paths) - set(present))
    if absent:
        _log.warning("%d of %d files are absent: %s", len(absent), len(paths), ", ".join(absent))
    return raw, present


def rejected_rows(raw: DataFrame, measure: str = "count") -> DataFrame:
    """Rows the permissive scan kept although their measure is missing or unreadable."""
    return raw.where(F.col(measure).isNull())


def over_limit_rows(df: DataFrame) -> DataFrame:
    """Rows with a text longer than the serving tables declare; they are kept in full."""
    condition = F.lit(False)
    for c, n in TEXT_LIMITS.items():
        if c in df.columns:
            condition = condition | (F.length(c) > n)
    return df.where(condition)
