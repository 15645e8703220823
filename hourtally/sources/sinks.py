"""Partitioned parquet writes and their physical layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from hourtally.session import evenly_written
from hourtally.sources.files import directory
from hourtally.sources.loads import new_load, write_record

BATCH = "_batch_id"

# Files a directory is spread over while it is small enough not to be cut by size. An hour of
# a 100 TB table is about 1 GB, so eight are of the usual 128 MB.
SHARDS = 8


def lay_out(
    df: DataFrame,
    partitions: Sequence[str],
    shard_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Gather rows by directory and shard, and sort them inside each task.

    REBALANCE rather than ``repartition``: AQE merges small shards and cuts a hot one (one
    project or one day with a third of the rows) into several tasks of the advisory size. The
    shard key is hashed to ``SHARDS`` values, not used itself: with thousands of projects
    every task would hold some of every directory and write a small file into each.

    The sort starts with the directory columns, as the writer would otherwise sort again, and
    leaves row groups with narrow key ranges for the scan to skip.
    """
    gather = list(partitions)
    if shard_by:
        df = df.withColumn("_shard", F.pmod(F.xxhash64(*shard_by), F.lit(SHARDS)))
        gather.append("_shard")
    rest = [c for c in sort_by if c not in partitions]
    return df.hint("rebalance", *gather).sortWithinPartitions(*partitions, *rest).drop("_shard")


def with_row_ids(df: DataFrame) -> DataFrame:
    """A random UUID per row. Added last, so that no shuffle depends on it or carries it."""
    return df.select(F.expr("uuid()").alias("id"), "*")


def _observed(df: DataFrame, partitions: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df``, and what tells its directories once it is written: one row for each, gathered as the
    rows pass by."""
    told = Observation()
    return df.observe(told, F.collect_set(F.struct(*partitions)).alias("directories")), told


def _store(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    lookup: Sequence[str],
    load: str | None,
    mode: str,
) -> None:
    writer = df.write.mode(mode).partitionBy(*partitions).option("compression", "snappy")
    if load:
        writer = writer.option("mapreduce.output.basename", load)
    for column in lookup:
        # Sized by the values of each row group: a small file carries a small filter, and one of
        # millions of titles a filter that still tells them apart.
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .option("parquet.bloom.filter.max.bytes", str(8 << 20))
        )
    with evenly_written(df.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _directories(told: Observation) -> list[Row]:
    try:
        return told.get["directories"]
    except Py4JJavaError as error:
        # A plan that turns out to be empty is dropped, and what was to be observed with it.
        if error.java_exception.getClass().getSimpleName() != "AssertionError":
            raise
        return []


def _record(
    df: DataFrame, path: str, load: str, partitions: Sequence[str], rows: list[Row], intervals: Iterable[int]
) -> None:
    spark = df.sparkSession
    names = [directory(spark, list(partitions), tuple(r)) for r in rows]
    write_record(spark, path, load, names, intervals)


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("date",),
    shard_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    lookup: Sequence[str] = (),
) -> list[Row]:
    """Append parquet under ``date=.../``, with a load record. Running it twice stores the rows
    twice. Returns the directories written to, as rows of their values.

    ``lookup`` columns get a bloom filter per row group, for equality filters.
    """
    load = new_load()
    seen, told = _observed(df, partitions)
    _store(lay_out(seen, partitions, shard_by, sort_by), path, partitions, lookup, load, "append")
    stored = _directories(told)
    _record(df, path, load, partitions, stored, ())
    return stored


def write_replacing(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("date", BATCH),
    shard_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    lookup: Sequence[str] = (),
    row_ids: bool = False,
    recorded: bool = False,
    intervals: Iterable[int] = (),
) -> list[Row]:
    """Write the directories ``df`` has rows for, replacing what they held, and return them.

    A directory must belong to one load only. An hour is part of a day, so hourly loads need
    a directory of their own below the day: replacing the bare ``date`` would drop the other
    23 hours. ``recorded`` leaves a load record, which also names the ``intervals`` loaded.
    """
    seen, told = _observed(df, partitions)
    rows = lay_out(seen, partitions, shard_by, sort_by)
    rows = with_row_ids(rows) if row_ids else rows
    load = new_load() if recorded else None
    _store(rows, path, partitions, lookup, load, "overwrite")
    stored = _directories(told)
    if recorded:
        _record(df, path, load, partitions, stored, intervals)
    return stored


def by_hour_loaded(df: DataFrame) -> DataFrame:
    """Name each row's load after its hour, so a re-run of an hour replaces just that hour."""
    return df.withColumn(BATCH, F.col("interval_start_unixtime"))
