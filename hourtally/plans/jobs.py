"""The load jobs: raw dump files to normalised, date-partitioned parquet."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.functions.timegrain import (
    DAY,
    HOUR,
    epoch_seconds,
    epoch_to_day,
    lagged_day,
    lagged_hour,
)
from hourtally.operators.dedup import dedup_mediacounts, dedup_pagecounts
from hourtally.schemas import MEDIACOUNTS_NORMAL, PAGECOUNTS_NORMAL
from hourtally.sources.loads import loaded_intervals
from hourtally.sources.paths import (
    DAILY_STAGED,
    HOURLY_STAGED,
    FileLayout,
    daily_paths,
    hourly_paths,
    interval_paths,
)
from hourtally.sources.raw import (
    read_mediacounts_raw,
    read_pagecounts_raw,
    read_present,
)
from hourtally.sources.sinks import by_hour_loaded, with_row_ids, write_replacing
from hourtally.sources.tables import add_partitions, files_table

Run = str | datetime | None


def normalize_pagecounts(raw: DataFrame, interval_start: Column, row_ids: bool = False) -> DataFrame:
    """Raw hourly rows to ``[id,] project, article, hour, count, date``, one per key.

    ``date`` follows from the hour, so it is computed after the deduplication instead of
    being shuffled along.
    """
    hourly = raw.withColumn("interval_start_unixtime", interval_start.cast("long"))
    hourly = hourly.select("project_name", "article_name", "interval_start_unixtime", "count")
    slim = dedup_pagecounts(hourly).withColumn(
        "date", epoch_to_day(F.col("interval_start_unixtime"))
    )
    slim = slim.select(*PAGECOUNTS_NORMAL.names)
    return with_row_ids(slim) if row_ids else slim


def normalize_mediacounts(raw: DataFrame, day: Column, row_ids: bool = False) -> DataFrame:
    """Raw daily rows to ``[id,] filename, _date, counters, date``, one per key.

    ``_date`` is the data column the table loader reads, ``date`` the directory; both hold
    the day.
    """
    daily = dedup_mediacounts(raw.withColumn("date", day))
    slim = daily.withColumn("_date", F.col("date")).select(*MEDIACOUNTS_NORMAL.names)
    return with_row_ids(slim) if row_ids else slim


def load_pagecounts(
    spark: SparkSession,
    run_times: Iterable[Run],
    source: str,
    lag_days: int = 1,
    layout: FileLayout = HOURLY_STAGED,
) -> DataFrame:
    """Normalised page counts of the hours the run times cover.

    All hours are one job: gzip cannot be split, so parallelism comes from reading many
    files. The hour is taken from the file name. An hour without a file is logged and costs
    only itself.
    """
    paths = hourly_paths(source, run_times, lag_days, layout)
    raw, _ = read_present(read_pagecounts_raw, spark, source, paths)
    return normalize_pagecounts(raw, layout.epoch(layout.name_of_row()))


def load_mediacounts(
    spark: SparkSession,
    run_times: Iterable[Run],
    source: str,
    lag_days: int = 2,
    layout: FileLayout = DAILY_STAGED,
) -> DataFrame:
    """Normalised media counts of the days the run times cover; as ``load_pagecounts``."""
    paths = daily_paths(source, run_times, lag_days, layout)
    raw, _ = read_present(read_mediacounts_raw, spark, source, paths)
    return normalize_mediacounts(raw, epoch_to_day(layout.epoch(layout.name_of_row())))


def store_pagecounts(
    df: DataFrame,
    path: str,
    row_ids: bool = False,
    database: str | None = None,
    intervals: Iterable[int] = (),
) -> None:
    """Write normalised page counts; a re-run of an hour replaces that hour alone.

    Leaves a load record, with the ``intervals`` that were loaded where they are named. The external
    table in ``database`` (see ``declare_external``) shows the load at once.
    """
    stored = write_replacing(
        by_hour_loaded(df),
        path,
        shard_by=("project_name",),
        sort_by=("interval_start_unixtime", "project_name", "article_name"),
        lookup=("article_name",),
        row_ids=row_ids,
        recorded=True,
        intervals=intervals,
    )
    if database:
        add_partitions(df.sparkSession, database, files_table("pagecounts"), stored)


def store_mediacounts(
    df: DataFrame,
    path: str,
    row_ids: bool = False,
    database: str | None = None,
    intervals: Iterable[int] = (),
) -> None:
    """Write normalised media counts; a re-run of a day replaces that day. Records and ``database``
    as for page counts."""
    stored = write_replacing(
        df,
        path,
        partitions=("date",),
        sort_by=("filename",),
        row_ids=row_ids,
        recorded=True,
        intervals=intervals,
    )
    if database:
        add_partitions(df.sparkSession, database, files_table("mediacounts"), stored)


# --- what was not loaded yet ------------------------------------------------------


def missing_intervals(spark: SparkSession, target: str, first: int, last: int, step: int) -> list[int]:
    """The intervals ``first, first + step, .. last`` that no load of ``target`` has read a dump of.

    Asks the load records alone. One number for each missing interval comes to the driver.
    """
    expected = spark.range(first, last + 1, step).withColumnRenamed("id", "interval")
    missing = expected.join(loaded_intervals(spark, target), "interval", "left_anti")
    return [r["interval"] for r in missing.orderBy("interval").collect()]


def load_missing_pagecounts(
    spark: SparkSession,
    first_run: Run,
    last_run: Run,
    source: str,
    target: str,
    lag_days: int = 1,
    layout: FileLayout = HOURLY_STAGED,
    row_ids: bool = False,
    database: str | None = None,
    at_once: int = 31 * 24,
) -> list[int]:
    """Load and store the hours of these run times that ``target`` has not, as far as their dumps
    are there; returns the hours loaded.

    A dump that is absent now stays missing in the records, so the next call looks for it again; one
    that is there counts as loaded, even if it is empty. ``at_once`` hours are one load: a long
    backfill that is cut off goes on where it stopped.
    """
    span = tuple(epoch_seconds(lagged_hour(t, lag_days)) for t in (first_run, last_run))
    store = partial(store_pagecounts, path=target, row_ids=row_ids, database=database)

    def normalize(raw: DataFrame) -> DataFrame:
        return normalize_pagecounts(raw, layout.epoch(layout.name_of_row()))

    todo = missing_intervals(spark, target, *span, HOUR)
    return _load(spark, todo, source, layout, read_pagecounts_raw, normalize, store, at_once)


def load_missing_mediacounts(
    spark: SparkSession,
    first_run: Run,
    last_run: Run,
    source: str,
    target: str,
    lag_days: int = 2,
    layout: FileLayout = DAILY_STAGED,
    row_ids: bool = False,
    database: str | None = None,
    at_once: int = 31,
) -> list[int]:
    """Load and store the missing days of these run times; as ``load_missing_pagecounts``."""
    span = tuple(epoch_seconds(lagged_day(t, lag_days)) for t in (first_run, last_run))
    store = partial(store_mediacounts, path=target, row_ids=row_ids, database=database)

    def normalize(raw: DataFrame) -> DataFrame:
        return normalize_mediacounts(raw, epoch_to_day(layout.epoch(layout.name_of_row())))

    todo = missing_intervals(spark, target, *span, DAY)
    return _load(spark, todo, source, layout, read_mediacounts_raw, normalize, store, at_once)


def _load(
    spark: SparkSession,
    intervals: list[int],
    source: str,
    layout: FileLayout,
    read: Callable[[SparkSession, str], DataFrame],
    normalize: Callable[[DataFrame], DataFrame],
    store: Callable[..., None],
    at_once: int,
) -> list[int]:
    loaded: list[int] = []
    for n in range(0, len(intervals), at_once):
        paths = interval_paths(source, intervals[n : n + at_once], layout)
        try:
            raw, present = read_present(read, spark, source, list(paths))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = [paths[p] for p in present]
        store(normalize(raw), intervals=found)
        loaded += found
    return loaded
