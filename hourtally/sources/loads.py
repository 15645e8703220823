"""A record of each load, kept below the table that it went into.

A record names the directories that a load wrote, what its files' names begin with, and the
intervals whose dump files it has read. So whoever follows the table opens just these directories
and lists none; and which intervals were never loaded is a question to the records, not to the
data. Records are small JSON files in a folder that readers of the table pass over. A record is
written after its data: a load that was cut off leaves none, and is loaded again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType, TimestampType

from hourtally.sources.files import as_pattern, read_all, read_or_none

# When and in which file a row arrived, where the source tells: of rows with one key the first
# counts, however the files are cut into batches.
ARRIVED, FILE = "_arrived", "_file"

RECORD = (
    StructType()
    .add("load", StringType())
    .add("stored_at", TimestampType())
    .add("directories", ArrayType(StringType()))
    .add("intervals", ArrayType(LongType()))
)


def records_path(table: str) -> str:
    return f"{table.rstrip('/')}/_loads"


def new_load() -> str:
    """A name for a load that no other has; the names of its files begin with it."""
    return f"load-{uuid.uuid4().hex}"


def write_record(
    spark: SparkSession,
    table: str,
    load: str,
    directories: Iterable[str],
    intervals: Iterable[int] = (),
) -> None:
    row = (load, datetime.now(timezone.utc), sorted(directories), sorted(intervals))
    # One file: a reader sees all of a record or nothing.
    record = spark.createDataFrame([row], RECORD).coalesce(1)
    record.write.mode("append").option("ignoreNullFields", "false").json(records_path(table))


def read_records(spark: SparkSession, table: str) -> DataFrame:
    """The records of a table, ``load, stored_at, directories, intervals``; none before its first
    load."""
    found = read_or_none(lambda: spark.read.schema(RECORD).json(records_path(table)))
    return spark.createDataFrame([], RECORD) if found is None else found


def loaded_intervals(spark: SparkSession, table: str) -> DataFrame:
    """``interval, load`` for each interval that a load has read a dump file of."""
    return read_records(spark, table).select(F.explode("intervals").alias("interval"), "load")


def read_loaded(
    spark: SparkSession, table: str, records: Sequence, schema: StructType
) -> DataFrame:
    """The rows that the loads of ``records`` stored, as far as no later load replaced them, and
    when and in which file each arrived.

    Opens the directories that the records name, one pattern for each, and no other. A pattern that
    nothing matches any more is passed over.
    """
    # The load's own name keeps a pattern from matching files of others.
    patterns = sorted(f"{as_pattern(d)}/{r['load']}-*" for r in records for d in r["directories"] or [])
    found = read_all(spark.read.schema(schema), table, patterns)
    return spark.createDataFrame([], arriving(schema)) if found is None else with_arrival(found)


def with_arrival(files: DataFrame) -> DataFrame:
    """The rows of ``files``, with the time and the name of the file that each is in."""
    return files.select(
        "*",
        F.col("_metadata.file_modification_time").alias(ARRIVED),
        F.col("_metadata.file_path").alias(FILE),
    )


def arriving(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(ARRIVED, TimestampType()).add(FILE, StringType())
