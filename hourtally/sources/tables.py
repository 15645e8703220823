"""Reading the stored tables, and declaring them in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourtally.functions.timegrain import DAY, day_string
from hourtally.operators.filters import FIRST_VISIBLE_DATE, visible_dates
from hourtally.schemas import (
    MEDIACOUNTS_EXTERNAL,
    MEDIACOUNTS_SERVING,
    PAGECOUNTS_EXTERNAL,
    PAGECOUNTS_SERVING,
)
from hourtally.sources.files import as_pattern, directory, read_all, read_or_none
from hourtally.sources.loads import read_records
from hourtally.sources.sinks import BATCH


def read_dates(
    spark: SparkSession, path: str, schema: StructType, days: Iterable[str] | None
) -> DataFrame:
    """The ``date=`` directories of ``days`` (None: all of them); absent ones are empty.

    Naming the directories keeps the driver from listing the others. The schema is always
    given: discovery would turn the ``date`` text into a DATE.
    """
    reader = spark.read
    if days is not None:
        names = ",".join(sorted(days))
        if not names:
            return spark.createDataFrame([], schema)
        reader = reader.option("basePath", path)
        path = f"{path.rstrip('/')}/date={{{names}}}"
    found = read_or_none(lambda: reader.schema(schema).parquet(path).select(*schema.names))
    return spark.createDataFrame([], schema) if found is None else found


def read_directories(
    spark: SparkSession, path: str, schema: StructType, directories: Iterable[Row]
) -> DataFrame:
    """The rows of some directories, given as rows of their values; no other is listed, and absent
    ones are empty."""
    names = (directory(spark, list(d.asDict()), tuple(d)) for d in directories)
    reader = spark.read.schema(schema)
    found = read_all(reader, path, sorted({as_pattern(n) for n in names}))
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)


def _days(first: str, last: str) -> list[str]:
    start, stop = date.fromisoformat(first), date.fromisoformat(last)
    return [(start + timedelta(days=n)).isoformat() for n in range((stop - start).days + 1)]


def _read_visible(
    spark: SparkSession, path: str, schema: StructType, first: str, last: str | None
) -> DataFrame:
    last = last or day_string(datetime.now(timezone.utc))
    return visible_dates(read_dates(spark, path, schema, _days(first, last)), first, last)


def read_pagecounts(
    spark: SparkSession, path: str, first: str = FIRST_VISIBLE_DATE, last: str | None = None
) -> DataFrame:
    """Stored page counts of the visible date range; new directories need no repair step.

    Only the directories of ``first .. last`` are listed: name the days that are asked for.
    """
    return _read_visible(spark, path, PAGECOUNTS_EXTERNAL, first, last)


def read_mediacounts(
    spark: SparkSession, path: str, first: str = FIRST_VISIBLE_DATE, last: str | None = None
) -> DataFrame:
    """Stored media counts of the visible date range; new directories need no repair step."""
    return _read_visible(spark, path, MEDIACOUNTS_EXTERNAL, first, last)


def register_external(
    spark: SparkSession,
    pagecounts: str,
    mediacounts: str,
    prefix: str = "",
    first: str = FIRST_VISIBLE_DATE,
    last: str | None = None,
) -> None:
    """Views ``pagecounts`` and ``mediacounts`` over the files of the load jobs, for SQL.

    A quick look: the views hold the days that are there now, and a new call replaces them.
    ``declare_external`` makes tables that show later loads as well.
    """
    read_pagecounts(spark, pagecounts, first, last).createOrReplaceTempView(f"{prefix}pagecounts")
    read_mediacounts(spark, mediacounts, first, last).createOrReplaceTempView(f"{prefix}mediacounts")


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def qualified(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def declare_table(
    spark: SparkSession,
    database: str,
    name: str,
    columns: StructType,
    path: str,
    partitions: Sequence[str] = ("date", BATCH),
) -> None:
    """Declare the table stored at ``path``, if the name is not taken.

    Its directories are kept in the catalog, so a query lists only those of the days it asks
    for. What is stored already is looked up here once; ``add_partitions`` tells of what comes later.
    """
    if spark.catalog.tableExists(qualified(database, name)):
        return
    types = {"date": "string", BATCH: "bigint"}
    declared = [f"{f.name} {f.dataType.simpleString()}" for f in columns if f.name not in types]
    every = ", ".join([*declared, *(f"{p} {types[p]}" for p in partitions)])
    # No rows: makes the folder where it is absent, and leaves what is stored as it is.
    spark.createDataFrame([], every).write.partitionBy(*partitions).mode("append").parquet(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {qualified(database, name)} ({every}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION {quoted(path)}"
    )
    find_partitions(spark, database, name)


def find_partitions(spark: SparkSession, database: str, name: str) -> None:
    """Tell the catalog of directories that came without ``add_partitions``. Lists the whole table."""
    spark.sql(f"ALTER TABLE {qualified(database, name)} RECOVER PARTITIONS")


# Directories that one statement names.
_AT_ONCE = 1000


def add_partitions(
    spark: SparkSession, database: str, name: str, directories: Iterable[Row]
) -> None:
    """Tell the catalog of directories, given as rows of their values. Repeating it changes nothing."""
    _alter(spark, database, name, "ADD IF NOT EXISTS {}", " ", directories)


def drop_partitions(
    spark: SparkSession, database: str, name: str, directories: Iterable[Row]
) -> None:
    """Tell the catalog that some directories are gone."""
    _alter(spark, database, name, "DROP IF EXISTS {}", ", ", directories)


def _alter(
    spark: SparkSession, database: str, name: str, change: str, between: str, directories: Iterable[Row]
) -> None:
    def value(v: str | int | None) -> str:
        return "NULL" if v is None else quoted(v) if isinstance(v, str) else str(v)

    parts = [
        f"PARTITION ({', '.join(f'{k} = {value(v)}' for k, v in row.asDict().items())})"
        for row in directories
    ]
    for n in range(0, len(parts), _AT_ONCE):
        some = between.join(parts[n : n + _AT_ONCE])
        spark.sql(f"ALTER TABLE {qualified(database, name)} {change.format(some)}")


# --- external tables ----------------------------------------------------------

_EXTERNAL = {
    "pagecounts": (PAGECOUNTS_EXTERNAL, ("date", BATCH)),
    "mediacounts": (MEDIACOUNTS_EXTERNAL, ("date",)),
}
# Today in UTC, read anew by each query. Of the clock's functions only this is free of the session zone,
# which a view would take in part from the session that made it.
_TODAY = f"string(date_from_unix_date(int(unix_seconds(current_timestamp()) DIV {DAY})))"


def files_table(name: str) -> str:
    """The catalog table behind the external view ``name``."""
    return f"{name}_files"


def declare_external(
    spark: SparkSession,
    database: str,
    pagecounts: str,
    mediacounts: str,
    first: str = FIRST_VISIBLE_DATE,
    last: str | None = None,
) -> None:
    """External ``pagecounts`` and ``mediacounts`` over the files of the load jobs, in a database.

    Views of the visible date range, by default up to the day of the query, over catalog tables
    that know their directories. ``store_pagecounts`` and ``store_mediacounts`` tell the database
    that they are given of the directories they write, so a query shows a new load at once, and lists only the
    days it asks for. Repeating the call changes the date range.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(database)}")
    for name, path in (("pagecounts", pagecounts), ("mediacounts", mediacounts)):
        columns, partitions = _EXTERNAL[name]
        declare_table(spark, database, files_table(name), columns, path, partitions)
        end = quoted(last) if last else _TODAY
        spark.sql(
            f"CREATE OR REPLACE VIEW {qualified(database, name)} AS "
            f"SELECT {', '.join(columns.names)} FROM {qualified(database, files_table(name))} "
            f"WHERE date BETWEEN {quoted(first)} AND {end}"
        )


def find_loads(spark: SparkSession, database: str, name: str) -> int:
    """Tell the catalog of the loads that were stored without naming ``database``, by their records;
    returns how many directories are new to it.

    Reads the records and the catalog, and lists no data.
    """
    table = qualified(database, files_table(name))
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    path = location.first()["data_type"]
    names = _EXTERNAL[name][1]
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}
    stored = read_records(spark, path).select(F.explode("directories").alias("d")).distinct()
    fresh = [r["d"] for r in stored.toLocalIterator() if r["d"] not in known]
    values = [[_value(p) for p in d.split("/")] for d in fresh]
    add_partitions(spark, database, files_table(name), [Row(**dict(zip(names, v))) for v in values])
    return len(fresh)


def _value(part: str) -> str | None:
    value = unquote(part.split("=", 1)[1])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Create the database and both serving tables below ``location`` where absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(database)} LOCATION {quoted(location)}")
    declare_table(spark, database, "pagecounts", PAGECOUNTS_SERVING, f"{location}/pagecounts")
    declare_table(spark, database, "mediacounts", MEDIACOUNTS_SERVING, f"{location}/mediacounts")
