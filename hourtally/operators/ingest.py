"""Loading a batch of files into a serving table, safely repeatable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourtally import schemas
from hourtally.functions.timegrain import HOUR, epoch_to_day
from hourtally.operators.dedup import keep_greatest
from hourtally.operators.mapping import project_mapping
from hourtally.sources.compaction import current_directories, not_compacted
from hourtally.sources.files import Store
from hourtally.sources.index import Index
from hourtally.sources.loads import ARRIVED, FILE
from hourtally.sources.sinks import BATCH, write_replacing
from hourtally.sources.tables import add_partitions, read_dates, read_directories
from hourtally.sources.totals import Totals


@dataclass(frozen=True)
class ServingTable:
    """Columns, key and layout of a table, and how source columns map onto it.

    ``interval`` is the time column: an hourly epoch, or the ``date`` itself.
    """

    name: str
    source: StructType
    columns: StructType
    mapping: Mapping[str, str]
    interval: str
    unique_key: Sequence[str] = ()
    shard_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()
    lookup: Sequence[str] = ()
    indexes: Sequence[Index] = ()
    totals: Sequence[Totals] = ()

    @property
    def kept_beside(self) -> list[Index | Totals]:
        """What the ingest keeps up to date beside the table."""
        return [*self.all_indexes, *self.totals]

    @property
    def key_index(self) -> Index | None:
        """What tells stored keys apart that do not hold the interval, and so may meet any row."""
        if not self.unique_key or self.interval in self.unique_key:
            return None
        return Index(tuple(self.unique_key))

    @property
    def all_indexes(self) -> list[Index]:
        key = self.key_index
        return [*self.indexes, *([key] if key and key not in self.indexes else [])]

    @property
    def stored(self) -> StructType:
        """The columns plus the directories they are stored under."""
        fields = [f for f in self.columns.fields if f.name != "date"]
        return StructType(fields + schemas.schema_of(f"date string, {BATCH} bigint").fields)

    def day(self) -> Column:
        return F.col("date") if self.interval == "date" else epoch_to_day(F.col(self.interval))


PAGECOUNTS = ServingTable(
    name="pagecounts",
    source=schemas.PAGECOUNTS_NORMAL,
    columns=schemas.PAGECOUNTS_SERVING,
    mapping=schemas.PAGECOUNTS_MAPPING,
    interval="interval_start_unixtime",
    unique_key=("interval_start_unixtime", "project_name", "article_name"),
    shard_by=("project_name",),
    sort_by=("interval_start_unixtime", "project_name", "article_name"),
    lookup=("article_name",),
)

# The media table declares no unique key, so there is nothing to skip: a plain append.
MEDIACOUNTS = ServingTable(
    name="mediacounts",
    source=schemas.MEDIACOUNTS_NORMAL,
    columns=schemas.MEDIACOUNTS_SERVING,
    mapping=schemas.MEDIACOUNTS_MAPPING,
    interval="date",
    sort_by=("filename",),
)


def keyed(table: ServingTable, *key: str) -> ServingTable:
    """The same table with first-write-wins on ``key``."""
    return replace(table, unique_key=key)


def indexed(table: ServingTable, *columns: str, buckets: int = 64) -> ServingTable:
    """The same table with an index on ``columns``, kept by the ingest."""
    return replace(table, indexes=(*table.indexes, Index(columns, buckets)))


def with_totals(table: ServingTable, *by: str, measures: Sequence[str]) -> ServingTable:
    """The same table with partial sums, kept by the ingest."""
    return replace(table, totals=(*table.totals, Totals(by, tuple(measures))))


def first_write_wins(
    batch: DataFrame, existing: DataFrame, key: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Rows of ``batch`` to insert: those whose key ``existing`` does not hold yet.

    Equal keys inside the batch keep the greatest measures, compared left to right. As in a unique index, a NULL in
    the key never collides: such rows are all kept and stay out of the shuffle, which they
    could otherwise overload. Both sides of the anti-join are unique per key, and it reuses
    the partitioning of the deduplication.
    """
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    fresh = keep_greatest(batch.where(complete), key, measures).join(
        existing.where(complete).select(*key), on=list(key), how="left_anti"
    )
    return fresh.select(*batch.columns).unionByName(batch.where(~complete))


def _within(interval: Column, spans: list[tuple]) -> Column:
    """Predicate for the intervals of some days, as ``(first, last)`` per day.

    Days that follow on without a gap become one range. The ranges are joined as a balanced
    tree, so any number of them can be analysed.
    """
    ranges: list[tuple] = []
    for first, last in sorted(spans):
        if ranges and isinstance(first, int) and first <= ranges[-1][1] + HOUR:
            ranges[-1] = (ranges[-1][0], last)
        else:
            ranges.append((first, last))
    terms = [interval.between(*r) for r in ranges]
    while len(terms) > 1:
        pairs = [reduce(lambda a, b: a | b, terms[i : i + 2]) for i in range(0, len(terms), 2)]
        terms = pairs
    return terms[0]


def _earlier_rows(
    spark: SparkSession, table: ServingTable, target: str, rows: DataFrame, batch_id: int
) -> DataFrame:
    """What earlier batches stored that a key of this one could meet.

    A key that holds the interval can only meet rows of the batch's intervals. Only the days of the batch are listed, and the interval predicate lets the scan skip row
    groups of other hours, so an hourly load does not re-read its day, nor a late hour another
    one. Rows of this batch and of later ones are left out: a replay sees what the first
    attempt saw. A key without the interval can meet any row, so it is looked up in the index of
    stored keys: only the buckets of the batch's keys are read, not the table.
    """
    if index := table.key_index:
        return index.of_rows(spark, target, table.stored, rows).where(F.col(BATCH) < batch_id)
    interval = F.col(table.interval)
    spans = (
        rows.where(interval.isNotNull())
        .groupBy(table.day().alias("day"))
        .agg(F.min(interval).alias("lo"), F.max(interval).alias("hi"))
    )
    found = spans.collect()  # one row for each calendar day
    if not found:
        return spark.createDataFrame([], table.stored)
    stored = read_dates(spark, target, table.stored, [r["day"] for r in found])
    wanted = _within(interval, [(r["lo"], r["hi"]) for r in found])
    return stored.where(wanted & (F.col(BATCH) < batch_id))


def rows_to_insert(
    spark: SparkSession, source: DataFrame, batch_id: int, table: ServingTable, target: str
) -> DataFrame:
    """Mapping and key check of one batch, without the write."""
    rows = project_mapping(source, table.columns, table.mapping)
    if not table.unique_key:
        return rows
    measures = [c for c in rows.columns if c not in table.unique_key]
    existing = _earlier_rows(spark, table, target, rows, batch_id)
    if ARRIVED in source.columns:
        # Compared before the measures: the earlier file is the greater. Files of one
        # millisecond go by a hash of their name.
        order = {ARRIVED: -F.unix_micros(ARRIVED), FILE: F.xxhash64(FILE)}
        rows = project_mapping(source, table.columns, table.mapping, order)
        measures = [*order, *measures]
    return first_write_wins(rows, existing, table.unique_key, measures).drop(ARRIVED, FILE)


def ingest_batch(
    source: DataFrame,
    batch_id: int,
    table: ServingTable,
    target: str,
    database: str | None = None,
) -> list[Row]:
    """Insert one batch, and return its directories. Repeating a batch with the same rows leaves the
    same table.

    Each batch owns the ``_batch_id`` directory below its days and replaces only that. Ids
    count up, and a target has one writer. Days that a compaction has closed for this batch take
    no rows: they have them already. The table's indexes and totals learn of the batch after its rows. The catalog table in ``database``, if one is named,
    is told of the new directories.
    """
    spark = source.sparkSession
    build_beside(spark, table, target)
    rows = rows_to_insert(spark, source, batch_id, table, target)
    stored = write_replacing(
        not_compacted(rows.withColumn("date", table.day()), target, batch_id)
        .withColumn(BATCH, F.lit(batch_id).cast("bigint")),
        target,
        shard_by=table.shard_by,
        sort_by=table.sort_by,
        lookup=table.lookup,
    )
    if table.kept_beside:
        new = read_directories(spark, target, table.stored, stored)
        for kept in table.kept_beside:
            kept.add(new, target)
    if database is not None:
        add_partitions(spark, database, table.name, stored)
    return stored


def build_beside(spark: SparkSession, table: ServingTable, target: str) -> None:
    """Indexes and totals of what ``target`` holds, where they are not there yet. Reads all of it
    once."""
    for kept in table.kept_beside:
        if not kept.exists(spark, target):
            kept.add(read_dates(spark, target, table.stored, None), target)
            Store(spark, target).make_folder(kept.path(target))


def read_indexed(
    spark: SparkSession, table: ServingTable, target: str, columns: Sequence[str], *values: str | int
) -> DataFrame:
    """The rows with these values in ``columns``, which have an index. Only the directories that the
    index names are opened."""
    (index,) = (i for i in table.all_indexes if i.columns == tuple(columns))
    found = index.directories(spark, target, table.stored, *values)
    rows = read_directories(spark, target, table.stored, current_directories(spark, target, found))
    for column, value in zip(columns, values, strict=True):
        rows = rows.where(F.col(column) == F.lit(value))
    return rows
