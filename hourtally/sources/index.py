"""Where the values of some columns are stored: an index beside a serving table.

For each batch the index holds the distinct values that the batch has stored, with their days, in
directories by a hash of the value and by batch. So whether a value is stored, and in which
directories of the table, costs the few buckets that the question hashes to, however large the table
is. Readers of the table pass over its folder.

A batch's part of the index is written after its rows and read back from them: replaying a batch
writes the same part again, and a batch is in the index once it is complete.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from hourtally.sources.files import Store, read_all
from hourtally.sources.sinks import BATCH, write_replacing

BUCKET = "_bucket"


@dataclass(frozen=True)
class Index:
    """An index on ``columns``, spread over so many ``buckets``.

    A batch writes a file for each bucket that it has values of, so buckets should be few enough
    for a batch to fill them, and many enough for a question to read little.
    """

    columns: tuple[str, ...]
    buckets: int = 64

    def path(self, target: str) -> str:
        return f"{target.rstrip('/')}/_index/{'-'.join(self.columns)}-{self.buckets}"

    def exists(self, spark: SparkSession, target: str) -> bool:
        return Store(spark, target).exists(self.path(target))

    def schema(self, stored: StructType) -> StructType:
        own = StructType([stored[c] for c in self.columns])
        return own.add("date", StringType()).add(BUCKET, LongType()).add(BATCH, LongType())

    def bucket(self, *values: Column) -> Column:
        """The bucket of some values, by default of a row's own."""
        return F.pmod(F.xxhash64(*(values or self.columns)), F.lit(self.buckets))

    def add(self, rows: DataFrame, target: str) -> None:
        """Enter what some batches have stored: ``rows`` of the table, whole batches.

        Rows with a null among the columns are found by no question and are left out.
        """
        known = rows.select(*self.columns, "date", BATCH).dropna(subset=list(self.columns))
        spread = [c for c in self.columns if c != "date"]
        write_replacing(
            known.select(*spread, "date", BATCH, self.bucket().alias(BUCKET)).distinct(),
            self.path(target),
            partitions=(BUCKET, BATCH),
            sort_by=(*spread, "date"),
            lookup=spread[:1],
        )

    def read(
        self, spark: SparkSession, target: str, stored: StructType, buckets: Iterable[int]
    ) -> DataFrame:
        """The entries of some buckets; the others are not listed."""
        schema = self.schema(stored)
        names = [f"{BUCKET}={b}" for b in sorted(set(buckets))]
        found = read_all(spark.read.schema(schema), self.path(target), names)
        return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)

    def of_rows(self, spark: SparkSession, target: str, stored: StructType, rows: DataFrame) -> DataFrame:
        """The entries that share a bucket with any of ``rows``; at most ``buckets`` numbers come to
        the driver."""
        wanted = rows.dropna(subset=list(self.columns)).select(self.bucket().alias(BUCKET)).distinct()
        return self.read(spark, target, stored, (r[BUCKET] for r in wanted.collect()))

    def directories(
        self, spark: SparkSession, target: str, stored: StructType, *values: str | int
    ) -> list[Row]:
        """``date, _batch_id`` of the directories that hold a row with these values. One for each
        comes to the driver."""
        typed = (F.lit(v).cast(stored[c].dataType) for c, v in zip(self.columns, values, strict=True))
        asked = spark.range(1).select(self.bucket(*typed).alias(BUCKET))
        entries = self.read(spark, target, stored, [asked.first()[BUCKET]])
        for column, value in zip(self.columns, values, strict=True):
            entries = entries.where(F.col(column) == F.lit(value))
        return entries.select("date", BATCH).distinct().collect()
