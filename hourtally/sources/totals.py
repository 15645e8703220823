"""Partial sums kept beside a serving table, so that reports over long ranges need not open it.

For each batch the totals hold the number of rows and the sums of the measures by some columns, in
directories by day and batch like the table's own. A report adds them up as it would the rows: a batch
that is replayed replaces its part, so what is added up is each batch once. Readers of the table
pass over the folder.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from hourtally.sources.files import Store
from hourtally.sources.sinks import BATCH, write_replacing
from hourtally.sources.tables import read_dates

# The number of rows that a partial sum stands for.
ROWS = "pairs"


@dataclass(frozen=True)
class Totals:
    """Sums of ``measures`` for each value of the columns ``by``."""

    by: tuple[str, ...]
    measures: tuple[str, ...]

    def path(self, target: str) -> str:
        return f"{target.rstrip('/')}/_totals/{'-'.join((*self.by, *self.measures))}"

    def exists(self, spark: SparkSession, target: str) -> bool:
        return Store(spark, target).exists(self.path(target))

    def schema(self, stored: StructType) -> StructType:
        own = StructType([stored[c] for c in self.by if c != "date"]).add(ROWS, LongType())
        for measure in self.measures:
            own = own.add(measure, LongType())
        return own.add("date", StringType()).add(BATCH, LongType())

    def add(self, rows: DataFrame, target: str) -> None:
        """Enter what some batches have stored: ``rows`` of the table, whole batches."""
        sums = (F.sum(m).cast("bigint").alias(m) for m in self.measures)
        keys = [c for c in self.by if c != "date"]
        write_replacing(
            rows.groupBy(*keys, "date", BATCH).agg(F.count(F.lit(1)).alias(ROWS), *sums),
            self.path(target),
            sort_by=keys,
        )

    def read(
        self, spark: SparkSession, target: str, stored: StructType, days: Iterable[str] | None = None
    ) -> DataFrame:
        """The partial sums of ``days`` (None: all); reports take them like rows of the table."""
        return read_dates(spark, self.path(target), self.schema(stored), days)
