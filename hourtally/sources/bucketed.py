"""A serving table in buckets: the key check moves the batch, never the table.

The directories are those of any serving table, by day and batch. In each the rows lie in files by a
hash of ``by``, which Spark knows from the catalog. A batch is dealt out by the same hash, once: its rows
are deduplicated where they come to lie, meet the stored keys of their bucket there, and are written
from there. The plain layout moves the stored keys of the batch's hours for each check.

That is a task for each bucket, so it holds while a bucket's share of the batch and of its days is small
enough for one. Beyond that the batch and the stored keys are dealt out by the whole key over as many
tasks as their rows need, and what is inserted is gathered by day and bucket again: a table that has
outgrown its buckets costs another shuffle, not the memory of a task.

``by`` are columns of the key. Project and article together, the default, spread a project that holds
a third of all rows; the project alone lets a report on one project read one file in ``buckets``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.operators.dedup import keep_greatest
from hourtally.operators.ingest import ServingTable
from hourtally.operators.mapping import project_mapping
from hourtally.sources.sinks import BATCH
from hourtally.sources.tables import qualified, quoted

# While a batch is stored: a join may use a partitioning by some of its keys, and only the
# directories that the batch has rows for are replaced.
_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Rows of the batch, and of the days it meets, that a task is to check.
ROWS_A_TASK = 1_000_000


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@dataclass(frozen=True)
class BucketedTable:
    """``table`` as ``database.name``, its files at ``path``."""

    table: ServingTable
    database: str
    path: str
    buckets: int = 16
    by: tuple[str, ...] = ("project_name", "article_name")

    @property
    def name(self) -> str:
        return qualified(self.database, self.table.name)

    def declare(self, spark: SparkSession) -> None:
        """Create the table, if the name is not taken."""
        t = self.table
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.stored)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(self.database)}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"PARTITIONED BY (date, {BATCH}) CLUSTERED BY ({', '.join(self.by)}) "
            f"SORTED BY ({', '.join(t.sort_by)}) INTO {self.buckets} BUCKETS LOCATION {quoted(self.path)}"
        )

    def ingest(self, source: DataFrame, batch_id: int) -> None:
        """Insert one batch, as ``ingest_batch`` does: of equal keys in it the greatest measures are
        kept, what an earlier batch has stored stays, a null in the key never collides, and
        repeating a batch leaves the same table."""
        t, spark = self.table, source.sparkSession
        rows, tasks = self._checked(source, batch_id)
        placed = rows.withColumn("date", t.day()).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        if tasks > self.buckets:
            # The writer's own hash, so that a task has few buckets to write; AQE cuts the large ones.
            bucket = F.pmod(F.hash(*self.by), F.lit(self.buckets))
            placed = placed.withColumn("_bucket", bucket).hint("rebalance", "date", "_bucket")
        with _settings(spark):
            placed.select(*t.stored.names).write.mode("overwrite").insertInto(self.name)

    def rows_to_insert(self, source: DataFrame, batch_id: int) -> DataFrame:
        """Mapping and key check of one batch, dealt out as it will lie. It is to run under the
        settings of ``ingest``; under others the stored keys are dealt out as well."""
        return self._checked(source, batch_id)[0]

    def _checked(self, source: DataFrame, batch_id: int) -> tuple[DataFrame, int]:
        """``rows_to_insert``, and the tasks that check them: one for each bucket, or more."""
        t, spark = self.table, source.sparkSession
        rows = project_mapping(source, t.columns, t.mapping)
        complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in t.unique_key))
        counted = rows.groupBy(t.day().alias("day")).agg(F.count(F.lit(1)).alias("n"))
        days = counted.collect()  # one row for each day
        wanted = F.col("date").isin([r["day"] for r in days]) & (F.col(BATCH) < batch_id)
        earlier = spark.table(self.name).where(wanted)
        stored = earlier.where(complete).select(*t.unique_key)
        # Whole directories, as the footers of their files tell that count.
        n_rows = sum(r["n"] for r in days) + earlier.count()
        tasks = max(self.buckets, math.ceil(n_rows / ROWS_A_TASK))
        measures = [c for c in rows.columns if c not in t.unique_key]
        dealt = rows.where(complete)
        if tasks > self.buckets:
            dealt = dealt.repartition(tasks, *t.unique_key)
            stored = stored.repartition(tasks, *t.unique_key)
        else:
            dealt = dealt.repartition(self.buckets, *self.by)
        fresh = keep_greatest(dealt, t.unique_key, measures)
        kept = fresh.join(stored, list(t.unique_key), "left_anti").select(*rows.columns)
        # What lacks a key meets nothing, and may all be of one bucket: it is written where it is.
        return kept.union(rows.where(~complete)), tasks
