"""Continuous loading of new parquet files into a serving table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hourtally.operators.ingest import ServingTable, ingest_batch
from hourtally.schemas import schema_of
from hourtally.sources.compaction import (
    batches,
    closed_days,
    compact_days,
    finish_compactions,
    stored_days,
)
from hourtally.sources.files import Store
from hourtally.sources.loads import RECORD, read_loaded, records_path, with_arrival
from hourtally.sources.sinks import BATCH
from hourtally.sources.tables import declare_table, qualified, read_dates
from hourtally.streaming.claims import Claim

# Batch ids that each definition of a pipeline has to itself.
IDS = 1 << 40


@dataclass(frozen=True)
class FileIngest:
    """New loads of ``source`` go into a target below ``root``.

    What is followed are the load records that ``store_pagecounts``, ``store_mediacounts`` and
    ``write_partitioned`` leave, up to ``max_files`` of them in a batch: a trigger lists the folder
    of records, and a batch opens the directories that its records name. ``listed`` is for files
    of other origin, without records: each trigger then lists all of ``source``.

    The checkpoint lies in a folder named after the definition. Changing the mapping, key or
    source therefore reads all files again: an old checkpoint is never read with a new mapping.
    The target stays: what it serves is kept, keys it holds are skipped, and the batch ids of a
    new definition continue above those stored. ``generation`` starts over with an unchanged
    definition. A table declared in ``database`` shows each batch once it is loaded. A day that a
    batch leaves with more than ``most_directories`` directories is compacted right after it.

    A target has one writer: a start is refused while another driver's claim holds, whatever its
    definition. ``take_over`` replaces a driver that is known to be lost; if it is not, it stops
    before its next batch.
    """

    table: ServingTable
    source: str
    root: str
    generation: int = 0
    max_files: int = 10_000
    source_schema: StructType | None = None
    database: str | None = None
    listed: bool = False
    most_directories: int | None = None
    take_over: bool = False

    @property
    def definition(self) -> str:
        t = self.table
        parts = [
            t.name,
            self.source,
            (self.source_schema or t.source).jsonValue(),
            t.columns.jsonValue(),
            sorted(t.mapping.items()),
            list(t.unique_key),
            self.generation,
        ]
        if not self.listed:
            parts.append("records")
        return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:16]

    @property
    def folder(self) -> str:
        return f"{self.root.rstrip('/')}/{self.table.name}-{self.definition}"

    @property
    def target(self) -> str:
        return f"{self.root.rstrip('/')}/{self.table.name}/table"

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    def declare(self, spark: SparkSession, database: str | None = None) -> None:
        """Point the catalog table at this target, with all that it holds."""
        database = database or self.database
        spark.sql(f"DROP TABLE IF EXISTS {qualified(database, self.table.name)}")
        declare_table(spark, database, self.table.name, self.table.columns, self.target)

    def start(self, spark: SparkSession, every: str | None = None) -> StreamingQuery:
        """Load what has arrived and stop, or look again ``every`` interval until stopped.

        Keys are remembered by the target itself, not by streaming state: they count for
        ever, so a late or repeated load finds them however old they are. ``max_files``
        cuts a backlog into batches; all of it is loaded, and the file that arrived first wins
        within a batch as it does between batches.
        """
        return self._start(spark, every)[0]

    def _start(self, spark: SparkSession, every: str | None) -> tuple[StreamingQuery, Claim]:
        claim = self._claim(spark)
        try:
            return claim.follow(self._query(spark, every, claim)), claim
        except BaseException:
            claim.release(spark)
            raise

    def _query(self, spark: SparkSession, every: str | None, claim: Claim) -> StreamingQuery:
        for path, name in self._stored_paths():
            finish_compactions(spark, path, self.database, name)
        first_id = self._first_batch_id(spark)
        arriving = self._files(spark) if self.listed else self._records(spark)

        def load(batch, batch_id):
            claim.check(batch.sparkSession)
            if not self.listed:
                records = batch.select("load", "directories").collect()  # one row for each load
                batch = read_loaded(spark, self.source, records, self._schema)
            self._load(batch, first_id + batch_id)

        writer = arriving.writeStream.foreachBatch(load)
        writer = writer.option("checkpointLocation", self.checkpoint)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return writer.trigger(**trigger).start()

    @property
    def _claims(self) -> str:
        return f"{self.root.rstrip('/')}/{self.table.name}/_writers"

    def _claim(self, spark: SparkSession) -> Claim:
        what = {"definition": self.definition, "source": self.source, "generation": self.generation}
        return Claim.take(spark, self._claims, what, self.take_over)

    def replaced(self, spark: SparkSession) -> FileIngest:
        """The same definition, to be started over: in a generation above the last one claimed."""
        _, last = Claim.newest(spark, self._claims)
        return replace(self, generation=max(self.generation, last.get("generation", 0)) + 1)

    def _stored_paths(self) -> list[tuple[str, str | None]]:
        """Folders with directories by day and batch, and the name in the catalog of the first."""
        beside = [(t.path(self.target), None) for t in self.table.totals]
        return [(self.target, self.table.name), *beside]

    def _load(self, batch: DataFrame, batch_id: int) -> None:
        stored = ingest_batch(batch, batch_id, self.table, self.target, self.database)
        if self.most_directories:
            days = {r["date"] for r in stored if r["date"] is not None}
            self.compact(batch.sparkSession, days, self.most_directories)

    def compact(
        self, spark: SparkSession, days: Iterable[str] | None = None, most: int = 1
    ) -> list[str]:
        """Rewrite as one directory each those of ``days`` (None: all) that have more than ``most``;
        returns them. Not while the pipeline runs, which does this by itself with
        ``most_directories``."""
        t = self.table
        days = stored_days(spark, self.target) if days is None else list(days)
        done = compact_days(
            spark, self.target, t.stored, days, most, t.shard_by, t.sort_by, t.lookup,
            self.database, t.name,
        )
        # The totals follow the table: a batch that may still be replayed keeps its own directory.
        closed = closed_days(spark, self.target) if t.totals else {}
        for totals in t.totals:
            path, columns = totals.path(self.target), totals.schema(t.stored)
            last = {d: max(batches(spark, path, d), default=0) for d in days if d in closed}
            some = [d for d, batch in last.items() if batch <= closed[d]]
            compact_days(spark, path, columns, some, most, sort_by=totals.by)
        return done

    @property
    def _schema(self) -> StructType:
        return self.source_schema or self.table.source

    def _records(self, spark: SparkSession) -> DataFrame:
        # A pipeline may start before the first load.
        Store(spark, self.source).make_folder(records_path(self.source))
        stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", self.max_files)
        return stream.json(records_path(self.source))

    def _files(self, spark: SparkSession) -> DataFrame:
        # By default Spark passes over files a week older than the newest it has seen; a dump
        # that comes late counts like any other.
        stream = spark.readStream.schema(self._schema).option("maxFileAge", "36500d")
        return with_arrival(stream.option("maxFilesPerTrigger", self.max_files).parquet(self.source))

    def _first_batch_id(self, spark: SparkSession) -> int:
        """Where this definition's batch ids begin: above all that the target held when it first
        started. Written down beside the checkpoint, so a restart begins there as well."""
        schema, path = "first_batch_id bigint", f"{self.folder}/first-batch-id"
        known = read_dates(spark, path, schema_of(schema), None).first()
        if known is None:
            stored = read_dates(spark, self.target, self.table.stored, None)
            last = stored.agg(F.max(BATCH)).first()[0]
            first = 0 if last is None else (last // IDS + 1) * IDS
            row = spark.range(1).select(F.lit(first).cast("bigint").alias("first_batch_id"))
            row.write.mode("overwrite").parquet(path)
            return first
        return known["first_batch_id"]

    def run(self, spark: SparkSession, every: str | None = None) -> None:
        """``start`` and wait for the end, then let others write."""
        query, claim = self._start(spark, every)
        try:
            query.awaitTermination()
        finally:
            query.stop()
            claim.release(spark)

    def run_available(self, spark: SparkSession) -> None:
        """Load all that has arrived, then return."""
        self.run(spark)
