"""

The sample tables hold no page or media counts; ``hourtally.standins`` gives ``events`` and
``lineitem`` that shape. Queries over stored tables first write the whole stand-in below the
folder ``spark.checkpoint.dir`` names, then read it back.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import standins
from hourtally.functions.timegrain import (
    DAY,
    HOUR,
    epoch_to_day,
    epoch_to_ntz,
    hour_epoch,
    day_string,
)
from hourtally.operators.dedup import dedup_mediacounts, dedup_pagecounts
from hourtally.operators.ingest import (
    MEDIACOUNTS,
    PAGECOUNTS,
    indexed,
    ingest_batch,
    keyed,
    read_indexed,
    with_totals,
)
from hourtally.plans import jobs, reports, sql
from hourtally.schemas import MEDIA_MEASURES, PAGECOUNTS_EXTERNAL
from hourtally.session import scratch_path
from hourtally.sources.bucketed import BucketedTable
from hourtally.sources.compaction import compact_days, stored_days
from hourtally.sources.loads import loaded_intervals, read_records
from hourtally.sources.paths import HOURLY_ARCHIVE
from hourtally.sources.raw import read_mediacounts_raw, read_pagecounts_raw
from hourtally.sources.sinks import write_partitioned
from hourtally.sources.tables import (
    create_tables,
    declare_external,
    read_dates,
    read_mediacounts,
    read_pagecounts,
    register_external,
)
from hourtally.streaming.file_ingest import FileIngest

try:
    import corpus_pipeline
    from hourtally.llm import registry as llm
except ImportError as missing:
    # The subpackage, its pipeline or a library that they need may be absent; nothing else depends
    # on them.
    warnings.warn(f"without the corpus queries: {missing}", stacklevel=2)
    llm = corpus_pipeline = None

SMOKE_FOLDER = "/root/testdata/sf0.001"

PROJECT = "view"
ARTICLE = "user_7"
# Dashboard range: 2024-01-05 05:00 to 2024-01-25 05:00 UTC, not whole days.
LO = 1704412800 + 5 * HOUR
HI = LO + 20 * DAY
AS_OF = "2024-01-20T00:00:00Z"
# The hour of each day whose dump comes late.
LATE_HOUR = 5
# Visible media dates; the sample ships from 1995 to 2001.
MEDIA_FIRST, MEDIA_LAST = "1996-01-01", "2000-12-31"


# --- reports -------------------------------------------------------------------


def hourly_total_views(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hourly_total_views(standins.page_requests(standins.events(spark, folder)))


def hourly_views_by_project(spark: SparkSession, folder: str) -> DataFrame:
    requests = standins.page_requests(standins.events(spark, folder))
    return reports.hourly_views_by_project(requests, PROJECT)


def hourly_views_by_article(spark: SparkSession, folder: str) -> DataFrame:
    requests = standins.page_requests(standins.events(spark, folder))
    return reports.hourly_views_by_article(requests, ARTICLE)


def daily_media_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.daily_media_totals(standins.media_requests(standins.lineitem(spark, folder)))


def _pagecounts(spark: SparkSession, folder: str) -> DataFrame:
    # Without `date`: it is no directory here, so a bound on it would only cost time.
    return standins.pagecounts(standins.events(spark, folder)).drop("date")


def hourly_rows_and_views(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hourly_rows_and_views(_pagecounts(spark, folder), LO, HI)


def hourly_rows_and_views_project(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hourly_rows_and_views(_pagecounts(spark, folder), LO, HI, PROJECT)


def relative_window_views(spark: SparkSession, folder: str) -> DataFrame:
    return reports.relative_rows_and_views(_pagecounts(spark, folder), as_of=AS_OF)


# --- raw files and load jobs -----------------------------------------------------


def _raw_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with quote characters in the titles, and the file hour they belong to."""
    events = standins.events(spark, folder)
    requests = standins.page_requests(events, F.floor("value").cast("int"))
    return requests.withColumn(
        "article_name", F.concat(F.lit('"'), "article_name", F.lit('"'))
    ).withColumn("load_hour", standins.hour_stamp(F.col("interval_start_unixtime")))


def raw_pagecounts_scan(spark: SparkSession, folder: str) -> DataFrame:
    """What the permissive scan makes of well-formed, short, empty and oversized lines."""
    path = scratch_path(spark, "raw")
    title = F.concat(F.lit('"user_'), F.col("user_id").cast("string"))
    project = F.col("event_type")
    lines = standins.events(spark, folder).select(
        F.explode(
            F.array(
                F.concat_ws(" ", project, title, F.lit("3"), F.lit("0")),
                F.concat_ws(" ", project, F.lit(""), F.lit("8"), F.lit("0")),
                F.concat_ws(" ", project, title, F.lit("3000000000"), F.lit("0")),
                F.concat_ws(" ", project, title),
            )
        ).alias("value")
    )
    lines.write.option("compression", "gzip").text(path)
    scanned = read_pagecounts_raw(spark, path)
    return scanned.groupBy(*scanned.columns).agg(F.count(F.lit(1)).alias("n_lines"))


def normalize_pagecounts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "pagecounts-raw")
    standins.write_raw_pagecounts(_raw_requests(spark, folder), path)
    raw = read_pagecounts_raw(spark, path, folders="load_hour string")
    # The directory is named like a staged file, so its stamp is cut out the same way.
    stamp = jobs.HOURLY_STAGED.epoch(F.col("load_hour"))
    return jobs.normalize_pagecounts(raw, stamp)


def normalize_mediacounts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "mediacounts-raw")
    rows = standins.media_requests(standins.lineitem(spark, folder))
    standins.write_raw_mediacounts(rows, path)
    raw = read_mediacounts_raw(spark, path, folders="load_day string")
    return jobs.normalize_mediacounts(raw, F.col("load_day"))


def interval_derivations(spark: SparkSession, folder: str) -> DataFrame:
    """Hour epoch, day and timestamp of each event hour, and the hour a file name stands for."""
    hours = standins.events(spark, folder).select(hour_epoch(F.col("ts")).alias("epoch")).distinct()
    hour = epoch_to_ntz(F.col("epoch"))
    stamp = standins.hour_stamp(F.col("epoch"), "-")
    name = F.concat(F.lit("pageviews-"), stamp, F.lit("0000.gz"))
    return hours.select(
        "epoch",
        epoch_to_day(F.col("epoch")).alias("day"),
        hour.alias("hour"),
        name.alias("file_name"),
        HOURLY_ARCHIVE.epoch(name).alias("file_epoch"),
    )


def row_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids are random, so only their number and distinctness are comparable."""
    events = standins.events(spark, folder)
    slim = jobs.normalize_pagecounts(
        standins.page_requests(events), F.col("interval_start_unixtime"), row_ids=True
    )
    return slim.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.min(F.length("id")).alias("id_length"),
    )


def late_hours_load(spark: SparkSession, folder: str) -> DataFrame:
    """Hours whose dump comes late: a first load passes over them, the next one loads just them."""
    source, target = scratch_path(spark, "dumps"), scratch_path(spark, "pagecounts")
    requests = _raw_requests(spark, folder)
    late = F.pmod("interval_start_unixtime", F.lit(DAY)) == LATE_HOUR * HOUR
    span = requests.agg(F.min("interval_start_unixtime"), F.max("interval_start_unixtime")).first()
    runs = [datetime.fromtimestamp(e, timezone.utc) for e in span]
    for arrival in (requests.where(~late), requests.where(late)):
        standins.write_raw_pagecounts(arrival, source)
        jobs.load_missing_pagecounts(
            spark, *runs, source, target, lag_days=0, layout=standins.HOURLY_FOLDERS
        )
    records = read_records(spark, target)
    second = records.agg(F.max("stored_at").alias("stored_at"))
    loads = records.join(second, "stored_at", "left_semi").select("load", F.lit(True).alias("late"))
    ledger = (
        loaded_intervals(spark, target)
        .join(loads, "load", "left")
        .groupBy(F.col("interval").alias("interval_start_unixtime"))
        .agg(F.count(F.lit(1)).alias("n_loads"), F.max("late").alias("late"))
    )
    stored = read_dates(spark, target, PAGECOUNTS_EXTERNAL, None)
    hours = stored.groupBy("interval_start_unixtime").agg(F.sum("count").alias("views"))
    return ledger.join(hours, "interval_start_unixtime", "left").select(
        "interval_start_unixtime", "n_loads", F.coalesce("late", F.lit(False)).alias("late"), "views"
    )


# --- deduplication ---------------------------------------------------------------


def dedup_pagecounts_query(spark: SparkSession, folder: str) -> DataFrame:
    counts = standins.pagecounts(standins.events(spark, folder)).drop("date")
    return dedup_pagecounts(standins.page_variants(counts))


def dedup_mediacounts_query(spark: SparkSession, folder: str) -> DataFrame:
    requests = standins.media_requests(standins.lineitem(spark, folder))
    return dedup_mediacounts(standins.media_variants(requests))


# --- stored tables ---------------------------------------------------------------


def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "pagecounts")
    counts = standins.pagecounts(standins.events(spark, folder))
    jobs.store_pagecounts(counts, path)
    return read_pagecounts(spark, path)


def media_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "mediacounts")
    counts = standins.mediacounts(standins.lineitem(spark, folder))
    jobs.store_mediacounts(counts, path)
    return read_mediacounts(spark, path, MEDIA_FIRST, MEDIA_LAST)


def stored_epoch_range(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard range over a stored table: only its days are listed and read."""
    path = scratch_path(spark, "pagecounts")
    jobs.store_pagecounts(standins.pagecounts(standins.events(spark, folder)), path)
    days = day_string(LO), day_string(HI)
    return reports.hourly_rows_and_views(read_pagecounts(spark, path, *days), LO, HI)


def stored_views_by_article(spark: SparkSession, folder: str) -> DataFrame:
    """One article over a stored table, where bloom filters and row group ranges can help."""
    path = scratch_path(spark, "pagecounts")
    jobs.store_pagecounts(standins.pagecounts(standins.events(spark, folder)), path)
    return reports.hourly_views_by_article(read_pagecounts(spark, path), ARTICLE)


# --- ingest ----------------------------------------------------------------------


def _second_arrival(counts: DataFrame) -> DataFrame:
    """Every key once more with a larger count, every key under another project, and a row
    without an article for each of them."""
    later = F.col("count") + 100
    copies = (
        (F.col("project_name"), F.col("article_name"), later),
        (F.concat("project_name", F.lit(".m")), F.col("article_name"), later),
        (F.col("project_name"), F.lit(None).cast("string"), later),
    )
    rows = F.array(
        *(
            F.struct(p.alias("project_name"), a.alias("article_name"), n.alias("count"))
            for p, a, n in copies
        )
    )
    return counts.select("interval_start_unixtime", "date", F.inline(rows)).select(*counts.columns)


def _stored_pagecounts(spark: SparkSession, target: str) -> DataFrame:
    return read_dates(spark, target, PAGECOUNTS.stored, None).select(*PAGECOUNTS.columns.names)


def keyed_ingest_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    target, arrivals = scratch_path(spark, "pagecounts"), scratch_path(spark, "arrivals")
    standins.pagecounts(standins.events(spark, folder)).write.parquet(arrivals)
    counts = spark.read.schema(PAGECOUNTS.source).parquet(arrivals)
    later = _second_arrival(counts)
    for batch_id, batch in ((0, counts), (1, later), (1, later)):
        ingest_batch(batch, batch_id, PAGECOUNTS, target)
    return _stored_pagecounts(spark, target)


def media_ingest_mapping(spark: SparkSession, folder: str) -> DataFrame:
    target, arrivals = scratch_path(spark, "mediacounts"), scratch_path(spark, "arrivals")
    rows = standins.mediacounts(standins.lineitem(spark, folder))
    rows.write.parquet(arrivals)
    counts = spark.read.schema(MEDIACOUNTS.source).parquet(arrivals)
    ingest_batch(counts, 0, MEDIACOUNTS, target)
    ingest_batch(counts, 0, MEDIACOUNTS, target)
    return read_dates(spark, target, MEDIACOUNTS.stored, None).select(*MEDIACOUNTS.columns.names)


def article_index_report(spark: SparkSession, folder: str) -> DataFrame:
    """One article through the index that the ingest keeps: only its directories are opened."""
    target, arrivals = scratch_path(spark, "pagecounts"), scratch_path(spark, "arrivals")
    standins.pagecounts(standins.events(spark, folder)).write.parquet(arrivals)
    counts = spark.read.schema(PAGECOUNTS.source).parquet(arrivals)
    table = indexed(PAGECOUNTS, "article_name")
    for batch_id in range(3):
        third = F.pmod(F.floor(F.col("interval_start_unixtime") / DAY), F.lit(3)) == batch_id
        ingest_batch(counts.where(third), batch_id, table, target)
    rows = read_indexed(spark, table, target, ["article_name"], ARTICLE)
    return reports.hourly_views_by_article(rows, ARTICLE)


def compacted_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, all days compacted, both batches replayed, and the directories of each day."""
    target, arrivals = scratch_path(spark, "pagecounts"), scratch_path(spark, "arrivals")
    standins.pagecounts(standins.events(spark, folder)).write.parquet(arrivals)
    counts = spark.read.schema(PAGECOUNTS.source).parquet(arrivals)
    both = counts, _second_arrival(counts)
    for batch_id, batch in enumerate(both):
        ingest_batch(batch, batch_id, PAGECOUNTS, target)
    compact_days(
        spark, target, PAGECOUNTS.stored, stored_days(spark, target),
        shard_by=PAGECOUNTS.shard_by, sort_by=PAGECOUNTS.sort_by, lookup=PAGECOUNTS.lookup,
    )
    for batch_id, batch in enumerate(both):
        ingest_batch(batch, batch_id, PAGECOUNTS, target)
    rows = read_dates(spark, target, PAGECOUNTS.stored, None)
    held = rows.groupBy("date").agg(F.countDistinct("_batch_id").alias("n_directories"))
    return rows.join(held, "date").select(*PAGECOUNTS.columns.names, "n_directories")


def bucketed_ingest_report(spark: SparkSession, folder: str) -> DataFrame:
    """The views of one project from a table in buckets, after two batches and a replay."""
    location, arrivals = scratch_path(spark, "bucketed"), scratch_path(spark, "arrivals")
    standins.pagecounts(standins.events(spark, folder)).write.parquet(arrivals)
    counts = spark.read.schema(PAGECOUNTS.source).parquet(arrivals)
    database = location.split("/")[-2].replace("-", "_")
    serving = BucketedTable(PAGECOUNTS, database, location, buckets=4)
    serving.declare(spark)
    later = _second_arrival(counts)
    for batch_id, batch in ((0, counts), (1, later), (1, later)):
        serving.ingest(batch, batch_id)
    table = f"{database}.pagecounts"
    return sql.run_report(spark, "hourly_views_by_project", table, project=PROJECT)


def totals_report(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard panel from the partial sums that the ingest keeps, after a replay."""
    target, arrivals = scratch_path(spark, "pagecounts"), scratch_path(spark, "arrivals")
    standins.pagecounts(standins.events(spark, folder)).write.parquet(arrivals)
    counts = spark.read.schema(PAGECOUNTS.source).parquet(arrivals)
    table = with_totals(
        PAGECOUNTS, "interval_start_unixtime", "project_name", measures=["count"]
    )
    later = _second_arrival(counts)
    for batch_id, batch in ((0, counts), (1, later), (1, later)):
        ingest_batch(batch, batch_id, table, target)
    sums = table.totals[0].read(spark, target, table.stored)
    return reports.hourly_rows_and_views(sums, LO, HI)


def stream_ingest_pagecounts(spark: SparkSession, folder: str) -> DataFrame:
    source, root = scratch_path(spark, "arrivals"), scratch_path(spark, "serving")
    counts = standins.pagecounts(standins.events(spark, folder))
    ingest = FileIngest(PAGECOUNTS, source, root)
    for arrival in (counts, _second_arrival(counts)):
        write_partitioned(arrival, source, shard_by=("project_name",))
        ingest.run_available(spark)
    ingest.run_available(spark)  # nothing new has arrived
    return _stored_pagecounts(spark, ingest.target)


def stream_ingest_mediacounts(spark: SparkSession, folder: str) -> DataFrame:
    """No key: a second copy of every file is appended, and an idle run adds nothing."""
    source, root = scratch_path(spark, "arrivals"), scratch_path(spark, "serving")
    counts = standins.mediacounts(standins.lineitem(spark, folder))
    ingest = FileIngest(MEDIACOUNTS, source, root)
    for _ in range(2):
        write_partitioned(counts, source)
        ingest.run_available(spark)
    ingest.run_available(spark)
    stored = read_dates(spark, ingest.target, MEDIACOUNTS.stored, None)
    return stored.select(*MEDIACOUNTS.columns.names)


def serving_tables_report(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog tables created if absent, filled, and asked in SQL with bound parameters."""
    location = scratch_path(spark, "serving")
    database = location.split("/")[-2].replace("-", "_")
    for _ in range(2):
        create_tables(spark, database, location)
    counts = standins.pagecounts(standins.events(spark, folder))
    ingest_batch(counts, 0, PAGECOUNTS, f"{location}/pagecounts", database)
    return sql.run_report(
        spark, "hourly_rows_and_views", f"{database}.pagecounts", lo=LO, hi=HI, project=PROJECT
    )


def serving_tables_all_hours(spark: SparkSession, folder: str) -> DataFrame:
    """A serving table has no date range of its own: hours of 2020 and rows without an hour are
    reported like all others."""
    location = scratch_path(spark, "serving")
    database = location.split("/")[-2].replace("-", "_")
    create_tables(spark, database, location)
    counts = standins.pagecounts(standins.events(spark, folder))
    hour = F.col("interval_start_unixtime")
    old = counts.withColumn("interval_start_unixtime", hour - 4 * 365 * DAY)
    lost = counts.withColumn("interval_start_unixtime", F.lit(None).cast("bigint"))
    target = f"{location}/pagecounts"
    ingest_batch(counts.unionByName(old), 0, PAGECOUNTS, target, database)
    sql.run_report(spark, "hourly_total_views", f"{database}.pagecounts").first()
    ingest_batch(lost, 1, PAGECOUNTS, target, database)  # seen although the table was read before
    return sql.run_report(spark, "hourly_total_views", f"{database}.pagecounts")


def keyed_media_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    """A key without the day: a file that is stored on one day is skipped on all others."""
    target, arrivals = scratch_path(spark, "mediacounts"), scratch_path(spark, "arrivals")
    standins.mediacounts(standins.lineitem(spark, folder)).write.parquet(arrivals)
    counts = spark.read.schema(MEDIACOUNTS.source).parquet(arrivals)
    table = keyed(MEDIACOUNTS, "filename")
    parts = counts.where("_date < '1997-01-01'"), counts.where("_date >= '1997-01-01'"), counts
    for batch_id, batch in enumerate(parts):
        ingest_batch(batch, batch_id, table, target)
    stored = read_dates(spark, target, MEDIACOUNTS.stored, None)
    return stored.select("filename", (F.col("date") < "1997-01-01").alias("early"))


def replaced_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """A replaced definition reads all files again and leaves what is served as it was."""
    source, root = scratch_path(spark, "arrivals"), scratch_path(spark, "serving")
    counts = standins.pagecounts(standins.events(spark, folder))
    ingest = FileIngest(PAGECOUNTS, source, root)
    for arrival in (counts, _second_arrival(counts).where("article_name IS NOT NULL")):
        write_partitioned(arrival, source, shard_by=("project_name",))
        ingest.run_available(spark)
    FileIngest(PAGECOUNTS, source, root, generation=1).run_available(spark)
    return _stored_pagecounts(spark, ingest.target)


def external_tables_report(spark: SparkSession, folder: str) -> DataFrame:
    """Stored media counts asked in SQL through the external views."""
    pages, media = scratch_path(spark, "pagecounts"), scratch_path(spark, "mediacounts")
    counts = standins.mediacounts(standins.lineitem(spark, folder))
    jobs.store_mediacounts(counts, media)
    prefix = media.split("/")[-2].replace("-", "_") + "_"
    register_external(spark, pages, media, prefix, MEDIA_FIRST, MEDIA_LAST)
    return sql.run_report(
        spark, "daily_media_totals", f"{prefix}mediacounts", MEDIA_FIRST, MEDIA_LAST
    )


def external_catalog_report(spark: SparkSession, folder: str) -> DataFrame:
    """External tables in the catalog: days stored after the first report are in the next one."""
    pages, media = scratch_path(spark, "pagecounts"), scratch_path(spark, "mediacounts")
    database = media.split("/")[-2].replace("-", "_")
    declare_external(spark, database, pages, media, MEDIA_FIRST)
    counts = standins.mediacounts(standins.lineitem(spark, folder))
    table = f"{database}.mediacounts"
    reported = []
    for n, days in enumerate((F.col("date") < "1998-01-01", F.col("date") >= "1998-01-01"), 1):
        jobs.store_mediacounts(counts.where(days), media, database=database)
        path = scratch_path(spark, "report")
        found = sql.run_report(spark, "daily_media_totals", table, "1996-07-01", MEDIA_LAST)
        found.withColumn("report", F.lit(n)).write.parquet(path)
        reported.append(spark.read.parquet(path))
    return reported[0].unionByName(reported[1])


def entry(spark: SparkSession) -> DataFrame:
    return hourly_total_views(spark, SMOKE_FOLDER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | ({**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "hourly_total_views": hourly_total_views,
        "hourly_views_by_project": hourly_views_by_project,
        "hourly_views_by_article": hourly_views_by_article,
        "daily_media_totals": daily_media_totals,
        "hourly_rows_and_views": hourly_rows_and_views,
        "hourly_rows_and_views_project": hourly_rows_and_views_project,
        "relative_window_views": relative_window_views,
        "raw_pagecounts_scan": raw_pagecounts_scan,
        "normalize_pagecounts": normalize_pagecounts,
        "normalize_mediacounts": normalize_mediacounts,
        "interval_derivations": interval_derivations,
        "row_ids": row_ids,
        "dedup_pagecounts": dedup_pagecounts_query,
        "dedup_mediacounts": dedup_mediacounts_query,
        "partitioned_roundtrip": partitioned_roundtrip,
        "media_roundtrip": media_roundtrip,
        "stored_epoch_range": stored_epoch_range,
        "stored_views_by_article": stored_views_by_article,
        "keyed_ingest_first_wins": keyed_ingest_first_wins,
        "media_ingest_mapping": media_ingest_mapping,
        "stream_ingest_pagecounts": stream_ingest_pagecounts,
        "stream_ingest_mediacounts": stream_ingest_mediacounts,
        "serving_tables_report": serving_tables_report,
        "serving_tables_all_hours": serving_tables_all_hours,
        "keyed_media_first_wins": keyed_media_first_wins,
        "replaced_pipeline": replaced_pipeline,
        "external_tables_report": external_tables_report,
        "external_catalog_report": external_catalog_report,
        "late_hours_load": late_hours_load,
        "article_index_report": article_index_report,
        "compacted_ingest": compacted_ingest,
        "totals_report": totals_report,
        "bucketed_ingest_report": bucketed_ingest_report,
    }


# --- the same in SQL ---------------------------------------------------------------

_EPOCH = "(epoch(date_trunc('hour', ts))::bigint)"


def _counts(epoch: str = _EPOCH) -> str:
    return f"""
      SELECT event_type AS project_name, 'user_' || user_id AS article_name,
             {epoch} AS interval_start_unixtime, count(*)::int AS count
      FROM events GROUP BY ALL"""


_HOUR = "make_timestamp(interval_start_unixtime * 1000000)"
_DAY = "strftime(make_timestamp(interval_start_unixtime * 1000000), '%Y-%m-%d')"

_MEDIA_EXPRESSIONS = {
    "total_response_bytes": "round(l_extendedprice * 100)::bigint",
    "total_transfers_all": "l_quantity::int",
    "total_transfers_restricted": "CASE WHEN l_linenumber = 1 THEN l_quantity::int ELSE 0 END",
    "total_transfers_transcoded_audio": "CASE WHEN l_returnflag = 'A' THEN l_quantity::int ELSE 0 END",
    "total_transfers_transcoded_image": "CASE WHEN l_returnflag = 'N' THEN l_quantity::int ELSE 0 END",
    "total_transfers_transcoded_mov": "CASE WHEN l_returnflag = 'R' THEN l_quantity::int ELSE 0 END",
    "transfers_from_wmf_domain": "CASE WHEN l_linestatus = 'O' THEN l_quantity::int ELSE 0 END",
    "transfers_from_non_wmf_domain": "CASE WHEN l_linestatus = 'F' THEN l_quantity::int ELSE 0 END",
    "transfers_from_invalid_domain": "CASE WHEN l_linenumber = 7 THEN l_quantity::int ELSE 0 END",
}
_MEDIA_DAY = "strftime(l_shipdate, '%Y-%m-%d')"


def _media_requests(day: str) -> str:
    measures = ", ".join(f"{e} AS {n}" for n, e in _MEDIA_EXPRESSIONS.items())
    return f"SELECT 'part/' || l_partkey AS filename, {day} AS date, {measures} FROM lineitem"


def _mediacounts(day: str) -> str:
    sums = ", ".join(
        f"sum({e})::{'bigint' if n == 'total_response_bytes' else 'int'} AS {n}"
        for n, e in _MEDIA_EXPRESSIONS.items()
    )
    return f"SELECT 'part/' || l_partkey AS filename, {day} AS date, {sums} FROM lineitem GROUP BY ALL"


_MEASURES = ", ".join(MEDIA_MEASURES)
_GREATEST_FIRST = ", ".join(f"{m} DESC NULLS LAST" for m in MEDIA_MEASURES)

_PANEL = f"""
  SELECT {_HOUR} AS hr, count(*) AS "Pages Viewed", sum(count)::bigint AS "Total Page Views"
  FROM pagecounts WHERE interval_start_unixtime BETWEEN {{lo}} AND {{hi}}{{more}}
  GROUP BY interval_start_unixtime"""


def _panel(lo: int, hi: int, more: str = "", epoch: str = _EPOCH) -> str:
    return f"WITH pagecounts AS ({_counts(epoch)}) " + _PANEL.format(lo=lo, hi=hi, more=more)


# as_of 2024-01-20 less the 1-day delay gives a "now" of 2024-01-19.
_NOW = 1705622400


def _media_ingested(day: str, source: str = "mediacounts") -> str:
    return f"""
      WITH mediacounts AS ({_mediacounts(day)})
      SELECT filename, date, total_response_bytes, total_transfers_all,
             {", ".join(f"NULL::int AS {m}" for m in MEDIA_MEASURES[2:])}
      FROM {source}"""


_TWICE = "(SELECT * FROM mediacounts UNION ALL SELECT * FROM mediacounts)"

_INGESTED = f"""
  WITH pagecounts AS ({_counts()})
  SELECT project_name, article_name, interval_start_unixtime, count FROM pagecounts
  UNION ALL
  SELECT project_name || '.m', article_name, interval_start_unixtime, count + 100 FROM pagecounts
  UNION ALL
  SELECT project_name, NULL, interval_start_unixtime, count + 100 FROM pagecounts"""


def oracle_sql() -> dict[str, str]:
    return _own_oracle_sql() | (llm.ORACLE_SQL if llm else {})


def _own_oracle_sql() -> dict[str, str]:
    return {
        "hourly_total_views": f"""
          WITH pagecounts AS ({_counts()})
          SELECT {_HOUR} AS hour, sum(count)::bigint AS pageviews
          FROM pagecounts GROUP BY interval_start_unixtime ORDER BY hour""",
        "hourly_views_by_project": f"""
          WITH pagecounts AS ({_counts()})
          SELECT {_HOUR} AS hour, project_name, sum(count)::bigint AS pageviews
          FROM pagecounts WHERE project_name = '{PROJECT}'
          GROUP BY interval_start_unixtime, project_name ORDER BY hour""",
        "hourly_views_by_article": f"""
          WITH pagecounts AS ({_counts()})
          SELECT {_HOUR} AS hour, article_name, sum(count)::bigint AS pageviews
          FROM pagecounts WHERE article_name = '{ARTICLE}'
          GROUP BY interval_start_unixtime, article_name ORDER BY hour""",
        "daily_media_totals": f"""
          WITH mediacounts AS ({_mediacounts(_MEDIA_DAY)})
          SELECT date AS d, sum(total_response_bytes)::bigint / power(10, 12) AS tb_served,
                 sum(total_transfers_all)::bigint AS n_imgs_served
          FROM mediacounts GROUP BY date ORDER BY date""",
        "hourly_rows_and_views": _panel(LO, HI),
        "hourly_rows_and_views_project": _panel(LO, HI, f" AND project_name = '{PROJECT}'"),
        "relative_window_views": _panel(_NOW - 3 * DAY, _NOW - DAY),
        "raw_pagecounts_scan": """
          WITH lines AS (
            SELECT event_type AS p, '"user_' || user_id AS t, unnest([1, 2, 3, 4]) AS kind
            FROM events)
          SELECT p AS project_name, CASE WHEN kind <> 2 THEN t END AS article_name,
                 CASE kind WHEN 1 THEN 3 WHEN 2 THEN 8 END AS count,
                 CASE WHEN kind < 4 THEN '0' END AS _deprecated, count(*) AS n_lines
          FROM lines GROUP BY ALL""",
        "normalize_pagecounts": f"""
          SELECT event_type AS project_name, '"user_' || user_id || '"' AS article_name,
                 {_EPOCH} AS interval_start_unixtime, max(floor(value)::int) AS count,
                 strftime(ts, '%Y-%m-%d') AS date
          FROM events GROUP BY ALL""",
        "normalize_mediacounts": f"""
          WITH requests AS ({_media_requests(_MEDIA_DAY)}),
               ranked AS (SELECT *, row_number() OVER (
                 PARTITION BY date, filename ORDER BY {_GREATEST_FIRST}) AS rn FROM requests)
          SELECT filename, date AS _date, {_MEASURES}, date FROM ranked WHERE rn = 1""",
        "interval_derivations": f"""
          SELECT DISTINCT {_EPOCH} AS epoch, strftime(ts, '%Y-%m-%d') AS day,
                 date_trunc('hour', ts) AS hour,
                 'pageviews-' || strftime(ts, '%Y%m%d-%H') || '0000.gz' AS file_name,
                 {_EPOCH} AS file_epoch
          FROM events""",
        "row_ids": f"""
          SELECT count(*) AS n_rows, count(*) AS n_ids, 36 AS id_length FROM ({_counts()})""",
        "dedup_pagecounts": f"""
          WITH pagecounts AS ({_counts()})
          SELECT project_name, article_name, interval_start_unixtime, count FROM pagecounts
          UNION ALL
          SELECT project_name, NULL, interval_start_unixtime, max(count)
          FROM pagecounts GROUP BY ALL""",
        "dedup_mediacounts": f"""
          WITH requests AS ({_media_requests(_MEDIA_DAY)}),
               copies AS (
                 SELECT * FROM requests
                 UNION ALL
                 SELECT * REPLACE (NULL::bigint AS total_response_bytes,
                                   total_transfers_all + 9 AS total_transfers_all) FROM requests
                 UNION ALL
                 SELECT * REPLACE (total_transfers_all + 1 AS total_transfers_all) FROM requests),
               ranked AS (SELECT *, row_number() OVER (
                 PARTITION BY date, filename ORDER BY {_GREATEST_FIRST}) AS rn FROM copies)
          SELECT date, filename, {_MEASURES} FROM ranked WHERE rn = 1""",
        "partitioned_roundtrip": f"""
          WITH pagecounts AS ({_counts()})
          SELECT project_name, article_name, interval_start_unixtime, count::bigint AS count,
                 {_DAY} AS date
          FROM pagecounts""",
        "media_roundtrip": f"""
          WITH mediacounts AS ({_mediacounts(_MEDIA_DAY)})
          SELECT filename, {_MEASURES}, date FROM mediacounts
          WHERE date BETWEEN '{MEDIA_FIRST}' AND '{MEDIA_LAST}'""",
        "stored_epoch_range": _panel(LO, HI),
        "stored_views_by_article": f"""
          WITH pagecounts AS ({_counts()})
          SELECT {_HOUR} AS hour, article_name, sum(count)::bigint AS pageviews
          FROM pagecounts WHERE article_name = '{ARTICLE}'
          GROUP BY interval_start_unixtime, article_name""",
        "article_index_report": f"""
          WITH pagecounts AS ({_counts()})
          SELECT {_HOUR} AS hour, article_name, sum(count)::bigint AS pageviews
          FROM pagecounts WHERE article_name = '{ARTICLE}'
          GROUP BY interval_start_unixtime, article_name""",
        "bucketed_ingest_report": f"""
          WITH pagecounts AS ({_INGESTED})
          SELECT {_HOUR} AS hour, project_name, sum(count)::bigint AS pageviews
          FROM pagecounts WHERE project_name = '{PROJECT}'
          GROUP BY interval_start_unixtime, project_name""",
        "totals_report": f"WITH pagecounts AS ({_INGESTED}) " + _PANEL.format(lo=LO, hi=HI, more=""),
        "compacted_ingest": f"SELECT *, 1 AS n_directories FROM ({_INGESTED})",
        "serving_tables_all_hours": f"""
          WITH pagecounts AS ({_counts()}),
               served AS (
                 SELECT interval_start_unixtime, count FROM pagecounts
                 UNION ALL SELECT interval_start_unixtime - {4 * 365 * DAY}, count FROM pagecounts
                 UNION ALL SELECT NULL, count FROM pagecounts)
          SELECT {_HOUR} AS hour, sum(count)::bigint AS pageviews
          FROM served GROUP BY interval_start_unixtime""",
        "keyed_media_first_wins": """
          SELECT 'part/' || l_partkey AS filename,
                 min(l_shipdate) < TIMESTAMP '1997-01-01' AS early
          FROM lineitem GROUP BY l_partkey""",
        "replaced_pipeline": f"""
          WITH pagecounts AS ({_counts()})
          SELECT project_name, article_name, interval_start_unixtime, count FROM pagecounts
          UNION ALL
          SELECT project_name || '.m', article_name, interval_start_unixtime, count + 100
          FROM pagecounts""",
        "keyed_ingest_first_wins": _INGESTED,
        "media_ingest_mapping": _media_ingested(_MEDIA_DAY),
        "stream_ingest_pagecounts": _INGESTED,
        "stream_ingest_mediacounts": _media_ingested(_MEDIA_DAY, _TWICE),
        "serving_tables_report": _panel(LO, HI, f" AND project_name = '{PROJECT}'"),
        "external_tables_report": f"""
          WITH mediacounts AS ({_mediacounts(_MEDIA_DAY)})
          SELECT date AS d, sum(total_response_bytes)::bigint / power(10, 12) AS tb_served,
                 sum(total_transfers_all)::bigint AS n_imgs_served
          FROM mediacounts WHERE date BETWEEN '{MEDIA_FIRST}' AND '{MEDIA_LAST}'
          GROUP BY date ORDER BY date""",
        "external_catalog_report": f"""
          WITH mediacounts AS ({_mediacounts(_MEDIA_DAY)})
          SELECT date AS d, sum(total_response_bytes)::bigint / power(10, 12) AS tb_served,
                 sum(total_transfers_all)::bigint AS n_imgs_served, report::int AS report
          FROM mediacounts, (VALUES (1, '1998-01-01'), (2, '9999-01-01')) AS reports(report, stored)
          WHERE date BETWEEN '1996-07-01' AND '{MEDIA_LAST}' AND date < stored
          GROUP BY date, report""",
        "late_hours_load": f"""
          WITH requests AS (
            SELECT event_type, user_id, {_EPOCH} AS epoch, max(floor(value)::int) AS count
            FROM events GROUP BY ALL)
          SELECT epoch AS interval_start_unixtime, 1 AS n_loads,
                 epoch % {DAY} = {LATE_HOUR * HOUR} AS late, sum(count)::bigint AS views
          FROM requests GROUP BY epoch""",
    }
