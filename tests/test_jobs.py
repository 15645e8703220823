import bz2
import gzip
import hashlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hourtally import __main__ as cli
from hourtally import schemas
from hourtally.operators.ingest import PAGECOUNTS
from hourtally.plans import jobs, reports, sql
from hourtally.sources import paths
from hourtally.sources.sinks import write_partitioned
from hourtally.sources.tables import read_mediacounts, read_pagecounts, register_external
from hourtally.streaming.file_ingest import FileIngest

LAST = "2030-01-01"


@pytest.fixture
def hourly(tmp_path):
    folder = tmp_path / "gz"
    folder.mkdir()

    def put(stamp, *lines):
        (folder / f"{stamp}.gz").write_bytes(gzip.compress("\n".join(lines).encode()))

    put("2022090104", "en A 3 0", "en A 7 0", 'de "Q" 1 0')
    put("2022090105", "en A 4 0", "en B 2 0")
    put.folder = str(folder)
    return put


@pytest.fixture
def daily(tmp_path):
    folder = tmp_path / "bz"
    folder.mkdir()

    def put(day, *rows):
        text = "\n".join("\t".join(map(str, (name, *[n] * 24))) for name, n in rows)
        path = folder / f"mediacounts.{day}.v00.tsv.bz2"
        path.write_bytes(bz2.compress(text.encode()))

    put("2022-08-30", ("/f", 1), ("/f", 5), ("/g", 2))
    put("2022-08-31", ("/f", 3))
    put.folder = str(folder)
    return put


RUNS = ["2022-09-02T04:30:00Z", "2022-09-02T05:00:00.000001+00:00"]


def test_hours_of_a_backfill_come_from_the_file_names(spark, hourly):
    got = {tuple(r) for r in jobs.load_pagecounts(spark, RUNS, hourly.folder).collect()}
    four, five = 1662004800, 1662008400
    assert got == {
        ("en", "A", four, 7, "2022-09-01"),
        ("de", '"Q"', four, 1, "2022-09-01"),
        ("en", "A", five, 4, "2022-09-01"),
        ("en", "B", five, 2, "2022-09-01"),
    }


def test_an_absent_file_costs_only_its_own_hour(spark, hourly, daily, caplog):
    runs = [*RUNS, "2022-09-02T06:00:00Z", "2022-09-03T05:00:00Z"]
    got = jobs.load_pagecounts(spark, runs, hourly.folder + "/").collect()
    assert sorted(got) == sorted(jobs.load_pagecounts(spark, RUNS, hourly.folder).collect())
    assert "2 of 4 files are absent" in caplog.text
    assert "2022090106.gz" in caplog.text and "2022090205.gz" in caplog.text
    days = ["2022-09-01T00:00:00Z", "2022-09-20T00:00:00Z"]
    assert jobs.load_mediacounts(spark, days, daily.folder).count() == 2
    assert "mediacounts.2022-09-18" in caplog.text
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        jobs.load_pagecounts(spark, ["2020-01-02T00:00:00Z"], hourly.folder)


def test_absent_files_of_the_published_folders(spark, tmp_path, caplog):
    for month, stamp in (("2022-08", "20220831-230000"), ("2022-09", "20220901-010000")):
        folder = tmp_path / "2022" / month
        folder.mkdir(parents=True)
        name = folder / f"pageviews-{stamp}.gz"
        name.write_bytes(gzip.compress(b"en A 3 0"))
    runs = [f"2022-09-0{d}T{h}:00:00Z" for d, h in ((1, 23), (2, "00"), (2, "01"))]
    got = jobs.load_pagecounts(spark, runs, str(tmp_path), layout=paths.HOURLY_ARCHIVE).collect()
    assert sorted(r.interval_start_unixtime for r in got) == [1661986800, 1661994000]
    assert "1 of 3 files are absent" in caplog.text and "20220901-000000" in caplog.text


def test_media_job_yields_both_day_columns(spark, daily):
    runs = ["2022-09-01T00:00:00Z", "2022-09-02T00:00:00Z"]
    df = jobs.load_mediacounts(spark, runs, daily.folder)
    got = {(r.filename, r._date, r.date, r.total_transfers_all) for r in df.collect()}
    assert got == {
        ("/f", "2022-08-30", "2022-08-30", 5),
        ("/g", "2022-08-30", "2022-08-30", 2),
        ("/f", "2022-08-31", "2022-08-31", 3),
    }


def test_row_ids_are_distinct(spark, hourly, daily, tmp_path):
    pages, media = str(tmp_path / "p"), str(tmp_path / "m")
    jobs.store_pagecounts(jobs.load_pagecounts(spark, RUNS, hourly.folder), pages, row_ids=True)
    runs = ["2022-09-01T00:00:00Z"]
    jobs.store_mediacounts(jobs.load_mediacounts(spark, runs, daily.folder), media, row_ids=True)
    for path, n in ((pages, 4), (media, 2)):
        ids = [r.id for r in spark.read.parquet(path).collect()]
        assert len(set(ids)) == n and all(len(i) == 36 for i in ids)
    # Readers do not see the column.
    assert "id" not in read_pagecounts(spark, pages).columns


def test_rerun_of_an_hour_replaces_only_that_hour(spark, hourly, tmp_path):
    table = str(tmp_path / "pq")
    jobs.store_pagecounts(jobs.load_pagecounts(spark, RUNS, hourly.folder), table)
    hourly("2022090105", "en A 40 0")
    for _ in range(2):
        jobs.store_pagecounts(jobs.load_pagecounts(spark, RUNS[1:], hourly.folder), table)
    views = reports.hourly_total_views(read_pagecounts(spark, table, last=LAST)).collect()
    assert [r.pageviews for r in views] == [8, 40]


def test_rerun_of_a_day_replaces_only_that_day(spark, daily, tmp_path):
    table = str(tmp_path / "pq")
    for runs in (["2022-09-01T00:00:00Z"], ["2022-09-02T00:00:00Z"], ["2022-09-02T00:00:00Z"]):
        jobs.store_mediacounts(jobs.load_mediacounts(spark, runs, daily.folder), table)
    got = reports.daily_media_totals(read_mediacounts(spark, table, last=LAST)).collect()
    assert [(r.d, r.n_imgs_served) for r in got] == [("2022-08-30", 7), ("2022-08-31", 3)]


def test_plain_append_stores_a_rerun_twice(spark, hourly, tmp_path):
    table = str(tmp_path / "pq")
    df = jobs.load_pagecounts(spark, RUNS, hourly.folder)
    for _ in range(2):
        write_partitioned(df, table)
    assert read_pagecounts(spark, table, last=LAST).count() == 8


def test_visible_range_and_text_dates(spark, hourly, tmp_path):
    table = str(tmp_path / "pq")
    jobs.store_pagecounts(jobs.load_pagecounts(spark, RUNS, hourly.folder), table)
    assert dict(read_pagecounts(spark, table).dtypes)["date"] == "string"
    assert dict(read_pagecounts(spark, table).dtypes)["count"] == "bigint"
    assert read_pagecounts(spark, table, last=LAST).count() == 4
    assert read_pagecounts(spark, table, "2022-09-02", LAST).count() == 0
    assert read_pagecounts(spark, table, "2022-01-01", "2022-08-31").count() == 0
    assert read_pagecounts(spark, table, "2022-09-02", "2022-09-01").count() == 0
    assert read_pagecounts(spark, table, "1900-01-01", "2500-01-01").count() == 4
    assert read_pagecounts(spark, str(tmp_path / "absent"), last=LAST).count() == 0


def scanned_rows(df):
    """Rows the scan handed on after skipping row groups and pages."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_days_after_today_are_not_visible(spark, tmp_path):
    rows = [("en", "A", 1662004800, 1, "2022-09-01"), ("en", "A", 32472144000, 1, "2999-01-01"),
            ("en", "A", 1609459200, 1, "2021-01-01")]
    table = str(tmp_path / "pq")
    jobs.store_pagecounts(spark.createDataFrame(rows, schemas.PAGECOUNTS_NORMAL), table)
    assert [r.date for r in read_pagecounts(spark, table).collect()] == ["2022-09-01"]
    assert read_pagecounts(spark, table, "2021-01-01", "2999-12-31").count() == 3


def test_layout_lets_the_scan_skip(spark, tmp_path):
    """Sorted by key for project filters, with a bloom filter for article filters."""
    rows = spark.range(200_000).select(
        F.concat(F.lit("p"), F.col("id") % 20).alias("project_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("article_name"),
        F.lit(1662004800).cast("long").alias("interval_start_unixtime"),
        F.col("id").cast("int").alias("count"),
        F.lit("2022-09-01").alias("date"),
    )
    table = str(tmp_path / "pq")
    jobs.store_pagecounts(rows, table)
    stored = read_pagecounts(spark, table, last=LAST)
    assert {f.split(".")[-2] for f in stored.inputFiles()} == {"snappy"}
    present = hashlib.sha256(b"77").hexdigest()
    assert reports.hourly_views_by_article(stored, present).collect()[0].pageviews == 77
    absent = hashlib.sha256(b"none").hexdigest()
    assert scanned_rows(stored.where(F.col("article_name") == absent)) == 0
    assert scanned_rows(stored.where(F.col("project_name") == "p3")) < 60_000


def test_a_hot_project_is_written_by_several_tasks(spark, tmp_path):
    """One project holds most of a day; REBALANCE must cut it instead of filling one file."""
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("p"), F.col("id") % 50))
        .otherwise("en")
        .alias("project_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("article_name"),
        F.lit(1662004800).cast("long").alias("interval_start_unixtime"),
        F.lit(1).alias("count"),
        F.lit("2022-09-01").alias("date"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "2m")
    try:
        jobs.store_pagecounts(rows, str(tmp_path / "pq"))
    finally:
        spark.conf.unset(key)
    stored = spark.read.parquet(str(tmp_path / "pq"))
    files = stored.where("project_name = 'en'").select("_metadata.file_name").distinct().count()
    assert files > 3
    assert stored.count() == 400_000


def test_many_projects_do_not_scatter_a_backfill(spark, tmp_path):
    """Files per hour are bounded by the shards, however many projects and tasks there are."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("p"), F.col("id") % 997).alias("project_name"),
        F.col("id").cast("string").alias("article_name"),
        (F.lit(1662004800) + F.col("id") % 6 * 3600).alias("interval_start_unixtime"),
        F.lit(1).alias("count"),
        F.lit("2022-09-01").alias("date"),
    )
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        jobs.store_pagecounts(rows, str(tmp_path / "pq"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    stored = spark.read.parquet(str(tmp_path / "pq"))
    files = stored.groupBy("_batch_id").agg(F.countDistinct("_metadata.file_path").alias("n"))
    # Two shards may hash to the same task, which then writes them as one file.
    assert [1 < r.n <= 8 for r in files.collect()] == [True] * 6
    spread = stored.groupBy("_batch_id", "project_name").agg(
        F.countDistinct("_metadata.file_path").alias("n")
    )
    assert spread.agg(F.max("n")).first()[0] == 1
    assert stored.count() == 60_000


def test_command_line(spark, hourly, daily, tmp_path, capsys):
    pages, media, root = (str(tmp_path / n) for n in ("p", "m", "serving"))
    cli.main(["load-pagecounts", "--source", hourly.folder, "--target", pages,
              "--run-time", RUNS[0], "--until", RUNS[0].replace("T04", "T05")])
    cli.main(["load-mediacounts", "--source", daily.folder, "--target", media,
              "--run-time", "2022-09-01T00:00:00Z", "--row-ids"])
    out = str(tmp_path / "out")
    cli.main(["report", "hourly_views_by_project", "--table", pages, "--project", "de", "--out", out])
    assert [r.pageviews for r in spark.read.parquet(out).collect()] == [1]
    cli.main(["report", "relative_rows_and_views", "--table", pages, "--as-of", "2022-09-04T00:00:00Z"])
    assert "Total Page Views" in capsys.readouterr().out
    cli.main(["ingest-mediacounts", "--source", media, "--root", root])
    target = capsys.readouterr().out.strip().splitlines()[0]
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(SystemExit):
        cli.main(["report", "hourly_views_by_article", "--table", pages])


def test_external_views_answer_sql(spark, hourly, daily, tmp_path):
    pages, media = str(tmp_path / "p"), str(tmp_path / "m")
    jobs.store_pagecounts(jobs.load_pagecounts(spark, RUNS, hourly.folder), pages)
    jobs.store_mediacounts(jobs.load_mediacounts(spark, ["2022-09-01T00:00:00Z"], daily.folder), media)
    register_external(spark, pages, media, "ext_", last=LAST)
    got = sql.run_report(spark, "hourly_views_by_project", "ext_pagecounts", last=LAST, project="en")
    assert [r.pageviews for r in got.collect()] == [7, 6]
    got = sql.run_report(spark, "daily_media_totals", "ext_mediacounts", last=LAST)
    assert [r.n_imgs_served for r in got.collect()] == [7]
    hostile = "en' OR '1'='1"
    got = sql.run_report(spark, "hourly_views_by_project", "ext_pagecounts", last=LAST, project=hostile)
    assert got.count() == 0


def test_dump_files_to_served_reports(spark, hourly, tmp_path):
    """Load, ingest and report; then a late hour and a re-run of a served one."""
    files, root = str(tmp_path / "pq"), str(tmp_path / "serving")
    ingest = FileIngest(PAGECOUNTS, files, root)

    def step(runs):
        jobs.store_pagecounts(jobs.load_pagecounts(spark, runs, hourly.folder), files)
        ingest.run_available(spark)
        served = read_pagecounts(spark, ingest.target, last=LAST)
        stored = read_pagecounts(spark, files, last=LAST)
        return [
            {r.hour.hour: r.pageviews for r in reports.hourly_total_views(t).collect()}
            for t in (served, stored)
        ]

    assert step(RUNS[1:]) == [{5: 6}, {5: 6}]
    assert step(RUNS[:1]) == [{4: 8, 5: 6}, {4: 8, 5: 6}]
    hourly("2022090105", "en A 400 0", "en C 1 0")
    # The files now hold the re-run; the served table keeps the counts written first.
    assert step(RUNS[1:]) == [{4: 8, 5: 7}, {4: 8, 5: 401}]
