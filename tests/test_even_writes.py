"""Gathered frames are written by more tasks than cores, and media counts are grouped on dates."""

import re
from datetime import datetime
from pathlib import Path

import pytest

from hourtally import standins
from hourtally.session import evenly_written
from hourtally.sources.sinks import write_replacing

KEY = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


@pytest.fixture
def many_partitions(spark):
    """As on a cluster: many shuffle partitions, none of which AQE has to merge for being tiny."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def lines(spark, days=40, of_day=20):
    rows = [
        (n, 1, float(n % 50), n * 1.25, "A", "O", datetime(1996, 1 + d // 28, 1 + d % 28, 3))
        for d in range(days)
        for n in range(of_day)
    ]
    rows += [(5, 1, 2.0, 3.0, "A", "O", None), (5, 7, 4.0, 1.0, "R", "F", None)]
    names = "l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"
    return spark.createDataFrame(rows, f"{names}, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def tasks_and_days(path, days):
    files = [f for f in Path(path).rglob("part-*") if not f.name.endswith(".crc")]
    assert len(files) == days  # a directory's rows stay together
    return {f.name.split("-")[1] for f in files}, {f.relative_to(path).parts[0] for f in files}


def test_raw_media_files_are_written_by_more_tasks_than_cores(spark, tmp_path, many_partitions):
    path = str(tmp_path / "raw")
    standins.write_raw_mediacounts(standins.media_requests(lines(spark)), path)
    tasks, days = tasks_and_days(path, 41)
    assert len(tasks) >= 2 * spark.sparkContext.defaultParallelism
    assert "load_day=1996-02-12" in days and "load_day=__HIVE_DEFAULT_PARTITION__" in days


def test_a_batch_is_written_by_more_tasks_than_cores(spark, tmp_path, many_partitions):
    path = str(tmp_path / "stored")
    counts = standins.mediacounts(lines(spark)).drop("_date")
    assert len(write_replacing(counts, path, partitions=("date",), sort_by=("filename",))) == 41
    assert len(tasks_and_days(path, 41)[0]) >= 2 * spark.sparkContext.defaultParallelism


def test_the_setting_is_put_back(spark):
    with evenly_written(spark):
        assert int(spark.conf.get(KEY)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(KEY, None) is None
    spark.conf.set(KEY, "3")
    with pytest.raises(ZeroDivisionError), evenly_written(spark):
        1 / 0
    assert spark.conf.get(KEY) == "3"
    spark.conf.unset(KEY)


def test_media_counts_are_grouped_on_dates(spark, plan):
    counts = standins.mediacounts(lines(spark, days=2, of_day=3))
    moved = plan(counts).split("Exchange")[1]
    assert "hashpartitioning(l_partkey" in moved and not re.search("as string", moved)
    got = {(r["filename"], r["_date"], r["date"], r["total_transfers_all"]) for r in counts.collect()}
    days = [("1996-01-01", n) for n in range(3)] + [("1996-01-02", n) for n in range(3)]
    assert got == {(f"part/{n}", d, d, n) for d, n in days} | {("part/5", None, None, 6)}
