import time
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from hourtally import schemas
from hourtally.operators.ingest import MEDIACOUNTS, PAGECOUNTS, keyed
from hourtally.plans import sql
from hourtally.sources.sinks import write_partitioned
from hourtally.sources.tables import read_dates
from hourtally.streaming.file_ingest import FileIngest


@pytest.fixture
def ingest(tmp_path):
    return FileIngest(PAGECOUNTS, str(tmp_path / "arrivals"), str(tmp_path / "serving"))


def arrive(spark, ingest, *rows):
    df = spark.createDataFrame([(*r, "1970-01-01") for r in rows], schemas.PAGECOUNTS_NORMAL)
    write_partitioned(df, ingest.source)


def stored(spark, ingest):
    df = read_dates(spark, ingest.target, ingest.table.stored, None)
    return {tuple(r) for r in df.select(*ingest.table.columns.names).collect()}


def test_new_files_are_loaded_once(spark, ingest):
    arrive(spark, ingest, ("en", "A", 0, 1), ("en", None, 0, 5))
    for _ in range(2):
        ingest.run_available(spark)
        assert stored(spark, ingest) == {("en", "A", 0, 1), ("en", None, 0, 5)}
    arrive(spark, ingest, ("en", "A", 0, 2), ("en", "B", 3600, 3))
    ingest.run_available(spark)
    assert stored(spark, ingest) == {("en", "A", 0, 1), ("en", None, 0, 5), ("en", "B", 3600, 3)}


def test_backlog_in_small_batches_gives_the_same_table(spark, ingest):
    for n in range(4):
        arrive(spark, ingest, ("en", "A", 0, n), ("en", f"B{n}", 0, n))
    small = replace(ingest, max_files=1)
    small.run_available(spark)
    batches = read_dates(spark, small.target, PAGECOUNTS.stored, None).select("_batch_id").distinct()
    assert batches.count() == 4
    assert stored(spark, small) == {("en", "A", 0, 0), *(("en", f"B{n}", 0, n) for n in range(4))}
    # One batch of all files keeps the same rows: the first file wins there as well.
    whole = replace(ingest, root=f"{ingest.root}-whole")
    whole.run_available(spark)
    assert stored(spark, whole) == stored(spark, small)


def test_runs_until_stopped(spark, ingest):
    arrive(spark, ingest, ("en", "A", 0, 1))
    query = ingest.start(spark, every="200 milliseconds")
    try:
        query.processAllAvailable()
        arrive(spark, ingest, ("en", "B", 0, 2))
        deadline = time.time() + 30
        while ("en", "B", 0, 2) not in stored(spark, ingest) and time.time() < deadline:
            time.sleep(0.2)
        assert query.isActive
    finally:
        query.stop()
    assert stored(spark, ingest) == {("en", "A", 0, 1), ("en", "B", 0, 2)}


def test_a_batch_cut_off_after_its_write_is_repeated(spark, ingest, monkeypatch):
    """The write is done but the checkpoint does not know: the restart runs the batch again."""
    from hourtally.streaming import file_ingest

    arrive(spark, ingest, ("en", "A", 0, 1), ("en", None, 0, 5))
    ingest.run_available(spark)
    arrive(spark, ingest, ("en", "A", 0, 2), ("en", None, 0, 6), ("en", "B", 0, 7))
    real = file_ingest.ingest_batch

    def cut_off(*args):
        real(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(file_ingest, "ingest_batch", cut_off)
    with pytest.raises(StreamingQueryException):
        ingest.run_available(spark)
    monkeypatch.setattr(file_ingest, "ingest_batch", real)
    ingest.run_available(spark)
    assert stored(spark, ingest) == {
        ("en", "A", 0, 1), ("en", None, 0, 5), ("en", None, 0, 6), ("en", "B", 0, 7)
    }
    rows = read_dates(spark, ingest.target, PAGECOUNTS.stored, None)
    assert rows.count() == 4


def test_a_replaced_definition_serves_under_the_same_name(spark, ingest):
    spark.sql("CREATE DATABASE IF NOT EXISTS served")
    ingest = replace(ingest, database="served")
    ingest.declare(spark)
    arrive(spark, ingest, ("en", "A", 0, 1))

    def served():
        rows = sql.run_report(spark, "hourly_total_views", "served.pagecounts", "1970-01-01")
        return [r.pageviews for r in rows.collect()]

    ingest.run_available(spark)
    assert served() == [1]
    arrive(spark, ingest, ("en", "A", 0, 5), ("en", "B", 0, 2))
    ingest.run_available(spark)
    assert served() == [3]
    again = replace(ingest, generation=1)
    again.run_available(spark)  # reads both files again; what is served stays
    again.declare(spark, "served")
    assert served() == [3]
    assert stored(spark, ingest) == {("en", "A", 0, 1), ("en", "B", 0, 2)}
    arrive(spark, ingest, ("en", "A", 0, 9), ("en", "C", 0, 4))
    again.run_available(spark)
    assert stored(spark, again) == {("en", "A", 0, 1), ("en", "B", 0, 2), ("en", "C", 0, 4)}
    ids = {r[0] for r in read_dates(spark, again.target, PAGECOUNTS.stored, None).select("_batch_id").collect()}
    assert len(ids) == 3 and max(ids) >= 1 << 40


def test_a_changed_definition_gets_a_checkpoint_of_its_own(ingest):
    again = FileIngest(PAGECOUNTS, ingest.source, ingest.root)
    assert again.checkpoint == ingest.checkpoint
    others = [
        replace(ingest, generation=1),
        replace(ingest, source="/elsewhere"),
        replace(ingest, table=keyed(PAGECOUNTS, "article_name")),
        replace(ingest, table=MEDIACOUNTS),
        replace(ingest, table=replace(MEDIACOUNTS, mapping=schemas.MEDIACOUNTS_FULL_MAPPING)),
    ]
    folders = {i.folder for i in [ingest, *others]}
    assert len(folders) == len(others) + 1
    assert replace(ingest, max_files=5).folder == ingest.folder
