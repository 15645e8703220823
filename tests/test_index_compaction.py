"""Indexes beside a serving table, and compaction of its days."""

import random

import pytest

from hourtally import schemas
from hourtally.functions.timegrain import HOUR, day_string
from hourtally.operators.ingest import MEDIACOUNTS, PAGECOUNTS, indexed, ingest_batch, keyed, read_indexed
from hourtally.plans import reports, sql
from hourtally.sources import compaction
from hourtally.sources.compaction import batches, closed_days, compact_days, finish_compactions
from hourtally.sources.files import Store
from hourtally.sources.sinks import BATCH
from hourtally.sources.tables import create_tables, read_dates
from hourtally.streaming.file_ingest import FileIngest

NOON = 1662033600  # 2022-09-01 12:00
DAY = 24 * HOUR
ARTICLES = indexed(PAGECOUNTS, "article_name", buckets=8)


def pages(spark, *rows):
    full = [("en", title, epoch, n, None if epoch is None else day_string(epoch)) for title, epoch, n in rows]
    return spark.createDataFrame(full, schemas.PAGECOUNTS_NORMAL)


def media(spark, *rows):
    return spark.createDataFrame([(f, d, *[n] * 9, d) for f, d, n in rows], schemas.MEDIACOUNTS_NORMAL)


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "target")


def stored(spark, target, table=PAGECOUNTS):
    rows = read_dates(spark, target, table.stored, None).select(*table.columns.names).collect()
    return sorted(map(tuple, rows), key=repr)


def compact(spark, target, days, table=PAGECOUNTS, **more):
    return compact_days(spark, target, table.stored, days, 1, table.shard_by, table.sort_by, table.lookup, **more)


# --- indexes ----------------------------------------------------------------------


def test_a_report_on_one_article_opens_its_directories(spark, target):
    for b in range(12):
        day = NOON + b * DAY
        rows = [(f"t{b}", day, b), (f"t{b}", day + HOUR, 1), ("every", day, 5), (None, day, 1)]
        ingest_batch(pages(spark, *rows), b, ARTICLES, target)
    found = read_indexed(spark, ARTICLES, target, ["article_name"], "t7")
    assert {f.split("/target/")[1].rsplit("/", 1)[0] for f in found.inputFiles()} == {"date=2022-09-08/_batch_id=7"}
    got = reports.hourly_views_by_article(found, "t7").collect()
    assert [(r.hour.hour, r.pageviews) for r in got] == [(12, 7), (13, 1)]
    assert read_indexed(spark, ARTICLES, target, ["article_name"], "every").count() == 12
    assert read_indexed(spark, ARTICLES, target, ["article_name"], "none").count() == 0
    for b in (3, 11):  # replays leave the index as it was
        ingest_batch(pages(spark, ("every", NOON + b * DAY, 5), (f"t{b}", NOON + b * DAY, b)), b, ARTICLES, target)
    assert read_indexed(spark, ARTICLES, target, ["article_name"], "every").count() == 12


def test_an_index_that_comes_later_knows_what_is_stored(spark, target):
    ingest_batch(pages(spark, ("old", NOON, 1), ("both", NOON, 2)), 0, PAGECOUNTS, target)
    ingest_batch(pages(spark, ("new", NOON, 3), ("both", NOON + HOUR, 4)), 1, ARTICLES, target)
    for title, n in (("old", 1), ("new", 1), ("both", 2)):
        assert read_indexed(spark, ARTICLES, target, ["article_name"], title).count() == n


def test_a_key_without_the_interval_reads_the_buckets_of_its_batch(spark, target):
    table = keyed(MEDIACOUNTS, "filename")
    index = table.key_index
    rng = random.Random(3)
    expected, rows_of = {}, []
    for b in range(6):
        rows = [(f"/f{rng.randrange(60)}", day_string(NOON + rng.randrange(9) * DAY), b * 100 + i) for i in range(25)]
        rows_of.append(rows)
        first = {}
        for f, d, n in rows:  # within a batch the greatest (date, measures) is kept
            first[f] = max(first.get(f, ("", 0)), (d, n))
        for f, v in first.items():
            expected.setdefault(f, v)
        ingest_batch(media(spark, *rows), b, table, target)
    got = {(r.filename, r.date, r.total_transfers_all) for r in read_dates(spark, target, table.stored, None).collect()}
    assert got == {(f, *v) for f, v in expected.items()}
    ingest_batch(media(spark, *rows_of[2]), 2, table, target)  # a replay
    again = {(r.filename, r.date, r.total_transfers_all) for r in read_dates(spark, target, table.stored, None).collect()}
    assert again == got
    one = media(spark, ("/f1", "2022-09-01", 1))
    read = index.of_rows(spark, target, table.stored, one)
    assert len({f.split("_bucket=")[1].split("/")[0] for f in read.inputFiles()}) == 1
    every = index.read(spark, target, table.stored, range(index.buckets))
    assert len({f.split("_bucket=")[1].split("/")[0] for f in every.inputFiles()}) > 20


# --- compaction ---------------------------------------------------------------------


def filled(spark, target, table=PAGECOUNTS, n=5, database=None):
    rows = []
    for b in range(n):
        batch = pages(spark, ("A", NOON, b), (f"t{b}", NOON, b), (f"t{b}", NOON + DAY, b), (None, NOON, b), ("x", None, b))
        ingest_batch(batch, b, table, target, database)
        rows.append(batch)
    return rows


def test_replays_after_a_compaction_change_nothing(spark, target):
    rows = filled(spark, target)
    before = stored(spark, target)
    assert compact(spark, target, ["2022-09-01", "2022-09-03"]) == ["2022-09-01"]
    assert batches(spark, target, "2022-09-01") == [4] and batches(spark, target, "2022-09-02") == [0, 1, 2, 3, 4]
    assert stored(spark, target) == before
    for b in (0, 2, 4):
        ingest_batch(rows[b], b, PAGECOUNTS, target)
        assert stored(spark, target) == before
    ingest_batch(pages(spark, ("A", NOON, 99), ("t1", NOON, 99), ("late", NOON, 1)), 5, PAGECOUNTS, target)
    assert stored(spark, target) == sorted([*before, ("en", "late", NOON, 1)], key=repr)
    assert compact(spark, target, ["2022-09-01", "2022-09-02"]) == ["2022-09-01", "2022-09-02"]
    assert closed_days(spark, target) == {"2022-09-01": 5, "2022-09-02": 4}
    assert compact(spark, target, ["2022-09-01", "2022-09-02"]) == []
    assert stored(spark, target) == sorted([*before, ("en", "late", NOON, 1)], key=repr)


@pytest.mark.parametrize("lost_after", range(6))
def test_a_compaction_cut_off_anywhere_is_completed(spark, target, monkeypatch, lost_after):
    filled(spark, target, n=3)
    before = stored(spark, target)
    steps = []

    def failing(real):
        def step(self, *args):
            if len(steps) == lost_after:
                raise RuntimeError("driver lost")
            steps.append(args)
            return real(self, *args)

        return step

    with monkeypatch.context() as patch:
        for name in ("create", "remove", "move"):
            patch.setattr(Store, name, failing(getattr(Store, name)))
        with pytest.raises(RuntimeError):
            compact(spark, target, ["2022-09-01", "2022-09-02"])
    finish_compactions(spark, target)
    assert stored(spark, target) == before
    finish_compactions(spark, target)
    compact(spark, target, ["2022-09-01", "2022-09-02"])
    assert stored(spark, target) == before
    assert batches(spark, target, "2022-09-01") == batches(spark, target, "2022-09-02") == [2]


def test_the_pipeline_keeps_days_at_few_directories(spark, tmp_path):
    ingest = FileIngest(ARTICLES, str(tmp_path / "in"), str(tmp_path / "out"), max_files=1, most_directories=2)
    from hourtally.plans.jobs import store_pagecounts

    for b in range(7):
        store_pagecounts(pages(spark, ("A", NOON + b * HOUR, b), (f"t{b}", NOON + b * HOUR, b)), ingest.source)
    ingest.run_available(spark)
    assert len(batches(spark, ingest.target, "2022-09-01")) <= 2
    assert len(stored(spark, ingest.target)) == 14
    # The index names directories that compactions have replaced.
    assert read_indexed(spark, ARTICLES, ingest.target, ["article_name"], "A").count() == 7
    assert read_indexed(spark, ARTICLES, ingest.target, ["article_name"], "t1").count() == 1
    assert ingest.compact(spark) == ["2022-09-01"] or len(batches(spark, ingest.target, "2022-09-01")) == 1
    assert len(stored(spark, ingest.target)) == 14


def test_the_catalog_follows_a_compaction(spark, tmp_path):
    create_tables(spark, "compacted", str(tmp_path))
    target = str(tmp_path / "pagecounts")
    filled(spark, target, n=3, database="compacted")

    def served():
        found = sql.run_report(spark, "hourly_total_views", "compacted.pagecounts", "2022-09-01", "2022-09-02")
        return [r.pageviews for r in found.collect()]

    before = served()
    compact(spark, target, ["2022-09-01"], database="compacted", name="pagecounts")
    assert served() == before
    parts = {r.partition for r in spark.sql("SHOW PARTITIONS compacted.pagecounts").collect()}
    assert {p for p in parts if "2022-09-01" in p} == {f"date=2022-09-01/{BATCH}=2"}
    spark.sql("DROP DATABASE compacted CASCADE")


def test_nothing_to_compact(spark, target):
    finish_compactions(spark, target)
    assert compact(spark, target, ["2022-09-01"]) == [] and compaction.stored_days(spark, target) == []
    assert closed_days(spark, target) == {}
