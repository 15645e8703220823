"""One writer for a target, and partial sums beside a table."""

import json
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from hourtally import schemas
from hourtally.functions.timegrain import HOUR, day_string
from hourtally.operators.ingest import MEDIACOUNTS, PAGECOUNTS, ingest_batch, with_totals
from hourtally.plans import reports
from hourtally.plans.jobs import store_pagecounts
from hourtally.sources.compaction import batches
from hourtally.sources.files import Store
from hourtally.sources.tables import read_dates
from hourtally.streaming.claims import Claim, ClaimedElsewhere
from hourtally.streaming.file_ingest import FileIngest

NOON = 1662033600
SUMMED = with_totals(PAGECOUNTS, "interval_start_unixtime", "project_name", measures=["count"])
(TOTALS,) = SUMMED.totals


def pages(spark, *rows):
    full = [(p, t, e, n, None if e is None else day_string(e)) for p, t, e, n in rows]
    return spark.createDataFrame(full, schemas.PAGECOUNTS_NORMAL)


@pytest.fixture
def ingest(tmp_path):
    return FileIngest(PAGECOUNTS, str(tmp_path / "in"), str(tmp_path / "out"))


def titles(spark, ingest):
    rows = read_dates(spark, ingest.target, PAGECOUNTS.stored, None).collect()
    return sorted(r.article_name for r in rows)


def elsewhere(spark, ingest):
    """As if another driver had claimed the target."""
    claim = ingest._claim(spark)
    text = json.loads(Store(spark, claim.path).text(claim.path)) | {"application": "another"}
    Store(spark, claim.path).remove(claim.path)
    Store(spark, claim.path).create(claim.path, json.dumps(text))
    return claim


# --- one writer ---------------------------------------------------------------------


def test_a_second_starter_is_refused(spark, ingest):
    query = ingest.start(spark, every="200 milliseconds")
    try:
        with pytest.raises(ClaimedElsewhere):
            ingest.start(spark)
        with pytest.raises(ClaimedElsewhere):  # nor one with another definition
            replace(ingest, generation=5).run_available(spark)
    finally:
        query.stop()
    store_pagecounts(pages(spark, ("en", "A", NOON, 1)), ingest.source)
    ingest.run_available(spark)  # stopped here, so it is known to be over
    ingest.run_available(spark)
    assert titles(spark, ingest) == ["A"]


def test_a_claim_of_another_driver_holds_until_it_is_released(spark, ingest):
    claim = elsewhere(spark, ingest)
    with pytest.raises(ClaimedElsewhere, match="another"):
        ingest.run_available(spark)
    claim.release(spark)
    ingest.run_available(spark)


def test_a_driver_that_was_taken_over_stops_before_it_writes(spark, ingest):
    query = ingest.start(spark, every="100 milliseconds")
    store_pagecounts(pages(spark, ("en", "A", NOON, 1)), ingest.source)
    query.processAllAvailable()
    taken = replace(ingest, take_over=True, generation=1)
    taken.run_available(spark)
    store_pagecounts(pages(spark, ("en", "B", NOON, 1)), ingest.source)
    with pytest.raises(StreamingQueryException, match="taken over"):
        query.processAllAvailable()
    query.stop()
    assert titles(spark, ingest) == ["A"]
    taken.run_available(spark)
    assert titles(spark, ingest) == ["A", "B"]


def test_of_two_that_start_at_once_one_is_refused(spark, ingest, monkeypatch):
    folder = ingest._claims
    number = Claim.newest(spark, folder)[0]
    Claim.take(spark, folder, {}).release(spark)
    monkeypatch.setattr(Claim, "newest", classmethod(lambda cls, *_: (number, {})))
    with pytest.raises(ClaimedElsewhere, match="same moment"):
        Claim.take(spark, folder, {})


def test_a_claim_that_is_being_written_holds(spark, ingest):
    Store(spark, ingest.root).create(f"{ingest._claims}/000000000001.json", "")
    with pytest.raises(ClaimedElsewhere):
        ingest.run_available(spark)
    replace(ingest, take_over=True).run_available(spark)


def test_a_start_that_fails_gives_its_claim_back(spark, ingest, monkeypatch):
    monkeypatch.setattr(FileIngest, "_first_batch_id", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.run_available(spark)
    monkeypatch.undo()
    ingest.run_available(spark)


def test_a_replaced_pipeline_starts_over_above_the_last(spark, ingest):
    store_pagecounts(pages(spark, ("en", "A", NOON, 1)), ingest.source)
    ingest.run_available(spark)
    one = ingest.replaced(spark)
    one.run_available(spark)
    two = ingest.replaced(spark)
    assert (one.generation, two.generation) == (1, 2) and two.checkpoint != one.checkpoint
    assert titles(spark, ingest) == ["A"]


# --- totals --------------------------------------------------------------------------


def compare(spark, target):
    rows = read_dates(spark, target, PAGECOUNTS.stored, None)
    sums = TOTALS.read(spark, target, PAGECOUNTS.stored)
    for report, *args in (
        (reports.hourly_total_views,), (reports.hourly_views_by_project, "de"),
        (reports.hourly_rows_and_views, NOON, NOON + HOUR), (reports.hourly_rows_and_views, 0, NOON, "en"),
    ):
        got, want = report(sums, *args), report(rows, *args)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    return sums


def test_totals_answer_like_the_table(spark, tmp_path):
    target = str(tmp_path / "t")
    first = pages(spark, ("en", "A", NOON, 1), ("en", "B", NOON, 2), ("de", "A", NOON + HOUR, None), ("de", None, None, 7))
    ingest_batch(first, 0, PAGECOUNTS, target)
    second = pages(spark, ("en", "A", NOON, 9), ("de", "C", NOON, 4), ("de", "A", NOON + 24 * HOUR, 5), ("en", None, NOON, None))
    ingest_batch(second, 1, SUMMED, target)  # what was there before is entered as well
    compare(spark, target)
    for _ in range(2):
        ingest_batch(second, 1, SUMMED, target)
    sums = compare(spark, target)
    assert all("/_totals/" in f for f in sums.inputFiles())
    assert reports.hourly_total_views(sums).count() == 4


def test_totals_of_media_and_of_no_rows(spark, tmp_path):
    table = with_totals(MEDIACOUNTS, "date", measures=["total_response_bytes", "total_transfers_all"])
    target = str(tmp_path / "m")
    rows = [(f"/f{i}", d, *[i] * 9, d) for i in range(5) for d in ("2022-09-01", "2022-09-02")]
    media = spark.createDataFrame(rows, schemas.MEDIACOUNTS_NORMAL)
    ingest_batch(media.where("false"), 0, table, target)
    ingest_batch(media, 1, table, target)
    ingest_batch(media, 2, table, target)
    sums = table.totals[0].read(spark, target, table.stored)
    got = [tuple(r) for r in reports.daily_media_totals(sums).collect()]
    assert got == [(d, 20 / 10**12, 20) for d in ("2022-09-01", "2022-09-02")]


def test_totals_follow_a_compaction_and_later_replays(spark, tmp_path):
    ingest = FileIngest(SUMMED, str(tmp_path / "in"), str(tmp_path / "out"), max_files=1, most_directories=2)
    for b in range(6):
        store_pagecounts(pages(spark, ("en", "A", NOON + b * HOUR, b), ("de", "B", NOON + b * HOUR, 1)), ingest.source)
    ingest.run_available(spark)
    path = TOTALS.path(ingest.target)
    assert len(batches(spark, path, "2022-09-01")) <= 2
    compare(spark, ingest.target)
    for b in (1, 5):
        again = pages(spark, ("en", "A", NOON + b * HOUR, b), ("de", "B", NOON + b * HOUR, 1))
        ingest_batch(again, b, SUMMED, ingest.target)
    assert compare(spark, ingest.target).agg({"count": "sum"}).first()[0] == 15 + 6
