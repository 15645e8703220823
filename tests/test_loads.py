"""Load records: what follows them, which intervals they miss, and external tables in the catalog."""

import bz2
import gzip
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest

from hourtally import __main__ as cli
from hourtally import schemas
from hourtally.functions.timegrain import HOUR, day_string
from hourtally.operators.ingest import PAGECOUNTS
from hourtally.plans import jobs, sql
from hourtally.sources import paths
from hourtally.sources.loads import loaded_intervals, new_load, read_loaded, read_records, write_record
from hourtally.sources.tables import declare_external, find_loads, read_dates, read_pagecounts
from hourtally.streaming import file_ingest
from hourtally.streaming.file_ingest import FileIngest

NOON = 1662033600  # 2022-09-01 12:00
FIRST, LAST = "2022-09-02T12:00:00Z", "2022-09-02T15:00:00Z"


def counts(spark, *rows):
    full = [("en", title, epoch, n, day_string(epoch)) for title, epoch, n in rows]
    return spark.createDataFrame(full, schemas.PAGECOUNTS_NORMAL)


def table(spark, path):
    rows = read_dates(spark, path, schemas.PAGECOUNTS_EXTERNAL, None).collect()
    return sorted((r.article_name, r.interval_start_unixtime, r["count"]) for r in rows)


@pytest.fixture
def ingest(tmp_path):
    return FileIngest(PAGECOUNTS, str(tmp_path / "pages"), str(tmp_path / "serving"))


def served(spark, ingest):
    rows = read_dates(spark, ingest.target, PAGECOUNTS.stored, None).collect()
    return sorted((r.article_name, r.interval_start_unixtime, r["count"]) for r in rows)


# --- records and the stream over them ---------------------------------------------


def test_a_record_names_the_directories_of_its_load(spark, tmp_path):
    path = str(tmp_path / "pages")
    assert read_records(spark, path).collect() == []
    jobs.store_pagecounts(counts(spark, ("A", NOON, 1), ("A", NOON + 24 * HOUR, 2)), path, intervals=[NOON])
    jobs.store_pagecounts(counts(spark, ("B", NOON + HOUR, 3)), path)
    one, two = read_records(spark, path).orderBy("stored_at").collect()
    assert one.directories == [f"date=2022-09-01/_batch_id={NOON}", f"date=2022-09-02/_batch_id={NOON + 24 * HOUR}"]
    assert one.intervals == [NOON] and two.intervals == [] and one.load != two.load
    assert [r.article_name for r in read_loaded(spark, path, [two], schemas.PAGECOUNTS_NORMAL).collect()] == ["B"]
    # Records are no data to readers of the table.
    assert read_pagecounts(spark, path, last="2030-01-01").count() == 3 == spark.read.parquet(path).count()


def test_a_load_without_rows_leaves_a_record(spark, tmp_path, ingest):
    jobs.store_pagecounts(counts(spark, ("A", NOON, 1)).where("count > 5"), ingest.source, intervals=[NOON])
    assert [r.directories for r in read_records(spark, ingest.source).collect()] == [[]]
    ingest.run_available(spark)
    assert served(spark, ingest) == []


def test_rows_without_an_hour_and_odd_dates_are_followed(spark, tmp_path):
    rows = [("/f", None, 1), ("/g", "a=b/{c},*?[d]", 2), ("/h", "2022-09-01", 3)]
    media = [(f, d, *[n] * 9, d) for f, d, n in rows]
    path = str(tmp_path / "media")
    jobs.store_mediacounts(spark.createDataFrame(media, schemas.MEDIACOUNTS_NORMAL), path)
    (record,) = read_records(spark, path).collect()
    got = read_loaded(spark, path, [record], schemas.MEDIACOUNTS_NORMAL).collect()
    assert sorted((r.filename, r._date) for r in got) == [(f, d) for f, d, _ in rows]


def test_a_trigger_lists_records_and_a_batch_opens_its_own_directories(spark, ingest, monkeypatch):
    opened = []
    real = file_ingest.ingest_batch
    monkeypatch.setattr(
        file_ingest, "ingest_batch", lambda rows, *args: (opened.append(rows.inputFiles()), real(rows, *args))
    )
    query = ingest.start(spark, every="100 milliseconds")  # before the first load
    try:
        for day in range(3):
            jobs.store_pagecounts(counts(spark, ("A", NOON + day * 24 * HOUR, day)), ingest.source)
            query.processAllAvailable()
        source = query.lastProgress["sources"][0]["description"]
    finally:
        query.stop()
    assert source.endswith("/pages/_loads]")
    assert [{f.split("/date=")[1][:10] for f in files} for files in opened] == [
        {"2022-09-01"}, {"2022-09-02"}, {"2022-09-03"},
    ]
    assert len(served(spark, ingest)) == 3


def test_a_load_that_was_replaced_before_it_was_read_is_passed_over(spark, ingest):
    jobs.store_pagecounts(counts(spark, ("A", NOON, 1), ("gone", NOON, 1)), ingest.source)
    jobs.store_pagecounts(counts(spark, ("A", NOON, 2)), ingest.source)
    replace(ingest, max_files=1).run_available(spark)
    assert served(spark, ingest) == [("A", NOON, 2)]


def test_a_late_load_needs_no_age_limit(spark, ingest):
    """However old the hour is, and however long ago the other loads were."""
    jobs.store_pagecounts(counts(spark, ("new", NOON + 900 * 24 * HOUR, 1)), ingest.source)
    ingest.run_available(spark)
    jobs.store_pagecounts(counts(spark, ("old", 0, 1)), ingest.source)
    ingest.run_available(spark)
    assert [r[0] for r in served(spark, ingest)] == ["new", "old"]


def test_files_of_other_origin_are_listed(spark, ingest):
    counts(spark, ("A", NOON, 1)).write.partitionBy("date").parquet(ingest.source)
    ingest.run_available(spark)
    assert served(spark, ingest) == []
    listed = replace(ingest, listed=True)
    assert listed.checkpoint != ingest.checkpoint
    listed.run_available(spark)
    assert served(spark, ingest) == [("A", NOON, 1)]


def test_a_batch_of_many_loads(spark, tmp_path, ingest):
    path = ingest.source
    jobs.store_pagecounts(counts(spark, *((f"t{n}", NOON + n * HOUR, n) for n in range(300))), path)
    records = read_records(spark, path).collect() + [
        {"load": new_load(), "directories": [f"date=2022-09-01/_batch_id={n}"]} for n in range(500)
    ]
    assert read_loaded(spark, path, records, schemas.PAGECOUNTS_NORMAL).count() == 300


# --- what was not loaded yet -------------------------------------------------------


@pytest.fixture
def dumps(tmp_path):
    folder = tmp_path / "gz"
    folder.mkdir()

    def put(stamp, *lines):
        (folder / f"{stamp}.gz").write_bytes(gzip.compress("\n".join(lines).encode()))

    put.folder = str(folder)
    return put


def load(spark, dumps, target, **more):
    return jobs.load_missing_pagecounts(spark, FIRST, LAST, dumps.folder, target, **more)


def test_an_absent_hour_is_loaded_when_it_comes(spark, dumps, tmp_path):
    target = str(tmp_path / "pages")
    assert load(spark, dumps, target) == []
    dumps("2022090112", "en A 1 0")
    dumps("2022090114", "en A 3 0")
    assert load(spark, dumps, target) == [NOON, NOON + 2 * HOUR]
    assert load(spark, dumps, target) == []
    assert jobs.missing_intervals(spark, target, NOON, NOON + 3 * HOUR, HOUR) == [NOON + HOUR, NOON + 3 * HOUR]
    dumps("2022090113", "en A 2 0")
    dumps("2022090112", "en A 9 0")  # loaded before: not read again
    dumps("2022090115")  # there, but empty
    assert load(spark, dumps, target) == [NOON + HOUR, NOON + 3 * HOUR]
    assert load(spark, dumps, target) == []
    assert table(spark, target) == [("A", NOON, 1), ("A", NOON + HOUR, 2), ("A", NOON + 2 * HOUR, 3)]
    ledger = loaded_intervals(spark, target).groupBy("interval").count().collect()
    assert sorted(map(tuple, ledger)) == [(NOON + n * HOUR, 1) for n in range(4)]


def test_a_load_cut_off_before_its_record_is_done_again(spark, dumps, tmp_path, monkeypatch):
    from hourtally.sources import sinks

    target = str(tmp_path / "pages")
    for n in range(4):
        dumps(f"20220901{12 + n}", f"en A {n} 0")
    calls = []

    def lost(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        write_record(*args)

    monkeypatch.setattr(sinks, "write_record", lost)
    with pytest.raises(RuntimeError):
        load(spark, dumps, target, at_once=1)
    monkeypatch.setattr(sinks, "write_record", write_record)
    assert load(spark, dumps, target, at_once=2) == [NOON + n * HOUR for n in (1, 2, 3)]
    assert table(spark, target) == [("A", NOON + n * HOUR, n) for n in range(4)]


def test_dumps_in_folders_of_parts(spark, tmp_path):
    for hour, part, line in ((12, 0, "en A 1 0"), (12, 1, "en B 2 0"), (14, 0, "en A 3 0")):
        folder = tmp_path / "in" / f"load_hour=20220901{hour}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{part}.gz").write_bytes(gzip.compress(line.encode()))
    layout = paths.FileLayout("", "load_hour=%Y%m%d%H", parts=True)
    target = str(tmp_path / "pages")
    args = spark, FIRST, LAST, str(tmp_path / "in"), target
    assert jobs.load_missing_pagecounts(*args, layout=layout) == [NOON, NOON + 2 * HOUR]
    assert table(spark, target) == [("A", NOON, 1), ("A", NOON + 2 * HOUR, 3), ("B", NOON, 2)]


def test_missing_days_and_the_command_line(spark, dumps, tmp_path, capsys):
    folder = tmp_path / "bz"
    folder.mkdir()

    def put(day, n):
        row = "\t".join(map(str, ("/f", *[n] * 24)))
        (folder / f"mediacounts.{day}.v00.tsv.bz2").write_bytes(bz2.compress(row.encode()))

    put("2022-08-30", 1)
    target = str(tmp_path / "media")
    command = ["load-mediacounts", "--source", str(folder), "--target", target, "--missing",
               "--run-time", "2022-09-01T00:00:00Z", "--until", "2022-09-03T05:00:00Z"]
    cli.main(command)
    put("2022-09-01", 3)
    cli.main(command)
    cli.main(command)
    assert capsys.readouterr().out.split("\n")[:3] == ["1 loaded", "1 loaded", "0 loaded"]
    days = spark.read.parquet(target).groupBy("_date").sum("total_transfers_all").collect()
    assert sorted(map(tuple, days)) == [("2022-08-30", 1), ("2022-09-01", 3)]


# --- external tables in the catalog -------------------------------------------------


@pytest.fixture
def external(spark, tmp_path):
    name = f"ext_{tmp_path.name}".replace("-", "_")
    declare_external(spark, name, str(tmp_path / "pages"), str(tmp_path / "media"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def hours(spark, name, **dates):
    found = sql.run_report(spark, "hourly_total_views", f"{name}.pagecounts", **dates)
    return [r.pageviews for r in found.collect()]


def test_a_stored_day_is_visible_at_once(spark, external, tmp_path):
    path = str(tmp_path / "pages")
    assert hours(spark, external) == []
    jobs.store_pagecounts(counts(spark, ("A", NOON, 1)), path, database=external)
    assert hours(spark, external) == [1]
    jobs.store_pagecounts(counts(spark, ("A", NOON + 24 * HOUR, 5)), path, database=external)
    assert hours(spark, external) == [1, 5]
    jobs.store_pagecounts(counts(spark, ("A", NOON, 7), ("B", NOON, 1)), path, database=external)
    assert hours(spark, external) == [8, 5]
    declare_external(spark, external, path, str(tmp_path / "media"), "2022-09-02")
    assert hours(spark, external) == [5]


def test_loads_stored_elsewhere_are_found_by_their_records(spark, external, tmp_path):
    path = str(tmp_path / "pages")
    jobs.store_pagecounts(counts(spark, ("A", NOON, 1)), path)
    assert hours(spark, external) == []
    assert find_loads(spark, external, "pagecounts") == 1
    assert hours(spark, external) == [1]
    assert find_loads(spark, external, "pagecounts") == 0
    media = [("/f", d, *[1] * 9, d) for d in (None, "2022-09-01", "a=b/c")]
    jobs.store_mediacounts(spark.createDataFrame(media, schemas.MEDIACOUNTS_NORMAL), str(tmp_path / "media"))
    assert find_loads(spark, external, "mediacounts") == 3
    assert find_loads(spark, external, "mediacounts") == 0
    got = spark.table(f"{external}.mediacounts_files").select("date").collect()
    assert {r.date for r in got} == {None, "2022-09-01", "a=b/c"}
    assert spark.table(f"{external}.mediacounts").count() == 1


def test_only_days_that_are_asked_for_are_listed(spark, external, tmp_path, plan):
    path = str(tmp_path / "pages")
    jobs.store_pagecounts(counts(spark, *(("A", NOON + d * 24 * HOUR, 1) for d in range(20))), path, database=external)
    found = sql.run_report(spark, "hourly_total_views", f"{external}.pagecounts", "2022-09-03", "2022-09-05")
    assert "InMemoryFileIndex(3 paths)" in plan(found)
    assert found.count() == 3


def test_the_range_ends_with_the_day_of_the_query(spark, external, tmp_path, zone):
    now = int(datetime.now(timezone.utc).timestamp()) // HOUR * HOUR
    rows = [("today", now, 1), ("ahead", now + 25 * HOUR, 2), ("old", 1609459200, 4)]
    jobs.store_pagecounts(counts(spark, *rows), str(tmp_path / "pages"), database=external)
    for name in ("UTC", "Pacific/Kiritimati", "Pacific/Pago_Pago"):
        zone(name)
        assert hours(spark, external) == [1]
    later = (datetime.now(timezone.utc) + timedelta(days=3)).date().isoformat()
    declare_external(spark, external, "", "", "2020-01-01", later)
    assert sorted(hours(spark, external)) == [1, 2, 4]
