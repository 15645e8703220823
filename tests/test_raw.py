import bz2
import gzip
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from hourtally.schemas import MEDIACOUNTS_RAW
from hourtally.sources import paths
from hourtally.sources.raw import (
    over_limit_rows,
    read_mediacounts_raw,
    read_pagecounts_raw,
    rejected_rows,
)

EDGE_LINES = [
    ("en Foo 3 0", ("en", "Foo", 3, "0")),
    ('en "Heroes" 4 0', ("en", '"Heroes"', 4, "0")),
    ('en "Weird_Al"_Yankovic 6 0', ("en", '"Weird_Al"_Yankovic', 6, "0")),
    ('en "Unclosed 5 0', ("en", '"Unclosed', 5, "0")),
    ("en Back\\slash 9 0", ("en", "Back\\slash", 9, "0")),
    ("en  8 0", ("en", None, 8, "0")),
    ("en Big 3000000000 0", ("en", "Big", None, "0")),
    ("en Short", ("en", "Short", None, None)),
]


@pytest.fixture
def edge_file(tmp_path):
    path = tmp_path / "2022090105.gz"
    path.write_bytes(gzip.compress("\n".join(line for line, _ in EDGE_LINES).encode()))
    return str(path)


def test_edge_lines_parse_verbatim(spark, edge_file):
    got = {tuple(r) for r in read_pagecounts_raw(spark, edge_file).collect()}
    assert got == {row for _, row in EDGE_LINES}


def test_rejects_are_kept_and_reported(spark, edge_file):
    rejects = rejected_rows(read_pagecounts_raw(spark, edge_file))
    assert {r.article_name for r in rejects.collect()} == {"Big", "Short"}


def test_media_columns_by_position(spark, tmp_path):
    line = "\t".join(["/a/b.png"] + [str(n) for n in range(1, 25)])
    path = tmp_path / "mediacounts.2022-09-01.v00.tsv.bz2"
    path.write_bytes(bz2.compress(line.encode()))
    row = read_mediacounts_raw(spark, str(path)).first()
    assert len(MEDIACOUNTS_RAW) == len(row) == 25
    assert row.filename == "/a/b.png"
    assert (row.total_response_bytes, row.total_transfers_transcoded_image) == (1, 7)
    assert (row.total_transfers_transcoded_mov, row.transfers_from_wmf_domain) == (16, 22)
    assert row.transfers_from_invalid_domain == 24
    assert row._rffu_5 == "21"


def test_scan_reads_only_the_columns_asked_for(spark, edge_file, plan):
    text = plan(read_pagecounts_raw(spark, edge_file).select("project_name", "count"))
    assert "ReadSchema: struct<project_name:string,count:int>" in text


def test_over_limit_text_is_kept_and_reported(spark):
    rows = [("p" * 64, "a"), ("p", "a" * 255)]
    df = spark.createDataFrame(rows, "project_name string, article_name string")
    assert [r.article_name for r in over_limit_rows(df).collect()] == ["a"]


def test_paths_for_many_run_times():
    runs = ["2022-09-02T05:10:00Z", "2022-09-02T05:50:00Z", "2022-09-02T04:00:00Z"]
    assert paths.hourly_paths("/in", runs) == ["/in/2022090104.gz", "/in/2022090105.gz"]
    assert paths.daily_paths("/in/", runs) == ["/in/mediacounts.2022-08-31.v00.tsv.bz2"]


def test_archive_names_pad_the_month():
    [path] = paths.hourly_paths("/in", ["2022-09-02T05:10:00Z"], layout=paths.HOURLY_ARCHIVE)
    assert path == "/in/2022/2022-09/pageviews-20220901-050000.gz"
    [path] = paths.daily_paths("/in", ["2022-09-02T05:10:00Z"], layout=paths.DAILY_ARCHIVE)
    assert path == "/in/2022/mediacounts.2022-08-31.v00.tsv.bz2"


@pytest.mark.parametrize(
    "layout, hourly",
    [
        (paths.HOURLY_ARCHIVE, True),
        (paths.HOURLY_STAGED, True),
        (paths.DAILY_ARCHIVE, False),
        (paths.DAILY_STAGED, False),
    ],
)
def test_interval_is_read_back_from_the_name(spark, layout, hourly):
    period = datetime(2022, 9, 1, 17 if hourly else 0, tzinfo=timezone.utc)
    name = layout.path("/in", period).split("/")[-1]
    row = spark.range(1).select(layout.epoch(F.lit(name)).alias("e")).first()
    assert row.e == int(period.timestamp())
