"""Count-shaped views of the sample tables, which hold no page or media counts.

``events`` stands in for page requests and ``lineitem`` for media transfers. The frames ending
in ``_requests`` have one row per input row, like a raw dump before normalising: enough for
reports that only add up, and without a shuffle. ``pagecounts`` and ``mediacounts`` are the
tables proper, with one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.functions.timegrain import DAY, HOUR, epoch_to_day, hour_epoch
from hourtally.schemas import MEDIACOUNTS_RAW, PAGECOUNTS_NORMAL
from hourtally.session import evenly_written
from hourtally.sources.paths import FileLayout

ARTICLE_PREFIX = "user_"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/lineitem.parquet")


def page_requests(df: DataFrame, count: Column | None = None) -> DataFrame:
    """One row per event, each counting one view unless ``count`` says otherwise."""
    epoch = hour_epoch(F.col("ts"))
    return df.select(
        F.col("event_type").alias("project_name"),
        F.concat(F.lit(ARTICLE_PREFIX), F.col("user_id").cast("string")).alias("article_name"),
        epoch.alias("interval_start_unixtime"),
        (F.lit(1) if count is None else count).alias("count"),
    )


def pagecounts(df: DataFrame) -> DataFrame:
    """Views per project, article and hour.

    Grouped on the numeric columns; the texts are made afterwards, so the shuffle carries
    no article names.
    """
    hour = hour_epoch(F.col("ts")).alias("interval_start_unixtime")
    views = F.count(F.lit(1)).cast("int").alias("count")
    counted = df.groupBy("event_type", "user_id", hour).agg(views)
    return counted.select(
        F.col("event_type").alias("project_name"),
        F.concat(F.lit(ARTICLE_PREFIX), F.col("user_id").cast("string")).alias("article_name"),
        "interval_start_unixtime",
        "count",
        epoch_to_day(F.col("interval_start_unixtime")).alias("date"),
    ).select(*PAGECOUNTS_NORMAL.names)


def _media_date() -> Column:
    return F.col("l_shipdate").cast("date")


def _media_day() -> Column:
    return _media_date().cast("string")


def _media_measures() -> dict[str, Column]:
    quantity = F.col("l_quantity").cast("int")

    def when(condition: Column) -> Column:
        return F.when(condition, quantity).otherwise(F.lit(0))

    flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return {
        "total_response_bytes": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        "total_transfers_all": quantity,
        "total_transfers_restricted": when(line == 1),
        "total_transfers_transcoded_audio": when(flag == "A"),
        "total_transfers_transcoded_image": when(flag == "N"),
        "total_transfers_transcoded_mov": when(flag == "R"),
        "transfers_from_wmf_domain": when(status == "O"),
        "transfers_from_non_wmf_domain": when(status == "F"),
        "transfers_from_invalid_domain": when(line == 7),
    }


def media_requests(df: DataFrame) -> DataFrame:
    """One row per order line."""
    return df.select(
        F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("filename"),
        _media_day().alias("date"),
        *(c.alias(name) for name, c in _media_measures().items()),
    )


def mediacounts(df: DataFrame) -> DataFrame:
    """Counters per file and day; as for ``pagecounts``, the texts are made after the shuffle."""
    measures = _media_measures()
    summed = [
        F.sum(c).cast("bigint" if name == "total_response_bytes" else "int").alias(name)
        for name, c in measures.items()
    ]
    return (
        df.groupBy("l_partkey", _media_date().alias("date"))
        .agg(*summed)
        .withColumn("date", F.col("date").cast("string"))
        .select(
            F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("filename"),
            F.col("date").alias("_date"),
            *measures,
            "date",
        )
    )


def page_variants(df: DataFrame) -> DataFrame:
    """Each row four times: as it is, with a smaller, a missing count and a missing article."""
    count, article = F.col("count"), F.col("article_name")
    return _variants(
        df,
        {"article_name": article, "count": count},
        {"article_name": article, "count": count - 1},
        {"article_name": article, "count": F.lit(None).cast("int")},
        {"article_name": F.lit(None).cast("string"), "count": count},
    )


def media_variants(df: DataFrame) -> DataFrame:
    """Each row three times: as it is, with no bytes known, and with more transfers."""
    size, transfers = F.col("total_response_bytes"), F.col("total_transfers_all")
    return _variants(
        df,
        {"total_response_bytes": size, "total_transfers_all": transfers},
        {"total_response_bytes": F.lit(None).cast("bigint"), "total_transfers_all": transfers + 9},
        {"total_response_bytes": size, "total_transfers_all": transfers + 1},
    )


def _variants(df: DataFrame, *variants: dict[str, Column]) -> DataFrame:
    """Copies of each row, differing as given, in a single pass over ``df``."""
    changed = list(variants[0])
    copies = F.array(*(F.struct(*(c.alias(n) for n, c in v.items())) for v in variants))
    kept = [c for c in df.columns if c not in changed]
    return df.select(*kept, F.inline(copies)).select(*df.columns)


def hour_stamp(epoch: Column, between: str = "") -> Column:
    """``yyyyMMddHH`` of an hour, as file names spell it."""
    hour = F.pmod(epoch, F.lit(DAY)) / F.lit(HOUR)
    day = F.replace(epoch_to_day(epoch), F.lit("-"), F.lit(""))
    return F.concat(day, F.lit(between), F.lpad(hour.cast("int").cast("string"), 2, "0"))


# How the raw page counts below are named: a folder of parts for each hour.
HOURLY_FOLDERS = FileLayout("", "load_hour=%Y%m%d%H", parts=True)


def write_raw_pagecounts(requests: DataFrame, path: str) -> None:
    """Space-delimited gzip text below ``load_hour=yyyyMMddHH`` directories."""
    _write_raw(
        requests.select(
            F.concat_ws(
                " ", "project_name", "article_name", F.col("count").cast("string"), F.lit("0")
            ).alias("value"),
            "load_hour",
        ),
        path,
        "load_hour",
        "gzip",
    )


def write_raw_mediacounts(rows: DataFrame, path: str) -> None:
    """Tab-delimited bzip2 text below ``load_day=yyyy-MM-dd`` directories."""
    fields = [
        F.col(name).cast("string") if name in rows.columns else F.lit("0")
        for name in MEDIACOUNTS_RAW.names
    ]
    # As a date, which names the directories alike: texts of one month begin alike, and sort slowly.
    day = F.col("date").cast("date").alias("load_day")
    _write_raw(
        rows.select(F.concat_ws("\t", *fields).alias("value"), day),
        path,
        "load_day",
        "bzip2",
    )


def _write_raw(lines: DataFrame, path: str, folder: str, codec: str) -> None:
    gathered = lines.hint("rebalance", folder).sortWithinPartitions(folder)
    with evenly_written(lines.sparkSession):
        gathered.write.mode("append").partitionBy(folder).option("compression", codec).text(path)
