"""Time-grain aggregates behind the reports.

Sums and counts only: Spark combines them before the shuffle, so each task sends one row
per interval however hot that interval or project is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtally.functions.timegrain import epoch_to_ntz
from hourtally.sources.totals import ROWS


def views_by_hour(df: DataFrame, *pinned: str) -> DataFrame:
    """Views per hour, oldest first; ``pinned`` columns hold one value by a filter."""
    epoch = "interval_start_unixtime"
    return (
        df.groupBy(epoch, *pinned)
        .agg(F.sum("count").alias("pageviews"))
        .orderBy(epoch)
        .select(epoch_to_ntz(F.col(epoch)).alias("hour"), *pinned, "pageviews")
    )


def rows_and_views_by_hour(df: DataFrame) -> DataFrame:
    """Rows (project-article pairs) and views per hour, in no order. ``df`` may hold partial sums, which
    know the number of their rows."""
    epoch = "interval_start_unixtime"
    pairs = F.sum(ROWS) if ROWS in df.columns else F.count(F.lit(1))
    return (
        df.groupBy(epoch)
        .agg(pairs.alias("pairs"), F.sum("count").alias("views"))
        .select(
            epoch_to_ntz(F.col(epoch)).alias("hr"),
            F.col("pairs").alias("Pages Viewed"),
            F.col("views").alias("Total Page Views"),
        )
    )


def media_totals_by_day(df: DataFrame) -> DataFrame:
    """Terabytes and transfers per day, oldest first."""
    terabyte = F.pow(F.lit(10), F.lit(12))
    return (
        df.groupBy("date")
        .agg(
            (F.sum("total_response_bytes") / terabyte).alias("tb_served"),
            F.sum("total_transfers_all").alias("n_imgs_served"),
        )
        .orderBy("date")
        .withColumnRenamed("date", "d")
    )
