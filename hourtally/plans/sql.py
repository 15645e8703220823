"""The reports as Spark SQL over catalog tables, for callers that speak SQL.

Table names and values are bound parameters (``spark.sql(text, args=...)``); nothing a user
types becomes query text. Every filter on the hour has its implied ``date`` bound beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourtally.functions.timegrain import day_string

_HOUR = "TIMESTAMP_NTZ'1970-01-01' + make_dt_interval(0, 0, 0, interval_start_unixtime)"
_DATES = "(:first IS NULL OR date >= :first) AND (:last IS NULL OR date <= :last)"

TEXTS = {
    "hourly_total_views": f"""
        WITH hours AS (
          SELECT interval_start_unixtime, sum(count) AS pageviews
          FROM IDENTIFIER(:table) WHERE {_DATES} GROUP BY ALL)
        SELECT {_HOUR} AS hour, pageviews FROM hours ORDER BY hour""",
    "hourly_views_by_project": f"""
        WITH hours AS (
          SELECT interval_start_unixtime, project_name, sum(count) AS pageviews
          FROM IDENTIFIER(:table) WHERE {_DATES} AND project_name = :project GROUP BY ALL)
        SELECT {_HOUR} AS hour, project_name, pageviews FROM hours ORDER BY hour""",
    "hourly_views_by_article": f"""
        WITH hours AS (
          SELECT interval_start_unixtime, article_name, sum(count) AS pageviews
          FROM IDENTIFIER(:table) WHERE {_DATES} AND article_name = :article GROUP BY ALL)
        SELECT {_HOUR} AS hour, article_name, pageviews FROM hours ORDER BY hour""",
    "hourly_rows_and_views": f"""
        WITH hours AS (
          SELECT interval_start_unixtime, count(1) AS pairs, sum(count) AS views
          FROM IDENTIFIER(:table)
          WHERE {_DATES} AND interval_start_unixtime BETWEEN :lo AND :hi
            AND (:project IS NULL OR project_name = :project)
          GROUP BY ALL)
        SELECT {_HOUR} AS hr, pairs AS `Pages Viewed`, views AS `Total Page Views` FROM hours""",
    "daily_media_totals": f"""
        SELECT date AS d, sum(total_response_bytes) / power(10, 12) AS tb_served,
               sum(total_transfers_all) AS n_imgs_served
        FROM IDENTIFIER(:table) WHERE {_DATES} GROUP BY date ORDER BY d""",
}


def run_report(
    spark: SparkSession,
    report: str,
    table: str,
    first: str | None = None,
    last: str | None = None,
    **values: str | int | None,
) -> DataFrame:
    """One of ``TEXTS`` over all of ``table``, or its dates ``first .. last``.

    Serving tables have no date range of their own: rows of any age, and those without an hour,
    are reported. External tables already show their visible dates only.
    """
    if "lo" in values:
        lo, hi = day_string(values["lo"]), day_string(values["hi"])
        first, last = max(first or lo, lo), min(last or hi, hi)
    if report == "hourly_rows_and_views":
        values.setdefault("project", None)
    args = {"table": table, "first": first, "last": last, **values}
    return spark.sql(TEXTS[report], args=args)
