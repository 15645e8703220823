"""The canonical reports, over any frame of page-count or media-count shape."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from hourtally.operators.aggregates import (
    media_totals_by_day,
    rows_and_views_by_hour,
    views_by_hour,
)
from hourtally.operators.filters import (
    DEFAULT_NOW_DELAY,
    DEFAULT_PROJECT,
    article_is,
    epoch_between,
    project_is,
    relative_window,
)


def hourly_total_views(pagecounts: DataFrame) -> DataFrame:
    return views_by_hour(pagecounts)


def hourly_views_by_project(pagecounts: DataFrame, project: str = DEFAULT_PROJECT) -> DataFrame:
    return views_by_hour(project_is(pagecounts, project), "project_name")


def hourly_views_by_article(pagecounts: DataFrame, article: str) -> DataFrame:
    """One article over all projects."""
    return views_by_hour(article_is(pagecounts, article), "article_name")


def daily_media_totals(mediacounts: DataFrame) -> DataFrame:
    return media_totals_by_day(mediacounts)


def hourly_rows_and_views(
    pagecounts: DataFrame, lo: int, hi: int, project: str | None = None
) -> DataFrame:
    """Dashboard panel for the hours ``lo .. hi``; all projects unless one is given."""
    rows = epoch_between(pagecounts, lo, hi)
    return rows_and_views_by_hour(rows if project is None else project_is(rows, project))


def relative_rows_and_views(
    pagecounts: DataFrame,
    since: str = "now-3d",
    until: str = "now-1d",
    as_of: str | datetime | None = None,
    now_delay: str = DEFAULT_NOW_DELAY,
    project: str | None = None,
) -> DataFrame:
    """Dashboard panel for a window relative to ``as_of``."""
    rows = relative_window(pagecounts, since, until, as_of, now_delay)
    return rows_and_views_by_hour(rows if project is None else project_is(rows, project))
