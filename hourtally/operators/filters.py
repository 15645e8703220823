"""Predicates of the reports, each in a form the parquet scan can use."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtally.functions.timegrain import day_string, relative_epoch

DEFAULT_PROJECT = "en.m"
FIRST_VISIBLE_DATE = "2022-01-01"
# The newest day is still being loaded, so "now" is a day ago.
DEFAULT_NOW_DELAY = "1d"


def project_is(df: DataFrame, project: str = DEFAULT_PROJECT) -> DataFrame:
    """The value is bound as a literal, never spliced into query text."""
    return df.where(F.col("project_name") == F.lit(project))


def article_is(df: DataFrame, article: str) -> DataFrame:
    return df.where(F.col("article_name") == F.lit(article))


def epoch_between(
    df: DataFrame, lo: int, hi: int, epoch: str = "interval_start_unixtime"
) -> DataFrame:
    """Intervals starting in ``lo .. hi``, both inclusive.

    Where the table has ``date`` directories their bound is added as well: Catalyst cannot
    derive it from the epoch, and without it every directory would be opened.
    """
    df = df.where(F.col(epoch).between(lo, hi))
    return dates_between(df, day_string(lo), day_string(hi)) if "date" in df.columns else df


def dates_between(df: DataFrame, first: str, last: str) -> DataFrame:
    return df.where(F.col("date").between(first, last))


def visible_dates(
    df: DataFrame, first: str = FIRST_VISIBLE_DATE, last: str | None = None
) -> DataFrame:
    """Rows of the declared date range; by default 2022-01-01 to today in UTC."""
    return dates_between(df, first, last or day_string(datetime.now(timezone.utc)))


def relative_window(
    df: DataFrame,
    since: str = "now-3d",
    until: str = "now-1d",
    as_of: str | datetime | None = None,
    now_delay: str = DEFAULT_NOW_DELAY,
) -> DataFrame:
    """``epoch_between`` with bounds relative to ``as_of`` (default: now)."""
    # One reading of the clock, so that both bounds refer to the same moment.
    as_of = as_of or datetime.now(timezone.utc)
    lo, hi = (relative_epoch(e, as_of, now_delay) for e in (since, until))
    return epoch_between(df, lo, hi)
