"""Hour and day arithmetic, all of it in UTC.

Epochs are seconds as LONG, days are ``yyyy-MM-dd`` strings and report hours are
TIMESTAMP_NTZ, so no result depends on ``spark.sql.session.timeZone`` or on the
zone of the driver host.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400

_UNIT_SECONDS = {"s": 1, "m": 60, "h": HOUR, "d": DAY, "w": 7 * DAY}
_RELATIVE = re.compile(r"now(?:-(\d+)([smhdw]))?")


# --- driver side -------------------------------------------------------------


def parse_run_time(value: str | datetime | None = None) -> datetime:
    """An ISO-8601 text or datetime as an aware UTC datetime; None means now.

    Any ISO form is taken, with or without a fraction; one without an offset is UTC.
    """
    if value is None:
        return datetime.now(timezone.utc)
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip())
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def lagged_hour(run_time: str | datetime | None, lag_days: int = 1) -> datetime:
    """The hour an hourly load covers: the run time less the lag, floored."""
    t = parse_run_time(run_time) - timedelta(days=lag_days)
    return t.replace(minute=0, second=0, microsecond=0)


def lagged_day(run_time: str | datetime | None, lag_days: int = 2) -> datetime:
    """The day a daily load covers: the run time less the lag, floored."""
    return lagged_hour(run_time, lag_days).replace(hour=0)


def run_times(
    first: str | datetime | None, last: str | datetime | None, step_hours: int = 1
) -> list[datetime]:
    """Run times from ``first`` to ``last``, both included, for a backfill."""
    start, stop = parse_run_time(first), parse_run_time(last)
    steps = int((stop - start).total_seconds()) // (step_hours * HOUR)
    return [start + timedelta(hours=n * step_hours) for n in range(steps + 1)]


def epoch_seconds(t: datetime) -> int:
    return int(parse_run_time(t).timestamp())


def day_string(t: datetime | int) -> str:
    """``yyyy-MM-dd`` in UTC of a datetime or an epoch."""
    if isinstance(t, int):
        t = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=t)
    return parse_run_time(t).date().isoformat()


def relative_epoch(expression: str, as_of: str | datetime | None = None, now_delay: str = "") -> int:
    """Epoch of ``now`` or ``now-<n><unit>`` (units s m h d w).

    ``now_delay`` (such as ``1d``) moves "now" itself back.
    """
    match = _RELATIVE.fullmatch(expression.strip())
    if not match:
        raise ValueError(f"not a relative time: {expression!r}")
    now = epoch_seconds(parse_run_time(as_of))
    if now_delay:
        now -= _span(now_delay)
    return now - (int(match[1]) * _UNIT_SECONDS[match[2]] if match[1] else 0)


def _span(text: str) -> int:
    match = re.fullmatch(r"(\d+)([smhdw])", text.strip())
    if not match:
        raise ValueError(f"not a time span: {text!r}")
    return int(match[1]) * _UNIT_SECONDS[match[2]]


# --- column side -------------------------------------------------------------


def hour_epoch(ts: Column) -> Column:
    """Interval start of a TIMESTAMP_NTZ read as UTC: its hour.

    Built from the date and the hour field, which are taken from the stored value itself. A
    difference of timestamps would pass through the session zone and be an hour off where
    that zone skips one.
    """
    return F.unix_date(ts.cast("date")).cast("long") * F.lit(DAY) + F.hour(ts) * F.lit(HOUR)


def epoch_to_ntz(epoch: Column) -> Column:
    """FROM_UNIXTIME as a real timestamp, the same in every session zone."""
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, epoch)


def epoch_to_day(epoch: Column) -> Column:
    """``yyyy-MM-dd`` of an epoch."""
    days = F.floor(epoch / F.lit(DAY)).cast("int")
    return F.date_from_unix_date(days).cast("string")
