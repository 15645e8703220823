"""Where the dump file of an hour or a day lies, and the reverse."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourtally.functions.timegrain import DAY, HOUR, lagged_day, lagged_hour

_WIDTHS = {"%Y": 4, "%m": 2, "%d": 2, "%H": 2}


@dataclass(frozen=True)
class FileLayout:
    """A folder below the root and a file name, both as strftime patterns.

    With ``parts`` the name is that of a folder, in which the dump of a period lies as any number
    of files, as a parallel copy stages it.
    """

    folder: str
    name: str
    parts: bool = False

    def path(self, root: str, period: datetime) -> str:
        parts = [root.rstrip("/"), period.strftime(self.folder), period.strftime(self.name)]
        return "/".join(p for p in parts if p)

    def name_of_row(self) -> Column:
        """The name that a scanned row's file, or its folder of parts, has in this layout."""
        if not self.parts:
            return F.col("_metadata.file_name")
        return F.element_at(F.split("_metadata.file_path", "/"), -2)

    def _field(self, name: Column, code: str) -> Column:
        """A date field cut out of the file name; every field has a fixed width."""
        before = self.name[: self.name.index(code)]
        start = len(before) + sum(before.count(c) * (w - len(c)) for c, w in _WIDTHS.items())
        return F.substring(name, start + 1, _WIDTHS[code]).cast("int")

    def epoch(self, name: Column) -> Column:
        """Interval start of the file called ``name``.

        Plain substrings: the value is computed for each row of a scan, where a regular
        expression would cost as much as parsing the line.
        """
        day = F.make_date(*(self._field(name, c) for c in ("%Y", "%m", "%d")))
        epoch = F.unix_date(day).cast("long") * F.lit(DAY)
        if "%H" in self.name:
            epoch = epoch + self._field(name, "%H") * F.lit(HOUR)
        return epoch


# --- fixed values: names of the published dumps and of staged copies ----------

HOURLY_ARCHIVE = FileLayout("%Y/%Y-%m", "pageviews-%Y%m%d-%H0000.gz")
HOURLY_STAGED = FileLayout("", "%Y%m%d%H.gz")
DAILY_ARCHIVE = FileLayout("%Y", "mediacounts.%Y-%m-%d.v00.tsv.bz2")
DAILY_STAGED = FileLayout("", "mediacounts.%Y-%m-%d.v00.tsv.bz2")


def interval_paths(root: str, epochs: Iterable[int], layout: FileLayout) -> dict[str, int]:
    """The path of each interval's dump, oldest first, and the interval's start."""
    starts = {e: datetime.fromtimestamp(e, timezone.utc) for e in sorted(set(epochs))}
    return {layout.path(root, t): e for e, t in starts.items()}


def hourly_paths(
    root: str,
    run_times: Iterable[str | datetime | None],
    lag_days: int = 1,
    layout: FileLayout = HOURLY_STAGED,
) -> list[str]:
    """One path for each distinct hour the run times cover, oldest first."""
    hours = sorted({lagged_hour(t, lag_days) for t in run_times})
    return [layout.path(root, h) for h in hours]


def daily_paths(
    root: str,
    run_times: Iterable[str | datetime | None],
    lag_days: int = 2,
    layout: FileLayout = DAILY_STAGED,
) -> list[str]:
    """One path for each distinct day the run times cover, oldest first."""
    days = sorted({lagged_day(t, lag_days) for t in run_times})
    return [layout.path(root, d) for d in days]
