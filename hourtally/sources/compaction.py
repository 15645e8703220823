"""Fewer directories for days of many batches, without losing what a replay relies on.

Every batch has a directory of its own below its days, so an ingest each minute makes up to 1,440 of
them a day. A compaction rewrites the directories of a day as one, named after the greatest batch in it,
and notes that the day is closed up to that batch. A batch that is replayed afterwards, although
all its rows are in the table, finds its number covered by the note and adds nothing to the day;
later batches have greater numbers and see the rows as those of an earlier one.

The rewritten days are staged first, in a folder that readers pass over. Then one small file, the
plan, is created: from that moment the compaction counts, and ``finish_compactions`` completes it
however often it is cut off. For the moment in which a day's old directories give way to its new one,
a reader may miss rows of this day; so the writer compacts between its batches, and never while one
of them looks for stored keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourtally.sources.files import Store, directory
from hourtally.sources.sinks import BATCH, write_replacing
from hourtally.sources.tables import add_partitions, drop_partitions, read_directories


def _plans(target: str) -> str:
    return f"{target.rstrip('/')}/_compactions"


def _staged(target: str, plan: str) -> str:
    return f"{target.rstrip('/')}/_staged/{plan}"


def closed_days(spark: SparkSession, target: str) -> dict[str, int]:
    """The days that have been compacted, and up to which batch."""
    days: dict[str, int] = {}
    store = Store(spark, target)
    for name in store.files(_plans(target)):
        if name.endswith(".json"):
            for day, last in json.loads(store.text(f"{_plans(target)}/{name}")).items():
                days[day] = max(last, days.get(day, last))
    return days


def not_compacted(rows: DataFrame, target: str, batch_id: int) -> DataFrame:
    """``rows`` of a batch without those of days that are closed for it."""
    closed = [d for d, last in closed_days(rows.sparkSession, target).items() if batch_id <= last]
    return rows.where(~_among(F.col("date"), closed)) if closed else rows


def _among(column: Column, values: Sequence[str]) -> Column:
    return F.coalesce(column.isin(list(values)), F.lit(False))


def current_directories(spark: SparkSession, target: str, rows: Iterable[Row]) -> list[Row]:
    """``date, _batch_id`` of the directories that now hold what those of ``rows`` held."""
    closed = closed_days(spark, target)
    return sorted(
        {Row(date=r["date"], **{BATCH: max(r[BATCH], closed.get(r["date"], r[BATCH]))}) for r in rows},
        key=str,
    )


def batches(spark: SparkSession, target: str, day: str) -> list[int]:
    """The batches that have a directory of this day."""
    folders = Store(spark, target).folders(f"{target.rstrip('/')}/{directory(spark, ['date'], (day,))}")
    return sorted(int(f.split("=")[1]) for f in folders if f.startswith(f"{BATCH}=") and f[len(BATCH) + 1 :].isdigit())


def stored_days(spark: SparkSession, target: str) -> list[str]:
    """The days that ``target`` has directories of; lists the days, not what is in them."""
    return [f.split("=", 1)[1] for f in Store(spark, target).folders(target) if f.startswith("date=")]


def compact_days(
    spark: SparkSession,
    target: str,
    stored: StructType,
    days: Iterable[str],
    most: int = 1,
    shard_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    lookup: Sequence[str] = (),
    database: str | None = None,
    name: str | None = None,
) -> list[str]:
    """Rewrite those of ``days`` that have more than ``most`` directories; returns them.

    To be run by the writer of the table, between its batches. One job rewrites all the days, with the
    layout of the table.
    """
    finish_compactions(spark, target, database, name)
    held = {day: batches(spark, target, day) for day in sorted(set(days))}
    held = {day: found for day, found in held.items() if len(found) > most}
    if not held:
        return []
    old = [Row(date=day, **{BATCH: b}) for day, found in held.items() for b in found]
    last = F.create_map(*(F.lit(x) for day, found in held.items() for x in (day, found[-1])))
    rows = read_directories(spark, target, stored, old)
    plan = uuid.uuid4().hex
    write_replacing(
        rows.withColumn(BATCH, last[F.col("date")].cast("bigint")),
        _staged(target, plan),
        shard_by=shard_by,
        sort_by=sort_by,
        lookup=lookup,
    )
    text = json.dumps({day: found[-1] for day, found in held.items()})
    Store(spark, target).create(f"{_plans(target)}/{plan}.json", text)
    finish_compactions(spark, target, database, name)
    return list(held)


def finish_compactions(
    spark: SparkSession, target: str, database: str | None = None, name: str | None = None
) -> None:
    """Complete what was decided: put the staged days in the place of the directories that they
    stand for. Repeating it changes nothing."""
    store = Store(spark, target)
    names = store.files(_plans(target))
    for plan in (n.removesuffix(".json") for n in names if n.endswith(".json")):
        if f"{plan}.done" in names:
            continue
        days = json.loads(store.text(f"{_plans(target)}/{plan}.json"))
        for day, last in days.items():
            _replace_day(spark, store, target, plan, day, last, database, name)
        store.create(f"{_plans(target)}/{plan}.done", "")
        store.remove(_staged(target, plan))


def _replace_day(
    spark: SparkSession,
    store: Store,
    target: str,
    plan: str,
    day: str,
    last: int,
    database: str | None,
    name: str | None,
) -> None:
    own = directory(spark, ["date", BATCH], (day, last))
    old = [b for b in batches(spark, target, day) if b <= last]
    staged = f"{_staged(target, plan)}/{own}"
    # What is staged is moved last: while it is there, all the others are old.
    if store.exists(staged):
        for b in old:
            store.remove(f"{target.rstrip('/')}/{directory(spark, ['date', BATCH], (day, b))}")
        store.move(staged, f"{target.rstrip('/')}/{own}")
    if database and name:
        gone = [Row(date=day, **{BATCH: b}) for b in old if b != last]
        drop_partitions(spark, database, name, gone)
        add_partitions(spark, database, name, [Row(date=day, **{BATCH: last})])
