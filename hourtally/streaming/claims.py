"""One writer for each target: numbered claims in a folder that all drivers see.

A claim is a file with the next number, made by an atomic creation: of two drivers that start at once
one is refused. The owner looks before each batch whether its claim is still the newest. So a driver
that was declared lost, and has been replaced, stops before it writes again.

A claim ends when its owner releases it, or when its query has stopped in the driver that asks. A
driver that died cannot release its claim, and from elsewhere it looks like one that is slow:
whoever knows better says so by ``take_over``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from hourtally.sources.files import Store


class ClaimedElsewhere(RuntimeError):
    """Another driver writes the target."""


# The queries that this driver has started, by the path of their claim.
_queries: dict[str, StreamingQuery] = {}


@dataclass(frozen=True)
class Claim:
    folder: str
    number: int

    @staticmethod
    def _path(folder: str, number: int) -> str:
        return f"{folder}/{number:012d}.json"

    @classmethod
    def newest(cls, spark: SparkSession, folder: str) -> tuple[int, dict]:
        """Number and content of the newest claim; 0 before the first."""
        store = Store(spark, folder)
        numbers = [int(n.split(".")[0]) for n in store.files(folder) if n.endswith(".json")]
        if not numbers:
            return 0, {}
        text = store.text(cls._path(folder, max(numbers)))
        # A claim that is being written belongs to somebody as well.
        return max(numbers), json.loads(text) if text else {}

    @classmethod
    def take(cls, spark: SparkSession, folder: str, what: dict, take_over: bool = False) -> Claim:
        """Claim the target for a definition; raises if another driver holds it."""
        number, owner = cls.newest(spark, folder)
        if number and not take_over and not cls(folder, number)._ended(spark, owner):
            raise ClaimedElsewhere(f"{folder} is claimed by {owner}; take_over replaces a lost driver")
        own = {
            **what,
            "application": spark.sparkContext.applicationId,
            "since": datetime.now(timezone.utc).isoformat(),
        }
        claim = cls(folder, number + 1)
        if not Store(spark, folder).create(claim.path, json.dumps(own)):
            raise ClaimedElsewhere(f"{folder} was claimed at the same moment")
        return claim

    @property
    def path(self) -> str:
        return self._path(self.folder, self.number)

    def _ended(self, spark: SparkSession, owner: dict) -> bool:
        if Store(spark, self.folder).exists(self.path.replace(".json", ".released")):
            return True
        own = owner.get("application") == spark.sparkContext.applicationId
        query = _queries.get(self.path)
        return own and query is not None and not query.isActive

    def follow(self, query: StreamingQuery) -> StreamingQuery:
        """The claim lasts as long as ``query``."""
        _queries[self.path] = query
        return query

    def check(self, spark: SparkSession) -> None:
        """Raises if a newer claim replaces this one."""
        number, owner = self.newest(spark, self.folder)
        if number != self.number:
            raise ClaimedElsewhere(f"{self.folder} has been taken over by {owner}")

    def release(self, spark: SparkSession) -> None:
        Store(spark, self.folder).create(self.path.replace(".json", ".released"), "")
