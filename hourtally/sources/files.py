"""The few file operations that Spark has no reader or writer for, on any store it can reach."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession


class Store:
    """The store that holds ``path``, as Hadoop's file systems offer it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self.path(path).getFileSystem(conf)

    def path(self, path: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self.path(path))

    def folders(self, path: str) -> list[str]:
        """Names of the folders right below ``path``; none if it is absent."""
        return self._names(path, True)

    def files(self, path: str) -> list[str]:
        """Names of the files right below ``path``; none if it is absent."""
        return self._names(path, False)

    def _names(self, path: str, folders: bool) -> list[str]:
        if not self.exists(path):
            return []
        found = self._fs.listStatus(self.path(path))
        return sorted(f.getPath().getName() for f in found if f.isDirectory() == folders)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def create(self, path: str, text: str) -> bool:
        """Write ``text`` to a new file; False if there is one already, which is left as it is."""
        try:
            out = self._fs.create(self.path(path), False)
        except Exception:
            if self.exists(path):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def text(self, path: str) -> str | None:
        """What the file holds; None if it is absent."""
        if not self.exists(path):
            return None
        stream = self._fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def directory(spark: SparkSession, names: list[str], values: tuple) -> str:
    """``name=value/...`` as Spark's writer spells a directory, nulls and odd characters included."""
    spell = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = (
        spell.getPartitionPathString(n, None if v is None else str(v)) for n, v in zip(names, values)
    )
    return "/".join(parts)


def read_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where nothing is at its path or pattern."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_all(reader: DataFrameReader, root: str, names: Sequence[str]) -> DataFrame | None:
    """The parquet files below the folders, or of the patterns, ``names`` of ``root``; None if there
    are none. Those that nothing matches are passed over."""
    if not names:
        return None
    root = root.rstrip("/")
    reader = reader.option("basePath", root)
    # One by one they are looked up at the same time, but must all be there; as alternatives of one
    # pattern they need not.
    each = read_or_none(lambda: reader.parquet(*(f"{root}/{n}" for n in names)))
    if each is not None:
        return each
    return read_or_none(lambda: reader.parquet(f"{root}/{{{','.join(names)}}}"))


def as_pattern(name: str) -> str:
    """The name as a pattern: signs that mean something in patterns stand for any one sign."""
    return re.sub(r"[][{}*?,^\\]", "?", name)
