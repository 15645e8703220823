"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library counts on. All but the session zone are Spark defaults, named
# here because the write path needs them: REBALANCE splits hot shards only under AQE.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def sizing_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and file sizes for one load over ``input_bytes`` of input on ``cores``.

    AQE merges small shuffle partitions but never adds any, so a load, whose shuffle is about
    as large as its input, starts from its size. Reports shuffle a few rows per task and do
    well with the default. Every key holds its hour, so a long backfill is best run as loads
    of a month or so each; none needs rows of another.
    """
    partitions = max(2 * cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(app: str = "hourtally", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def evenly_written(spark: SparkSession) -> Iterator[None]:
    """While a gathered frame is written: AQE leaves at least four tasks for each core, where it would
    merge the shuffle's partitions until there is about one.

    As many tasks as cores and one more take twice the time, and compressing and writing take far longer
    than reading the shuffle. A directory's rows stay together, so its files stay as many.
    """
    key = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, for data written once and read back.

    It lies in the folder ``spark.checkpoint.dir`` names, which every executor sees. Without that
    setting a session whose executors are threads of the driver, as in a quick trial, gets a folder
    in its warehouse; any other is refused, as its executors may not share one. What is left there
    is for the cluster's retention rule to clear.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.scratch"
    return f"{base.rstrip('/')}/hourtally-{uuid.uuid4().hex}/{name}"
