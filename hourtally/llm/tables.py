"""Written intermediate tables, and the connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def literal_rows(spark: SparkSession, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """A small table of constants, which the optimizer sees as such."""
    structs = (F.struct(*(F.lit(x).alias(n) for n, x in zip(names, row, strict=True))) for row in rows)
    return spark.range(1).select(F.inline(F.array(*structs)))


def materialised(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back; ``options`` are the writer's.

    Cuts the lineage: what follows survives the loss of any executor without redoing this work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Digests, of 16 bytes each, up to which a set of them is sent to every task: some ten MB.
BROADCAST_ROWS = 200_000


def digest_set(digests: DataFrame, name: str) -> DataFrame:
    """A table of distinct digests, written down and counted; with up to ``BROADCAST_ROWS`` a join
    sends it to the tasks, so that the texts it is joined with stay where they are."""
    digests = materialised(digests, name)
    return F.broadcast(digests) if digests.count() <= BROADCAST_ROWS else digests


def dealt(facts: DataFrame, *key: str) -> DataFrame:
    """``facts``, one row for each ``key``, dealt out anew for a join with the rows they sum up.

    Spark cuts the rows of a hot key into several tasks only where both sides of a join come
    straight from a shuffle by that key. What was just grouped by it does not.
    """
    return facts.repartition(F.xxhash64(*key, F.lit("dealt")))


def joined(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key``, a long, is among ``facts``, with what these tell of it.

    As a join with ``dealt`` facts, but with one exchange of the facts instead of two: the join is
    on the complement of the key, by which facts just grouped by the key itself are not laid out.
    """

    def turned(df: DataFrame) -> DataFrame:
        rest = (c for c in df.columns if c != key)
        return df.select(F.bitwise_not(key).alias("_turned"), *rest)

    both = turned(rows).join(turned(facts), "_turned")
    return both.withColumn(key, F.bitwise_not("_turned")).drop("_turned")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``: the smallest node it is linked to by
    any path.

    Alternates the two star operations: each round points every node at the smallest one of its
    neighbours, which halves the paths. The smallest neighbour is a plain minimum, combined
    before the shuffle, and is joined back by a join that Spark can cut, so a node with very many
    links is never gathered.
    """
    edges = materialised(_downward(links), "links")
    seen = None
    while True:
        edges = materialised(_small_star(_large_star(edges)), "links")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    # Now every edge goes from a node to the smallest of its component.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller node."""
    big, small = F.greatest("a", "b"), F.least("a", "b")
    return links.where("a <> b").select(big.alias("a"), small.alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("b")).select(
        "a", F.least("a", "b").alias("m")
    )
    return _downward(
        both.where("b > a").join(dealt(least, "a"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(dealt(least, "a"), "a")
    hops = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _downward(hops.union(least))
