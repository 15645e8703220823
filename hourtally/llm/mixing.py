"""Mixing sources to target weights by Pfair scheduling.

Documents of a source are put in a scattered order and cut into blocks of ``BLOCK`` documents.
Weights are whole numbers; among the sources that still have blocks, a source of weight w in a total
of W is due w blocks in every W slots. Its k-th block (from 0) in such a round is released at slot
floor(k W / w) and due at slot ceil((k + 1) W / w); every slot takes the released block with the
earliest deadline. At every slot each source is then less than one block from its exact share.

A source of n blocks lasts ceil(n / w) rounds. When sources run out the others go on in rounds of
their own total, so all documents appear exactly once, and the shares are exact up to the round in
which the first source ends. The pattern of a round depends only on which sources are left: there
are at most as many patterns as sources, and each is as long as its total weight, so they are made
from the weights and block counts alone.

The place of a document within its source is a prefix sum: documents fall into bins by hash, about
``BIN`` in each, bins are counted, the counts are added up over groups of ``BIN`` bins and over the
groups, and only within a bin are documents ranked. No task holds a whole source.

Defined results: a null source is a source of its own, a source without a given weight has weight 1,
one with weight 0 or less is left out of the mixture. Rows without id are placed by their text.
Rows that are equal in id and text have adjacent places in any order. Columns named ``mix_slot`` and ``mix_place`` are replaced. Empty tables
give no row.
"""

from __future__ import annotations

from collections.abc import Mapping
from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourtally.llm.tables import literal_rows, table

BLOCK = 16
BIN = 1_000
#: Target weights of the registered query; sources that are not named have weight 1.
WEIGHTS = {"src0": 5, "src1": 3, "src2": 3, "src3": 2}


def round_pattern(weights: Mapping[str, int]) -> list[tuple[str, int]]:
    """The blocks of one round in order, as (source, number): earliest deadline first among the
    released ones, then by name."""
    total = sum(weights.values())
    coming = [(0, s, 0) for s in weights]  # by release
    heapify(coming)
    ready: list[tuple[int, str, int]] = []  # by deadline
    pattern = []
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            _, source, k = heappop(coming)
            heappush(ready, (-(-(k + 1) * total // weights[source]), source, k))
        _, source, k = heappop(ready)
        pattern.append((source, k))
        if k + 1 < weights[source]:
            heappush(coming, ((k + 1) * total // weights[source], source, k + 1))
    return pattern


def _order() -> tuple[Column, Column]:
    """A text that scatters the rows, and a tie-breaker."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    return F.md5(name.cast("binary")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def _named(source: Column) -> Column:
    """A null source gets a name that no source has: theirs are prefixed."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def _schedule(spark: SparkSession, blocks: Mapping[str, int], weights: Mapping[str, int]) -> DataFrame:
    """Phases of equal active sources: a block's slot is
    ``before + (round - first_round) * slots + slot``."""
    rounds = {s: -(-n // weights[s]) for s, n in blocks.items()}
    rows, first, before = [], 0, 0
    for end in sorted(set(rounds.values())):
        active = {s: weights[s] for s in sorted(blocks) if rounds[s] > first}
        pattern = round_pattern(active)
        for slot, (source, number) in enumerate(pattern):
            rows.append((source, number, first, end, before, len(pattern), slot))
        before += (end - first) * len(pattern)
        first = end
    names = ("name", "number", "first_round", "end_round", "before", "slots", "slot")
    return literal_rows(spark, names, rows)


def _starts(counts: DataFrame) -> DataFrame:
    """``name, bin, start``: how many documents of a source are in earlier bins.

    Bins are added up within groups of ``BIN`` bins, and the groups by source: no task has more
    rows of a source than there are bins in a group, or groups.
    """

    def before(of: str, order: str, *by: str) -> Column:
        rows = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(of).over(rows), F.lit(0))

    grouped = counts.withColumn("group", F.floor(F.col("bin") / BIN))
    groups = grouped.groupBy("name", "group").agg(F.sum("n").alias("total"))
    groups = groups.select("name", "group", before("total", "group", "name").alias("earlier"))
    inside = grouped.withColumn("inside", before("n", "bin", "name", "group"))
    both = inside.join(groups, ["name", "group"])
    return both.select("name", "bin", (F.col("earlier") + F.col("inside")).alias("start"))


def mix_sources(docs: DataFrame, weights: Mapping[str, int], block: int = BLOCK) -> DataFrame:
    """``docs`` with ``mix_slot`` and ``mix_place``: ordered by both, the rows are the mixture; a
    slot is one block. Documents need ``doc_id``, ``text`` and ``source``."""
    spark = docs.sparkSession
    docs = docs.drop("mix_slot", "mix_place")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    scatter, tie = _order()
    rows = docs.select(
        whole.alias("doc"), _named(F.col("source").cast("string")).alias("name"),
        scatter.alias("scatter"), tie.alias("tie"),
    )
    by_name = {f"+{s}": int(w) for s, w in weights.items()}
    sizes = {
        r["name"]: r["n"]
        for r in rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()
        if by_name.get(r["name"], 1) > 0
    }  # one row for each source
    if not sizes:
        return docs.withColumns({c: F.lit(None).cast("long") for c in ("mix_slot", "mix_place")}).where("false")
    shares = {s: by_name.get(s, 1) for s in sizes}
    phases = _schedule(spark, {s: -(-n // block) for s, n in sizes.items()}, shares)
    sources = literal_rows(
        spark, ("name", "weight", "bins"), [(s, shares[s], -(-n // BIN)) for s, n in sizes.items()]
    )
    # A number below 2^32 from the leading digits, scaled to the bins of the source.
    leading = F.conv(F.substring("scatter", 1, 8), 16, 10).cast("long")
    rows = rows.join(sources, "name").withColumn(
        "bin", F.shiftright(leading * F.col("bins"), 32)
    )
    counts = rows.groupBy("name", "bin").agg(F.count(F.lit(1)).alias("n"))
    starts = _starts(counts)
    within = F.row_number().over(W.partitionBy("name", "bin").orderBy("scatter", "tie")) - 1
    placed = rows.withColumn("within", within).join(starts, ["name", "bin"])
    at = F.col("start") + F.col("within")
    number = F.floor(at / block)
    placed = placed.select(
        "doc", "name", (at % block).alias("mix_place"),
        F.floor(number / F.col("weight")).alias("round"), (number % F.col("weight")).alias("number"),
    )
    mixed = placed.join(phases, ["name", "number"]).where(
        "round >= first_round and round < end_round"
    )
    slot = F.col("before") + (F.col("round") - F.col("first_round")) * F.col("slots") + F.col("slot")
    return mixed.select("doc.*", slot.alias("mix_slot"), F.col("mix_place").cast("long"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # The places need no more of a text than its digest.
    slim = docs.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text"))
    mixed = mix_sources(slim, WEIGHTS)
    return mixed.select("doc_id", "source", "mix_slot", "mix_place")
