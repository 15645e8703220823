"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct word shingles. One permutation scatters the shingles, a
second one, shifted by 0, 1, 2, ... places on the circle of 2^32, orders them; the least element
under shift k is signature coordinate k. Groups of ``ROWS`` coordinates, the bands, are hashed to
bucket keys, and documents that share a bucket are compared on their full sets.

Equal sets are one representative from the start, so groups of copies cost one row. Within a
bucket nobody is compared with everybody: every round picks a leader by bucket and compares the
others with it, and documents found connected need no more comparisons. What the rounds leave
apart, buckets that hold several components, is joined on the rarest shingles of its members.
A shingle among the rarest of a document that still has more than ``CROWD`` holders, as in pages
made from one template, is not joined on: that would compare all its holders with each other,
though few are similar. Documents with such shingles get a second, finer signature, bands of
``FINE_ROWS`` coordinates, whose buckets only similar documents share, and in as many bands as
keep the probability of a missed pair where it is. So the components are the ones that all bucket
pairs would give, up to that probability.

The similarity from which documents are linked is a parameter, and the number of bands follows from
it: a pair right at the limit shares no bucket with a probability of at most ``MISSED``. That takes
30 bands (``BANDS``) for op1's 0.85 and 47 for the 0.80 of the pipeline's stage.

Defined results: a document with a null or empty text, or without words, has an empty set and is
linked with nothing. Ids name documents: rows that repeat an id and text are each returned, with
one verdict; rows that repeat an id with other texts are compared each, and the id gets the
smallest of their components.
A row without an id is linked with nothing, is its own document (``component_id``
null) and is kept. A very long text is one set. An empty table gives no rows. Columns other than id
and text are not read; ``drop_near_duplicates`` keeps them, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.tables import components, dealt, materialised, table
from hourtally.llm.text import (
    encoded,
    mix,
    per_piece,
    split_words,
    window_hashes,
    word_hashes,
)

SHINGLE = 5
ROWS, BANDS = 6, 30
# op1's similarity as a percentage: linked if 100 * common >= SIMILARITY * union.
SIMILARITY = 85
MISSED = 7e-7
# Rounds of comparisons with one leader by bucket, before the pairs that are left.
LEADER_ROUNDS = 2
SKETCH_BITS = 1024
# Holders of a shingle up to which they are compared for sharing it, and the rows of the bands that
# tell apart those who share more frequent ones.
CROWD, FINE_ROWS = 256, 12

_SIGNATURE_TYPE = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
_SET_TYPE = "doc_id bigint, shingles array<bigint>, sketch array<bigint>"


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, lower-cased in A-Z; a shorter text is
    one shingle as a whole."""
    words = split_words([t.lower() for t in texts])
    hashes = word_hashes(words)
    sets = []
    for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
        n = int(hi - lo)
        sets.append(np.unique(window_hashes(hashes[lo:hi], min(n, size) or 1)))
    return sets


def _permute(x: np.ndarray, spare: np.ndarray) -> None:
    """A permutation of the 32-bit numbers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def signatures(sets: list[np.ndarray], n: int = ROWS * BANDS) -> np.ndarray:
    """``n`` coordinates for each set, none of them empty."""
    scattered = mix(np.concatenate(sets)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), n), np.uint32)
    order, spare = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(n):
        np.add(scattered, np.uint32(k), out=order)
        _permute(order, spare)
        out[:, k] = np.minimum.reduceat(order, starts)
    return out


def bands_for(similarity: int, rows: int = ROWS) -> int:
    """The bands after which a pair of ``similarity`` percent is missed with at most ``MISSED``."""
    return math.ceil(math.log(MISSED) / math.log1p(-((similarity / 100) ** rows)))


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each document and band; bands have keys of their own."""
    n, width = coordinates.shape
    bands = coordinates.astype(np.uint64).reshape(n, width // rows, rows)
    keys = np.broadcast_to(np.arange(1, width // rows + 1, dtype=np.uint64), bands.shape[:2])
    for i in range(rows):
        keys = mix(keys + bands[:, :, i])
    return keys


def _signature_rows(n_bands: int):
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(encoded(batch.column("text")))
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        if full:
            keys = band_keys(signatures([sets[i] for i in full], ROWS * n_bands)).view(np.int64)
            for i, row in zip(full, keys, strict=True):
                bands[i] = row
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array([s.sum() for s in sets], np.uint64).view(np.int64)),
                pa.array(np.array([mix(s).sum() for s in sets], np.uint64).view(np.int64)),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )

    return rows


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` bits, each flipped once by every shingle that hashes to it. Two sets'
    sketches differ in at most as many bits as there are shingles in just one of the sets."""
    flips = np.bincount(mix(shingles) % np.uint64(SKETCH_BITS), minlength=SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _set_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(encoded(batch.column("text")))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").cast(pa.int64()),
            pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            pa.array([parity_sketch(s) for s in sets], pa.list_(pa.int64())),
        ],
        names=["doc_id", "shingles", "sketch"],
    )


def _similar(common: Column, n_a: Column, n_b: Column, similarity: int) -> Column:
    return 100 * common >= similarity * (n_a + n_b - common)


def _linked(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    similar = _similar(common, F.size("set_a"), F.size("set_b"), similarity)
    return both.where(similar).select("a", "b").distinct()


def _labelled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, with their label."""
    members = shared.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep")
    )
    open_keys = (
        members.groupBy("key")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo < hi")
        .select("key")
    )
    return members.join(dealt(open_keys, "key"), "key")


def _pairs(both: DataFrame, similarity: int) -> DataFrame:
    """The ids of two members side by side whose components differ and whose sizes allow a link."""
    return (
        both.where("label <> other_label")
        .where(100 * F.least("n", "other_n") >= similarity * F.greatest("n", "other_n"))
        .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
        .distinct()
    )


def _leader_pairs(left: DataFrame, turn: int, similarity: int) -> DataFrame:
    """Each member with the leader of its bucket: the one with the least hash of id and round."""
    rank = F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "n", "label")
    leaders = left.groupBy("key").agg(F.min(rank).alias("leader"))
    both = left.join(dealt(leaders, "key"), "key").select(
        "rep", "n", "label",
        F.col("leader.rep").alias("other"),
        F.col("leader.n").alias("other_n"),
        F.col("leader.label").alias("other_label"),
    )
    return _pairs(both, similarity)


def _far(similarity: int) -> Column:
    """Whether two members side by side differ in more places of their sketches than a link allows."""
    total = F.col("n") + F.col("other_n")
    needed = F.ceil(total * similarity / (100 + similarity) - 1e-9)
    apart = sum(
        F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("other_sketch")[i]))
        for i in range(SKETCH_BITS // 64)
    )
    return apart > total - 2 * needed


def _both(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` side by side with the others of their ``key``, each two once."""
    names = [c for c in rows.columns if c not in (key, "rep")]
    other = rows.select(key, F.col("rep").alias("other"), *(F.col(c).alias(f"other_{c}") for c in names))
    return rows.join(other, key).where(F.col("rep") < F.col("other"))


def _prefix_pairs(left: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs of the members that can still be linked, by their rarest shingles.

    Sort every set by how many members hold a shingle, rarest first. Similar sets of n and m
    elements have at least c = s / (1 + s) * (n + m) in common, so their first common element is
    among the n - c + 1 first of the one and the m - c + 1 first of the other. Shingles that
    nobody else holds fill those places first and need not be joined. The join also compares the
    parity sketches, which never differ in more bits than the sets do in elements.

    If the first common element of two sets is one of more than ``CROWD`` holders, both have it among
    these first: such pairs are sought by ``_fine_pairs`` among the documents of which that is true.
    """
    members = left.select(F.col("rep").alias("doc_id"), "label").distinct()
    shingles = sets.join(members, "doc_id").select(
        F.col("doc_id").alias("rep"), "label", "sketch", F.size("shingles").alias("n"),
        F.explode("shingles").alias("shingle"),
    )
    held = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    ranked = (
        shingles.drop("sketch")
        .join(dealt(held, "shingle"), "shingle")
        .groupBy("rep", "label", "n")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "shingle"))).alias("common"))
    )
    # The other set has s * n elements at least, so no more than these places can matter.
    places = F.size("common") - F.floor((F.col("n") * similarity + 99) / 100).cast("int") + 1
    prefixes = materialised(
        ranked.where(places > 0)
        .withColumn("alone", F.col("n") - F.size("common"))
        .withColumn("common", F.slice("common", 1, places)),
        "prefixes",
    )
    first = (
        prefixes.select("rep", "label", "n", "alone", F.posexplode("common").alias("at", "entry"))
        .where(F.col("entry.holders") <= CROWD)
        .join(sets.select(F.col("doc_id").alias("rep"), "sketch"), "rep")
        .select(
            "rep", "label", "n", "sketch", F.col("entry.shingle").alias("shingle"),
            (F.col("n") - F.col("alone") - F.col("at")).alias("rest"),
        )
    )
    needed = F.ceil((F.col("n") + F.col("other_n")) * similarity / (100 + similarity) - 1e-9)
    both = _both(first, "shingle").where((F.least("rest", "other_rest") >= needed) & ~_far(similarity))
    # The last place has the most holders.
    crowded = prefixes.where(F.element_at("common", -1)["holders"] > CROWD).select("rep", "label")
    found = _pairs(both, similarity)
    if crowded.isEmpty():
        return found
    return found.union(_fine_pairs(crowded, sets, similarity)).distinct()


def _fine_rows(n_bands: int):
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.values.to_numpy().view(np.uint64) for s in batch.column("shingles")]
        keys = np.concatenate(
            [band_keys(signatures([s], FINE_ROWS * n_bands), FINE_ROWS) for s in sets]
        ).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("label"), batch.column("n"), batch.column("sketch"), pa.array(list(keys), pa.list_(pa.int64()))],
            names=["rep", "label", "n", "sketch", "keys"],
        )

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                yield rows(batch.slice(lo, 256))

    return run


def _fine_pairs(crowded: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs of ``crowded(rep, label)`` that share a bucket of the finer signature."""
    own = sets.withColumnRenamed("doc_id", "rep").join(crowded, "rep")
    own = own.select("rep", "label", F.size("shingles").cast("long").alias("n"), "sketch", "shingles")
    fine = own.mapInArrow(
        _fine_rows(bands_for(similarity, FINE_ROWS)),
        "rep bigint, label bigint, n bigint, sketch array<bigint>, keys array<bigint>",
    )
    fine = materialised(fine, "fine")
    keys = fine.select("rep", "label", F.explode("keys").alias("key"))
    open_keys = (
        keys.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    )
    shared = keys.join(dealt(open_keys, "key"), "key").select("rep", "key")
    rows = shared.join(fine.drop("keys"), "rep")
    return _pairs(_both(rows, "key").where(~_far(similarity)), similarity)


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id,
    kept``. A component is all documents linked by any path, named by its smallest id; documents
    are linked from a similarity of ``similarity`` percent."""
    docs = docs.select("doc_id", "text")
    signature_rows = per_piece(_signature_rows(bands_for(similarity)))
    found = materialised(docs.mapInArrow(signature_rows, _SIGNATURE_TYPE), "signatures")

    # Equal sets first: the smallest id stands for all of them.
    same = ["set_a", "set_b", "n_shingles"]
    full = found.where("doc_id is not null and n_shingles > 0")
    standing = full.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    reps = full.join(standing.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")

    buckets = reps.select(
        F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key")
    )
    several = (
        buckets.groupBy("key")
        .agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
        .where("lo < hi")
        .select("key")
    )
    shared = materialised(buckets.join(dealt(several, "key"), "key"), "shared")
    compared = docs.join(shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = materialised(compared.mapInArrow(per_piece(_set_rows), _SET_TYPE), "sets")

    links = tried = labels = None
    for turn in range(LEADER_ROUNDS + 1):
        left = shared.withColumn("label", F.col("rep"))
        if labels is not None:
            left = materialised(_labelled(shared, labels), "open")
            if left.isEmpty():
                break
        if turn < LEADER_ROUNDS:
            pairs = _leader_pairs(left, turn, similarity)
        else:
            pairs = _prefix_pairs(left, sets, similarity)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialised(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        new = materialised(_linked(pairs, sets, similarity), "links")
        links = new if links is None else links.union(new)
        labels = materialised(components(links), "labels")

    # The component goes to each group of equal sets and from there to its rows.
    groups = (
        dealt(standing.where("rep < last"), *same)
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*same, F.coalesce("label", "rep").alias("group_id"))
    )
    named = (
        full.drop("bands")
        .join(groups, same, "left")
        .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", F.coalesce("group_id", "label", "doc_id").alias("component_id"))
    )
    return (
        found.select("doc_id", "n_shingles")
        .join(
            named.groupBy("doc_id").agg(F.min("component_id").alias("component_id")),
            "doc_id",
            "left",
        )
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias(
                "kept"
            ),
        )
    )


def drop_near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id, all columns kept."""
    dropped = near_duplicates(docs, similarity).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
