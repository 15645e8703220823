"""From raw documents to a training mixture, in five stages.

Each stage takes what the one before wrote and decides on all of it. ``run`` writes every stage's
result to the shared scratch folder as Parquet and reads it again, so a lost executor costs at most
the stage that is running.

Defined results: documents with a null or empty text have no words, so that only the quality stage may
reject them; one without an id is in no group of copies, owns no passage and is placed by its
text. Of equal documents the smallest id stays; rows that repeat an id and a text go or stay
together. A text of any length is judged whole. An empty table passes through all stages. All but the last
return the columns of ``documents``, other columns included whatever their names; the last adds
``mix_slot`` and ``mix_place`` and replaces columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourtally.llm.decontamination import drop_contaminated
from hourtally.llm.mixing import WEIGHTS, mix_sources
from hourtally.llm.near_duplicates import drop_near_duplicates
from hourtally.llm.quality_classifier import drop_low_quality
from hourtally.llm.substring_dedup import drop_repeated_passages
from hourtally.llm.tables import materialised, table

# Percentage of equal shingles of five words from which the stage takes documents for near copies.
NEAR_COPIES = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects. Without labels none is rejected."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.
    They are linked from a similarity of 0.80, op1 from 0.85."""
    return drop_near_duplicates(docs, NEAR_COPIES)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that an earlier document already has, and without documents of which no word
    is left."""
    return drop_repeated_passages(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that overlap with a benchmark item. Without items none goes."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources."""
    return mix_sources(docs, WEIGHTS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return docs


# The stages compare hashed sets, run automata and fit a model, which SQL cannot express; the tests
# hold run()'s rows against plain Python versions of the stages, and the classifier against held-out rows.
ORACLE_SQL = None
