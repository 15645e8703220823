import re

import pytest

import corpus_pipeline
from hourtally.llm import decontamination, near_duplicates, quality_classifier, substring_dedup
from hourtally.llm.tables import components, materialised

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialised(stage(spark, out[-1], FOLDER), name))
    return out


def test_each_stage_does_its_part(spark, stages):
    documents, good, single, cut, clean, mixed = stages
    for frame in (good, single, cut, clean):
        assert frame.columns == documents.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rejected = quality_classifier.quality_scores(documents, labels).where("predicted = 0")
    assert good.count() == documents.count() - rejected.count()
    # Nothing is left for a stage to do on its own result.
    assert near_duplicates.near_duplicates(single).where("not kept").count() == 0
    assert decontamination.benchmark_overlaps(clean, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == 0
    removed = substring_dedup.substring_dedup(single).where("size(removed) > 0").count()
    before = {r.doc_id: r.text for r in single.collect()}
    changed = [r for r in cut.collect() if r.text != before[r.doc_id]]
    assert len(changed) + len(before) - cut.count() == removed
    assert all(r.n_chars == len(r.text) for r in changed)
    assert all(len(re.findall(r"\S+", r.text)) < len(before[r.doc_id].split()) for r in changed)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in clean.collect())


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages[-1].collect()))


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    links += [(5, 5), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 203)}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
