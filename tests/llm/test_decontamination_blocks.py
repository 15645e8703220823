"""Seeds of texts and benchmark meet in a join: one pass over the texts, whatever the benchmark."""

import random

import numpy as np

from hourtally.llm import decontamination as dc


def test_a_filter_has_all_its_seeds_and_few_others():
    rng = np.random.default_rng(3)
    own, others = (rng.integers(0, 2**64, 50_000, np.uint64) for _ in range(2))
    known = dc.SeedFilter(20)
    known.add(own)
    assert len(known.likely(own)) == len(own)
    assert 0 < len(known.likely(others)) < 0.02 * len(others)


def test_a_saturated_filter_loses_nothing(spark, sample, monkeypatch):
    docs, bench = sample("documents"), sample("benchmark")
    want = sorted(dc.benchmark_overlaps(docs, bench).collect()), sorted(dc.drop_contaminated(docs, bench).collect())
    assert want[0]
    monkeypatch.setattr(dc, "FILTER_BITS", 4)
    got = sorted(dc.benchmark_overlaps(docs, bench).collect()), sorted(dc.drop_contaminated(docs, bench).collect())
    assert got == want


def test_texts_are_searched_once(spark, corpus, monkeypatch):
    """However many documents have a text, and however many items there are."""
    rng = random.Random(2)
    items = [" ".join(f"w{rng.randrange(500)}" for _ in range(20)) for _ in range(300)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = corpus([(i, items[i % 3] + " and more") for i in range(200)] + [(900, "nothing of it " * 9)])
    found = dc.benchmark_overlaps(docs, bench)
    assert found.count() == 200 and {(r.doc_id % 3, r.item_id) for r in found.collect()} == {(i, i) for i in range(3)}
    assert [r.doc_id for r in dc.drop_contaminated(docs, bench).collect()] == [900]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan  # the search is done and written down


def test_without_broadcasts_the_result_is_the_same(spark, sample, monkeypatch):
    from hourtally.llm import tables

    docs, bench = sample("documents"), sample("benchmark")
    want = sorted(dc.benchmark_overlaps(docs, bench).collect()), sorted(dc.drop_contaminated(docs, bench).collect())
    clean = dc.drop_contaminated(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in clean and "Exchange hashpartitioning" not in clean
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    got = sorted(dc.benchmark_overlaps(docs, bench).collect()), sorted(dc.drop_contaminated(docs, bench).collect())
    assert got == want
