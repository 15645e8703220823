import random
import re

import numpy as np
import pytest

from hourtally.llm import near_duplicates as nd


def brute(rows):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                label[hi] = lo
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_like_brute_force_on_the_sample_and_on_drifting_copies(spark, sample, corpus):
    rows = [(r.doc_id, r.text) for r in sample("documents").select("doc_id", "text").collect()]
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    # A crowd of copies of one text, near 0.85 of each other: some linked, most only through others.
    rows += [(10_000 + i, edited(rng, base, 2 + i % 3)) for i in range(120)]
    # A chain: each link is similar, its ends are not.
    chain = list(base)
    for i in range(8):
        chain[i * 12] = f"c{i}"
        rows.append((20_000 - i, " ".join(chain)))
    # Texts that share a long passage but are too different.
    for i in range(40):
        rows.append((30_000 + i, " ".join(base + [f"q{i}_{j}" for j in range(60)])))
    rng.shuffle(rows)
    assert found(nd.near_duplicates(corpus(rows))) == brute(rows)


def test_awkward_rows(corpus, awkward):
    rows = nd.near_duplicates(corpus(awkward)).collect()
    assert len(rows) == len(awkward)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(r.kept and r.component_id == r.doc_id for r in rows)
    kept = nd.drop_near_duplicates(corpus([*awkward, (9, "SAME row twice with more than five words")]))
    assert kept.columns == corpus([]).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 5, 6, 7, 8]


def test_empty_table(corpus):
    assert nd.near_duplicates(corpus([])).collect() == []


@pytest.mark.parametrize("similarity", [0.5, 0.85])
def test_signatures_estimate_similarity(similarity):
    rng = np.random.default_rng(1)
    common = int(4000 * similarity)
    pool = rng.integers(0, 2**63, 8000).astype(np.uint64)
    a, b = pool[:4000], np.concatenate([pool[:common], pool[4000 : 8000 - common]])
    true = common / (8000 - common)
    x, y = nd.signatures([a, b])
    assert abs((x == y).mean() - true) < 5 * np.sqrt(true * (1 - true) / len(x))


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(2)
    for n in (0, 1, 30, 700):
        a = rng.integers(0, 2**63, 500).astype(np.uint64)
        b = np.concatenate([a[n // 2 :][: 500 - n // 2], rng.integers(0, 2**63, n).astype(np.uint64)])
        differ = int(np.bitwise_count(nd.parity_sketch(a).view(np.uint64) ^ nd.parity_sketch(b).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))
