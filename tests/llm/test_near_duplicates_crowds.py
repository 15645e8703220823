"""Pages made from one template: many share their shingles, few are similar."""

import random

import pytest

from hourtally.llm import near_duplicates as nd


def pages(n, values=4, seed=5):
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(200)]
    slots = rng.sample(range(200), 17)
    out = []
    for i in range(n):
        words = list(base)
        for s in slots:
            words[s] = f"v{s}x{rng.randrange(values)}"
        out.append((i, " ".join(words)))
    return out


def components(rows, limit):
    sets = {}
    for i, text in rows:
        words = text.split()
        sets[i] = {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= limit * (len(sets[i]) + len(sets[j]) - common):
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("similarity", [80, 85])
@pytest.mark.parametrize("crowd", [0, 3, 40, 10**6])
def test_crowded_shingles_lose_no_link(spark, monkeypatch, similarity, crowd):
    monkeypatch.setattr(nd, "CROWD", crowd)
    monkeypatch.setattr(nd, "LEADER_ROUNDS", 1)
    # Two values at each place give more similar pages than four.
    rows = pages(160, values=2) + [(160 + i, t) for i, t in pages(160, values=3, seed=6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = components(rows, similarity)
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs, similarity).collect()}
    assert got == want
    assert 1 < len(set(want.values())) < len(rows)


def test_crowds_are_compared_in_proportion_to_their_size(spark, monkeypatch):
    """The comparisons of full sets that the rounds leave, for twice the pages."""
    compared = []
    real = nd._linked
    monkeypatch.setattr(nd, "_linked", lambda pairs, *rest: (compared.append(pairs.count()), real(pairs, *rest))[1])
    counts = []
    for n in (1000, 2000):
        compared.clear()
        docs = spark.createDataFrame(pages(n), "doc_id bigint, text string")
        nd.near_duplicates(docs)
        counts.append(sum(compared))
    assert counts[1] < 3 * counts[0] and counts[1] < 60 * 2000
