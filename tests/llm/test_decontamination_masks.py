"""Every overlap that the 80 % test accepts is met by a seed, all placements enumerated."""

from itertools import combinations

import numpy as np
import pytest

from hourtally.llm import decontamination as dc
from hourtally.llm.text import PUNCTUATION, plain, split_words, word_hashes

WORDS = [f"w{i}" for i in range(40)]


def allowed(size):
    return size - -(-size * dc.EQUAL_PERCENT // 100)


class Index:
    """The seeds of one item, as the operator joins them with those of a text."""

    def __init__(self, items):
        ((_, text),) = items
        self.items = [word_hashes(split_words([plain(text)], PUNCTUATION))]
        self.places = {}
        for seed, word in zip(*dc.item_seeds(self.items[0]), strict=True):
            self.places.setdefault(int(seed), []).append(int(word))


def overlaps(index, hashes):
    """``(text, item, first word, first word of the item, words, equal words)`` of one text."""
    starts = set()
    for mask in dc.SHORT_MASKS.get(len(index.items[0]), dc.MASKS):
        for at, seed in enumerate(dc.seeds(hashes, mask)):
            starts |= {at - word for word in index.places.get(int(seed), ())}
    return [(0, 0, *f) for start in sorted(starts) for f in dc.overlaps(index.items[0], hashes, start)]


def replaced(words, places):
    other = words.copy()
    other[list(places)] = np.arange(10**6, 10**6 + len(places))
    return other


def noise(n, start):
    return np.arange(start, start + n, dtype=np.uint64)


@pytest.mark.parametrize("n", range(8, 13))
def test_items_shorter_than_an_overlap_with_all_replacements(n):
    index = Index([(7, " ".join(WORDS[:n]))])
    item = index.items[0]
    assert len(item) == n
    for k in range(allowed(n) + 1):
        for places in combinations(range(n), k):
            text = np.concatenate([noise(5, 2000), replaced(item, places), noise(20, 3000)])
            assert overlaps(index, text) == [(0, 0, 5, 0, n, n - k)], places
    for places in combinations(range(n), allowed(n) + 1):
        assert overlaps(index, np.concatenate([noise(5, 2000), replaced(item, places), noise(20, 3000)])) == []
    # A text that is the item alone.
    assert overlaps(index, item.copy()) == [(0, 0, 0, 0, n, n)]


@pytest.mark.parametrize("at", [0, 1, 13, 27])
def test_isolated_overlaps_with_all_replacements(at):
    index = Index([(7, " ".join(WORDS))])
    part = index.items[0][at : at + dc.OVERLAP]
    for k in range(allowed(dc.OVERLAP) + 1):
        for places in combinations(range(dc.OVERLAP), k):
            text = np.concatenate([noise(30, 2000), replaced(part, places), noise(30, 3000)])
            found = overlaps(index, text)
            assert len(found) == 1, places
            lo, hi = found[0][2], found[0][2] + found[0][4]
            assert lo <= 30 and hi >= 30 + dc.OVERLAP


def test_masks_of_every_length_cover_all_accepted_replacements():
    for size, masks in {**dc.SHORT_MASKS, dc.SPAN: dc.MASKS}.items():
        assert {len(m) for m in masks} == {size}
        for places in combinations(range(size), allowed(size)):
            assert any(all(m[i] == "0" for i in places) for m in masks), (size, places)
    # Every allowed pair of an overlap is two of SPAN words; more is never allowed there.
    assert set(dc.SHORT_MASKS) == set(range(dc.LEAST_WORDS, dc.SPAN))
    assert allowed(dc.OVERLAP) <= allowed(dc.SPAN)


def test_short_items_through_the_operator(spark, corpus):
    bench = spark.createDataFrame(
        [(1, "one two three four five six seven eight"), (2, "a b c d e f g h i j"), (3, "too few words")],
        "item_id bigint, text string",
    )
    rows = [
        (1, "so One two THREE other five six seven eight it is"),
        (2, "a b c x e f g h y j"),
        (3, "one two other four other six seven eight"),
        (4, "these are too few words for evidence"),
    ]
    docs = corpus(rows)
    found = dc.benchmark_overlaps(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.doc_word, r.n_words, r.n_equal) for r in found) == [
        (1, 1, 1, 8, 7), (2, 2, 0, 10, 8),
    ]
    assert sorted(r.doc_id for r in dc.drop_contaminated(docs, bench).collect()) == [3, 4]
