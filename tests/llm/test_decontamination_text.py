"""Copies that differ in typography, items shorter than a seed, and a plain version of the search."""

import random
import re
import unicodedata

import pytest

from hourtally.llm import decontamination as dc
from hourtally.llm.text import plain

ITEM = "Which of these 13 words, copied one by one, is found in the text?"


def words(text):
    text = unicodedata.normalize("NFKC", re.sub("[­​-‏⁠﻿]", "", (text or "").lower())).lower()
    return re.findall(r"[^\W_]+", text)


COPIES = [
    ITEM,
    ITEM.replace(" ", " "),
    " ".join(f"“{w}”" if i % 3 == 0 else w for i, w in enumerate(ITEM.split())),
    ITEM.replace(", copied", "—copied").replace("one, is", "one — is"),
    ITEM.replace(",", "，").replace("?", "？"),
    "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in ITEM),
    ITEM.replace("copied", "cop­ied").replace("found", "fo​und"),
    ITEM.upper().replace(" ", "  "),
]


@pytest.mark.parametrize("number", range(len(COPIES)))
def test_typographic_copies_are_found(spark, corpus, number):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    docs = corpus([(5, f"é before {COPIES[number]} after"), (6, "nothing of it, és “so” on")])
    assert [(r.doc_id, r.n_equal) for r in dc.benchmark_overlaps(docs, bench).collect()] == [(5, 13 + 1)]
    assert [r.doc_id for r in dc.drop_contaminated(docs, bench).collect()] == [6]


def test_words_of_any_alphabet():
    text = "É_é don’t “ﬁne” ＡＢ１２ 漢字、かな 1½ a­b\n\x00x"
    assert re.findall(r"[^\W_]+", plain(text).decode()) == words(text)
    assert words("É") == words("É") and words("Ａ１") == ["a1"]


def brute(docs, items):
    """Items of LEAST_WORDS and more by every alignment; shorter ones as whole texts or lines."""
    found = set()
    for i, text in docs:
        mine = words(text)
        lines = {tuple(words(x)) for x in (text or "").split("\n")} | {tuple(mine)}
        for number, item in items:
            its = words(item)
            if not its:
                continue
            if len(its) < dc.LEAST_WORDS:
                if tuple(its) in lines:
                    found.add((i, number))
                continue
            size = min(dc.OVERLAP, len(its))
            need = -(-size * dc.EQUAL_PERCENT // 100)
            for start in range(-len(its) + 1, len(mine)):
                lo, hi = max(0, -start), min(len(its), len(mine) - start)
                same = [its[k] == mine[start + k] for k in range(lo, hi)]
                if any(sum(same[k : k + size]) >= need for k in range(len(same) - size + 1)):
                    found.add((i, number))
                    break
    return found


def test_like_brute_force_over_unicode_punctuation(spark, corpus, awkward):
    rng = random.Random(8)
    vocabulary = ["uno", "dós", "three", "vier", "fünf", "６", "семь", "漢字", "nine9", "ten"]
    apart = [" ", ", ", " ", " — ", "“", "”. ", "\n", "　", "_", "…"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice(apart) for _ in range(n))

    items = [(n, text(rng.choice([0, 1, 2, 3, 5, 7, 8, 9, 10, 11, 12, 13, 20, 40]))) for n in range(40)]
    docs = []
    for i in range(150):
        middle = words(rng.choice(items)[1])
        for _ in range(rng.randrange(4)):
            if middle:
                middle[rng.randrange(len(middle))] = rng.choice(vocabulary)
        cut = rng.randrange(3)
        body = "".join(w + rng.choice([a for a in apart if a != "_"]) for w in middle[cut:])
        docs.append((100 + i, rng.choice(["", "\n", text(6), text(30) + "\n"]) + body + rng.choice(["", "\n" + text(9)])))
    rows = [*awkward, *docs]
    bench = spark.createDataFrame([*items, (None, items[3][1]), (99, None)], "item_id bigint, text string")
    want = brute(rows, [*items, (None, items[3][1])])
    frame = corpus(rows)
    got = dc.benchmark_overlaps(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 60
    kept = dc.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    dirty = {i for i, _ in want}
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        (str(i), str(t)) for i, t in rows if i not in dirty
    )


def test_short_items_are_whole_lines_or_texts(spark, corpus):
    bench = spark.createDataFrame([(1, "Yes."), (2, "Paris, of course"), (3, "two\nlines")], "item_id bigint, text string")
    rows = [(1, "yes"), (2, "he said yes"), (3, "Q?\nYES!\nand more text here"), (4, "Paris — of course…"), (5, "two lines"),
            (6, "two\nlines"), (7, "a two lines"), (8, "x\n\nparis of\ncourse")]
    found = {(r.doc_id, r.item_id, r.doc_word) for r in dc.benchmark_overlaps(corpus(rows), bench).collect()}
    assert found == {(1, 1, 0), (3, 1, 1), (4, 2, 0), (5, 3, 0), (6, 3, 0)}


def test_empty_tables(spark, corpus):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    docs = corpus([(1, ITEM)])
    assert dc.benchmark_overlaps(docs.where("false"), bench).collect() == []
    assert dc.benchmark_overlaps(docs, bench.where("false")).collect() == []
    assert dc.drop_contaminated(docs, bench.where("false")).count() == 1
    assert dc.drop_contaminated(docs.where("false"), bench).count() == 0
