import hashlib
import random
import re

from pyspark.sql import functions as F

from hourtally.llm import substring_dedup as sd


def brute(rows):
    return {row[0]: row[1:] for row in brute_rows(rows)}


def brute_rows(rows):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, own in words:
        for j in range(len(own) - 12):
            key = tuple(own[j : j + 13])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, own in words:
        gone = [False] * len(own)
        for j in range(len(own) - 12):
            if first[tuple(own[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        left = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((i, len(own), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def digests(found):
    return {row[0]: row[1:] for row in digest_rows(found)}


def digest_rows(found):
    out = []
    for r in found.collect():
        n = sum(s["end"] - s["first"] for s in r.removed)
        left = " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        out.append((r.doc_id, r.n_words, n, hashlib.sha256(left.encode()).hexdigest()))
    return out


def passages(seed=5):
    rng = random.Random(seed)
    fresh = iter(range(10**6))
    shared = [[f"s{k}_{i}" for i in range(rng.choice((12, 13, 14, 60, 200)))] for k in range(8)]
    rows = []
    for doc_id in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += [f"f{next(fresh)}" for _ in range(rng.randrange(0, 30))]
            part = rng.choice(shared)
            lo = rng.randrange(0, len(part))
            words += part[lo : lo + rng.randrange(1, 90)]
        rows.append((doc_id, rng.choice((" ", "\n", " \t ")).join(words)))
    rows.append((60, "la " * 40))  # one word, over and over
    rows.append((61, "la " * 30 + "le"))
    rng.shuffle(rows)
    return rows


def test_like_brute_force(spark, sample, corpus):
    rows = [(r.doc_id + 1000, r.text) for r in sample("documents").select("doc_id", "text").collect()]
    rows += passages()
    assert digests(sd.substring_dedup(corpus(rows))) == brute(rows)


def test_awkward_rows(corpus, awkward):
    found = sd.substring_dedup(corpus([*awkward, (9, awkward[8][1])]))
    rows = found.collect()
    assert len(rows) == len(awkward) + 1
    removed = {r.doc_id: r.removed for r in rows if r.removed}
    assert removed == {9: [(0, 120_000)]}
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[1].n_words == 0
    assert by_id[2].text == "" and by_id[3].text == " \t\n "
    assert sd.substring_dedup(corpus([])).collect() == []


def test_ids_with_several_texts(corpus):
    fresh = iter(range(10**6))
    part = {k: " ".join(f"{k}{i}" for i in range(90)) for k in "abcd"}

    def text(*kinds):
        return " ".join(
            f"x{next(fresh)} {part[k]}" if k in part else f"x{next(fresh)}" for k in kinds
        )

    rows = [
        (1, part["a"]),
        (3, text("b")), (3, text("c")),  # two texts with blocks of the same numbers
        (5, part["a"]), (5, text("d")),  # one is a copy, the other has what 9 repeats
        (5, None),
        (7, text("c", "b")),
        (9, text("d", "a")),
        (9, text("d", "a")),
    ]
    got = digest_rows(sd.substring_dedup(corpus(rows)))
    assert sorted(got) == sorted(brute_rows(rows))


def test_layout_around_a_passage_stays(corpus):
    shared = " ".join(f"p{i}" for i in range(20))
    docs = corpus([(1, shared), (2, f"  head\n\nof it {shared}\ttail.\n"), (3, f"x {shared}"), (4, shared)])
    left = sd.drop_repeated_passages(docs)
    assert left.columns == docs.columns
    rows = {r.doc_id: r for r in left.collect()}
    # Document 4 has nothing left and goes.
    assert {i: r.text for i, r in rows.items()} == {1: shared, 2: "  head\n\nof it tail.\n", 3: "x "}
    assert rows[2].n_chars == len(rows[2].text) and rows[1].rest == "x"


def test_query(spark, sample):
    got = sd.op9_substring_dedup(spark, "/root/testdata/sf0.001")
    want = brute([(r.doc_id, r.text) for r in sample("documents").collect()])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == want
    assert got.where(F.col("n_removed") > 0).count() > 0


def test_copies_that_keep_nothing_but_blanks_go(spark, corpus):
    text = " ".join(f"w{i}" for i in range(30))
    docs = corpus([(1, text), (2, "\n" + text), (3, "\t " + text + " \x0b"), (4, text), (5, " \n"), (6, None), (7, "")])
    assert sorted(r.doc_id for r in sd.drop_repeated_passages(docs).collect()) == [1, 5, 6, 7]
