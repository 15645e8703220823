"""The pipeline's rows against plain Python versions of its stages.

Which documents the classifier rejects is taken from its scores, which have tests of their own; what
the four other stages make of the rest is computed here with sets, loops and sorted lists.
"""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import corpus_pipeline
from hourtally.llm import quality_classifier
from hourtally.llm.mixing import BLOCK, WEIGHTS

WORD = r"[^\x20\x09-\x0D]+"


def near_duplicates(docs, limit=80):
    sets = {}
    for i, (text, _) in docs.items():
        words = re.findall(WORD, "".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= limit * (len(sets[i]) + len(sets[j]) - common):
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return {i: d for i, d in docs.items() if root(i) == i}


def substrings(docs):
    words = {i: re.findall(WORD, text or "") for i, (text, _) in docs.items()}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][j : j + 13]), i)
    out = {}
    for i, mine in words.items():
        gone = set()
        for j in range(len(mine) - 12):
            if first[tuple(mine[j : j + 13])] < i:
                gone.update(range(j, j + 13))
        left = [w for j, w in enumerate(mine) if j not in gone]
        if left or not gone:
            out[i] = (" ".join(left) if gone else docs[i][0], docs[i][1])
    return out


def letters_and_digits(text):
    return re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", (text or "").lower()).lower())


def decontamination(docs, items):
    def overlaps(mine, its):
        size = min(13, len(its))
        need = -(-size * 80 // 100)
        for start in range(-len(its) + 1, len(mine)):
            low, high = max(0, -start), min(len(its), len(mine) - start)
            same = [its[k] == mine[start + k] for k in range(low, high)]
            if any(sum(same[k : k + size]) >= need for k in range(len(same) - size + 1)):
                return True
        return False

    its = [letters_and_digits(t) for t in items]
    return {i: d for i, d in docs.items() if not any(overlaps(letters_and_digits(d[0]), it) for it in its)}


def mixing(docs):
    """``{id: (slot, place)}``, slot by slot: among the released blocks the one due first."""
    def order(i):
        return hashlib.md5(str(i).encode()).hexdigest()

    by_source = {}
    for i, (_, source) in docs.items():
        by_source.setdefault(source, []).append(i)
    blocks = {}
    for source, ids in by_source.items():
        ids.sort(key=order)
        blocks[source] = [ids[n : n + BLOCK] for n in range(0, len(ids), BLOCK)]
    weights = {s: WEIGHTS.get(s, 1) for s in blocks}
    taken, out, slot = Counter(), {}, 0
    while any(taken[s] < len(b) for s, b in blocks.items()):
        active = {s: w for s, w in weights.items() if taken[s] < len(blocks[s])}
        total, done = sum(active.values()), Counter()
        begin = Counter(taken)
        for t in range(total):
            ready = [(-(-(done[s] + 1) * total // w), s) for s, w in active.items()
                     if done[s] < w and done[s] * total // w <= t]
            _, source = min(ready)
            number = begin[source] + done[source]
            done[source] += 1
            if number < len(blocks[source]):
                for place, i in enumerate(blocks[source][number]):
                    out[i] = (slot, place)
                taken[source] += 1
            slot += 1
    return out


def corpus(rng):
    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "l", "rt", "")]

    def text(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(n))

    items = [text(n) for n in (16, 20, 30, 14)]
    shared = [text(n) for n in (60, 80, 52)]
    docs, labels = {}, {}
    for i in range(420):
        kind = rng.randrange(12)
        body = text(rng.randrange(60, 160))
        if kind == 0:
            body = "".join(rng.choice("#$%|<> ") for _ in range(300))
        elif kind == 1 and i > 20:
            twin = (docs[rng.randrange(i)][0] or "").split(" ")
            for _ in range(rng.randrange(4)):
                twin[rng.randrange(len(twin))] = rng.choice(words)
            body = " ".join(twin)
        elif kind == 2:
            cut = rng.randrange(len(body))
            body = body[:cut] + " " + rng.choice(shared) + "\n" + body[cut:]
        elif kind == 3:
            body = body + "\n“" + rng.choice(items).replace(" ", " ", 3) + "”"
        elif kind == 4 and i % 3 == 0:
            body = rng.choice([None, "", " \n", "one", shared[0]])
        docs[i] = (body, rng.choice(["src0", "src0", "src0", "src1", "src2", "src3", "src4", "été"]))
        if rng.random() < 0.8:
            labels[i] = int(kind != 0)
    return docs, labels, items


def test_run_like_plain_python(spark, tmp_path):
    docs, labels, items = corpus(random.Random(12))
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, (t, s) in docs.items()]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    marked = spark.createDataFrame([(i, q, 0) for i, q in labels.items()], "doc_id bigint, quality int, toxic int")
    marked.write.parquet(f"{tmp_path}/labels.parquet")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")

    scored = quality_classifier.quality_scores(frame, marked).where("predicted = 1").collect()
    good = {r.doc_id: docs[r.doc_id] for r in scored}
    single = near_duplicates(good)
    cut = substrings(single)
    clean = decontamination(cut, items)
    want = mixing(clean)
    sizes = [len(d) for d in (docs, good, single, cut, clean)]
    assert all(a > b for a, b in zip(sizes, sizes[1:])) and len(want) == len(clean)

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.mix_slot, r.mix_place) for r in got} == want
    for r in got:
        text, source = clean[r.doc_id]
        assert r.source == source
        assert re.findall(WORD, r.text or "") == re.findall(WORD, text or "")
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_run_on_awkward_and_empty_tables(spark, tmp_path, corpus, awkward):
    docs = corpus(awkward)
    none = docs.where("false")
    marked = spark.createDataFrame([(4, 1, 0), (7, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "x y")], "item_id bigint, text string")
    for n, (d, m, b) in enumerate(((docs, marked, bench), (none, marked, bench), (docs, marked.where("false"), bench.where("false")))):
        folder = f"{tmp_path}/{n}"
        for name, table in (("documents", d), ("labels", m), ("benchmark", b)):
            table.write.parquet(f"{folder}/{name}.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        assert (len(rows) == 0) == (n == 1)
        assert all(c in rows[0].asDict() for c in docs.columns) if rows else True
        assert len({(r.mix_slot, r.mix_place) for r in rows}) == len(rows)
