import re
from collections import Counter

import pytest

from hourtally.llm import decontamination as dc
from hourtally.llm import licenses as lc
from hourtally.llm import mixing as mx
from hourtally.llm import url_filter as uf
from hourtally.llm.tables import literal_rows

# --- urls ---

URLS = [
    None, "", "nothing", "http://", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y", "x://b.net?/en/",
    "x://example.net/EN/", "x://notexample.net/en/a", "x://example.com/de", "x://example.com/de/#a",
    "x://w.example.com/de/a/b/c", "x://org/fr/", "x://a.org/fr/1", "x://a.org/f", "x://.net/", "x://a..net//",
    "x://example.net/en", "x://u:p@example.net:80/en/", "a://b://c.net/", "x://net\n/en/", "x://É.ORG/fr/\n",
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize(
    "rules",
    [
        uf.RULES,
        (("example.net", "/e", "block"), ("example.net", "/en/x", "allow"), ("a.org", "/fr/1", "block"),
         ("org", "/fr/1", "allow"), ("net", "/", "block"), ("net", "/", "allow"), ("c.net", "//", "block")),
    ],
)
def test_urls_like_brute_force(spark, rules):
    urls = [*URLS, "x://" + "a." * 500 + "net/" + "en/" * 500]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    found = uf.url_verdicts(pages.union(pages.limit(5)), literal_rows(spark, ("host", "path", "verdict"), rules))
    assert found.count() == len(urls) + 5
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {i: judged(u, rules) for i, u in enumerate(urls)}


def test_the_short_number_is_the_only_key(spark, plan):
    pages = spark.createDataFrame([(i, URLS[i % len(URLS)]) for i in range(99)], "page_id bigint, url string")
    rules = spark.createDataFrame(list(uf.RULES) * 5, "host string, path string, verdict string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(uf.url_verdicts(pages, rules))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line.split("SortMergeJoin ")[1] for line in found.split("\n") if "SortMergeJoin" in line]
    assert len(joins) == 2 and any(re.match(r"\[short#\d+L\], \[short#\d+L\], Inner", j) for j in joins)
    assert "Python" not in found and "Arrow" not in found


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "x://a.net/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [r.verdict for r in uf.url_verdicts(pages, none).collect()] == ["allow"]
    rules = literal_rows(spark, ("host", "path", "verdict"), uf.RULES)
    assert uf.url_verdicts(pages.where("false"), rules).collect() == []


# --- mixing ---


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 7, "b": 2, "c": 1}, {f"s{i}": 1 + i % 5 for i in range(40)}])
def test_pattern_stays_within_one_block_of_the_shares(weights):
    pattern = mx.round_pattern(weights)
    total, taken = sum(weights.values()), Counter()
    for slot, (source, k) in enumerate(pattern, 1):
        assert k == taken[source]
        taken[source] += 1
        assert all(abs(taken[s] - slot * w / total) < 1 for s, w in weights.items())
    assert taken == weights


def test_mixture_has_every_document_once_and_keeps_the_shares(spark, corpus):
    docs = corpus([(i, f"t{i}") for i in range(3000)], source="big")
    docs = docs.union(corpus([(5000 + i, f"t{i}") for i in range(700)], source="small"))
    docs = docs.union(corpus([(7000, "a"), (7001, None), (None, "b"), (None, None)], source=None))
    docs = docs.union(corpus([(8000, "gone")], source="off"))
    mixed = mx.mix_sources(docs, {"big": 3, "small": 2, "off": 0}, block=10)
    assert mixed.columns == [*(c for c in docs.columns if c != "mix_slot"), "mix_slot", "mix_place"]
    rows = sorted(mixed.collect(), key=lambda r: (r.mix_slot, r.mix_place))
    assert len({(r.mix_slot, r.mix_place) for r in rows}) == len(rows) == 3704
    blocks = Counter((r.mix_slot, r.source) for r in rows)
    assert len({slot for slot, _ in blocks}) == len(blocks) and max(blocks.values()) == 10
    # Sources big 3, small 2 and null 1 take turns; the null source ends in the first round.
    taken = Counter()
    for slot in range(6, 6 + 5 * 34):
        taken[next(s for n, s in blocks if n == slot)] += 1
        done = slot - 5
        assert abs(taken["big"] - done * 3 / 5) < 1 and abs(taken["small"] - done * 2 / 5) < 1
    order = [r.doc_id for r in rows if r.source == "big"]
    assert order != sorted(order)


def test_bins_give_the_places_of_a_full_sort(spark, corpus):
    import hashlib

    docs = corpus([(i, f"t{i}") for i in range(4000)])
    rows = sorted(mx.mix_sources(docs, {}).collect(), key=lambda r: (r.mix_slot, r.mix_place))
    want = sorted(range(4000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert [r.doc_id for r in rows] == want


def test_mixing_awkward_rows(corpus, awkward):
    assert mx.mix_sources(corpus(awkward), {}).count() == len(awkward)
    assert mx.mix_sources(corpus([]), {}).collect() == []


# --- decontamination ---


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


ITEM = [f"Word{i}," for i in range(40)]


def test_passages_with_replaced_words_are_found(spark, corpus):
    def noise(k, n=200):
        return [f"n{k}x{i}" for i in range(n)]

    changed = [w if i % 8 else "other" for i, w in enumerate(ITEM)]
    rows = [
        (1, " ".join(noise(1) + ITEM + noise(2))),
        (2, " ".join(noise(3) + changed + noise(4))),
        (3, "\n".join(w.upper() for w in ITEM[10:24])),
        (4, " ".join(ITEM[:10] + noise(5))),  # fewer than OVERLAP words
        (5, " ".join(w if i % 3 else "other" for i, w in enumerate(ITEM))),  # a third replaced
        (6, " ".join(noise(6) + "a short one of nine words is this item".split() + noise(7))),
        (7, " ".join(noise(8))),
    ]
    bench = items(spark, [(0, " ".join(ITEM)), (1, "A short one of nine words is: this item"), (2, "too short"), (3, None), (4, "")])
    found = dc.benchmark_overlaps(corpus(rows), bench)
    got = {(r.doc_id, r.item_id): (r.doc_word, r.item_word, r.n_words, r.n_equal) for r in found.collect()}
    assert got[1, 0] == (200, 0, 40, 40)
    assert got[3, 0] == (0, 10, 14, 14)
    assert got[6, 1] == (200, 0, 9, 9)
    assert got[2, 0] == (200, 0, 40, 35) and set(got) == {(1, 0), (2, 0), (3, 0), (6, 1)}
    docs = corpus(rows)
    clean = dc.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {4, 5, 7}


def test_exact_passages_like_brute_force(spark, sample):
    docs, bench = sample("documents"), sample("benchmark")
    plain = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = {}
    for r in bench.collect():
        w = plain(r.text)
        for i in range(len(w) - 12):
            grams.setdefault(tuple(w[i : i + 13]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = plain(r.text)
        for i in range(len(w) - 12):
            want |= {(r.doc_id, k) for k in grams.get(tuple(w[i : i + 13]), ())}
    found = dc.benchmark_overlaps(docs, bench).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in found}
    # The rest has replaced words, and nearly all words equal.
    assert all(r.n_equal >= 0.8 * r.n_words - 1 for r in found)


def test_decontamination_of_awkward_rows(spark, corpus, awkward):
    bench = items(spark, [(0, " ".join(ITEM))])
    assert dc.benchmark_overlaps(corpus(awkward), bench).collect() == []
    assert dc.drop_contaminated(corpus(awkward), bench).count() == len(awkward)
    assert dc.benchmark_overlaps(corpus(awkward), items(spark, [])).collect() == []
    assert dc.drop_contaminated(corpus([(None, " ".join(ITEM))]), bench).collect() == []


# --- licences ---

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_licence_sentences_and_rules(spark, corpus, awkward):
    rows = [
        (21, f"Some text.\n{MIT}\nMore."),
        (22, "Hello!\nLicensed under the Apache License, Version 2.0. And then: released under the MIT license."),
        (23, "text | x\nThis work is licensed under the GNU General Public License, version 3.\nRELEASED UNDER THE MIT LICENSE"),
        (24, "You may obtain a copy of the License at\n\n  nowhere."),
        (25, "We spoke of the license and its warranty."),
    ]
    got = {r.doc_id: (r.sentences, r.licences) for r in lc.licence_scan(corpus([*awkward, *rows])).collect()}
    assert got == {
        21: (["mit.grant", "mit.notice"], ["MIT"]),
        22: (["apache.ref"], ["Apache-2.0"]),
        23: (["gpl3.ref", "mit.ref"], ["GPL-3.0-only", "MIT"]),
        24: (["apache.copy"], []),
    }
    assert lc.licence_scan(corpus([])).collect() == []


def test_tables_of_licences_fit_together():
    assert all(any(m in s for m in lc.MARKERS) for s in lc.SENTENCES)
    assert all(re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s) for s in lc.SENTENCES)
    assert {i for ids, _ in lc.RULES for i in ids} <= set(lc.SENTENCES.values())
