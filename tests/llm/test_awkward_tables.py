"""Every query on awkward rows, on tables with clashing extra columns, and on empty tables."""

import pytest

from hourtally.llm.registry import QUERIES

# Queries that return a row for each row of documents; op8 has rows for texts with known sentences, op7 for
# overlaps, op12 for groups.
PER_DOCUMENT = ("op1", "op2", "op4", "op5", "op6", "op9", "op10", "op13")
# op9 takes rows with one id for one document.
ONE_FOR_AN_ID = ("op9",)


def folder_of(spark, path, docs, **empty):
    extra = "x"
    tables = {
        "documents": docs,
        "labels": spark.createDataFrame(
            [(1, 1, 0), (4, 0, 1), (5, 1, None), (5, 0, 0), (None, 1, 1), (99, 1, 1)],
            "doc_id bigint, quality int, toxic int",
        ),
        "benchmark": spark.createDataFrame(
            [(1, "same row twice with more than five words"), (2, None), (3, ""), (None, "one")], "item_id bigint, text string"
        ),
        "pages": spark.createDataFrame(
            [(1, None, extra), (2, "", extra), (None, "x://net/", extra), (3, "http://a.org/fr/", extra), (3, "http://a.org/fr/", extra)],
            "page_id bigint, url string, rule string",
        ),
        "embeddings": spark.createDataFrame(
            [(1, None, extra), (2, [], extra), (None, [0.5, 1.0], extra), (3, [0.25, 2.0], extra), (3, [0.25, 2.0], extra)],
            "vec_id bigint, embedding array<float>, n string",
        ),
    }
    for name, table in tables.items():
        (table.where("false") if empty.get(name) or empty.get("every") else table).write.parquet(f"{path}/{name}.parquet")
    return str(path)




@pytest.mark.parametrize("name", sorted(QUERIES))
def test_awkward_rows(spark, tmp_path, corpus, awkward, name):
    folder = folder_of(spark, tmp_path, corpus(awkward).withColumnRenamed("copy", "shard"))
    rows = QUERIES[name](spark, folder).collect()
    number = name.split("_")[0]
    if number in PER_DOCUMENT:
        ids = [i for i, _ in awkward]
        got = sorted(str(r.doc_id) for r in rows)
        if number in ONE_FOR_AN_ID:
            assert set(got) == {str(i) for i in ids}
        else:
            assert got == sorted(map(str, ids))
    again = QUERIES[name](spark, folder).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, corpus, awkward, name):
    folder = folder_of(spark, tmp_path / "every", corpus(awkward), every=True)
    assert QUERIES[name](spark, folder).collect() == []
    # Documents, but nothing to learn from and nothing to look for.
    folder = folder_of(spark, tmp_path / "some", corpus(awkward), labels=True, benchmark=True)
    rows = QUERIES[name](spark, folder).collect()
    assert name.split("_")[0] not in PER_DOCUMENT or rows
