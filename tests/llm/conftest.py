"""Small corpora for the operators: sample documents, and rows of every awkward kind."""

import pytest

SAMPLE = "/root/testdata/sf0.001"
# Extra columns with names that the operators use themselves.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, rep string, label string, "
    "copy string, rest string, passages string, removed string, n_words string, mix_slot string, score string"
)


@pytest.fixture
def corpus(spark):
    """``corpus([(doc_id, text), ...], lang=, source=)``: documents with clashing extra columns."""

    def build(rows, lang="en", source="s"):
        full = [
            (i, t, lang, source, None if t is None else len(t), *["x"] * 9) for i, t in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def awkward():
    """Null, empty and blank texts, a row without id, repeated rows, one word, one very long text."""
    long = " ".join(f"w{i % 7919}x{i % 104729}" for i in range(120_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (None, "no id here at all"), (None, None),
        (5, "same row twice with more than five words"), (5, "same row twice with more than five words"),
        (6, long), (7, "é ñ ß 漢字 \u2003 wide\u00a0space"), (8, "!!! ### ,,,"),
    ]


@pytest.fixture
def sample(spark):
    return lambda name: spark.read.parquet(f"{SAMPLE}/{name}.parquet")
