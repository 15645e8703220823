import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourtally.llm import embedding_whitening as ew

SCHEMA = "vec_id bigint, embedding array<float>, n string, vector string, component string, whitened string"


def rows_of(vectors):
    return [(i, None if v is None else [None if e is None else float(e) for e in v], *["x"] * 4) for i, v in enumerate(vectors)]


def frame(spark, vectors):
    return spark.createDataFrame(rows_of(vectors), SCHEMA)


def usable(vectors):
    rows = [(i, [float(np.float32(e)) for e in v]) for i, v in enumerate(vectors)
            if v is not None and all(e is not None and math.isfinite(e) and abs(e) < 2.0**40 for e in v)]
    sizes = [len(v) for _, v in rows]
    most = max(set(sizes), key=lambda s: (sizes.count(s), s))
    return [(i, v) for i, v in rows if len(v) == most]


def check(df, vectors, components=8):
    rows = usable(vectors)
    x = np.array([[math.floor(1024 * e) + 100000 for e in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    centred = ((n * x - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    d = cov.shape[0]
    got = df.collect()
    k = min(components, d)
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    by = {(r.vec_id, r.component): r for r in got}
    assert {i for i, _ in by} == {i for i, _ in rows}
    for (i, _), raw in zip(rows, x):
        assert by[i, 1].deviation == sum(int(v) ** 2 for v in (n * raw - sums))
    assert {r.n for r in got} == {n}
    whole = np.array([[by[i, c].whitened for c in range(1, k + 1)] for i, _ in rows], float)
    for c in range(k):
        if values[c] <= d * np.finfo(float).eps * values.sum():
            assert np.isnan(whole[:, c]).all()
            continue
        assert abs(got[0].identity_error) < 1e-9
        assert abs(by[rows[0][0], c + 1].explained - values[c] / values.sum()) < 1e-12
        # An eigenvector: the covariance of the projection with all dimensions points along it.
        along = centred.T @ whole[:, c] / n  # = sqrt(e) * v
        v = along / math.sqrt(values[c])
        assert abs(np.linalg.norm(v) - 1) < 1e-9
        assert np.abs(cov @ v - values[c] * v).max() < 1e-11 * values[0]
        assert np.abs(centred @ v / math.sqrt(values[c]) - whole[:, c]).max() < 1e-8


def sample(kind, n=400, d=12):
    rng = np.random.default_rng(kind)
    x = rng.standard_normal((n, d)) * np.linspace(1, 0.05, d)
    if kind == 1:  # copies, and dimensions that are equal
        x[50:300], x[:, 3] = x[0], x[:, 4]
    if kind == 2:  # fewer dimensions than they seem
        x[:, 2:] = 0.25
    if kind == 3:
        x *= 300
    return x.tolist()


@pytest.mark.parametrize("kind", range(4))
@pytest.mark.parametrize("parts", [1, 9])
def test_like_brute_force(spark, kind, parts, monkeypatch):
    monkeypatch.setattr(ew, "FAN", 3)
    vectors = sample(kind)
    df = frame(spark, vectors).repartition(parts)
    check(ew.whitened(df, ew.fit_whitening(df)), vectors)


def test_awkward_vectors(spark):
    vectors = [*sample(4, 60, 5), None, [], [1, 2, None, 4, 5], [1, 2, float("nan"), 4, 5], [float("inf")] * 5,
               [1e30, 0, 0, 0, 0], [1, 2, 3], [0] * 5, [0] * 5]
    df = frame(spark, vectors)
    check(ew.whitened(df, ew.fit_whitening(df)), vectors)


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 5, [[0.0]] * 3, [[1.0], [2.0], [4.0]]])
def test_no_or_little_variance(spark, vectors):
    df = frame(spark, vectors)
    rows = ew.whitened(df, ew.fit_whitening(df)).collect()
    assert len(rows) == len(vectors) * min(8, len(vectors[0]))
    if len({tuple(v) for v in vectors}) == 1:
        assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in rows} == {(None, None, 0.0, 0)}
    else:
        check(ew.whitened(df, ew.fit_whitening(df)), vectors)


def test_no_usable_rows(spark):
    for vectors in ([None, [None], [float("nan")]], [[]]):
        df = frame(spark, vectors)
        assert ew.fit_whitening(df) is None
        assert ew.whitened(df, None).collect() == []
    df = frame(spark, [[1.0]]).where("false")
    assert ew.whitened(df, ew.fit_whitening(df)).collect() == []


def test_a_deviation_beyond_a_long_is_null(spark):
    vectors = [[2.0**38, 1.0], [0.0, 1.0], [0.5, 2.0]]
    df = frame(spark, vectors)
    rows = {(r.vec_id, r.component): r.deviation for r in ew.whitened(df, ew.fit_whitening(df)).collect()}
    assert rows[0, 1] is None


def test_rank_one_updates_like_eigh():
    rng = np.random.default_rng(7)
    for values in (np.zeros(6), np.array([0, 0, 1, 1, 1, 5.0]), np.sort(rng.random(6)), np.arange(6) * 1e-12):
        for v in (rng.standard_normal(6), np.eye(6)[2], np.ones(6), np.zeros(6), np.array([1, 1e-18, 0, 0, 1e-9, 1])):
            for weight in (1.0, 1e-9, 1e9):
                got, vectors = ew.rank_one(values, np.eye(6), weight, v)
                full = np.diag(values) + weight * np.outer(v, v)
                scale = max(np.abs(full).max(), 1e-300)
                assert np.abs(np.linalg.eigvalsh(full) - got).max() < 1e-13 * scale
                assert np.abs(vectors * got @ vectors.T - full).max() < 1e-13 * scale
                assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-13


def test_query_over_the_sample(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    out = ew.op11_embedding_whitening(spark, "/root/testdata/sf0.001")
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    check(out, [r.embedding for r in rows])
    one = out.where(F.col("vec_id") == 0).orderBy("component").collect()
    assert [r.explained for r in one] == sorted((r.explained for r in one), reverse=True)
