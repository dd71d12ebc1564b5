import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import whitening
from lakeops.llm.queries import op11_whiten


def brute(vectors):
    """(integers, deviations, centred rows, falling eigenvalues, eigenvectors, trace) of plain arithmetic."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    z = n * x - s
    centred = (z / n).astype(float)
    cov = centred.T @ centred / n
    value, vector = np.linalg.eigh(cov)
    return (z * z).sum(axis=1), centred, value[::-1], vector[:, ::-1], np.trace(cov)


def check(spark, rows, kept, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, v string")
    got = sorted(whitening.whiten(df.repartition(3), **how).collect(), key=lambda r: r.vec_id)
    kept = sorted(kept)
    deviation, centred, value, vector, trace = brute([v for _, v in kept])
    k = min(how.get("components", 32), int((value > len(value) * 1e-15 * max(value[0], 0)).sum()))
    assert [r.vec_id for r in got] == [i for i, _ in kept]
    assert [int(r.deviation) for r in got] == deviation.tolist() and {r.n for r in got} == {len(kept)}
    w = np.array([r.whitened for r in got]).reshape(len(got), -1)
    assert w.shape[1] == k and np.allclose(got[0].explained, value[:k] / trace, rtol=1e-9)
    for i in range(k):
        expected = centred @ vector[:, i] / np.sqrt(value[i])
        assert np.allclose(w[:, i] * np.sign(w[:, i] @ expected), expected, atol=1e-6)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-6
    return got


@pytest.mark.parametrize("spread,width", [(1.0, 7), (300.0, 3), (1e7, 2)])
def test_equals_plain_arithmetic(spark, spread, width):
    rng = random.Random(width)
    rows = [(i, [rng.uniform(-spread, spread) for _ in range(width)], None, "x") for i in range(130)]
    check(spark, rows, [(i, v) for i, v, *_ in rows])
    check(spark, rows, [(i, v) for i, v, *_ in rows], components=2)


def test_wide_integers_are_exact(spark):
    """Deviations and products far beyond 64 bits."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1e15, 1e15), rng.uniform(-1, 1)], None, None) for i in range(50)]
    got = check(spark, rows, [(i, v) for i, v, *_ in rows])
    assert max(int(r.deviation) for r in got) > 1 << 64


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25]), (2, [0.5, -0.25]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.0, 3.0])]
    bad = [(10, None), (11, []), (12, [None, 1.0]), (13, [nan, 1.0]), (14, [1.0, inf]), (15, [1.0, 2.0, 3.0]), (16, [1e30, 0.0]), (17, [1.0])]
    check(spark, [(i, v, 3, "v") for i, v in good + bad], good)
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(frame([])).collect() == [] and whitening.whiten(frame(bad[:3])).collect() == []
    alone = whitening.whiten(frame([(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in alone] == [(2, 0, [], [], 0.0)] * 2
    flat = whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 5.0])])).collect()
    assert [len(r.whitened) for r in flat] == [1, 1]


def test_commonest_width_whatever_comes_first(spark):
    rows = [(0, [1.0] * 5)] + [(i, [float(i % 7), float(i % 5), 1.0 / (1 + i)]) for i in range(1, 40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(r.vec_id for r in got) == list(range(1, 40))


def test_plane_counts():
    y = np.array([[5, 0], [3, 1], [7, 1], [0, 0], [1, 1]])
    bits = np.array([3, 1])
    counts = whitening.plane_counts(whitening.pack_planes(y, bits))
    assert np.triu(whitening.weigh(counts, bits)).tolist() == np.triu(y.T @ y).tolist()


def test_query_columns(spark):
    out = op11_whiten(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    one = out.groupBy("vec_id").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("c")).distinct()
    assert {(r.a, r.b, r.c) for r in one.select("a", "b", "c").collect()} == {(1, 32, 32)}
