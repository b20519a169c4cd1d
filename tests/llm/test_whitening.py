import numpy as np
import pytest
from pyspark.sql import functions as F

from evigraph.llm import whitening as X

SCHEMA = "vec_id long, embedding array<float>"


def direct(vectors):
    """(n, sums, eigenvalues, eigenvectors, trace, x by row) of whole vectors by the exact covariance."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors], dtype=np.int64)
    once = np.unique(x, axis=0)
    centred = once - once.sum(0) / len(once)
    v = centred.T @ centred / len(once)
    e, u = np.linalg.eigh(v)
    return len(once), once.sum(0), e[::-1], u[:, ::-1], np.trace(v), x


def check(got, ids, vectors, k, loose=1e-8):
    n, sums, e, u, trace, x = direct(vectors)
    assert len(got) == len(ids) * k
    signs = {}
    rows = {}
    for r in got:
        rows.setdefault((r.vec_id, r.component), []).append(r)
    for i, vec in zip(ids, x):
        far = sum((n * int(a) - int(s)) ** 2 for a, s in zip(vec, sums))
        for c in range(k):
            want = float((vec - sums / n) @ u[:, c] / np.sqrt(e[c]))
            r = rows[i, c + 1][0]
            assert (r.n, r.deviation) == (n, far) and abs(r.explained - e[c] / trace) <= 1e-10 and r.identity_error <= 1e-9
            sign = signs.setdefault(c, 1 if abs(r.whitened - want) <= abs(r.whitened + want) else -1) if abs(want) > 1e-3 else signs.get(c)
            assert abs(r.whitened - (sign or 1) * want) <= loose * max(1, abs(want)) or sign is None


def spread(rng, n, dims, scales):
    turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    return (rng.standard_normal((n, dims)) * scales) @ turn


@pytest.mark.parametrize("fall", [0.3, 0.97])
def test_components_equal_the_whole_decomposition(spark, fall):
    rng = np.random.default_rng(3)
    vectors = spread(rng, 700, 40, 5 * fall ** np.arange(40)).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:1].repeat(300, 0)])
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], SCHEMA).withColumn("component", F.lit(9)).repartition(5)
    got = X.whitened(df).collect()
    check(got, ids, vectors.tolist(), 4)
    model = X.fit(df.select(X.integers(F.col("embedding")).alias("x")).distinct())
    assert (model.width < 40) == (fall < 0.5)  # a slowly falling spectrum needs all dimensions


def test_odd_vectors_and_tables(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((30, 6)).round(3).tolist()
    bad = [(100, None), (101, [1.0, float("nan"), *[0.0] * 4]), (102, [1.0, None, *[0.0] * 4]), (103, [float("inf")] * 6)]
    rows = [(i, v) for i, v in enumerate(vectors)] + bad + [(7, vectors[7]), (None, vectors[3])]
    got = X.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 * 32 and {r.vec_id for r in got} == {None, *range(30)}
    check([r for r in got if r.vec_id is not None and r.vec_id != 7] + [r for r in got if r.vec_id == 7][:4], list(range(30)), vectors, 4)
    short = X.whitened(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [0.5, -1.0]), (4, [])], SCHEMA)).collect()
    check(short, [1, 2, 3, 4], [[1.0, 0], [1.0, 2.0], [0.5, -1.0], [0.0, 0.0]], 2)
    flat = X.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], SCHEMA)).collect()
    check(flat, list(range(9)), [[float(i), 2.0 * i, 0.0] for i in range(9)], 1)
    for none in ([], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, [])]):
        assert X.whitened(spark.createDataFrame(none, SCHEMA)).count() == 0


def test_deviations_are_exact_beyond_doubles():
    x = np.array([[3, -2], [2**20, 5]], dtype=np.int64)
    assert X.deviations(x, 10**6, np.array([7, 11])) == [(3 * 10**6 - 7) ** 2 + (2 * 10**6 + 11) ** 2, (2**20 * 10**6 - 7) ** 2 + (5 * 10**6 - 11) ** 2]
    assert X.deviations(x[:1], 2**31, np.array([1, 1])) == [(3 * 2**31 - 1) ** 2 + (2 * 2**31 + 1) ** 2]
