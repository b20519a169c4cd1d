import numpy as np
from pyspark.sql import functions as F

from evigraph.llm import topk


def brute(rows, k):
    out = []
    for qi, q in sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and i % 20 == 0}):
        s = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i is not None and v is not None and i != qi and len(v) == len(q))[:k]
        out += [(qi, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-500, 500, 6).tolist()) for i in range(400)]
    rows += [(1000 + i, [7] * 6) for i in range(30)] + [(3, rows[3][1])] + [(20, None), (None, [1] * 6), (2000, [1, 2]), (2001, [3, 4]), (2020, [0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, v array<long>, score int")
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    for k in (1, 10):
        assert sorted(map(tuple, topk.search(df, df.where("vec_id % 20 = 0"), k).collect())) == brute(rows, k)
    assert topk.search(df.limit(0), df.limit(0)).count() == 0
    assert topk.search(df, df.limit(0)).count() == 0


def test_index_keeps_all_possible_members():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 128, (3000, 32)), np.full((50, 32), 90), np.zeros((50, 32))]).astype(np.int64)
    index = topk.ImpactIndex(x)
    stopped = 0
    for q in [*x[::200], np.zeros(32, np.int64), -x[3050], np.eye(32, dtype=np.int64)[3] * 900]:
        rows, scores = index.search(q, 10)
        stopped += len(rows) < 400
        full = x @ q
        kth = np.sort(full)[-10]
        assert set(np.flatnonzero(full >= kth)) <= set(rows.tolist()) and (full[rows] == scores).all()
    assert stopped > 5


def test_vectors_with_nulls_take_no_part(spark):
    rows = [(1, [0.5, -0.5]), (2, [float("nan"), 0.0]), (3, [None, 1.0]), (4, None), (5, [float("inf"), 0.0]), (6, [-0.0001, 1.0]), (7, [])]
    got = {r.vec_id: r.v for r in spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", topk.integers(F.col("e")).alias("v")).collect()}
    assert got == {1: [512, -512], 2: None, 3: None, 4: None, 5: None, 6: [-1, 1024], 7: []}
