import hashlib
import math

from evigraph.llm import mixing


def test_counts_follow_the_inverse_of_the_distribution(spark):
    rows = [(i, f"t{i}", "a" if i % 3 else None, i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_key long")
    weights = spark.createDataFrame([("a", 1.0), (None, 3.0), ("b", 9.0), ("c", -1.0)], "source string, weight double")
    got = mixing.mix(docs, weights, total=4000.0).select("doc_id", "source", "mix_copy").collect()
    n = {}
    for r in got:
        n[r.doc_id] = max(n.get(r.doc_id, 0), r.mix_copy)
    assert len(got) == sum(n.values())
    known = {"a": 1.0, None: 3.0}
    for i, _, s, _ in rows:
        rate = known[s] / 4.0 * 4000 / (2000 if s == "a" else 1000)
        u = int(hashlib.md5(f"42|{i}".encode()).hexdigest()[:13], 16) / 2**52
        k, c, p = 0, math.exp(-rate), math.exp(-rate)
        while c < u:
            k += 1
            p *= rate / k
            c += p
        assert n.get(i, 0) == k


def test_edges(spark):
    docs = spark.createDataFrame([(1, "x", "s"), (1, "x", "s"), (None, None, None)], "doc_id long, text string, source string")
    assert mixing.mix(docs.limit(0)).count() == 0
    many = mixing.mix(docs, total=5000.0)
    assert many.columns == ["doc_id", "text", "source", "mix_copy", "mix_key"]
    by = {r["doc_id"]: r["count"] for r in many.groupBy("doc_id").count().collect()}
    assert by[1] % 2 == 0 and 1500 < by[1] < 3500 and 1500 < by[None] < 3500
    none = spark.createDataFrame([("s", 0.0)], "source string, weight double")
    assert mixing.mix(docs, none).count() == 0


def test_salted_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x", f"s{i % 5}") for i in range(200)], "doc_id long, text string, source string")
    want = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == want
