import random

import pytest
import xxhash

from evigraph.llm import simhash
from evigraph.llm.components import components


def brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_is_the_majority_of_the_hashes():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "ÄB äb Äb x\u0085y z", "a b c " * 400] + [" ".join(rng.choice("ab cd É x1 Zq".split()) for _ in range(rng.randrange(1, 40))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t) & (2**64 - 1) == brute(t)


def test_blocks_do_not_change_a_long_text(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole


def test_links_lose_nothing(spark):
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(40)} | {0, 2**64 - 1}
    for f in list(fps):
        for k in range(5):
            g = f
            for b in rng.sample(range(64), k):
                g ^= 1 << b
            fps.add(g)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bits in (0, 1, 3):
        grown = {r.node: r.root for r in simhash.linked(df, bits).collect()}
        root = {a: a for a in signed}
        for _ in signed:
            new = {a: min(root[b] for b in signed if bin((a ^ b) & (2**64 - 1)).count("1") <= bits) for a in signed}
            if new == root:
                break
            root = new
        assert {a: grown.get(a, a) for a in signed} == root


def jaccard(a, b, k=5):
    sets = [{tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_copies_by_similarity(spark):
    """One text stays of each group; of links at 0.8 or more nine of ten at least are found, and none below."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("kalomitenru") for _ in range(rng.randrange(2, 9)))
    docs, alike, apart, at = [], [], [], 0
    for group in range(150):
        words = [word() for _ in range(rng.randrange(60, 400))]
        copy = edited(rng, words, rng.randrange(1, 2 + len(words) // 25))
        docs += [(at, " ".join(words)), (at + 1, copy)]
        (alike if jaccard(*(t for _, t in docs[-2:])) >= 0.8 else apart).append(at)
        at += 2
    hot = [word() for _ in range(200)]
    docs += [(1000 + i, edited(rng, hot, 1)) for i in range(400)]  # a large group of different near copies
    docs += [(5000, None), (5001, ""), (5002, " \t"), (5003, "two words"), (5004, "Two  WORDS"), (5005, "w " * 100_000), (5006, "w " * 100_001)]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, node string")
    kept = simhash.representatives(d)
    assert kept.columns == d.columns
    stay = {r.doc_id for r in kept.collect()}
    assert all(i in stay and i + 1 in stay for i in apart) and all(i in stay for i in alike)
    assert sum(i + 1 not in stay for i in alike) >= 0.9 * len(alike) and len(alike) > 60 and len(apart) > 20
    assert [i for i in stay if 1000 <= i < 5000] == [1000] and [i for i in sorted(stay) if i >= 5000] == [5000, 5003, 5005]


def test_classes(spark):
    docs = spark.createDataFrame([(5, "a b c d", 1), (3, "A b C d", 2), (3, "A b C d", 2), (9, None, 3), (8, "", 4), (None, "a b c d", 5), (7, "unlike all others here", 6)], "doc_id long, text string, fp int")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.classes(docs).collect())
    assert got == [(-1, 3), (3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (9, 8)]
    assert simhash.classes(docs.limit(0)).count() == 0
    assert sorted((r.doc_id, r.text) for r in simhash.representatives(docs).collect()) == [(3, "A b C d"), (7, "unlike all others here"), (8, "")]
    some = docs.where("doc_id in (5, 9, 8, 7)")
    assert sorted(r.doc_id for r in simhash.representatives(some).collect()) == [5, 7, 8] and simhash.representatives(some).columns == docs.columns
    assert sorted(r.text for r in simhash.representatives(docs.where("doc_id is null")).collect()) == ["a b c d"]
    assert simhash.representatives(docs.limit(0)).count() == 0


def test_components_of_a_chain_a_star_and_a_cycle(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 260)]
    cycle = [(1, 2), (2, 3), (3, 1), (3, 3), (1, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + cycle + [(None, 4)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 200 for i in range(200, 260)}, 1: 1, 2: 1, 3: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bits_beyond_the_cover_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.linked(spark.createDataFrame([], "fp long"), 4)


def test_few_links_are_kept_in_few_partitions(spark):
    links = spark.range(500).selectExpr("id + 1 a", "id b").union(spark.range(600, 700).selectExpr("id a", "600L b")).repartition(40)
    out = components(links)
    assert out.rdd.getNumPartitions() <= 2
    assert {(r.node, r.root) for r in out.collect()} == {(i, 0) for i in range(501)} | {(i, 600) for i in range(600, 700)}


def test_shingles_are_made_once_and_of_the_texts_of_pairs_only(spark, monkeypatch):
    texts = {1: "a b c d e f g h i j k l", 2: "a b c d e f g h i j k l m", 3: "none of these words stand in one of the others"}
    docs = spark.createDataFrame([*texts.items(), (1, "another text of the same id")], "doc_id long, text string")
    node = {i: simhash.signed(t)[0] for i, t in texts.items()}
    firsts = spark.createDataFrame([(n, i) for i, n in node.items()], "node long, first long")
    plans, stored = [], simhash.common.stored
    monkeypatch.setattr(simhash.common, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df))
    pairs = spark.createDataFrame([(node[1], node[2]), (node[1], node[3])], "a long, b long")
    assert [tuple(r) for r in simhash.alike(docs, firsts, 0.8, 5)(pairs).collect()] == [(node[1], node[2])]
    (plan,) = (p for p in plans if "EvalPython" in p or "InPandas" in p)
    assert plan.count("EvalPython") + plan.count("InPandas") == 1
    assert plan.index("Python" if "EvalPython" in plan else "InPandas") < plan.index("Join")


def test_a_round_of_components_is_one_join(spark, monkeypatch):
    plans, stored = [], simhash.common.stored
    monkeypatch.setattr(simhash.common, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df))
    chain = [7, 31, 2, 19, 11, 3, 23, 5]
    out = components(spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long"))
    assert {(r.node, r.root) for r in out.collect()} == {(i, 2) for i in chain}
    assert len(plans) > 2 and all(p.count("Join") <= 1 for p in plans)
