"""Toxicity, quality and language: against brute force, and on rows held out."""

import math
import os
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from evigraph.llm import common, language, quality, toxicity

rng = random.Random(11)
PLAIN = ["".join(rng.choice(["ka", "lo", "mi", "ten", "ru"]) for _ in range(rng.randrange(2, 4))) for _ in range(300)]


def corpus(n=500):
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [rng.choice(PLAIN) for _ in range(rng.randrange(20, 60))]
        if bad:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), "grumb" + rng.choice(["", "ler", "lest", "x"]))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(not bad), int(bad)))
    return docs, labels


def test_toxicity_held_out_and_edges(spark):
    docs, labels = corpus()
    docs += [(9001, None, "x"), (9002, "", "x"), (None, "a grumbler", "x"), (9003, "grumb " * 3, "x"), (9003, "grumb " * 3, "x"), (9004, " ".join(PLAIN) * 200, "x")]
    labels += [(9001, 1, 1), (9002, 1, 0), (None, 1, 1), (5, None, None), (77777, 0, 1), (10, 0, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(d, l)
    got = d.select("doc_id", toxicity.score_column(F.col("text"), model, spark).alias("r")).select("doc_id", "r.*").collect()
    assert len(got) == len(docs)
    score = {r.doc_id: r.score for r in got}
    assert all((score[i] >= toxicity.THRESHOLD) == (i % 5 == 0) for i in range(500))
    assert score[9003] > 0.9 and score[9001] < 0.3 and score[9002] < 0.3 and score[9004] < 0.3 and score[None] > 0.3
    assert next(r for r in got if r.doc_id == 9003).evidence[0].cosine > 0
    bare = toxicity.train(d, l.limit(0))
    assert {round(r.r.score, 2) for r in d.select(toxicity.score_column(F.col("text"), bare, spark).alias("r")).collect()} == {0.0}
    assert d.limit(0).select(toxicity.score_column(F.col("text"), model, spark)).count() == 0


def brute_neighbours(index, text, k=toxicity.NEIGHBOURS):
    """Cosines by dictionaries, example after example."""
    unit = lambda ids, counts: dict(zip(ids.tolist(), index.unit(ids, counts).tolist()))
    q = unit(*index.vectors([text])[0])
    cosines = [sum(w * e.get(t, 0) for t, w in q.items()) for e in (unit(*toxicity.unpack(x)) for x in index.packed)]
    return sorted((-round(c, 12), i) for i, c in enumerate(cosines) if c > toxicity.MARGIN)[:k]


def test_block_max_index_finds_the_exact_neighbours_and_skips_blocks(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    g = np.random.default_rng(1)
    kinds = [[k + a + b for a in "abcdefghij" for b in "uvwxyz"] for k in ("ka", "lo", "mi", "ru")]
    texts = [" ".join(g.choice(kinds[i % 4], g.integers(1, 40))) for i in range(700)] + ["kaau kaav"] * 30 + ["", "..."]
    found = toxicity.terms(texts)
    vocabulary = np.unique(np.concatenate([i for i, _ in found]))
    index = toxicity.Index([(i, toxicity.pack(np.searchsorted(vocabulary, t), n), i % 3 == 0) for i, (t, n) in enumerate(found)], vocabulary, np.log(2 + np.arange(len(vocabulary))))
    queries = [*texts[::23], "kaau loau miau ruau unknown", "unknown", None]
    for text, near in zip(queries, index.search(index.vectors(queries))):
        want = brute_neighbours(index, text)
        assert [i for _, i in near] == [i for _, i in want] and np.allclose([c for c, _ in near], [-c for c, _ in want], atol=1e-11)
    assert index.skipped > 0.3 * index.met
    assert all(c <= toxicity.COPY for near in index.search(index.vectors(queries), copies=False) for c, _ in near)


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_query_of_toxicity_equals_brute_force_and_is_calibrated(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    index = toxicity.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in toxicity.op3_toxicity_neighbours(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        want = brute_neighbours(index, texts[i])
        assert [e.doc_id for e in r.evidence] == [int(index.ids[j]) for _, j in want]
        share = (sum(-c * index.y[j] for c, j in want) + toxicity.PRIOR * index.base) / (sum(-c for c, _ in want) + toxicity.PRIOR)
        assert math.isclose(r.score, index.calibrated(share), abs_tol=1e-9) and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.evidence or not any(map(str.isalpha, texts[i] or ""))


BIG = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(BIG), reason="no test data")
def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    index = toxicity.train(docs, labels)
    rows = docs.join(labels, "doc_id").where((common.remainder(F.col("doc_id"), 4) == 2) & F.col("toxic").isNotNull()).select("text", "toxic").collect()
    y = np.array([r.toxic for r in rows])
    p = np.array([s for s, _ in index.scores(index.vectors([r.text for r in rows]))])
    assert (p[y == 1] >= toxicity.THRESHOLD).mean() >= 0.9 and (p[y == 0] >= toxicity.THRESHOLD).mean() <= 0.01
    assert ((p - y) ** 2).mean() < 0.02
    for low, high in ((0, 0.1), (0.1, 0.5), (0.5, 1.01)):
        inside = (p >= low) & (p < high)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.2 or inside.sum() < 15


def test_near_copy_of_a_toxic_text_of_words_seen_once_is_found(spark):
    docs, labels = corpus(200)
    free = [i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 4 != 2]
    rare = [f"zy{a}{b}qu" for a in "bcdfghjk" for b in "aeiou"]
    docs += [(i, " ".join(rare), "x") for i in free[:3]] + [(9100, " ".join(rare[1:]), "x"), (9101, docs[1][1] + " more", "x")]
    labels += [(i, 0, 1) for i in free[:3]]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.r for r in d.where("doc_id > 9000").select("doc_id", toxicity.score_column(F.col("text"), model, spark).alias("r")).collect()}
    assert got[9100].score > 0.5 and got[9100].evidence[0].toxic == 1 and got[9100].evidence[0].cosine > 0.9
    assert got[9101].score < toxicity.THRESHOLD and len(got[9101].evidence) == toxicity.NEIGHBOURS  # no toxic term, and still searched


def test_labelled_sample_is_bounded_and_outside_the_fold(spark):
    d = spark.createDataFrame([(i, "t", 0) for i in range(400)], "doc_id long, text string, y int")
    l = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r.y for r in common.labelled_sample(d.union(d).union(d), l, "toxic", 4, 2, 50).collect()}
    assert len(got) == 50 and common.labelled_sample(d.union(d), l, "toxic", 4, 2, 50).count() == 50 and all(zlib.crc32(str(i).encode()) % 4 != 2 and y == i % 2 for i, y in got.items())


def test_quality_ranks_held_out_rows(spark):
    docs, labels = corpus(300)
    docs = [(i, t.upper() + "!!" if i % 5 == 0 else t, s) for i, t, s in docs] + [(9001, None, "x"), (9002, "", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    l = spark.createDataFrame(labels + [(9001, 0, 0), (9002, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(d, l)
    score = {r.doc_id: r.s for r in d.select("doc_id", quality.score_column(F.col("text"), model).alias("s")).collect()}
    assert np.mean([(score[i] >= 0.5) == (i % 5 != 0) for i in range(300)]) > 0.98 and 0 <= score[9001] == score[9002] <= 1
    none = quality.train(d, l.limit(0))
    assert {r.s for r in d.select(quality.score_column(F.col("text"), none).alias("s")).collect()} == {0.5}


def test_quality_learns_from_all_pairs_of_all_labelled_rows(spark):
    g = np.random.default_rng(3)
    n, width = 300, len(quality.FEATURES)
    x = g.normal(size=(n, width))
    x[0] *= 10  # an odd text
    y = (x[:, 0] - x[:, 1] / 2 + g.normal(size=n) > 1).astype(int)
    rows = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], "x array<double>, y int").repartition(5).localCheckpoint()
    m = quality.train_rows(rows)
    d = (x[y == 1][:, None, :] - x[y == 0][None, :, :]).reshape(-1, width)
    grad = d.T @ (1 / (1 + np.exp(np.clip(d @ m["w"], -500, 500)))) / len(d) - quality.RIDGE * m["w"]
    assert np.abs(grad).max() < 2e-5
    assert abs(m["threshold"] - np.quantile(x @ m["w"], (y == 0).mean())) < 1e-9
    values = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 5.0, -1e9, 7.5, 7.5]], "s double")
    for share in (0.0, 0.1, 0.33, 0.5, 0.75, 0.9, 1.0):
        assert abs(quality.quantile(values, share) - np.quantile([1.0, 2.0, 2.0, 2.0, 5.0, -1e9, 7.5, 7.5], share)) < 1e-5


def test_quality_takes_every_labelled_row_once(spark):
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(400)] + [(3, [-1.0]), (None, [0.0]), (5, None)], "doc_id long, x array<double>")
    l = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(7, None), (4, 1), (900, 1), (None, 0)], "doc_id long, quality int")
    got = sorted((r.x[0], r.y) for r in quality.labelled(rows, l).collect())
    want = sorted((-1.0 if i == 3 else float(i), 1 if i == 4 else i % 2) for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1)
    assert got == want


def test_newton_reaches_the_stationary_point():
    g = np.random.default_rng(0)
    x = g.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] + g.normal(size=400) > 0).astype(int)
    m = quality.fit(x, y, pairs=5000)
    r = np.random.default_rng(42)
    d = x[r.choice(np.flatnonzero(y == 1), 5000)] - x[r.choice(np.flatnonzero(y == 0), 5000)]
    grad = d.T @ (1 - 1 / (1 + np.exp(-d @ m["w"]))) / 5000 - quality.RIDGE * m["w"]
    assert np.abs(grad).max() < 1e-6


def slow_bits(grams, text):
    """Code length by walking the contexts byte by byte."""
    b = b"\0\0\0" + text.encode()
    seen = {x for g in grams for x in g}
    bits = 0.0
    for i in range(3, len(b)):
        gone: set = set()
        for k in (3, 2, 1, 0):
            here: Counter = Counter()
            for g, n in grams.items():
                if g[3 - k : 3] == b[i - k : i]:
                    here[g[3]] += n
            here = Counter({s: n for s, n in here.items() if s not in gone})
            if not here:
                continue
            whole = sum(here.values()) + len(here)
            if here[b[i]]:
                bits -= math.log2(here[b[i]] / whole)
                break
            bits -= math.log2(len(here) / whole)
            gone |= set(here)
        else:
            bits += math.log2(256 - len(gone))
    return bits


def test_code_lengths_equal_a_walk_through_the_contexts():
    texts = {"a": "the cat sat on the mat, the end", "b": "der hund und die katze äß"}
    grams = {}
    for lang, t in texts.items():
        b = b"\0\0\0" + t.encode()
        grams[lang] = Counter(b[i : i + 4] for i in range(len(b) - 3))
    model = language.build([(lang, int.from_bytes(g), n) for lang, c in grams.items() for g, n in c.items()])
    for t in ("the mat", "und the", "zzz 中", "ä", "x"):
        assert np.allclose(language.code_lengths(model, t), [slow_bits(grams[lang], t) for lang in ("a", "b")], rtol=1e-4)
        assert np.allclose(language.code_lengths(model, t, block=2), language.code_lengths(model, t))


def test_language_held_out_and_edges(spark):
    words = {"aa": ["ka", "lo", "mi"], "bb": ["stu", "pro", "ench"], "cc": ["éz", "ñó", "já"]}
    docs = [(i, " ".join("".join(rng.choice(words[l]) for _ in range(3)) for _ in range(12)), l) for i, l in ((i, "abc"[i % 3] * 2) for i in range(240))]
    docs += [(9001, None, "aa"), (9002, "", "aa"), (9003, "12 34 !!", "bb"), (9004, "ka " * 30000, None), (None, "stupro", "bb")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, lang string, lang_pred int")
    got = {r.doc_id: r.r for r in d.select("doc_id", language.predict_column(F.col("text"), language.train(d), spark).alias("r")).collect()}
    assert all(got[i].lang_pred == l for i, _, l in docs[:240])
    assert [got[i].lang_pred for i in (9001, 9002, 9003, 9004)] == ["und", "und", "und", "aa"] and got[9001].score == 0
    assert got[9001].excess is None and got[0].margin > 0.25 and 0.5 < got[0].excess < 1.5
    alone = language.train(d.where("lang = 'aa'"))
    assert {r.r.margin for r in d.select(language.predict_column(F.col("text"), alone, spark).alias("r")).collect()} == {None}
    empty = language.train(d.limit(0))
    assert {r.r.lang_pred for r in d.select(language.predict_column(F.col("text"), empty, spark).alias("r")).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rows = [(10 * i + j, f"word{i} text", f"l{i:03}") for i in range(230) for j in range(8)]
    got = language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert got.select("lang").distinct().count() == 230


def test_language_model_is_built_in_little_memory(monkeypatch):
    rng = random.Random(9)
    rows = sorted({(lang, int.from_bytes(bytes(rng.randrange(40, 120) for _ in range(4)))): rng.randrange(1, 9) for lang in ("aa", "bb") for _ in range(10_000)}.items())
    rows = [(*key, n) for key, n in rows]
    tracemalloc.start()
    model = language.build(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * model["bits"].nbytes
    monkeypatch.setattr(language, "CONTEXTS", 7)
    few = language.build(rows[:300])
    monkeypatch.setattr(language, "CONTEXTS", 1 << 20)
    whole = language.build(rows[:300])
    assert all((few[k] == whole[k]).all() for k in ("node", "bits", "typical"))
