"""Each stage of the pipeline on its own input, against a slow form of it."""

import os
import random

import corpus_pipeline
import pytest

from evigraph.llm import language, tiling, toxicity

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


def jaccard_groups(texts, limit=0.8, k=5):
    """Each id's smallest id over links of shingle similarity, all pairs looked at, and the linked pairs."""
    ids = sorted(texts)
    words = {i: (texts[i] or "").encode().lower().split() for i in ids}
    sets = {i: {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} for i, w in words.items()}
    near = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if limit * len(sets[b]) <= len(sets[a]) <= len(sets[b]) / limit and len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b])]
    group = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in near:
            low = min(group[a], group[b])
            moved = moved or group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group, near


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    only = lambda kept: docs.where(docs.doc_id.isin(sorted(kept)))
    stage = dict(corpus_pipeline.STAGES)
    index = toxicity.train(docs, labels)
    kept = {i for i, r in rows.items() if index.score(r.text)[0] < toxicity.THRESHOLD}
    assert ids(stage["toxicity"](spark, docs, SF)) == kept and len(kept) < len(rows)
    model = language.train(only(kept))
    found = {i: language.predict(model, rows[i].text) for i in kept}
    told = {i for i in kept if found[i][3] is not None and found[i][3] <= 1.5 and found[i][4] >= 0.25}
    assert ids(stage["language"](spark, only(kept), SF)) == told
    group, _ = jaccard_groups({i: rows[i].text for i in told})
    first = ids(stage["near_copies"](spark, only(told), SF))
    want = {i for i in told if group[i] == i}
    assert want <= first and len(first - want) <= 0.1 * (len(told) - len(want)) and len(want) < len(told)
    tiler = tiling.Tiler([(r.item_id, r.text) for r in benchmark.collect()])
    clean = {i for i in first if not tiler.cover(rows[i].text)}
    assert ids(stage["decontamination"](spark, only(first), SF)) == clean and len(clean) < len(first)
    mixed = sorted((r.doc_id, r.mix_copy) for r in stage["mixing"](spark, only(clean), SF).collect())
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.mix_copy) for r in got.collect()) == mixed and mixed
    assert set(docs.columns) < set(got.columns)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages_keep_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), SF)
        assert out.count() == 0
        if name != "mixing":
            assert out.schema.names == docs.schema.names


@pytest.mark.skipif(not os.path.isdir(MID), reason="no test data")
def test_language_decides_and_keeps_clean_rows(spark):
    rng = random.Random(5)
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = ["".join(rng.choice("0123456789abcdef") for _ in range(400)), "\u4e2d\u6587\u7684\u6587\u672c" * 40, "X%% Q## Z@@ " * 60, None, "", "12 34"]
    more = spark.createDataFrame([(10**6 + i, t, None, None, None) for i, t in enumerate(odd)], docs.schema)
    out = corpus_pipeline.drop_unknown_language(spark, docs.unionByName(more), MID)
    kept, n = {r.doc_id for r in out.select("doc_id").collect()}, docs.count()
    assert not any(i >= 10**6 for i in kept)
    assert 0.98 * n <= len(kept) < n  # some rows of the table itself go, and few


@pytest.mark.skipif(not os.path.isdir(MID), reason="no test data")
def test_near_copies_reach_nine_of_ten_links(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    group, near = jaccard_groups(texts)
    out = corpus_pipeline.drop_near_copies(spark, docs, MID)
    kept = {r.doc_id for r in out.collect()}
    gone, wanted = set(texts) - kept, {i for i in texts if group[i] != i}
    assert gone <= wanted and len(gone) >= 0.9 * len(wanted) and near
    inexact = {b for a, b in near if texts[a].split() != texts[b].split()} & wanted
    assert len(inexact & gone) >= 0.9 * len(inexact)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages_take_nulls_repeats_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = docs.orderBy("doc_id").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "no id", "en", "src0", 5), (7_000_001, None, "en", None, None), (7_000_002, "", None, "src1", 0), (7_000_003, "w " * 60_000, "en", "src1", None), (7_000_004, "The same and the same.", None, None, None), (7_000_004, "The same and the same.", None, None, None)], docs.schema)
    both = plain.unionByName(odd)
    for name in ("score", "node", "family", "mark", "row", "coverage", "share", "excess"):
        both = both.withColumn(name, both.doc_id)
    before = both.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, both, SF)
        assert set(both.columns) <= set(out.columns)
        n = out.count()
        assert n <= before if name != "mixing" else n > 0
        if name in ("toxicity", "decontamination"):
            assert out.where("doc_id = 7000004").count() in (0, 2) and out.where("text is null").count() == 2
        if name == "near_copies":
            assert out.where("doc_id = 7000004").count() == 1 and out.where("text is null or text = ''").count() == 1
