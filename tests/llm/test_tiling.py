import random

from evigraph.llm import tiling


def slow_tiles(a, b, k):
    """Greedy string tiling as published: mark the longest free matches, again and again."""
    ta, tb, n = set(), set(), 0
    while True:
        best = []
        top = k
        for i in range(len(a)):
            for j in range(len(b)):
                m = 0
                while i + m < len(a) and j + m < len(b) and a[i + m] == b[j + m] and i + m not in ta and j + m not in tb:
                    m += 1
                if m > top:
                    best, top = [(i, j, m)], m
                elif m == top:
                    best.append((i, j, m))
        if not best:
            return n
        for i, j, m in best:
            if not any(i + x in ta or j + x in tb for x in range(m)):
                ta.update(range(i, i + m))
                tb.update(range(j, j + m))
                n += m


def test_tiles_equal_the_published_algorithm():
    rng = random.Random(2)
    for trial in range(150):
        w = "abc" if trial % 2 else "abcdefgh"
        a, b = ([rng.choice(w) for _ in range(rng.randrange(3, 25))] for _ in range(2))
        if rng.random() < 0.5:
            b = b[:5] + a[3:12] + b[5:] + a[:4]
        t = tiling.Tiler([(1, " ".join(a))], k=3, threshold=1e-9)
        got = t.cover(" ".join(b))
        assert (got[0]["words"] if got else 0) == slow_tiles(a, b, min(3, len(a)))


ITEM = "One two three four five six, seven eight nine ten! Eleven twelve thirteen fourteen fifteen."


def test_reordered_and_clean_texts(spark):
    moved = "eleven TWELVE thirteen fourteen fifteen -- filler -- one two three four five six seven eight nine ten"
    rows = [(1, "before " + ITEM + " after"), (2, moved), (3, "one two three four six five"), (4, None), (5, ""), (6, ITEM), (6, ITEM), (None, ITEM), (7, "filler words " * 50000 + moved), (8, "yes no"), (9, "no yes")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, coverage int")
    items = spark.createDataFrame([(10, ITEM), (11, None), (12, "..."), (13, "yes no"), (14, ITEM)], "item_id long, text string")
    found = tiling.overlaps(docs, items)
    got = sorted((r.doc_id or -1, r.item_id, r.coverage, r.tiles) for r in found.collect())
    want = [(-1, 1), (1, 1), (2, 2), (6, 1), (6, 1), (7, 2)]
    assert got == sorted([(d, i, 1.0, n) for d, n in want for i in (10, 14)] + [(8, 13, 1.0, 1)])
    assert sorted(r.doc_id for r in tiling.without_overlaps(docs, items).collect()) == [3, 4, 5, 9]
    assert tiling.overlaps(docs, items.limit(0)).count() == 0 and tiling.overlaps(docs.limit(0), items).count() == 0
    assert tiling.without_overlaps(docs, items.limit(0)).count() == len(rows)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} x{i} y{i} z{i} v{i} u{i} t{i}") for i in range(30)], "doc_id long, text string")
    items = docs.withColumnRenamed("doc_id", "item_id")
    want = sorted(map(tuple, tiling.overlaps(docs, items).collect()))
    monkeypatch.setattr(tiling, "MOST_WORDS", 60)
    assert len(tiling.tilers(items)) > 3 and sorted(map(tuple, tiling.overlaps(docs, items).collect())) == want and len(want) == 30
