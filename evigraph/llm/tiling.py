"""Benchmark decontamination by greedy string tiling.

Words are numbered by the benchmark's vocabulary. Every run of ``SEED_WORDS`` words of an item is a
seed; a rolling polynomial (Karp-Rabin) hash over a document finds the places that may share one,
and the words there are compared. Seeds that follow each other join to the longest common runs; the
longest run whose words are still free in both is marked as a tile, what is left of a run that is
partly taken is tried again, until no run of seed length is left. An item's share of tiled words is
its coverage, whatever the order of the tiles, so passages whose parts were moved are found too.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED_WORDS, THRESHOLD = 5, 0.5
#: Words of the benchmark that are broadcast at a time; a larger one is taken in blocks of items.
MOST_WORDS = 2_000_000
RESULT = "array<struct<item_id: long, coverage: double, tiles: int, words: int>>"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all other than ASCII characters."""
    return (text or "").encode().translate(_FOLD).split()


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """The polynomial hash of each k numbers in a row, modulo 2 to the power 64."""
    if len(ids) < k:
        return np.zeros(0, np.uint64)
    x, h = ids.astype(np.uint64), np.zeros(len(ids) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = h * _BASE + x[j : len(ids) - k + 1 + j]
    return h


def tile(seeds: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the tiles, from all places where k words agree."""
    runs: list[tuple[int, int, int]] = []
    for d, p in sorted((t - p, p) for p, t in set(seeds)):
        if runs and runs[-1][1] - runs[-1][0] == d and runs[-1][0] + runs[-1][2] - k + 1 == p:
            runs[-1] = (*runs[-1][:2], runs[-1][2] + 1)
        else:
            runs.append((p, p + d, k))
    heap = [(-n, p, t) for p, t, n in runs]
    heapq.heapify(heap)
    item_taken: set[int] = set()
    text_taken: set[int] = set()
    tiles = []
    while heap:
        n, p, t = heapq.heappop(heap)
        free = [p + i not in item_taken and t + i not in text_taken for i in range(-n)]
        if all(free):
            tiles.append((p, t, -n))
            item_taken.update(range(p, p - n))
            text_taken.update(range(t, t - n))
            continue
        start = 0
        for i in range(-n + 1):
            if i == -n or not free[i]:
                if i - start >= k:
                    heapq.heappush(heap, (start - i, p + start, t + start))
                start = i + 1
    return sorted(tiles)


class Tiler:
    """Seeds of benchmark items, and the items that a text covers."""

    def __init__(self, items: list[tuple[int | None, str | None]], k: int = SEED_WORDS, threshold: float = THRESHOLD):
        self.number: dict[bytes, int] = {}
        self.k, self.threshold = k, threshold
        self.items = []
        for item_id, text in items:
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words(text)], np.int64)
            if len(ids):
                self.items.append((item_id, ids))
        # an item shorter than a seed is one seed of its own length
        self.seeds: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, (_, ids) in enumerate(self.items):
            own = min(k, len(ids))
            for p, h in enumerate(rolling(ids, own).tolist()):
                self.seeds.setdefault(own, {}).setdefault(h, []).append((i, p))
        self.sieves = {}
        for own, known in self.seeds.items():
            sieve = np.zeros(1 << 20, bool)
            sieve[np.fromiter(known, np.uint64, len(known)) >> np.uint64(44)] = True
            self.sieves[own] = sieve

    def cover(self, text: str | None) -> list[dict]:
        """Each item whose coverage reaches the threshold, in the order of the items."""
        get = self.number.get
        ids = np.array([get(w, 0) for w in words(text)], np.int64)
        places: dict[int, list[tuple[int, int]]] = {}
        for own, known in self.seeds.items():
            h = rolling(ids, own)
            maybe = np.flatnonzero(self.sieves[own][h >> np.uint64(44)])
            for t, x in zip(maybe.tolist(), h[maybe].tolist()):
                for i, p in known.get(x, ()):
                    if len(self.items[i][1]) >= own and np.array_equal(self.items[i][1][p : p + own], ids[t : t + own]):
                        places.setdefault(i, []).append((p, t))
        out = []
        for i in sorted(places):
            item_id, item = self.items[i]
            k = min(self.k, len(item))
            reach = np.zeros(len(item), bool)
            for p, _ in set(places[i]):
                reach[p : p + k] = True
            if reach.sum() < self.threshold * len(item):
                continue
            tiles = tile(places[i], k)
            n = sum(x[2] for x in tiles)
            if n >= self.threshold * len(item):
                out.append({"item_id": item_id, "coverage": n / len(item), "tiles": len(tiles), "words": n})
        return out


def tilers(benchmark: DataFrame, k: int = SEED_WORDS, threshold: float = THRESHOLD, most: int | None = None) -> list[Tiler]:
    """One tiler of all items if they have at most ``most`` words, else one for each block of items."""
    size = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2 + 1
    blocks = math.ceil(size / (most or MOST_WORDS))
    dealt = benchmark.select("item_id", "text").where("text is not null")
    if blocks <= 1:
        return [Tiler([tuple(r) for r in dealt.orderBy("item_id", "text").collect()], k, threshold)]
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [Tiler([tuple(r) for r in dealt.where(number == b).orderBy("item_id", "text").collect()], k, threshold) for b in range(blocks)]


def cover_column(text: Column, tiler: Tiler, spark) -> Column:
    """The items that each whole text covers, as an array of :data:`RESULT`; none for null."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(tiler))

    @F.pandas_udf(RESULT)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = pickle.loads(shared.value)
        for texts in batches:
            yield pd.Series([known.cover(t) for t in texts], dtype=object)

    return udf(text)


def overlaps(docs: DataFrame, benchmark: DataFrame, k: int = SEED_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, words): each document and item with a coverage of at least ``threshold``.

    A row of ``docs`` is looked at by itself, so repeated rows repeat their results; the null text
    covers nothing, an item that is null or has no word is never covered, and one shorter than
    ``k`` words counts where it stands whole. Items are broadcast in blocks of bounded size.
    """
    out = None
    for tiler in tilers(benchmark, k, threshold):
        part = docs.select("doc_id", F.inline(cover_column(F.col("text"), tiler, docs.sparkSession)))
        out = part if out is None else out.unionByName(part)
    return out


def without_overlaps(docs: DataFrame, benchmark: DataFrame, k: int = SEED_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that cover no item, with their columns."""
    for tiler in tilers(benchmark, k, threshold):
        docs = docs.where(F.size(cover_column(F.col("text"), tiler, docs.sparkSession)) == 0)
    return docs


def op9_benchmark_tiling(spark, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of the words of a benchmark item, and the item."""
    return overlaps(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
