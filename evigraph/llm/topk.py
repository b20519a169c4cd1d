"""Exact top-k search by inner product over impact-ordered posting segments, score at a time.

Vectors are dealt to blocks. In a block every dimension has a posting list in the order of impact:
the component, shifted to be 0 or more and quantised to steps of ``1 << SHIFT``. A query reads a list
from the end where its product is largest. In each round the segments of all lists whose
contribution |q| * impact is above a falling cutoff are added to the accumulators of their members,
and the cutoff bounds what a list can still give to vectors not met in it. The k-th best lower bound
is then compared with each vector's upper bound: processing stops when, by that proof, few vectors
can still be among the k best, or at the last segment, and these are rescored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

SHIFT = 1
#: Vectors of a block, and queries that meet it at a time.
BLOCK_ROWS, QUERY_ROWS = 8192, 2048
#: Share of a block that may be rescored.
FEW = 0.1
#: Cutoffs of the rounds, as shares of the largest contribution. The last one lets everything through.
CUTOFFS = (0.6, 0.5, 0.45, 0.4, 0.36, 0.32, 0.28, 0.24, 0.2, 0.15, 0.1, 0.05, 0.0)


class ImpactIndex:
    """Posting lists of one block of integer vectors."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.least, self.most = x.min(0), x.max(0)
        self.rising, self.falling = self._lists(x - self.least), self._lists(self.most - x)

    @staticmethod
    def _lists(up: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each dimension members and quantised impacts, by falling impact; ``up`` is 0 or more."""
        out = []
        for d in range(up.shape[1]):
            impact = up[:, d] >> SHIFT
            order = np.argsort(-impact, kind="stable")
            out.append((order, impact[order] << SHIFT))
        return out

    def search(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can be among the k of largest inner product with q (all those that are, ties at the k-th included), and their scores."""
        n, width = len(self.x), (1 << SHIFT) - 1
        few = max(4 * k, int(FEW * n))
        alive = np.arange(n)
        used = [d for d in range(len(q)) if q[d]]
        if n > few and used:
            lists = [self.rising[d] if q[d] > 0 else self.falling[d] for d in used]
            weight = np.abs(q[used])
            top = np.array([(s[1][0] + width) for s in lists]) * weight  # the most that a dimension gives
            inexact = int(weight.sum()) * width  # what quantising can have added to a sum
            pack = len(used) + 1
            packed = np.zeros(n, np.int64)  # upper bound of what was met, and in how many dimensions
            begun = [0] * len(used)
            for share in CUTOFFS:
                cutoff = int(top.max() * share)
                for j, (members, impacts) in enumerate(lists):
                    w = int(weight[j])
                    # segments with (impact + width) * w > cutoff
                    end = len(impacts) - int(np.searchsorted(impacts[::-1], cutoff // w - width, side="right")) if cutoff else n
                    if end > begun[j]:
                        packed[members[begun[j] : end]] += impacts[begun[j] : end] * (w * pack) + (width * w * pack + 1)
                        begun[j] = end
                met_sum, met = np.divmod(packed, pack)
                rest = int(sum(t for t, b in zip(top, begun) if not b))
                upper = met_sum + rest + cutoff * (sum(1 for b in begun if b) - met)
                alive = np.flatnonzero(upper >= np.partition(met_sum, n - k)[n - k] - inexact) if k <= n else alive
                if len(alive) <= few:
                    break
        return alive, self.x[alive] @ q


def integers(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a double, as longs; null for a vector that is null or has a null or non-finite component."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(embedding.isNotNull() & sound, F.transform(embedding, lambda x: F.floor(x.cast("double") * float(scale))))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products with vectors of other ids, ties to the smaller id.

    Both tables have (vec_id, v), v an array of longs; null arrays and ids take no part, and only
    vectors of as many components as the query are compared. A vector that is there twice counts
    twice; repeated queries of one id and vector are one. If there are fewer than k, all are given.
    Vectors and queries are dealt to blocks of bounded size and every block of queries meets every
    block of vectors; a block gives k rows for each query, and the best of these are the result.
    """
    vectors = common.cut(vectors.where("v is not null and vec_id is not null").select("vec_id", "v", F.size("v").alias("dims")))
    queries = common.cut(queries.where("v is not null and vec_id is not null").select("vec_id", "v", F.size("v").alias("dims"), F.xxhash64("v").alias("mark")).distinct())
    blocks, groups = -(-vectors.count() // BLOCK_ROWS) or 1, -(-queries.count() // QUERY_ROWS) or 1
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v", F.rand(1)), F.lit(n)).cast("int")
    left = common.cut(vectors.withColumn("block", deal(blocks))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = common.cut(queries.withColumn("group", deal(groups))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asked):
            own = own.sort_values("vec_id", kind="stable")
            ids, index = own["vec_id"].to_numpy(), ImpactIndex(np.stack(own["v"].to_numpy()).astype(np.int64))
            for query_id, mark, q in zip(asked["vec_id"], asked["mark"], asked["v"]):
                same = int((ids == query_id).sum())
                rows, scores = index.search(np.asarray(q, np.int64), k + same)
                other = ids[rows] != query_id
                rows, scores = rows[other], scores[other]
                best = np.lexsort((ids[rows], -scores))[:k]
                found.append(pd.DataFrame({"query_id": query_id, "mark": mark, "vec_id": ids[rows[best]], "score": scores[best]}))
        return pd.concat(found) if found else pd.DataFrame(columns=["query_id", "mark", "vec_id", "score"], dtype="int64")

    met = left.groupBy("dims", "group", "block").cogroup(right.groupBy("dims", "group", "block")).applyInPandas(meet, "query_id long, mark long, vec_id long, score long")
    order = W.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_impact_topk(spark, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    rows = common.table(spark, sf_dir, "embeddings").select("vec_id", integers(F.col("embedding")).alias("v"))
    return search(rows, rows.where("vec_id % 100 = 0"))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
