"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are a word and its first five bytes. Every term that an example has is indexed, with idf
counted over all documents; terms that the likelihood ratio ties to toxic examples weigh more, by
the root of the ratio (near copies count once there). A word that no example has is no dimension:
it would scale all of a text's cosines alike.

The index is block-max inverted. Examples lie in blocks of like ones. A query's products with the
rarer terms come from postings, term at a time. The common terms, whose lists are long, are bounded:
each block keeps its largest weight of each, so the largest sum that one of its examples can reach is
known beforehand. The most promising blocks are worked out first, and a block whose bound is below
the k-th best cosine found is skipped, which loses no neighbour. Cosines are rounded to 12 digits,
so they do not depend on the order of a sum.

Neighbours vote with their cosine as weight, against ``PRIOR`` votes at the examples' rate. The share
of toxic votes becomes a probability by a logistic curve fitted to the examples themselves, each
scored by the others without its near copies.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from . import common

#: Labelled documents that examples come from at most.
MOST_LABELLED = 3_000
#: Likelihood ratio (chi-square, one degree of freedom) that a term needs to weigh more, documents it
#: must be in, and how many times as frequent it must be in toxic documents as in others.
LEAST_RATIO, LEAST_DOCS, LEAST_LIFT = 24.0, 3, 3.0
#: How much more per root of the ratio; chosen by leaving each example out in turn, sf0.1.
BOOST = 1 / 8
NEIGHBOURS, PRIOR, THRESHOLD = 15, 0.5, 0.3
#: Most common terms, share of examples a term needs to be one, examples of a block, queries at a time.
COMMON, COMMON_SHARE, BLOCK, BATCH = 512, 1 / 32, 128, 128
#: Blocks that are worked out first.
FIRST = 2
#: Far above the error of a sum in double precision.
MARGIN = 1e-9
#: Examples as alike as this are copies and do not vote for each other in the calibration.
COPY = 0.9

_FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of whole texts as 64-bit hashes, how often each stands there, and how many each text has; a hash may come twice in a text.

    Words are runs of ASCII letters and of all other than ASCII characters, lower-cased; those of
    five bytes or more also count under their first five.
    """
    hashes, counts, sizes = [], [], []
    for text in texts:
        words = Counter((text or "").lower().encode().translate(_FOLD).split())
        long = [w for w in words if len(w) >= 5]
        hashes += map(xxh3_64_intdigest, words)
        hashes += [xxh3_64_intdigest(w[:5], 1) for w in long]
        counts += words.values()
        counts += map(words.__getitem__, long)
        sizes.append(len(words) + len(long))
    return np.array(hashes, np.uint64).view(np.int64), np.array(counts, np.int64), np.array(sizes, np.int64)


def summed(rows: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of ``n`` rows its keys, ascending, and the sum of the counts of each."""
    order = np.lexsort((keys, rows))
    rows, keys, counts = rows[order], keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])]))
    total = np.add.reduceat(counts, new) if len(new) else counts
    ends = np.searchsorted(rows[new], np.arange(n + 1))
    keys = keys[new]
    return [(keys[a:b], total[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def terms(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The terms of each whole text as ascending hashes, and how often each stands there; see :func:`hashed`."""
    hashes, counts, sizes = hashed(texts)
    return summed(np.repeat(np.arange(len(sizes)), sizes), hashes, counts, len(sizes))


def signature(text: str) -> int:
    """The smallest CRC-32 of the text's three-word shingles; near copies mostly agree in it, other texts do not."""
    words = text.lower().encode().split()
    return min(map(zlib.crc32, map(b" ".join, zip(words, words[1:], words[2:]))), default=zlib.crc32(b" ".join(words)))


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A vector in few bytes: 64-bit numbers, then 32-bit counts."""
    return zlib.compress(ids.astype("<i8").tobytes() + counts.astype("<i4").tobytes(), 1) if len(ids) else b""


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(packed) if packed else b""
    n = len(raw) // 12
    return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i4", n, 8 * n)


def ratio(a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    """The likelihood ratio of each term, in ``a`` of ``n`` toxic and ``b`` of ``m`` other examples, that it goes with toxic ones; else 0."""
    if not n or not m:
        return np.zeros(len(a))
    share = (a + b) / (n + m)
    part = lambda seen, expected: np.where(seen > 0, 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(expected > 0, expected, 1)), 0.0)
    whole = part(a, n * share) + part(n - a, n * (1 - share)) + part(b, m * share) + part(m - b, m * (1 - share))
    return np.where((a >= LEAST_DOCS) & (a * m > LEAST_LIFT * b * n), np.round(whole, 6), 0.0)


class Index:
    """Examples as unit TF-IDF vectors: blocks with the largest weights of common terms, postings of the others."""

    def __init__(self, examples: list[tuple], vocabulary: np.ndarray, idf: np.ndarray):
        """``examples``: (doc_id, packed, y) in the order of their ids, term numbers being places in ``vocabulary``, the ascending hashes; ``idf`` has the weight of each."""
        self.vocabulary, self.idf = vocabulary, idf
        self.base = float(sum(y for _, _, y in examples) / max(1, len(examples)))
        rows = [x for x in examples if x[1]]  # others have no direction
        self.ids = np.array([x[0] for x in rows], np.int64)
        self.y = np.array([x[2] for x in rows], float)
        self.packed = [x[1] for x in rows]
        self.curve = (1.0, 0.0)
        self.ready = False

    def __getstate__(self):
        keep = ("vocabulary", "idf", "base", "ids", "y", "packed", "curve")
        return {k: getattr(self, k) for k in keep} | {"ready": False}

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The numbers of each whole text's known terms, ascending, and how often each stands there."""
        hashes, counts, sizes = hashed(texts)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        if len(self.vocabulary):
            at = np.searchsorted(self.vocabulary, hashes)
            at[at == len(self.vocabulary)] = 0
            known = np.flatnonzero(self.vocabulary[at] == hashes)
        else:
            at, known = hashes, np.zeros(0, np.int64)
        return summed(rows[known], at[known], counts[known], len(sizes))

    def unit(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(np.asarray(counts, float))) * self.idf[ids]
        return w / np.sqrt((w * w).sum()) if len(w) else w

    def prepare(self) -> None:
        """Blocks and postings; made where the index is used, so that less is sent."""
        n, size = len(self.packed), len(self.idf)
        lengths = [len(unpack(x)[0]) for x in self.packed]
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        terms, weights = np.empty(starts[-1], np.int32), np.empty(starts[-1])
        for x, at in zip(self.packed, starts.tolist()):  # one at a time: workers keep what they once held
            ids, counts = unpack(x)
            terms[at : at + len(ids)], weights[at : at + len(ids)] = ids, self.unit(ids, counts)
        df = np.bincount(terms, minlength=size)
        often = np.argsort(-df, kind="stable")[:COMMON]
        often = often[df[often] > n * COMMON_SHARE]
        self.column = np.full(size, -1, np.int32)
        self.column[often] = np.arange(len(often))
        owner, column = np.repeat(np.arange(n, dtype=np.int32), lengths), self.column[terms]
        matrix = np.zeros((n, len(often)))
        matrix[owner[column >= 0], column[column >= 0]] = weights[column >= 0]
        self.order = like_together(matrix)  # row of the index -> example
        self.matrix = np.ascontiguousarray(matrix[self.order].T)
        self.starts = np.arange(0, n, BLOCK)
        self.most = np.maximum.reduceat(self.matrix, self.starts, axis=1) if n else np.zeros((len(often), 0))
        place = np.empty(n, np.int32)
        place[self.order] = np.arange(n)
        rare = column < 0
        by_term = np.argsort(terms[rare], kind="stable")
        self.owners, self.given = place[owner[rare][by_term]], weights[rare][by_term]
        self.start = np.concatenate([[0], np.cumsum(np.where(self.column < 0, df, 0))]).astype(np.int32)
        self.length = np.diff(self.start)
        self.steps = np.arange(len(self.owners), dtype=np.int32)
        self.skipped = self.met = 0
        self.ready = True

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, copies: bool = True) -> list[list[tuple[float, int]]]:
        """The k nearest examples of each query, (cosine, number), ties to the smaller number; only cosines above 0, without ``copies`` only those up to ``COPY``."""
        if not self.ready:
            self.prepare()
        out: list[list[tuple[float, int]]] = []
        for a in range(0, len(queries), BATCH):
            part = [(np.asarray(i, np.int64), self.unit(np.asarray(i, np.int64), c)) for i, c in queries[a : a + BATCH]]
            sums = self._sums(part, k, copies)
            out += [self._top(row, k) for row in sums]
        return out

    def _sums(self, part: list[tuple[np.ndarray, np.ndarray]], k: int, copies: bool) -> np.ndarray:
        """Each query's cosines with the index's rows; less than any of its k best where its block was skipped."""
        n, blocks = len(self.ids), len(self.starts)
        asked = np.zeros((len(part), len(self.matrix)))
        if not n:
            return np.zeros((len(part), 0))
        rest = np.zeros((len(part), n))
        for row, (ids, q) in enumerate(part):
            column = self.column[ids]
            often = column >= 0
            asked[row, column[often]] = q[often]
            rare = ids[~often]
            lo, length = self.start[rare], self.length[rare]
            if total := int(length.sum()):
                at = np.repeat(lo - np.cumsum(length, dtype=np.int32) + length, length) + self.steps[:total]
                rest[row] = np.bincount(self.owners[at], self.given[at] * np.repeat(q[~often], length), minlength=n)
        bound = np.maximum.reduceat(rest, self.starts, axis=1) + asked @ self.most + MARGIN
        sums = np.full((len(part), n), -np.inf)

        def work(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)):
                rows, own = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, min((b + 1) * BLOCK, n))
                found = rest[rows, own] + asked[rows] @ self.matrix[:, own]
                sums[rows, own] = found if copies else np.where(found > COPY, -np.inf, found)

        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, np.argsort(-bound, axis=1)[:, :FIRST], True, axis=1)
        work(first)
        kth = np.partition(sums, n - k, axis=1)[:, n - k] if n > k else np.full(len(part), -np.inf)
        more = ~first & (bound >= kth[:, None] - MARGIN)
        work(more)
        self.met += len(part) * blocks
        self.skipped += int((~first & ~more).sum())
        return sums

    def _top(self, sums: np.ndarray, k: int) -> list[tuple[float, int]]:
        n = len(sums)
        least = np.partition(sums, n - k)[n - k] - MARGIN if n > k else 0.0
        near = np.flatnonzero(sums >= max(least, MARGIN))
        cosine, own = np.round(sums[near], 12), self.order[near]
        best = np.lexsort((own, -cosine))[:k]
        return list(zip(cosine[best].tolist(), own[best].tolist()))

    def votes(self, near: list[tuple[float, int]]) -> float:
        """The share of toxic votes, from 0 to 1."""
        return float((sum(c * self.y[i] for c, i in near) + PRIOR * self.base) / (sum(c for c, _ in near) + PRIOR))

    def calibrated(self, share: float) -> float:
        """The probability that goes with a share of votes."""
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * _logit(share) + b, -700, 700))))

    def scores(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[dict]]]:
        return [(self.calibrated(self.votes(near)), [{"doc_id": int(self.ids[i]), "cosine": c, "toxic": int(self.y[i])} for c, i in near]) for near in self.search(queries)]

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        return self.scores(self.vectors([text]))[0]


def _logit(share):
    p = np.clip(share, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def like_together(rows: np.ndarray, clusters: int = 16, rounds: int = 4) -> np.ndarray:
    """An order of rows in which like ones are neighbours: by cluster of direction, then by length."""
    n = len(rows)
    if n <= BLOCK or not rows.shape[1]:
        return np.arange(n)
    length = np.sqrt((rows * rows).sum(1))
    flat = rows / np.maximum(length, 1e-9)[:, None]
    centres = [flat[int(length.argmax())]]
    nearest = flat @ centres[0]
    while len(centres) < clusters:
        centres.append(flat[int(nearest.argmin())])
        nearest = np.maximum(nearest, flat @ centres[-1])
    middle = np.stack(centres)
    for _ in range(rounds):
        own = (flat @ middle.T).argmax(1)
        middle = np.stack([flat[own == c].mean(0) if (own == c).any() else middle[c] for c in range(clusters)])
        middle /= np.maximum(np.sqrt((middle * middle).sum(1)), 1e-9)[:, None]
    return np.lexsort((length, (flat @ middle.T).argmax(1)))


def curve(share: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from the logit of a share of votes to the probability of y = 1.

    The identity, (1, 0), where there is one label only or no rising curve.
    """
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    x, w = np.stack([_logit(share), np.ones(len(y))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (y - p) - 1e-3 * (w - [1.0, 0.0]))
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 and np.isfinite(w).all() else (1.0, 0.0)


_loaded: dict[int, tuple] = {}


def _here(shared: Broadcast):
    """What ``shared`` holds, unpacked once in a Python worker."""
    value = shared.value
    if id(value) not in _loaded or _loaded[id(value)][0] is not value:
        _loaded.clear()
        _loaded[id(value)] = (value, pickle.loads(value))
    return _loaded[id(value)][1]


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Index:
    """The index of at most ``most`` labelled documents whose crc32 modulo 4 is not 2, idf from all of ``docs``.

    An id counts once; of repeated rows with one id the smallest text does. Documents are counted on
    the executors; what comes to the driver are the examples' vectors as packed numbers and a count
    for each of their terms.
    """
    spark = docs.sparkSession
    examples = common.cut(common.labelled_sample(docs, labels, "toxic", 4, 2, most))

    @F.pandas_udf("v binary, s long")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame({"v": [pack(*x) for x in terms(texts.tolist())], "s": [signature(t) for t in texts]})

    rows = examples.select("doc_id", "y", packed("text").alias("x")).select("doc_id", "y", "x.v", "x.s").toArrow()
    found = sorted(zip(*(rows[c].to_pylist() for c in ("doc_id", "v", "y", "s"))))
    vectors = [unpack(v) for _, v, _, _ in found]
    vocabulary = np.unique(np.concatenate([i for i, _ in vectors])) if vectors else np.zeros(0, np.int64)
    numbered = [(np.searchsorted(vocabulary, i), c) for i, c in vectors]
    seen: set[tuple[int, int]] = set()
    n, counts = [0, 0], np.zeros((2, len(vocabulary)), np.int64)
    for (_, _, y, s), (ids, _) in zip(found, numbered):  # of near copies with one label the first counts
        if (y, s) not in seen:
            seen.add((y, s))
            n[y] += 1
            counts[y, ids] += 1
    strong = ratio(counts[1], counts[0], n[1], n[0])
    boost = np.where(strong >= LEAST_RATIO, 1 + BOOST * np.sqrt(strong), 1.0)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(Index([], vocabulary, boost)))

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _here(shared)
        df, n = np.zeros(len(index.vocabulary), np.int64), 0
        for rows in batches:
            n += len(rows)
            for a in range(0, len(rows), BATCH):
                for ids, _ in index.vectors(rows["text"].iloc[a : a + BATCH].tolist()):
                    df[ids] += 1
        yield pd.DataFrame({"t": np.append(np.flatnonzero(df), -1), "n": np.append(df[df > 0], n)})

    df, total = np.zeros(len(vocabulary), np.int64), 0
    if len(vocabulary):
        counted = docs.select("text").mapInPandas(frequencies, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
        t, by_term = counted["t"].to_numpy(), counted["n"].to_numpy()
        total = int(by_term[t < 0].sum())
        df[t[t >= 0]] = by_term[t >= 0]
    shared.destroy()  # its one job is done
    index = Index([(d, pack(*v), y) for (d, _, y, _), v in zip(found, numbered)], vocabulary, (np.log((1 + total) / (1 + df)) + 1) * boost)
    own = spark.sparkContext.broadcast(cloudpickle.dumps(index))

    @F.pandas_udf("double")
    def others(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        here = _here(own)
        for texts in batches:
            yield pd.Series([here.votes(near) for near in here.search(here.vectors(texts.tolist()), copies=False)], dtype=float)

    fitted = examples.select("doc_id", "y", others("text").alias("share")).toArrow().sort_by("doc_id")
    own.destroy()
    index.curve = curve(fitted["share"].to_numpy(), fitted["y"].to_numpy().astype(float))
    return index


def score_column(text: Column, model: Index, spark) -> Column:
    """Score from 0 to 1 and evidence (doc_id, cosine, toxic) of each whole text, as a struct.

    A null text is empty. A text that shares no term with an example has the score of the examples'
    share of toxic ones, and no evidence. Equal cosines go to the example that comes first by id.
    """
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    @F.pandas_udf("score double, evidence array<struct<doc_id: long, cosine: double, toxic: int>>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = _here(shared)
        for texts in batches:
            found = []
            for a in range(0, len(texts), BATCH):
                found += index.scores(index.vectors(texts.iloc[a : a + BATCH].tolist()))
            yield pd.DataFrame(found, columns=["score", "evidence"], dtype=object)

    return udf(text)


def op3_toxicity_neighbours(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, with the nearest examples."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (common.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), score_column(F.col("text"), model, spark).alias("r"))
    return scored.select("doc_id", "held_out", "r.score", (F.col("r.score") >= THRESHOLD).cast("int").alias("predicted"), "r.evidence")
