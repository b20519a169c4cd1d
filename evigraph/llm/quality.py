"""Document quality by Bradley-Terry ranking of labelled pairs.

A document's strength is a linear function of features of its text. Of a pair of a good and a bad
document the good one should win, with the logistic of the difference of strengths as probability:
logistic loss on feature differences, minimised by Newton steps. The threshold is the quantile of
the labelled documents' strengths at the share of bad ones.

All labelled documents outside the held-out fold take part, and all pairs of a good and a bad one. Pairs
are not listed: the chance that one wins depends on two strengths only, so documents are counted and their features
summed by label and bins of strength, and pairs of bins stand for their pairs of documents, by the chance at the bins'
mean strengths and its slope. What a step sends to the driver does not grow with the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Pairs that :func:`fit` draws.
PAIRS = 200_000
RIDGE = 1e-3
#: Bins of strength for each unit of it, near the middle; far out they widen with the distance, so that an odd text adds few.
FINE = 64
#: By how much bins may misjudge a loss, and twice the loss that is not worth a further step.
SLACK, LEAST = 1e-5, 1e-8

FEATURES = ("log_words", "upper", "digits", "marks", "symbols", "bars", "shouts", "white", "word_length", "distinct_words", "echoes", "distinct_lines", "line_words", "other")


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text, each of about unit size; all of an empty text are 0."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    lower, upper = n[97:123].sum() + n[128:].sum(), n[65:91].sum()
    share = lambda *chars: float(sum(n[ord(c)] for c in chars)) / size
    seldom = lambda x: float(np.log1p(1000 * x)) / 7
    lines = raw.split(b"\n")
    punct = float(n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum()) / size
    return [
        float(np.log1p(len(words))) / 10, float(upper / max(1, upper + lower)), seldom(float(n[48:58].sum()) / size), seldom(punct), seldom(share(*"%#*$&^~@")), seldom(share("|")), seldom(share("!")),
        share(" ", "\n", "\t"), (size / len(words) - 1) / 10, len(set(words)) / len(words), sum(map(eq, words, words[1:])) / len(words), len(set(lines)) / len(lines), float(np.log1p(len(words) / len(lines))) / 6, float(n[:9].sum() + n[14:32].sum() + n[127]) / size,
    ]


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts], dtype=object)

    return udf(text)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, steps: int = 25) -> dict:
    """Weights, and the threshold of strength, from few rows of features and labels 0 or 1 in memory, on drawn pairs; no query uses it, see :func:`train`.

    Pairs of a good and a bad row are drawn with a fixed seed. With one label only there is no
    pair: weights are 0 and every score is 0.5.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not len(good) or not len(bad):
        return {"w": np.zeros(width), "threshold": 0.0}
    rng = np.random.default_rng(42)
    d = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w = np.zeros(width)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -50, 50)))
        grad = d.T @ (1 - p) / pairs - RIDGE * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(width)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return {"w": w, "threshold": float(np.quantile(x @ w, len(bad) / len(y)))}


def strength(x: Column, w: np.ndarray) -> Column:
    return F.aggregate(F.zip_with(x, F.array(*(F.lit(float(v)) for v in w)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, y): features and quality of every labelled document of ``rows`` (doc_id, x) whose crc32 modulo 3 is not 1, one row an id.

    Labels that are null or neither 0 nor 1 are left out, as are rows without an id or features; of several
    labels of an id the largest counts, of several rows the one of the smallest features.
    """
    told = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (common.remainder(F.col("doc_id"), 3) != 1))
    told = told.groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    found = rows.select("doc_id", "x").where("x is not null").join(told, "doc_id")
    return found.groupBy("doc_id").agg(F.min("x").alias("x"), F.max("y").alias("y")).select("x", "y")


def quantile(values: DataFrame, share: float) -> float:
    """The quantile of the doubles ``s``, interpolated as numpy's, from counts by 1,024 bins that narrow down to one value."""
    n, lo, hi = values.agg(F.count("s"), F.min("s"), F.max("s")).first()
    place = share * (n - 1)
    at, upto = int(place), n  # values up to ``hi``
    below = 0
    while lo < hi:
        number = F.floor((F.col("s") - lo) / (hi - lo) * 1023)
        for _, count, low, high in values.where(F.col("s").between(lo, hi)).groupBy(number.alias("b")).agg(F.count("s"), F.min("s"), F.max("s")).orderBy("b").collect():
            if below + count > at:
                lo, hi, upto = low, high, below + count
                break
            below += count
    if place == at or at + 1 < upto:
        return float(lo)
    return float(lo + (place - at) * (values.where(F.col("s") > lo).agg(F.min("s")).first()[0] - lo))


def _binned(rows: DataFrame, w: np.ndarray, middle: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the bad and the good rows: documents of each bin of strength, the sum of their features, and that of strength times features."""
    sized = rows.select("y", "x", strength(F.col("x"), w).alias("s"))
    number = F.round(F.asinh(F.col("s") - F.lit(float(middle))) * FINE).cast("long")
    sums = [F.array(*(F.sum(F.col("x")[i] * by) for i in range(len(w)))) for by in (F.lit(1.0), F.col("s"))]
    found = sized.groupBy(number.alias("b"), "y").agg(F.count(F.lit(1)).alias("n"), sums[0].alias("x"), sums[1].alias("sx")).collect()
    of = lambda y, name: np.array([r[name] for r in found if r.y == y], float)
    return [(of(y, "n"), of(y, "x").reshape(-1, len(w)), of(y, "sx").reshape(-1, len(w))) for y in (0, 1)]


def _spread(rows: DataFrame, w: np.ndarray, bends: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The sum of x x^T over all rows, each as often as its label's ``bends`` (strengths, weights) say at its strength."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(w), len(w)))
        for batch in batches:
            if len(batch):
                x, y = np.stack(batch["x"]), batch["y"].to_numpy()
                often = np.where(y == 1, np.interp(x @ w, *bends[1]), np.interp(x @ w, *bends[0]))
                total += (x * often[:, None]).T @ x
        yield pd.DataFrame({"part": [total.ravel().tolist()]})

    return sum((np.array(r.part) for r in rows.mapInPandas(add, "part array<double>").toLocalIterator()), np.zeros(len(w) ** 2)).reshape(len(w), len(w))


def train_rows(rows: DataFrame, steps: int = 25) -> dict:
    """Weights and threshold from all pairs of a good and a bad row of ``rows`` (x, y), which is read several times.

    Steps that raise the loss are halved. With one label only there is no pair: weights are 0 and every score is 0.5.
    """
    width = len(FEATURES)
    w, step, best = np.zeros(width), np.zeros(width), np.inf
    bad, good = (n for n, _, _ in _binned(rows, w, 0.0))
    if not bad.sum() or not good.sum():
        return {"w": w, "threshold": 0.0}
    share, pairs, middle = bad.sum() / (bad.sum() + good.sum()), bad.sum() * good.sum(), 0.0
    for _ in range(steps):
        (n0, x0, t0), (n1, x1, t1) = _binned(rows, w + step, middle)
        s0, s1 = (x0 @ (w + step)) / n0, (x1 @ (w + step)) / n1
        d = s1[:, None] - s0[None, :]
        loss = n1 @ np.logaddexp(0, -d) @ n0 / pairs + RIDGE / 2 * ((w + step) ** 2).sum()
        if loss > best + SLACK:
            step = step / 2
            continue
        w, best = w + step, loss
        p = 1 / (1 + np.exp(-np.clip(d, -50, 50)))
        lost, bend = 1 - p, p * (1 - p)
        bend0, bend1 = n1 @ bend, bend @ n0
        # strengths within a bin differ from its mean, which counts by how the chance changes with strength
        inner = bend1 @ (t1 - s1[:, None] * x1) + bend0 @ (t0 - s0[:, None] * x0)
        grad = ((lost @ n0) @ x1 - (n1 @ lost) @ x0 - inner) / pairs - RIDGE * w
        bends = [(s[o := np.argsort(s)], k[o]) for s, k in ((s0, bend0), (s1, bend1))]
        cross = x1.T @ bend @ x0
        hess = (_spread(rows, w, bends) - cross - cross.T) / pairs + RIDGE * np.eye(width)
        step, middle = np.linalg.solve(hess, grad), float((n0 @ s0 / n0.sum() + n1 @ s1 / n1.sum()) / 2)
        if grad @ step < LEAST:  # twice what is still to be won
            w = w + step
            break
    return {"w": w, "threshold": quantile(rows.select(strength(F.col("x"), w).alias("s")), share)}


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The model from ``labels.quality`` of all labelled documents whose crc32 modulo 3 is not 1; see :func:`labelled`."""
    rows = docs.where("text is not null").select("doc_id", feature_column(F.col("text")).alias("x"))
    return train_rows(common.stored(labelled(rows, labels)))


def score_of(x: Column, model: dict) -> Column:
    """The score of features from 0 to 1: the logistic of strength less threshold."""
    s = strength(x, model["w"]) - F.lit(float(model["threshold"]))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), s))))


def score_column(text: Column, model: dict) -> Column:
    """The score of each whole text; null is the empty text."""
    return score_of(feature_column(text), model)


def op4_quality_ranking(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document; features are made once, for learning and for scores."""
    docs = common.table(spark, sf_dir, "documents")
    rows = common.stored(docs.select("doc_id", F.col("text").isNull().alias("blank"), feature_column(F.col("text")).alias("x")))
    model = train_rows(common.stored(labelled(rows.where("not blank"), common.table(spark, sf_dir, "labels"))))
    scored = rows.select("doc_id", (common.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), score_of(F.col("x"), model).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
