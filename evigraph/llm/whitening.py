"""Whitening embeddings by their largest principal components.

Components, a handful in a space of some hundred dimensions, are found by a randomised range finder: a
random basis of a few more directions than components is multiplied by the covariance, orthonormalised, and so again
for some power passes; within its range the covariance is a small matrix whose eigenvectors (Rayleigh-Ritz) are the
components. Each pass reads all centred rows: a task multiplies its rows with the basis and adds up
its share of the product, of as many numbers as the basis has, and the shares are summed. A component holds if
what the covariance makes of it lies along itself, closely against the distance to the next eigenvalue; otherwise
the basis is doubled, up to all dimensions, where its product is the covariance itself.

What passes through the driver is the basis and its product: dimensions x directions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE = 256
COMPONENTS, OVERSAMPLE, PASSES = 4, 8, 4
#: What a component may lose to others: its residual against the gap to the nearest eigenvalue.
CLOSE = 1e-11
#: Eigenvalues below this share of the trace are taken as 0: there is no scale to divide by.
NOTHING = 1e-12
#: Tasks whose shares are added in one group.
NEAR = 64
#: Long sums stay exact below this.
EXACT = 1 << 62


def integers(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of each entry as a double, as longs; null for a vector that is null or has a null or non-finite entry."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(embedding.isNotNull() & sound, F.transform(embedding, lambda x: F.floor(x.cast("double") * float(scale))))


@dataclass(frozen=True)
class Model:
    """``n`` different vectors, their ``sums`` by dimension, ``components`` as columns, their eigenvalues, and the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    width: int


def _dense(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _summed(vectors: DataFrame, dims: int, share, width: int) -> np.ndarray:
    """The sum over all rows of ``share(rows)``, dims x width doubles. Tasks send one share each; shares are summed by dimension, in the order of partitions."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((dims, width)), False
        for b in batches:
            if b.num_rows:
                total += share(_dense(b.column(0), dims))
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["d", "v"])

    parts = vectors.select("x").mapInArrow(add, "d int, v array<double>").withColumn("piece", F.spark_partition_id())
    # in two steps, so that no group holds a share of every task; sorted, so that a sum of doubles comes out the same each time
    added = F.reduce(F.array_sort(F.collect_list(F.struct("piece", "v"))), F.array_repeat(F.lit(0.0), width), lambda a, x: F.zip_with(a, x["v"], lambda p, q: p + q)).alias("v")
    near = parts.groupBy("d", F.floor(F.col("piece") / NEAR).alias("near")).agg(added)
    sums = near.withColumnRenamed("near", "piece").groupBy("d").agg(added)
    out = np.zeros((dims, width))
    for r in sums.collect():  # dims rows of width numbers
        out[r.d] = r.v
    return out


def _held(residuals: np.ndarray, values: np.ndarray, k: int) -> bool:
    """Whether the first ``k`` Ritz vectors are eigenvectors, as closely as they are apart from the others."""
    near = np.abs(values[:k, None] - values[None, :])
    near[np.arange(k), np.arange(k)] = np.inf
    gap = np.minimum(near.min(1), values[:k]) if len(values) > 1 else values[:k]
    return bool((residuals[:k] <= CLOSE * np.maximum(gap, 0)).all())


def fit(vectors: DataFrame, components: int = COMPONENTS, oversample: int = OVERSAMPLE, passes: int = PASSES, seed: int = 11) -> Model | None:
    """The largest principal components of different vectors (x array<long>), each counted once; None without any.

    ``vectors`` is read several times and should be stored. Fewer components come out where the rank is lower.
    """
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dims"), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("most")).first()
    n, dims = shape.n, shape.dims
    if not n or not dims:
        return None
    if n * (shape.most or 0) >= EXACT:
        raise OverflowError("sums of the vectors do not fit a long")
    each = vectors.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.sum("v").alias("s"))
    sums = np.zeros(dims, np.int64)
    for r in each.collect():  # dims numbers
        sums[r.d] = r.s
    mean = sums / n
    trace = float(_summed(vectors, dims, lambda x: ((x - mean) ** 2).sum(0)[:, None], 1).sum()) / n

    def covariance(basis: np.ndarray) -> np.ndarray:
        def share(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ basis)

        return _summed(vectors, dims, share, basis.shape[1]) / n

    width, random = min(dims, components + oversample), np.random.default_rng(seed)
    while True:
        if width == dims:
            basis, made = np.eye(dims), covariance(np.eye(dims))
        else:
            basis = np.linalg.qr(random.standard_normal((dims, width)))[0]
            for _ in range(passes):
                basis = np.linalg.qr(covariance(basis))[0]
            made = covariance(basis)
        small = basis.T @ made
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        found, image = basis @ turned, made @ turned
        residuals = np.linalg.norm(image - found * values, axis=0)
        k = min(components, width, int((values > NOTHING * trace).sum()))
        # values just beyond the components belong to the gap; the last ones of a narrow basis are not known well
        if width == dims or k < min(components, width) and residuals.max() <= CLOSE * trace or k == components and _held(residuals, values, k):
            return Model(n, sums, found[:, :k], values[:k], trace, width)
        width = min(dims, 2 * width)


def _whitener(model: Model):
    mean, scaled = model.sums / model.n, model.components / np.sqrt(model.values)
    return lambda x: (x - mean) @ scaled


def identity_error(vectors: DataFrame, model: Model) -> float:
    """The largest entry, of either sign, of the whitened vectors' covariance less the identity."""
    k, dims, white = len(model.values), len(model.sums), _whitener(model)
    if not k:
        return 0.0

    def share(x: np.ndarray) -> np.ndarray:
        w = white(x)
        out = np.zeros((dims, k + 1))
        out[:k, :k], out[:k, k] = w.T @ w, w.sum(0)
        return out

    total = _summed(vectors, dims, share, k + 1)[:k] / model.n
    mean = total[:, k]
    return float(np.abs(total[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum over dimensions of (n * x - sums)^2, exact."""
    away = n * x - sums
    most = int(np.abs(away).max(initial=0))
    if most * most * max(1, x.shape[1]) < EXACT:
        return (away * away).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in away]


def whiten(rows: DataFrame, model: Model, error: float) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of rows (vec_id, x); null ``x`` takes no part."""
    white, n, sums, k = _whitener(model), model.n, model.sums, len(model.values)
    explained = (model.values / model.trace).tolist()
    kind = rows.schema["vec_id"].dataType.simpleString()

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and k:
                x = _dense(b.column(1), len(sums))
                w, far = white(x), deviations(x, n, sums)
                ids = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), k)))
                columns = [ids, pa.array(np.tile(np.arange(1, k + 1), b.num_rows), pa.int32()), pa.array(np.full(b.num_rows * k, n), pa.int64()), pa.array([d for d in far for _ in range(k)], pa.int64()), pa.array(w.ravel()), pa.array(explained * b.num_rows), pa.array(np.full(b.num_rows * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where("x is not null").select("vec_id", "x").mapInArrow(through, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every vector on its largest principal components, each of variance 1; see :func:`whiten` for the columns.

    Vectors that are null or hold null or non-finite entries take no part. Equal vectors count once in
    the fit, and each row has its result, repeated ids and null ids too. Shorter vectors end in
    zeros. Of equal eigenvalues any basis of their space may be taken, the same for all rows. Components without
    variance are left out, so vectors that are all equal, or of no entries, have no rows; nor does an empty
    table. A deviation that does not fit a long is an error. Other columns are not looked at.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), integers(F.col(vector_col)).alias("x"))
    different = common.stored(rows.where("x is not null").select("x").distinct())
    model = fit(different, components)
    if model is None:
        return whiten(rows.where("false"), Model(1, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 1.0, 0), 0.0)
    return whiten(rows, model, identity_error(different, model))


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """Every embedding on the four largest components of all different ones."""
    return whitened(common.table(spark, sf_dir, "embeddings"))
