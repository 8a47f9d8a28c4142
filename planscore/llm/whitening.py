"""Embedding whitening with a covariance by polarisation.

Entries become integers ``x = floor(scale * c) + shift``. Two aggregations over the fit list (all
rows whose vector is whole) give the exact covariance:

1. number of rows and the sum of every dimension;
2. with ``y = x - round(mean)``, exact sums of ``y_i ** 2`` for every dimension and of
   ``(y_i + y_j) ** 2`` for every pair of dimensions. The values are centred before they are squared,
   and what rounding the mean leaves over is taken off exactly, so the variances of dimensions and of
   pair sums are exact fractions. Polarisation gives the rest:
   ``cov(i, j) = (var(i + j) - var(i) - var(j)) / 2``.

The driver holds one number per pair of dimensions (``MAX_DIMENSIONS`` bounds them), rounds the
fractions to doubles and calls ``eigh``. Rows are then projected on the leading components and divided
by the root of their eigenvalue. A third aggregation measures the covariance of the whitened rows.

Each task adds up its rows in 64-bit integers where their range allows it and in Python integers
elsewhere; sums travel as ``decimal(38)``, one row per pair and task, added by Spark.

Definitions: a row takes part if its vector is not null, holds no null or non-finite entry, and has
the table's dimension: the most frequent length among such vectors, the longer one of equals. Empty
vectors take no part. Repeated rows count as often as they occur; ids (null ones too) and other
columns pass through. Scaled entries are held within ±2**40. Components whose eigenvalue is zero to
double precision relative to the largest cannot be whitened: their values are 0.0 and they are left
out of the error. The error is 0.0, and so are shares of a zero trace, if there is no other
component. An empty table gives an empty result and a model without components.
"""

from __future__ import annotations

import dataclasses
import sys
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planscore.llm.vectors import whole

MAX_DIMENSIONS = 4096
SCALED_LIMIT = float(2 ** 40)
BLOCK_ROWS = 2048


@dataclasses.dataclass
class Model:
    """``components``: columns are unit eigenvectors by falling ``eigenvalues``; ``sums``: exact sums
    of the fit list's ``x`` by dimension."""

    scale: float
    shift: int
    n: int
    sums: list
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def matrix(column, scale: float, dimension: int) -> np.ndarray:
    """``floor(scale * c)`` of an Arrow list column without nulls, whole vectors of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):        # a product beyond the doubles is held at the limit too
        scaled = np.floor(flat * scale)
    return np.clip(scaled, -SCALED_LIMIT, SCALED_LIMIT).astype(np.int64).reshape(-1, dimension)


def blocks(batches, column: int, scale: float, dimension: int):
    """Slices of Arrow batches, each with its scaled integer matrix."""
    for b in batches:
        for at in range(0, b.num_rows, BLOCK_ROWS):
            part = b.slice(at, BLOCK_ROWS)
            if part.num_rows:
                yield part, matrix(part.column(column), scale, dimension)


def exact(values: np.ndarray, bound: int) -> np.ndarray:
    """``values`` as 64-bit integers if ``bound`` fits them, else as Python integers."""
    return values if bound < 2 ** 63 else values.astype(object)


def dimension_of(df: DataFrame, vec_col: str) -> int:
    """The most frequent vector length, the longer one of equals; 0 without rows."""
    row = (df.filter(F.size(vec_col) > 0).groupBy(F.size(vec_col).alias("d"))
           .agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first())
    d = row["d"] if row else 0
    if d > MAX_DIMENSIONS:
        raise ValueError(f"vectors have {d} dimensions; a covariance is built for "
                         f"{MAX_DIMENSIONS} at most")
    return d


def summed(df: DataFrame, vec_col: str, run) -> dict[int, int]:
    """Exact totals by key of the ``(k, v)`` arrays that ``run`` gives per task."""
    rows = df.select(F.col(vec_col).alias("v")).mapInArrow(run, "k int, v decimal(38,0)")
    return {r["k"]: int(r["v"]) for r in rows.groupBy("k").agg(F.sum("v").alias("v")).collect()}


def _emit(totals):
    values = [Decimal(int(t)) for t in totals]
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38, 0))],
        names=["k", "v"])


def sums_of(df: DataFrame, vec_col: str, scale: float, dimension: int) -> tuple[int, list]:
    """Row count and exact sums of ``floor(scale * c)`` by dimension."""
    def run(batches):
        total = np.zeros(dimension + 1, object)
        for _, x in blocks(batches, 0, scale, dimension):
            total[0] += len(x)
            total[1:] += x.sum(0).astype(object)     # 2**40 * BLOCK_ROWS fits 64 bits
        if total[0]:
            yield from _emit(total)
    got = summed(df, vec_col, run)
    return got.get(0, 0), [got.get(1 + i, 0) for i in range(dimension)]


def squares_of(df: DataFrame, vec_col: str, scale: float, centre: np.ndarray) -> list:
    """Exact sums of ``y_i ** 2`` by dimension, then of ``(y_i + y_j) ** 2`` by pair ``i < j`` (row
    by row of the upper triangle), with ``y = floor(scale * c) - centre``."""
    d = len(centre)
    n_sums = d * (d + 1) // 2

    def run(batches):
        total, rows = np.zeros(n_sums, object), 0
        for _, x in blocks(batches, 0, scale, d):
            y = x - centre
            most = 2 * int(np.abs(y).max())
            y = exact(y, most * most * len(y))
            found, at = np.empty(n_sums, y.dtype), d
            found[:d] = (y * y).sum(0)
            for i in range(d - 1):
                pair = y[:, i:i + 1] + y[:, i + 1:]
                found[at:at + d - 1 - i] = (pair * pair).sum(0)
                at += d - 1 - i
            total += found.astype(object)
            rows += len(y)
        if rows:
            yield from _emit(total)
    got = summed(df, vec_col, run)
    return [got.get(i, 0) for i in range(n_sums)]


def covariance(n: int, left: list, squares: list) -> np.ndarray:
    """Covariance (divisor ``n``) from the sums ``left`` of ``y`` and :func:`squares_of`, exact until
    the last rounding."""
    d = len(left)

    def variance(square: int, total: int) -> Fraction:
        return Fraction(n * square - total * total, n * n)
    own = [variance(squares[i], left[i]) for i in range(d)]
    out, at = np.empty((d, d)), d
    for i in range(d):
        out[i, i] = float(own[i])
        for j in range(i + 1, d):
            both = variance(squares[at], left[i] + left[j])
            out[i, j] = out[j, i] = float((both - own[i] - own[j]) / 2)
            at += 1
    return out


def fit(df: DataFrame, vec_col: str, scale: float = 64.0, shift: int = 1_000_000) -> Model:
    """Whitening model of all whole vectors of ``df``."""
    rows = whole(df, vec_col)
    d = dimension_of(rows, vec_col)
    if not d:
        return Model(scale, shift, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    rows = rows.filter(F.size(vec_col) == d)
    n, sums = sums_of(rows, vec_col, scale, d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    squares = squares_of(rows, vec_col, scale, np.array(centre, np.int64))
    cov = covariance(n, [s - n * c for s, c in zip(sums, centre)], squares)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    # one sign for all rows: the largest entry of a component is positive
    vectors = vectors * np.where(
        vectors[np.abs(vectors).argmax(0), np.arange(d)] < 0, -1.0, 1.0)
    return Model(scale, shift, n, [s + n * shift for s in sums], values, vectors,
                 float(np.trace(cov)))


def _weights(model: Model, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection that whitens, and which of its columns have a positive eigenvalue."""
    k = min(components, model.dimension)
    e = model.eigenvalues[:k]
    live = e > model.dimension * np.finfo(float).eps * max(model.eigenvalues.max(initial=0.0), 0.0)
    return model.components[:, :k] * np.where(live, 1 / np.sqrt(np.where(live, e, 1)), 0), live


def _centred(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Integer part of the mean of ``x - shift`` and what is left of it, as doubles."""
    centre = [(2 * s + model.n) // (2 * model.n) - model.shift for s in model.sums]
    left = [float(Fraction(s, model.n) - model.shift - c) for s, c in zip(model.sums, centre)]
    return np.array(centre, np.int64), np.array(left)


def whiten(df: DataFrame, model: Model, vec_col: str, components: int = 32,
           out_col: str = "whitened", deviation_col: str = "deviation") -> DataFrame:
    """Rows of ``df`` with a whole vector of the model's dimension, plus ``out_col`` (array of at most
    ``components`` values) and ``deviation_col`` (decimal: exact sum over dimensions of
    ``(n * x - S) ** 2``). New columns replace those of the same name."""
    made = [(out_col, "array<double>"), (deviation_col, "decimal(38,0)")]
    keep = [c for c in df.columns if c not in (out_col, deviation_col)]
    rows = (whole(df, vec_col).filter(F.size(vec_col) == model.dimension)
            .select(*[F.col(f"`{c}`") for c in keep], F.col(vec_col).alias("_vector_to_whiten")))
    if not model.n:
        return rows.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in made]).limit(0)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    weights, _ = _weights(model, components)
    centre, left = _centred(model)
    n, scale, d = model.n, model.scale, model.dimension
    # n * x - S = n * y - (S - n * (centre + shift))
    rest = [s - n * (int(c) + model.shift) for s, c in zip(model.sums, centre)]

    def run(batches):
        for part, x in blocks(batches, len(keep), scale, d):
            y = x - centre
            value = (y - left) @ weights
            reach = n * (int(np.abs(y).max()) + 1)
            z = exact(y, d * reach * reach)
            z = n * z - np.array(rest, z.dtype)
            deviation = [Decimal(int(v)) for v in (z * z).sum(1)]
            offsets = np.arange(0, value.size + 1, value.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(len(keep))]
                + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.ravel())),
                   pa.array(deviation, pa.decimal128(38, 0))],
                names=[*keep, *[c for c, _ in made]])
    return rows.mapInArrow(run, fields + "".join(f", `{c}` {t}" for c, t in made))


def identity_error(df: DataFrame, model: Model, vec_col: str, components: int = 32) -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor ``n``) minus the identity,
    measured over the rows."""
    weights, live = _weights(model, components)
    k = int(live.sum())
    if not model.n or not k:
        return 0.0
    weights = weights[:, live]
    centre, left = _centred(model)
    scale, d = model.scale, model.dimension

    def run(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for _, x in blocks(batches, 0, scale, d):
            w = ((x - centre) - left) @ weights
            first += w.sum(0)
            second += w.T @ w
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["k", "v"])
    rows = whole(df, vec_col).filter(F.size(vec_col) == d).select(F.col(vec_col).alias("v"))
    got = {r["k"]: r["v"] for r in rows.mapInArrow(run, "k int, v double")
           .groupBy("k").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([got[i] for i in range(k + k * k)]) / model.n
    mean, second = flat[:k], flat[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def op13(spark, sf_dir: str) -> DataFrame:
    """``embeddings``: whitened values, one row per row and component."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit(rows, "embedding")
    error = identity_error(rows, model, "embedding")
    share = [float(e) / model.trace if model.trace else 0.0 for e in model.eigenvalues[:32]]
    out = whiten(rows, model, "embedding").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), "whitened",
        F.element_at(F.array(*[F.lit(s) for s in share or [0.0]]), F.col("at") + 1)
        .alias("explained"), F.lit(error).alias("identity_error"))


# tasks need no installed package: functions travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
