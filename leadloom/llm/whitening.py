"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The matrix X of distinct rows (whole numbers, centred) is never gathered. Each step multiplies it once by a vector on the
right and once by the result on the left, both in one pass: a task forms its part of u = X z and at once its share of
the transposed product, and only sums as wide as a row come back. Left vectors are not stored: each is
X w for a short vector w, so a task forms them anew from its rows to orthogonalise the new one against all. The steps
give a small bidiagonal matrix; its singular values and vectors are those of X.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.session import written

SCALE = 256
COMPONENTS = 4
#: Partial sums that one pass sends to the driver at most, each a few rows wide.
PARTIALS = 2_048
#: Rows that are multiplied at once.
BLOCK = 4_096
_EPS = float(np.finfo(float).eps)


class Whitening(NamedTuple):
    """``n`` distinct rows with sums ``sums`` by dimension; unit ``vectors`` (a column each) with eigenvalues ``values`` of their
    covariance, falling; ``trace`` of the covariance; ``identity_error`` of the whitened rows."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def whole(vector: Column) -> Column:
    """The entries as whole numbers, floor(SCALE * c)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(rows: DataFrame, width: int, shapes: list[tuple[int, ...]], share: Callable[[np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """The sums of ``share`` (arrays of the given shapes) over blocks of all rows (column ``x``). Tasks send one partial sum each;
    they are added in the order of the partitions, so a repeated pass gives the same numbers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            x = _matrix(batch.column(0), width).astype(np.float64)
            for i in range(0, len(x), BLOCK):
                flat = np.concatenate([a.ravel() for a in share(x[i : i + BLOCK])])
                total = flat if total is None else total + flat
        if total is not None:
            at = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([total.tobytes()], pa.binary())], ["at", "sums"])

    got = sorted(rows.mapInArrow(partial, "at int, sums binary").collect())
    total = np.sum([np.frombuffer(r["sums"]) for r in got], axis=0)
    edges = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return [part.reshape(s) for part, s in zip(np.split(total, edges), shapes, strict=True)]


def _orthogonal(v: np.ndarray, against: np.ndarray) -> np.ndarray:
    """``v`` without what lies along the columns of ``against``; twice, so that rounding leaves nothing."""
    for _ in range(2):
        v = v - against @ (against.T @ v)
    return v


class _Steps(NamedTuple):
    values: np.ndarray
    vectors: np.ndarray
    whole_space: bool


def bidiagonalised(rows: DataFrame, mean: np.ndarray, energy: float, wanted: int, away: np.ndarray, seed: int) -> _Steps:
    """Leading squared singular values of the centred rows and their right vectors, orthogonal to the columns of
    ``away``. Stops where the ``wanted`` leading ones have converged before half of the space is used up, or else
    when the space (or the ``energy``, the sum of all squared singular values) is.
    """
    d, draw = len(mean), np.random.default_rng(seed)
    right, short, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # v; w with u = X w; X'u
    alphas, betas = [], []

    def fresh() -> np.ndarray:
        v = _orthogonal(draw.standard_normal(d), np.hstack([away, right]))
        return v / np.linalg.norm(v)

    v, beta = fresh(), 0.0
    while True:
        z = v - (beta * short[:, -1] if alphas else 0.0)
        k = short.shape[1]

        def share(x: np.ndarray, z: np.ndarray = z, short: np.ndarray = short) -> list[np.ndarray]:
            x = x - mean
            u = x @ z
            return [(x @ short).T @ u, x.T @ u, np.array([u @ u])]

        along, product, square = _summed(rows, d, [(k,), (d,), (1,)], share)
        # the new left vector without what lies along the earlier ones, and all that follows from it
        u_square = max(0.0, float(square[0]) - float(along @ along))
        alpha = float(np.sqrt(u_square))
        z, product = z - short @ along, product - back @ along
        right = np.column_stack([right, v])
        dead = alpha * alpha <= energy * _EPS * _EPS * d
        alphas.append(0.0 if dead else alpha)
        betas.append(0.0)
        short = np.column_stack([short, np.zeros(d) if dead else z / alpha])
        back = np.column_stack([back, np.zeros(d) if dead else product / alpha])
        used = right.shape[1] + away.shape[1] >= d
        if not used:
            rest = _orthogonal(back[:, -1] - alphas[-1] * v, np.hstack([away, right]))
            beta = float(np.linalg.norm(rest))
            if beta * beta <= energy * _EPS * _EPS * d:  # an invariant space: go on in what is left of it
                beta, v = 0.0, fresh()
            else:
                v = rest / beta
        bidiagonal = np.diag(alphas) + np.diag(betas[:-1], 1)
        left, sigma, turned = np.linalg.svd(bidiagonal)
        if not used:
            betas[-1] = beta
        count = min(wanted, len(sigma))
        residual = (0.0 if used else beta) * np.abs(left[-1, :count])
        settled = len(sigma) >= wanted and bool(np.all(residual <= 4 * _EPS * sigma[0])) and beta > 0
        if used or (settled and 2 * right.shape[1] <= d):
            return _Steps(sigma[:count] ** 2, right @ turned[:count].T, used)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the rows ``x`` (arrays of whole numbers, one width, each distinct vector once); null where there are none.
    Singular values of equal size appear as often as they occur: where the steps end before the space is used up, they begin
    again away from what they found, until nothing larger comes."""
    first = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = first["n"], first["d"]
    if not n or not d:
        return None
    rows = vectors.select("x").coalesce(PARTIALS)
    # whole numbers: their sums are exact
    entries = vectors.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.sum(F.col("c").cast("decimal(19,0)") * F.col("c")).alias("q")
    )
    found = {r["at"]: (int(r["s"]), int(r["q"])) for r in entries.collect()}
    exact = [found[i] for i in range(d)]
    sums = np.array([float(s) for s, _ in exact])
    energy_n = sum(n * q - s * s for s, q in exact)  # n times the sum of squares of the centred rows
    trace = energy_n / (n * n)
    mean = np.array([s / n for s, _ in exact])
    if not energy_n:
        return Whitening(n, np.array([s for s, _ in exact], dtype=object), np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    energy, values, away, seed = energy_n / n, np.zeros(0), np.zeros((d, 0)), 1
    while True:
        got = bidiagonalised(rows, mean, energy, min(components, d - away.shape[1]), away, seed)
        larger = len(values) < components or bool(len(got.values) and got.values[0] > values[components - 1] * (1 + 1e-12))
        order = np.argsort(-np.append(values, got.values), kind="stable")
        values, away = np.append(values, got.values)[order], np.column_stack([away, got.vectors])[:, order]
        if got.whole_space or not larger or away.shape[1] >= d:
            break
        seed += 1
    real = int(np.sum(values[:components] > energy * _EPS * d))
    values, vectors_ = values[:real] / n, away[:, :real]
    turn = vectors_ / np.sqrt(values)

    def share(x: np.ndarray) -> list[np.ndarray]:
        z = (x - mean) @ turn
        return [z.sum(0), z.T @ z]

    middle, square = _summed(rows, d, [(real,), (real, real)], share) if real else (np.zeros(0), np.zeros((0, 0)))
    error = np.abs(square / n - np.outer(middle / n, middle / n) - np.eye(real)).max() if real else 0.0
    return Whitening(n, np.array([s for s, _ in exact], dtype=object), vectors_, values, trace, float(error))


def transform(rows: DataFrame, model: Whitening, key: str = "vec_id") -> DataFrame:
    """For each row (``key``, ``x``) and component: the whitened coordinate and the facts of the fit. ``deviation`` is a
    decimal, n^2 times the squared distance from the mean, exact up to 38 digits and null beyond."""
    mean = np.array([int(s) / model.n for s in model.sums])
    turn, d, real = model.vectors / np.sqrt(model.values), len(model.sums), len(model.values)
    kind = T.StructType([
        T.StructField("key", rows.schema[key].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("squares", T.StringType()), T.StructField("cross", T.StringType()),
    ])
    big = [int(s) for s in model.sums]
    small = max((abs(s) for s in big), default=0)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, sums = to_arrow_schema(kind), np.array(big, dtype=object)
        for batch in batches:
            x = _matrix(batch.column(1), d)
            m = len(x)
            if not m:
                continue
            most = int(np.abs(x).max(initial=0))
            fits = most * max(most, small) * d < 1 << 62
            held, by = (x, sums.astype(np.int64)) if fits else (x.astype(object), sums)
            squares, cross = (held * held).sum(1), (held * by).sum(1)
            white = ((x - mean) @ turn).ravel()
            take = pa.array(np.repeat(np.arange(m), real))
            text = lambda values: pa.array([str(int(v)) for v in values], pa.string()).take(take)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), pa.array(np.tile(np.arange(1, real + 1, dtype=np.int32), m)), pa.array(white),
                text(squares), text(cross),
            ], schema=schema)

    wide = "decimal(38,0)"
    whole_number = lambda c: F.col(c).try_cast(wide)
    n, total = F.lit(str(model.n)).cast(wide), F.lit(str(sum(s * s for s in big))).cast(wide)
    spread = F.try_subtract(F.try_multiply(n, whole_number("squares")), F.try_multiply(F.lit(2).cast(wide), whole_number("cross")))
    deviation = F.try_add(F.try_multiply(n, spread).cast(wide), total).cast(wide)
    explained = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("component")) if real else F.lit(None).cast("double")
    done = rows.select(F.col(key).alias("key"), "x").mapInArrow(projected, kind)
    return done.select(
        F.col("key").alias(key), "component", F.lit(model.n).cast("long").alias("n"), deviation.alias("deviation"), "whitened",
        explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row of ``rows`` and component up to ``components``: ``key``, ``component`` (from 1, by falling eigenvalue), ``n``
    (distinct vectors), ``deviation`` (decimal: n^2 times the squared distance from the mean), ``whitened`` (the centred row along
    the component, over its standard deviation), ``explained`` (share of the variance) and ``identity_error``.

    Vectors are taken as floor(256 * c) of their entries. Rows whose vector is null or empty or holds null or non-finite
    entries are left out, and so are those of another length than the commonest (of equally common ones, the longest). The
    fit takes each distinct vector once; a row under a null or repeated key gives its rows all the same. There are no more components
    than directions in which the vectors differ: none for one distinct vector or an empty table, which give no rows.
    Other columns are not read. The fit runs when this is called.
    """
    able = rows.where(usable(F.col(vector)) & (F.size(vector) > 0)).select(F.col(key).alias("_key"), whole(F.col(vector)).alias("x"))
    able = written(able, "whole-vectors")
    lengths = able.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if lengths is None:
        able, model = able.limit(0), None
    else:
        able = able.where(F.size("x") == lengths["d"])
        model = fit(written(able.select("x").distinct(), "distinct-vectors"), components)
    if model is None:
        model = Whitening(0, np.zeros(0, dtype=object), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    return transform(able, model, "_key").withColumnRenamed("_key", key)


def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
