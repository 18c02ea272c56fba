"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

An entry c of a vector becomes the whole number ``floor(256 * c)``. The fit list holds each distinct vector of these
once. Tasks sum it (exactly) and its centred scatter (in double), so the driver sees numbers of a table as large as the
dimension squared, whatever the number of rows. With the scatter P'VP = L L' the columns of L are rotated in pairs until
all are at right angles: their squared norms are the eigenvalues of V, the columns of unit length its eigenvectors.
V itself is never diagonalised, so small eigenvalues keep their relative precision.

Nulls: rows whose vector is null or holds null, NaN or an infinity are left out, and so are vectors whose length is not
the commonest one (of equally common ones the greatest), since they have no place in one covariance. Identifiers may be
null and repeat: every row counts by itself, equal vectors once in the fit. Components without variance are left out, so
an empty table, a single vector and vectors without entries give no rows. Entries beyond the range of a long are taken as
its ends; a deviation beyond it is null. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import staged, table

COMPONENTS = 4
SCALE = 256
_SAFE = 2**62


@dataclass
class Fit:
    """Size and sums of the fit list, components as columns, eigenvalues by size, trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null or not finite."""
    finite = lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))  # noqa: E731  NaN is the greatest
    return vector.isNotNull() & F.forall(vector, finite)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as 64-bit numbers where they fit, else as Python's."""
    most = max((abs(s) for s in sums), default=0) + n * (max(int(x.max()), -int(x.min())) if x.size else 0)
    return x * n - np.array(sums, np.int64) if most < _SAFE else x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64)


def _total(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            n += len(x)
            # halves of 32 bits cannot overflow in the sum of a batch
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            sums = [s + (h << 32) + w for s, h, w in zip(sums, high.tolist(), low.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.decimal128(38, 0)))], ["n", "sums"])

    parts = fit.mapInArrow(run, "n bigint, sums array<decimal(38,0)>")
    # the row of all numbers comes as place -1
    placed = parts.select(F.posexplode(F.concat(F.array(F.col("n").cast("decimal(38,0)")), "sums")).alias("i", "v"))
    got = {r.i: int(r.v) for r in placed.groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return got.get(0, 0), [got.get(i + 1, 0) for i in range(size)]


def _scatter(fit: DataFrame, size: int, width: int, centre) -> np.ndarray:
    """Sum of the products of all pairs of the ``width`` numbers that ``centre`` makes of each vector, and below it their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            y = centre(_matrix(batch.column("x"), size))
            total[:width] += y.T @ y
            total[width] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    parts = fit.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((width + 1, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """F with F F' = a up to rounding, for a positive semidefinite: the largest remaining variance comes next, until none is left."""
    d = len(a)
    factor, rest = np.zeros((d, d)), a.diagonal().copy()
    least = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        p = int(rest.argmax())
        if rest[p] <= least:
            return factor[:, :k]
        column = (a[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(rest[p])
        column[rest == -np.inf] = 0.0  # chosen before: the factor is triangular in the order of choice
        factor[:, k] = column
        rest = rest - column**2
        rest[p] = -np.inf
    return factor


def _rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of r columns in rounds of pairs without a column in common."""
    players = list(range(r + r % 2))
    out = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(min(p, q), max(p, q)) for p, q in zip(players[:half], reversed(players[half:])) if max(p, q) < r]
        out.append(tuple(np.array(side) for side in zip(*pairs)))
        players = [players[0], players[-1], *players[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of F F', falling, by rotating columns of F until all are at right angles."""
    f = factor.copy()
    rounds = _rounds(f.shape[1]) if f.shape[1] > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            x, y = f[:, p], f[:, q]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(a * b)
            turn = np.abs(c) > np.finfo(float).eps * size
            worst = max(worst, float(np.max(np.abs(c[turn]) / size[turn], initial=0.0)))
            safe = np.where(turn, c, 1.0)
            zeta = (b - a) / (2 * safe)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            f[:, p], f[:, q] = cos * x - cos * t * y, cos * t * x + cos * y
        if worst <= 8 * np.finfo(float).eps:
            break
    norms = np.sqrt((f * f).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, f[:, order] / norms[order]


def fit_components(fit: DataFrame, size: int) -> Fit:
    """Components of the covariance of a list of vectors ``x``, each of ``size`` whole numbers."""
    n, sums = _total(fit, size) if size else (0, [])
    if not n:
        return Fit(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0)
    covariance = _scatter(fit, size, size, lambda x: _centred(x, n, sums))[:size] / n
    values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
    return Fit(n, sums, vectors, values, float(covariance.trace()))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: ``id, component, n, deviation, whitened, explained, identity_error``."""
    spark = rows.sparkSession
    named = rows.select(F.col(id_col).alias("_id"), F.col(vector).alias("_v")).filter(usable(F.col("_v"))).select("_id", whole_numbers(F.col("_v")).alias("x"))
    lengths = named.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    commonest = lengths.orderBy(F.desc("rows"), F.desc("size")).first()
    size = commonest["size"] if commonest else 0
    of_size = named.filter(F.size("x") == size)
    fit = staged(spark, of_size.select("x").distinct(), "whitening-fit")
    fitted = fit_components(fit, size)
    k = min(most, len(fitted.values))
    n, sums = fitted.n, fitted.sums
    weights = fitted.components[:, :k] / np.sqrt(fitted.values[:k])
    explained = (fitted.values[:k] / fitted.trace).tolist() if k else []
    error = 0.0
    if k:
        around = _scatter(fit, size, k, lambda x: _centred(x, n, sums) @ weights) / n
        error = float(np.abs(around[:k] - np.outer(around[k], around[k]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), size)
            apart = deviations(x, n, sums)
            if apart.dtype != object and int(np.abs(apart).max()) ** 2 * size >= _SAFE:
                apart = apart.astype(object)
            squares = [s if s < 2**63 else None for s in (apart * apart).sum(axis=1).tolist()]
            white = (apart / n).astype(np.float64) @ weights
            ids = batch.column("_id").take(pa.array(np.repeat(np.arange(len(x)), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(ids), n, np.int64)),
                    pa.array([s for s in squares for _ in range(k)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(ids), error)),
                ],
                ["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = named.schema["_id"].dataType.simpleString()
    made = of_size.mapInArrow(run, f"_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    return made.withColumnRenamed("_id", id_col)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
