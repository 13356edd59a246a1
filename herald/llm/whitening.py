"""Embedding whitening: project centred vectors on the leading eigenvectors of their covariance.

Vectors become whole numbers and are fitted on their distinct values, so hot copies weigh once. One
pass adds up the dimensions exactly, the next the products of centred components; a task sends
one number per pair of dimensions, added up by row of the matrix, and only the matrix comes to the
driver, whose size is the square of the dimensions whatever the rows are. There Householder
reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, and
inverse iteration their vectors, made orthogonal again within clusters of close values. Mean and
components, a few rows of numbers, are handed to the tasks that project.

Rows without a vector, or with a NULL or non-finite entry, are left out; all others are kept,
repeated rows, NULL and repeated ids included. Vectors shorter than the longest count as filled up with
zeros. Components whose eigenvalue is under 1e-11 of the largest have no direction that could be
told from rounding and are not returned: one distinct vector has none, so no rows. An empty table
gives no rows. Other columns are not looked at. Entries beyond 2^28 either way stop the query with an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import by_key
from herald.llm.vectors import WORK_BYTES, finite, floors, matrix
from herald.scale import settle

MOST = 1 << 36
#: Eigenvalues below this share of the largest are rounding.
VOID = 1e-11
#: Eigenvalues closer than this share of the matrix's norm have their vectors made orthogonal.
CLOSE = 1e-3


# --- covariance ------------------------------------------------------------------------

def _chunks(batches, width: int, dtype):
    rows = max(1, WORK_BYTES // (8 * max(1, width)))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield matrix(batch.column("x").slice(start, rows), width, dtype)


def sums(rows: DataFrame, width: int, kind: str) -> tuple[int, list]:
    """Number of rows (x) and the sum of each dimension; exact where x is of whole numbers."""
    dtype = np.int64 if kind == "long" else np.float64

    def add(batches):
        n, total = 0, np.zeros(width, dtype)
        for x in _chunks(batches, width, dtype):
            n += len(x)
            total += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()])], ["n", "sums"])

    parts = rows.select("x").mapInArrow(add, f"n long, sums array<{kind}>")
    number = F.col("total").cast("decimal(38,0)") if kind == "long" else F.col("total")
    each = parts.select("n", F.posexplode("sums").alias("dim", "total"))
    found = each.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(number).alias("total")).collect()
    total = {r.dim: r.total for r in found}
    convert = int if kind == "long" else float
    return (found[0].n if found else 0), [convert(total[i]) for i in range(len(total))]


def covariance(rows: DataFrame, width: int, n: int, mean: np.ndarray) -> np.ndarray:
    """Of rows (x), divided by ``n``; every vector is centred before it is multiplied."""
    def products(batches):
        total = np.zeros((width, width))
        for x in _chunks(batches, width, np.float64):
            x = x - mean
            total += x.T @ x
        for start in range(0, width, 256):
            part = total[start:start + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(start, start + len(part)), pa.int32()),
                 pa.array(part.tolist(), pa.list_(pa.float64()))], ["row", "values"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, values in zip(batch.column("row").to_pylist(),
                                 matrix(batch.column("values"), width, np.float64)):
                total[i] = total[i] + values if i in total else values.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], ["row", "values"])

    shape = "row int, values array<double>"
    parts = rows.select("x").mapInArrow(products, shape)
    tasks = min(width, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros((width, width))
    for r in by_key(parts, tasks, "row").mapInArrow(add, shape).collect():  # a row per dimension
        out[r.row] = r["values"]
    return (out + out.T) / 2 / n


# --- eigenvalues and eigenvectors of a small symmetric matrix ---------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections, each the identity less 2 w w'."""
    a = v.astype(float).copy()
    n, reflections = len(a), []
    off = np.zeros(max(0, n - 1))
    for k in range(n - 1):
        w = a[k + 1:, k].copy()
        norm = np.sqrt(w @ w)
        if k == n - 2 or norm == abs(w[0]):  # nothing below the off-diagonal
            off[k] = w[0]
            reflections.append(np.zeros(len(w)))
            continue
        off[k] = -norm if w[0] >= 0 else norm
        w[0] -= off[k]
        w /= np.sqrt(w @ w)
        rest = a[k + 1:, k + 1:]
        p = rest @ w
        p -= (w @ p) * w
        rest -= 2 * (np.outer(w, p) + np.outer(p, w))
        reflections.append(w)
    return np.diag(a).copy(), off, reflections


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues are smaller than each of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float(np.square(off).max(initial=0)))
    count, pivot = np.zeros(len(at), int), np.ones(len(at))
    for i, value in enumerate(diagonal):
        pivot = value - at - (off[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    reach = np.abs(np.concatenate(([0.0], off))) + np.abs(np.concatenate((off, [0.0])))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    edge = np.finfo(float).eps * max(np.abs(low).max(), np.abs(high).max(), np.finfo(float).tiny)
    low, high = low - edge, high + edge
    need = len(diagonal) - np.arange(k)  # so many eigenvalues lie below what is above the j-th largest
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = below(diagonal, off, middle) >= need
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return (low + high) / 2


def _solve(diagonal, off, shift, b):
    """Gaussian elimination of the shifted tridiagonal matrix, with row exchanges."""
    n = len(diagonal)
    least = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), 1e-300)
    main, one, two, b = list(diagonal - shift), [*off, 0.0], [0.0] * n, list(b)
    for i in range(n - 1):
        lower = off[i]
        if abs(lower) > abs(main[i]):
            main[i], lower = lower, main[i]
            one[i], main[i + 1] = main[i + 1], one[i]
            two[i], one[i + 1] = one[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(main[i]) < least:
            main[i] = least
        factor = lower / main[i]
        main[i + 1] -= factor * one[i]
        one[i + 1] -= factor * two[i]
        b[i + 1] -= factor * b[i]
    if abs(main[-1]) < least:
        main[-1] = least
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - one[i] * x[i + 1] - two[i] * x[i + 2]) / main[i]
    return x[:n]


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector per row by inverse iteration. Vectors of close values are made
    orthogonal in every step, or they would all run to the same one."""
    n, out = len(diagonal), []
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    draw = np.random.Generator(np.random.PCG64(7))
    shift = np.inf
    for j, value in enumerate(values):
        # equal values get shifts a rounding apart
        shift = min(value, shift - 4 * np.finfo(float).eps * norm)
        close = [out[i] for i in range(j) if abs(values[i] - value) <= CLOSE * norm]
        x = draw.standard_normal(n)
        for _ in range(6):
            for other in close * 2:
                x = x - (x @ other) * other
            x = x / np.sqrt(x @ x)
            x = _solve(diagonal, off, shift, x)
            x = x / np.abs(x).max()
        for other in close * 2:
            x = x - (x @ other) * other
        out.append(x / np.sqrt(x @ x))
    return np.array(out).reshape(len(out), n)


def eigen(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The up to k largest eigenvalues that are not rounding, and their unit vectors as rows."""
    scale = float(np.abs(v).max(initial=0))
    if not scale:
        return np.empty(0), np.empty((0, len(v)))
    diagonal, off, reflections = tridiagonal(v / scale)
    values = leading(diagonal, off, min(k, len(v)))
    values = values[values > VOID * values[0]]
    found = vectors(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        w = reflections[i]
        found[:, i + 1:] -= 2 * np.outer(found[:, i + 1:] @ w, w)
    return values * scale, found / np.sqrt(np.square(found).sum(1, keepdims=True))


# --- the operator ----------------------------------------------------------------------

@dataclass
class Whitening:
    """n vectors with exact sums per dimension; unit vectors as rows, with their eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])  # the nearest double of each
        return (x - mean) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        most = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if most >= 1 << 62:
            return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        y = x * self.n - np.array(self.sums, np.int64)
        if most ** 2 * x.shape[1] < 1 << 63:
            return np.square(y).sum(1).tolist()
        # squares of halves that fit: y = high * 2^31 + low, in pieces of 24 bits
        parts = [y & 0xFFFFFF, (y >> 24) & 0xFFFFFF, y >> 48]
        dot = {(i, j): (parts[i] * parts[j]).sum(1).tolist() for i in range(3) for j in range(i, 3)}
        return [sum((1 + (i != j)) * dot[i, j][r] << 24 * (i + j) for i, j in dot) for r in range(len(y))]


def usable(df: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """Rows (vec_id, x) that take part, and the length of the longest vector."""
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.filter(finite(F.col("vector")))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    whole = floors(F.col("vector"), scale, MOST)
    fill = F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("vector"))
    return rows.select("vec_id", F.when(F.size("vector") == width, whole)
                       .otherwise(F.concat(whole, fill)).alias("x")), width


def fit(rows: DataFrame, width: int, components: int = 4) -> Whitening:
    """On the distinct vectors of ``rows``."""
    spark = rows.sparkSession
    each = settle(rows.select("x").distinct(), "distinct-vectors")
    n, total = sums(each, width, "long")
    if not n:
        return Whitening(0, [], np.empty((0, width)), np.empty(0), 0.0)
    v = covariance(each, width, n, np.array([s / n for s in total]))
    values, found = eigen(v, components)
    model = Whitening(n, total, found, values, float(np.trace(v)))
    if len(values):
        k = len(values)

        def project(batches):
            for x in _chunks(batches, width, np.int64):
                yield pa.RecordBatch.from_arrays([pa.array(model.project(x).tolist())], ["x"])

        white = each.mapInArrow(project, "x array<double>")
        _, mean = sums(white, k, "double")
        error = covariance(white, k, n, np.array(mean) / n) - np.eye(k)
        model.identity_error = float(np.abs(error).max())
    return model


SCHEMA = ("vec_id long, component int, n long, deviation string, whitened double, "
          "explained double, identity_error double")


def transform(rows: DataFrame, width: int, model: Whitening) -> DataFrame:
    """Per row and component: its coordinate, and how far the row lies from the mean (a whole
    number, in up to 38 digits)."""
    k = len(model.values)
    explained = [float(e / model.trace) for e in model.values]

    def project(batches):
        step = max(1, WORK_BYTES // (8 * max(1, width)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = matrix(part.column("x"), width, np.int64)
                m = len(x)
                again = pa.array(np.repeat(np.arange(m), k))
                far = pa.array(map(str, model.deviations(x)), pa.string())
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n)), far.take(again),
                    pa.array(model.project(x).reshape(-1)), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, SCHEMA).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(df: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)."""
    rows, width = usable(df, scale)
    model = fit(rows, width, components)
    if not len(model.values):
        empty = df.sparkSession.createDataFrame([], SCHEMA)
        return empty.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
    return transform(rows, width, model)
