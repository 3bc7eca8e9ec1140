"""Operator 11: whitening of embeddings, with the principal components by contour integration (FEAST).

1. One pass sums every dimension of the integer vectors x exactly; a second one sums products of
   x - m, m the integer nearest the mean, so nothing cancels.  Both leave one small row per
   dimension (or pair of dimensions) and task, which Spark adds up; only the dims x dims matrix
   reaches the driver.
2. Inertia counts (signs of a symmetric indefinite factorisation of V - sI) find the interval that
   holds the wanted eigenvalues, its lower end in a gap of the spectrum.
3. FEAST: a quadrature of complex shifted solves (zI - V) Q = Y round the interval projects a few
   vectors onto its eigenspace; Rayleigh-Ritz extracts components, repeated until the residual
   is at rounding level.  The number found must equal the inertia count, so none is missed.
4. A last pass projects every row; the covariance of what comes out is measured on all rows.

Rows whose vector is null, empty, of another length than most, or holds a null or non-finite entry
are dropped; a null id and repeated rows stay as they are.  An entry past 65,535 in size is an error.  An
empty table gives no rows.  Components whose eigenvalue is zero (to rounding) cannot be whitened and
are left out, so equal rows only give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starling.llm.common import stored
from starling.llm.vectors import as_matrix, scaled_floor, vector_length

SCALE, SHIFT = 1024, 100_000
LIMIT = 2.0 ** 26  # of |scaled entry|: products of two and sums of many stay exact
EXACT = 2.0 ** 53
NODES = 16  # quadrature points on the upper half of the contour


# ------------------------------------------------------------------ eigenvalues
def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` lie above ``shift``: the positive pivots of
    a factorisation of matrix - shift I with symmetric 1x1 and 2x2 pivots (complete pivoting)."""
    a = matrix - shift * np.eye(len(matrix))
    alpha, positive = (1 + 17 ** 0.5) / 8, 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        i = int(diagonal.argmax())
        largest, on_diagonal = size.max(), diagonal[i]
        if largest == 0:
            break
        if on_diagonal >= alpha * largest:
            pivots = [i]
        else:
            pivots = sorted(divmod(int(size.argmax()), len(a)))
        rest = np.delete(np.arange(len(a)), pivots)
        block, side = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        positive += 1 if len(pivots) == 2 else int(block[0, 0] > 0)  # a 2x2 pivot has one sign of each
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return positive


def _bracket(matrix: np.ndarray, j: int, low: float, high: float, width: float) -> tuple[float, float]:
    """Bounds (low, high], at most ``width`` apart, of the j-th largest eigenvalue (from 1)."""
    while high - low > width:
        middle = (low + high) / 2
        if inertia_above(matrix, middle) >= j:
            low = middle
        else:
            high = middle
    return low, high


def leading_interval(matrix: np.ndarray, k: int, gap: float = 1e-6) -> tuple[float, float, int]:
    """(a, b, count): the interval holds ``count`` >= k eigenvalues, the largest ones, and a lies in
    a gap of at least ``gap`` of the largest (or below all eigenvalues)."""
    n = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger in size
    low, high = -0.01 * bound, bound * (1 + 1e-9)
    first = _bracket(matrix, 1, low, high, 1e-3 * bound)
    above = _bracket(matrix, k, low, first[1], gap * first[1] / 4)
    for j in range(k + 1, n + 1):
        below = _bracket(matrix, j, low, above[1], gap * first[1] / 4)
        if above[0] - below[1] > gap * first[1]:
            a = (above[0] + below[1]) / 2
            break
        above = below
    else:
        a = low
    b = first[1] + 0.05 * (first[1] - a)
    return a, b, inertia_above(matrix, a)


def feast(matrix: np.ndarray, a: float, b: float, count: int, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in (a, b], falling, and their unit eigenvectors as columns; an error unless there
    are ``count`` of them with a residual at rounding level."""
    n = len(matrix)
    size = min(n, max(count + 6, 2 * count))
    basis = np.random.default_rng(11).standard_normal((n, size))
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi / 2 * (1 - nodes))
    centre, radius, eye = (a + b) / 2, (b - a) / 2, np.eye(n)
    norm = np.abs(matrix).sum(axis=1).max()
    best, stalled, kept = np.inf, 0, None
    for _ in range(rounds):
        projected = sum(w / 2 * (radius * t * np.linalg.solve((centre + radius * t) * eye - matrix, basis)).real
                        for w, t in zip(weights, turns, strict=True))
        q = np.linalg.qr(projected)[0]
        small = q.T @ matrix @ q
        values, inner = np.linalg.eigh((small + small.T) / 2)
        basis = q @ inner
        inside = np.flatnonzero((values > a) & (values <= b))[::-1]
        if len(inside) == count:
            found = basis[:, inside]
            residual = np.abs(matrix @ found - found * values[inside]).max() / norm
            if residual < best / 2:
                best, stalled, kept = residual, 0, (values[inside], found)
            else:
                stalled += 1
            if stalled >= 2 and best < 1e-13:
                return kept
    if best < 1e-11:
        return kept
    raise ArithmeticError(f"{count} eigenvalues expected in ({a:g}, {b:g}], residual {best:g}")


# ------------------------------------------------------------------ fit
@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]  # S, exact
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    trace: float

    @property
    def pivot(self) -> np.ndarray:
        """The integer nearest the mean of each dimension."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)


def _integers(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    rows, matrix = as_matrix(column, length)
    return rows, scaled_floor(matrix, SCALE, LIMIT).astype(np.int64) + SHIFT


def _totals(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(length, np.int64)
        for batch in batches:
            x = _integers(batch.column(0), length)[1]
            n, sums = n + len(x), sums + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"j": np.arange(length), "n": np.full(length, n), "s": sums})

    rows = vectors.mapInArrow(run, "j long, n long, s long").groupBy("j").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["j"]: r for r in rows}
    return (by[0]["n"], [int(by[j]["s"]) for j in range(length)]) if by else (0, [0] * length)


def _products(vectors: DataFrame, length: int, pivot: np.ndarray) -> np.ndarray:
    """Sums over all rows of (x - pivot)_i (x - pivot)_j, exact, as Python integers."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(pivot)
    i, j = np.triu_indices(length)

    def rows_of(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"i": i.astype(np.int64), "j": j.astype(np.int64), "g": total[i, j]})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bound = np.zeros((length, length), np.int64), 0.0
        for batch in batches:
            y = (_integers(batch.column(0), length)[1] - shared.value).astype(np.float64)
            most = max(1.0, float(np.abs(y).max())) ** 2 if len(y) else 1.0
            step = int(max(1, EXACT // most))
            for at in range(0, len(y), step):  # every product sum is a whole number below 2^53
                part = y[at:at + step]
                if bound + most * len(part) > 2.0 ** 62:
                    yield rows_of(total)
                    total, bound = np.zeros((length, length), np.int64), 0.0
                total, bound = total + (part.T @ part).astype(np.int64), bound + most * len(part)
        if bound:
            yield rows_of(total)

    sums = (vectors.mapInArrow(run, "i long, j long, g long").groupBy("i", "j")
            .agg(F.sum(F.col("g").cast("decimal(38,0)")).alias("g")).collect())
    out = np.zeros((length, length), dtype=object)
    for r in sums:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["g"])
    return out


def fit(df: DataFrame, vector: str = "embedding", k: int = 8) -> Whitening | None:
    """The k leading components of all usable vectors of ``df`` (None if there are none)."""
    length = vector_length(df, vector)
    if not length:
        return None
    vectors = df.select(F.col(f"`{vector}`").cast("array<double>").alias("v"))
    n, sums = _totals(vectors, length)
    if not n:
        return None
    model = Whitening(n, tuple(sums), np.zeros(0), np.zeros((length, 0)), 0.0)
    pivot = model.pivot
    products = _products(vectors, length, pivot)
    rest = [s - n * int(p) for s, p in zip(sums, pivot, strict=True)]  # sums of x - pivot
    exact = [[n * products[i, j] - rest[i] * rest[j] for j in range(length)] for i in range(length)]
    covariance = np.array([[g / (n * n) for g in row] for row in exact])
    trace = sum(exact[i][i] for i in range(length)) / (n * n)
    if trace == 0:
        return model
    a, b, count = leading_interval(covariance, min(k, length))
    values, components = feast(covariance, a, b, count)
    real = [i for i in range(min(k, length)) if values[i] > 8 * length * np.finfo(float).eps * values[0]]
    return Whitening(n, tuple(sums), values[real], components[:, real], trace)


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, deviation, deviation_exact, w array) of every usable row: ``deviation_exact`` is the sum
    over dimensions of (n x - S)^2 as decimal, ``deviation`` the same as long (null past its range)."""
    length, n = len(model.sums), model.n
    pivot = model.pivot
    rest = np.array([s - n * int(p) for s, p in zip(model.sums, pivot, strict=True)], dtype=object)
    load = model.vectors / np.sqrt(model.values)
    shared = df.sparkSession.sparkContext.broadcast(
        (pivot, rest, load, np.array([r / n for r in rest], dtype=np.float64) @ load, int(sum(r * r for r in rest))))
    schema = T.StructType([df.schema[id_col], T.StructField("deviation", T.LongType()),
                           T.StructField("deviation_exact", T.DecimalType(38, 0)), T.StructField("w", T.ArrayType(T.DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, rest, load, offset, squares = shared.value
        small = max([1, *map(abs, rest)]) < 2 ** 26  # else whole numbers of any size
        for batch in batches:
            rows, x = _integers(batch.column(1), length)
            y = x - pivot
            own = (y * y).sum(axis=1).tolist()
            cross = (y @ rest.astype(np.int64)).tolist() if small else y.astype(object).dot(rest).tolist()
            exact = [n * n * o - 2 * n * c + squares for o, c in zip(own, cross, strict=True)]
            w = (y @ load - offset).ravel()
            lists = pa.ListArray.from_arrays(np.arange(0, len(w) + 1, max(1, load.shape[1])) if len(w) else np.zeros(len(x) + 1, np.int32), w)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows)).cast(arrow.field(0).type),
                pa.array([e if e < 1 << 63 else None for e in exact], pa.int64()),
                pa.array([Decimal(e) for e in exact], pa.decimal128(38, 0)),
                lists.cast(arrow.field(3).type)], schema=arrow)

    return df.select(F.col(f"`{id_col}`"), F.col(f"`{vector}`").cast("array<double>")).mapInArrow(run, schema)


def identity_error(wide: DataFrame, k: int) -> float:
    """Largest entry, in size, of the covariance of ``w`` (over all rows, divisor n) minus the
    identity; centred on the measured means before multiplying."""
    w = [F.col("w")[i] for i in range(k)]
    means = wide.agg(*[F.avg(c) for c in w]).first()
    centred = [c - F.lit(float(m)) for c, m in zip(w, means, strict=True)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = wide.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(float(v) - (i == j)) for (i, j), v in zip(pairs, found, strict=True))


def whitened_rows(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact, eigenvalue."""
    spark, id_type = df.sparkSession, df.schema[id_col].dataType
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
                        T.StructField("deviation_exact", T.DecimalType(38, 0)), T.StructField("eigenvalue", T.DoubleType())])
    model = fit(df, vector, k)
    if model is None or not len(model.values):
        return spark.createDataFrame([], out)
    wide = stored(whiten(df, model, id_col, vector), "whitened")
    error = identity_error(wide, len(model.values))
    values = F.array(*[F.lit(float(e)) for e in model.values])
    long = wide.select(f"`{id_col}`", "deviation", "deviation_exact", F.posexplode("w").alias("at", "whitened"))
    return long.select(F.col(f"`{id_col}`"), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                       "deviation", "whitened", (values[F.col("at")] / F.lit(model.trace)).alias("explained"),
                       F.lit(error).alias("identity_error"), "deviation_exact", values[F.col("at")].alias("eigenvalue"))
