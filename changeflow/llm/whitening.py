"""Whitening of vectors: rotated to principal axes and scaled to unit variance on each.

Entries become whole numbers first, so sums and the covariance are exact: tasks multiply their
rows, centred by the mean rounded to a whole number, as matrices, and integers are added up; what
the rounding left is taken off exactly. The covariance is a square matrix of the number of
dimensions and goes to the driver, whatever the number of vectors.

Its eigenvectors are found in single precision and then refined by the iterations of Ogita and
Aishima, which are matrix products: the residuals of orthogonality and of diagonality, evaluated in
twice the working precision, give the correction of all eigenvectors at once, and errors square in
each round. Eigenvalues that lie too close together for that are a cluster: the matrix restricted to
it, with the common part taken off, is solved by itself, which separates what can be separated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.scratch import tasks_for, written

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
# An entry times the scale must be below this, or it counts as not finite.
LIMIT = float(1 << 60)
# Arrow and numpy hold so many entries of a batch at once.
_ENTRIES = 1 << 20
_EXACT = float(1 << 53)
_LIMB = 1 << 30


# -- products in twice the precision --------------------------------------------------------


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _slices(a: np.ndarray, number: int) -> list[np.ndarray]:
    """Matrices that sum to ``a``, rows of so few bits that products of two are exact."""
    bits = int(np.ceil((53 + np.log2(max(a.shape[1], 2))) / 2))
    out = []
    for _ in range(number):
        largest = np.abs(a).max(axis=1, keepdims=True)
        sigma = np.where(largest > 0, np.exp2(np.ceil(np.log2(np.where(largest > 0, largest, 1))) + bits), 0)
        top = (a + sigma) - sigma
        out.append(top)
        a = a - top
    return out


def product(a: np.ndarray, b: np.ndarray, number: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``a @ b`` as a sum of two matrices, to about twice the precision of a double.

    Both are cut into slices whose products a matrix multiplication gives without any rounding.
    """
    high = np.zeros((a.shape[0], b.shape[1]))
    low = np.zeros_like(high)
    left, right = _slices(a, number), [s.T for s in _slices(np.ascontiguousarray(b.T), number)]
    for total in range(2 * number - 1):
        for i in range(max(0, total - number + 1), min(total, number - 1) + 1):
            high, error = _two_sum(high, left[i] @ right[total - i])
            low += error
    return _two_sum(high, low)


# -- eigenvectors -----------------------------------------------------------------------------


def _residuals(a: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
    """I - X'X and X'AX, the latter as high and low parts."""
    gram = product(x.T, x)
    eye = np.eye(x.shape[1])
    r = (eye - gram[0]) - gram[1]
    ax, ax_low = product(a[0], x)
    ax_low = ax_low + a[1] @ x
    s, s_low = product(x.T, ax)
    s, s_low = _two_sum(s, s_low + x.T @ ax_low)
    return r, s, s_low


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of eigenvalues, in falling order, whose neighbours are within ``gap``."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _common_gap(r: np.ndarray, s: np.ndarray, size: float) -> float:
    off = s - np.diag(np.diag(s))
    return 2 * (np.linalg.norm(off) + size * np.linalg.norm(r))


def eigenvectors(high: np.ndarray, low: np.ndarray | None = None, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors, as columns, of the symmetric matrix
    ``high + low``, to double precision.

    Eigenvalues that agree to the last bit have some orthonormal basis of their space.
    """
    low = np.zeros_like(high) if low is None else low
    largest = np.abs(high).max(initial=0.0)
    if not largest:
        return np.zeros(len(high)), np.eye(len(high))
    scale = np.exp2(np.round(np.log2(largest)))
    a = high / scale, low / scale
    x = np.linalg.eigh(a[0].astype(np.float32))[1][:, ::-1].astype(np.float64)
    size = float(np.linalg.norm(a[0]))
    values = np.zeros(len(high))
    for _ in range(rounds):
        r, s, s_low = _residuals(a, x)
        clusters = _clusters(np.diag(s), _common_gap(r, s, size))
        for own in clusters:  # what they have in common is taken off before low parts are rounded away
            middle = s[own[0], own[0]]
            part = s[np.ix_(own, own)] - middle * np.eye(len(own)) + s_low[np.ix_(own, own)]
            part = part + middle * r[np.ix_(own, own)]
            x[:, own] = x[:, own] @ np.linalg.eigh((part + part.T) / 2)[1][:, ::-1]
        if clusters:
            r, s, s_low = _residuals(a, x)
        own = 1 - np.diag(r)
        values = np.diag(s) / own
        value_low = (np.diag(s) - values * own + np.diag(s_low)) / own
        gap = values[None, :] - values[:, None] + (value_low[None, :] - value_low[:, None])
        apart = np.abs(gap) > _common_gap(r, s, size)
        simple = (s + s_low + values[None, :] * r) / np.where(apart, gap, 1.0)
        correction = np.where(apart, simple, r / 2)
        x = x + x @ correction
        if np.abs(correction).max() < 4 * np.finfo(np.float64).eps:
            break
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


# -- sums over all vectors ------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _whole(column: pa.Array) -> np.ndarray:
    """floor(scale * c) of each entry; the shift is the caller's."""
    return np.floor(_matrix(column) * float(SCALE)).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], column: int, dimensions: int) -> Iterator[pa.RecordBatch]:
    step = max(1, _ENTRIES // max(dimensions, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _exactly(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x' y of whole numbers as Python integers; through floating point where that is exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * len(x)
    if most < _EXACT:
        return (x.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64).astype(object)
    return x.astype(object).T @ y.astype(object)


def _limbs(total: np.ndarray) -> np.ndarray:
    """Each Python integer as four signed limbs of 30 bits and the rest."""
    out = []
    for _ in range(4):
        out.append(total % _LIMB)
        total = total // _LIMB
    return np.array([*out, total], dtype=np.int64)


def _whole_numbers(limbs: np.ndarray) -> np.ndarray:
    return sum(limb.astype(object) * _LIMB**i for i, limb in enumerate(limbs))


def _moments(dimensions: int, centre) -> Callable:
    """A task's rows of sums: row i of the products, or with no centre the plain sums as row 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0, 0
        for part in _parts(batches, 0, dimensions):
            x = _whole(part.column(0))
            if centre is not None:
                x = x - centre.value
            total = total + _exactly(x if centre is not None else np.ones((len(x), 1), np.int64), x)
            n += len(x)
        if n:
            for i, row in enumerate(total):
                yield _moment(i, n, _limbs(row))

    return run


def _moment(i: int, n: int, limbs: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([i], pa.int32()), pa.array([n], pa.int64()), pa.array([limbs.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["i", "n", "limbs"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sums of all tasks, in order, added up: one row in memory at a time."""
    at, n, total = None, 0, 0
    for batch in batches:
        for i, rows, limbs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if i != at:
                if at is not None:
                    yield _moment(at, n, _limbs(total))
                at, n, total = i, 0, 0
            n, total = n + rows, total + _whole_numbers(np.frombuffer(limbs, np.int64).reshape(5, -1))
    if at is not None:
        yield _moment(at, n, _limbs(total))


def _summed(vectors: DataFrame, dimensions: int, centre=None) -> tuple[int, list[np.ndarray]]:
    """n, and the sums over all rows; each is a row of one number for each dimension."""
    schema = "i int, n long, limbs binary"
    parts = vectors.mapInArrow(_moments(dimensions, centre), schema)
    parts = parts.repartition(min(dimensions, tasks_for(vectors)), "i").sortWithinPartitions("i")
    found = sorted(parts.mapInArrow(_added, schema).collect(), key=lambda r: r["i"])
    return found[0]["n"], [_whole_numbers(np.frombuffer(r["limbs"], np.int64).reshape(5, -1)) for r in found]


@dataclass(frozen=True)
class Axes:
    """A fitted whitening: n, sums of the whole numbers (without the shift), and the axes."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, the largest first
    vectors: np.ndarray  # as columns
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Which components have variance beyond what rounding makes."""
        return self.values > len(self.sums) * np.finfo(np.float64).eps * self.trace


def fit(vectors: DataFrame, dimensions: int, components: int = COMPONENTS) -> Axes:
    """The principal axes of a column of vectors, all of ``dimensions`` finite entries."""
    n, (sums,) = _summed(vectors, dimensions)
    centre = np.array([int((2 * s + n) // (2 * n)) for s in sums], dtype=np.int64)
    sent = vectors.sparkSession.sparkContext.broadcast(centre)
    _, products = _summed(vectors, dimensions, sent)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre, strict=True)], dtype=object)
    whole = n * np.array(products, dtype=object) - np.outer(rest, rest)  # n * n times the covariance
    high = np.array([[_quotient(v, n * n) for v in row] for row in whole])
    low = np.array([[float(Fraction(v, n * n) - Fraction(h)) for v, h in zip(*rows, strict=True)] for rows in zip(whole, high, strict=True)])
    values, axes = eigenvectors(high, low)
    trace = _quotient(int(np.trace(whole)), n * n)
    take = min(components, dimensions)
    return Axes(n, tuple(int(s) for s in sums), values[:take], axes[:, :take], trace)


def _quotient(a: int, b: int) -> float:
    return int(a) / int(b)  # of integers, rounded once


def _projected(axes) -> Callable:
    """The deviation, exactly, and the whitened coordinates; null on axes without variance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Axes = axes.value
        n, d = fitted.n, len(fitted.sums)
        sums = np.array(fitted.sums, dtype=object)
        centre = np.array([int((2 * s + n) // (2 * n)) for s in fitted.sums], dtype=np.int64)
        rest = np.array([int(s) - n * int(c) for s, c in zip(sums, centre, strict=True)], dtype=object)
        part_of_unit = np.array([_quotient(r, n) for r in rest])
        scaled = fitted.vectors / np.sqrt(np.where(fitted.usable, fitted.values, 1.0))
        for part in _parts(batches, 1, d):
            x = _whole(part.column(1)) - centre
            most = n * (float(np.abs(x).max(initial=0)) + 1)
            if d * most * most < LIMIT:
                own = n * x - rest.astype(np.int64)
                deviation = pa.array((own * own).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                own = n * x.astype(object) - rest
                deviation = [_decimal(v) for v in (own * own).sum(axis=1)]
                deviation = pa.array(deviation, pa.decimal128(38, 0))
            white = (x - part_of_unit) @ scaled
            white[:, ~fitted.usable] = np.nan
            flat = pa.array(white.ravel(), from_pandas=True)
            offsets = pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32())
            columns = [part.column(0), deviation, pa.ListArray.from_arrays(offsets, flat)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "deviation", "whitened"])

    return run


def _decimal(value: int):
    from decimal import Decimal

    return Decimal(int(value)) if abs(int(value)) < 10**38 else None


def _clean(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector, in double precision, of the rows that take part."""
    entries = F.col(vector_column).cast("array<double>")
    fine = F.forall(entries, lambda c: F.coalesce(F.abs(c) * float(SCALE) < LIMIT, F.lit(False)))
    rows = vectors.select(F.col(id_column).alias("id"), entries.alias("vector"), fine.alias("fine"))
    return rows.filter(F.col("fine") & (F.size("vector") > 0)).drop("fine")


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """id, component, n, deviation, whitened, explained and identity_error of each vector.

    A vector takes part unless it is null, empty, or has an entry that is null, not finite, or too
    large for a whole number of 60 bits. Its entries c are whole numbers floor(1024 c) + 100000. A row
    for each of the leading components, at most as many as there are dimensions: the coordinate on
    that axis, divided by the standard deviation there, and the share of the whole variance. On an
    axis without variance (one vector, equal vectors) whitened is null; without any at all the share
    is null too, and identity_error where no axis is left. ``deviation`` is the exact sum of
    squares of n times an entry less the sum of all, a decimal of 38 digits, null beyond. Equal
    rows and equal ids each keep their rows. Vectors of another length are a set of their own with
    a fit of its own. An empty table gives an empty one. Other columns are not read.

    The driver holds matrices of the number of dimensions squared.
    """
    spark = vectors.sparkSession
    rows = written(_clean(vectors, id_column, vector_column), "whitening-vectors")
    kind = rows.schema["id"].dataType
    wide = T.StructType().add("id", kind).add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    out = spark.createDataFrame([], T.StructType([T.StructField("id", kind), *T.StructType.fromDDL(schema).fields]))
    for (dimensions,) in sorted(rows.select(F.size("vector")).distinct().collect()):
        own = rows.filter(F.size("vector") == dimensions)
        axes = fit(own.select("vector"), dimensions, components)
        found = own.mapInArrow(_projected(spark.sparkContext.broadcast(axes)), wide)
        found = written(found, "whitened")
        error = _identity_error(found, axes)
        shares = [float(v) / axes.trace if axes.trace else None for v in axes.values]
        shares = F.array(*[F.lit(s).cast("double") for s in shares])
        each = found.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        out = out.unionAll(
            each.select(
                "id", (F.col("at") + 1).alias("component"), F.lit(axes.n).cast("long").alias("n"), "deviation", "whitened",
                F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
            )
        )
    return out


def _identity_error(found: DataFrame, axes: Axes) -> float | None:
    """The largest entry of the covariance of the whitened coordinates, less the identity."""
    usable = [i for i, fine in enumerate(axes.usable) if fine]
    pairs = [(i, j) for i in usable for j in usable if i <= j]
    if not pairs:
        return None
    at = [F.get("whitened", F.lit(i)) for i in range(len(axes.usable))]
    got = found.agg(*[F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(got, pairs, strict=True))
