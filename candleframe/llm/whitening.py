"""Whitening of embeddings by the leading eigenvectors of their exact covariance.

Vectors become integers, so sums and products are exact and the covariance is correctly
rounded whatever the partitioning. Its spectrum is cut into intervals, which Spark tasks
solve by contour integration (``feast``); only matrices of dimension x dimension, never
rows, come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleframe.llm import feast
from candleframe.llm.common import ddl, free_name, ship_package, trimmed

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Entries of this size or more take no part: their products would not fit the exact sums.
LIMIT = float(2**48)
#: Eigenvalues below this share of the norm (times the dimension) are not known to 1e-4.
NOISE = 1e4 * feast.EPS
#: Largest dimension: the covariance, 8 bytes an entry, travels to tasks and the driver.
MOST_DIMENSIONS = 4096


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: all of it is of the size of the dimension or its square."""

    n: int
    sums: list[int]
    values: np.ndarray  # falling
    vectors: np.ndarray  # unit columns
    trace: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values


def usable(c: Column) -> Column:
    """A vector without NULL, non-finite or huge entries (and not NULL or empty itself)."""
    return F.coalesce(F.forall(c, lambda x: F.coalesce(F.abs(x.cast("double")) < LIMIT, F.lit(False))), F.lit(False)) & (F.size(c) > 0)


def as_integers(column: pa.Array, d: int) -> np.ndarray:
    """x = floor(64 c) + 1000000 of each entry, one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, d) + OFFSET


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact y^T y as Python integers."""
    if not len(y) or float(np.abs(y).max()) ** 2 * len(y) < 2.0**53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _summed(rows: DataFrame, d: int, run: Callable, kind: str) -> np.ndarray:
    """The entrywise sum over partitions of what ``run`` makes of each: a matrix of ``d`` columns.

    A partition gives its matrix row by row; partial sums meet in a map-side aggregate.
    """

    def whole(batches):
        total = None
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = run(b.slice(at, 4096))
                total = part if total is None else total + part
        if total is not None:
            made = [Decimal(int(v)) for v in total.ravel()] if kind.startswith("decimal") else total.ravel().tolist()
            flat = pa.array(made, pa.decimal128(38) if kind.startswith("decimal") else pa.float64())
            ends = pa.array(np.arange(0, total.size + 1, d, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.ListArray.from_arrays(ends, flat)], ["i", "v"])

    parts = rows.mapInArrow(trimmed(whole), f"i int, v array<{kind}>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((max((c.i for c in cells), default=-1) + 1, d), dtype=object if kind.startswith("decimal") else float)
    for c in cells:
        out[c.i, c.j] = int(c.v) if kind.startswith("decimal") else c.v
    return out


def _eigenpairs(spark: SparkSession, v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` leading eigenpairs above noise (fewer if there are not so many), one task an interval."""
    d = len(v)
    norm = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    if norm == 0:
        return np.zeros(0), np.zeros((d, 0))
    a = v / norm
    # The whole spectrum; intervals from the top until they hold enough.
    form = feast.tridiagonal(a)
    cut = feast.intervals(form, feast.floor_near(form, NOISE * d), 1.001)
    work, held = [], 0
    for lo, hi, n in reversed(cut):
        if held < most:
            work.append((lo, hi, n))
            held += n
    if not work:
        return np.zeros(0), np.zeros((d, 0))

    def solve(batches):
        for b in batches:
            for r in b.to_pylist():
                _, found = feast.inside(a, r["lo"], r["hi"], r["n"])
                yield pa.RecordBatch.from_arrays([pa.array(found.T.tolist(), pa.list_(pa.float64()))], ["vector"])

    tasks = spark.createDataFrame(work, "lo double, hi double, n int").repartition(len(work))
    found = np.array([r.vector for r in tasks.mapInArrow(trimmed(solve), "vector array<double>").collect()]).T
    values, vectors = feast.joined(a, found)
    return values[:most] * norm, vectors[:, :most]


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on every usable vector of the most common length (of equally common ones, the longest).

    Vectors that are NULL, empty, or hold a NULL, non-finite or huge entry (2^48 or more)
    take no part. None without any vector. Sums and products of integers are exact:
    entries are centred on the rounded mean before they are multiplied, and what rounding
    left is subtracted in integers, so the covariance is the correctly rounded one.
    Directions without variance are no components: fewer vectors than components, or
    constant vectors, give fewer of them, or none.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    own = vectors.select(F.col(column).alias("v")).where(usable(F.col("v")))
    common = own.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    d, n = common.d, common.n
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries: the covariance of more than {MOST_DIMENSIONS} is not built")
    own = own.where(F.size("v") == d)
    sums = [int(s) for s in _summed(own, d, lambda b: as_integers(b.column("v"), d).astype(object).sum(axis=0)[None], "decimal(38,0)")[0]]
    near = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)  # the means, rounded
    left = np.array([s - n * int(m) for s, m in zip(sums, near, strict=True)], dtype=object)
    products = _summed(own, d, lambda b: _gram(as_integers(b.column("v"), d) - near), "decimal(38,0)")
    exact = n * products - np.outer(left, left)
    covariance = np.array([[int(x) / n**2 for x in row] for row in exact])
    trace = sum(int(exact[i, i]) for i in range(d)) / n**2
    values, units = _eigenpairs(spark, covariance, components)
    fit = Whitening(n, sums, values, units, trace, 0.0)
    if not len(values):
        return fit
    k = len(values)

    def moments(b):
        w = _whitened(as_integers(b.column("v"), d), fit)
        return np.concatenate([w.sum(axis=0)[None], w.T @ w])

    total = _summed(own, k, moments, "double") / n
    error = float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())
    return Whitening(n, sums, values, units, trace, error)


def _centred(x: np.ndarray, fit: Whitening) -> np.ndarray:
    """x - S / n: the whole part is subtracted in integers."""
    whole = np.array([s // fit.n for s in fit.sums], dtype=np.int64)
    rest = np.array([(s % fit.n) / fit.n for s in fit.sums])
    return (x - whole).astype(np.float64) - rest


def _whitened(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return (_centred(x, fit) @ fit.vectors) / np.sqrt(fit.values)


def _deviations(x: np.ndarray, fit: Whitening) -> list[int | None]:
    """sum((n x - S)^2), exact; None where it does not fit a long."""
    whole = np.array([s // fit.n for s in fit.sums], dtype=np.int64)
    rest = np.array([s % fit.n for s in fit.sums], dtype=np.int64)
    y = x - whole
    if float(np.abs(y).max(initial=0) + 1) ** 2 * float(fit.n) ** 2 * x.shape[1] < 2.0**62:
        return ((fit.n * y - rest) ** 2).sum(axis=1).tolist()
    found = ((fit.n * y.astype(object) - rest.astype(object)) ** 2).sum(axis=1).tolist()
    return [v if v < 2**63 else None for v in found]


def whiten(vectors: DataFrame, fit: Whitening | None, column: str = "embedding") -> DataFrame:
    """The usable vectors of the fit's length with ``whitened`` (array<double>) and ``deviation`` (long).

    ``deviation``: sum over dimensions of (n x - S)^2, exact; NULL where it exceeds a long.
    Other rows are dropped, every other column passes; columns named like the two new ones
    are replaced. No shuffle.
    """
    ship_package(vectors.sparkSession)
    made = ("whitened", "deviation")
    kept = vectors.select(*[F.col(f"`{c}`") for c in vectors.columns if c.lower() not in made])
    names = kept.columns
    v = free_name(names, "_v")
    d = len(fit.sums) if fit else -1

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = as_integers(part.column(v), d)
                w = _whitened(x, fit)
                ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                cols = [part.column(c) for c in names]
                cols += [pa.ListArray.from_arrays(ends, pa.array(w.ravel())), pa.array(_deviations(x, fit), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, [*names, *made])

    rows = kept.withColumn(v, F.col(f"`{column}`")).where(usable(F.col(v)) & (F.size(v) == d))
    return rows.mapInArrow(trimmed(run), ddl(kept, "whitened array<double>", "deviation long"))
