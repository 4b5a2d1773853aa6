"""Embedding whitening: principal components of the covariance, by mixed-precision refinement.

Vectors are counted in whole units, ``floor(SCALE * entry) + ORIGIN``. The fit list holds each distinct vector of units once.
Two passes over it give the sums and, about the rounded mean, the sums of products; both are whole numbers, added exactly
in the tasks and by Spark, so the covariance is exact however rows are split. Its eigenvectors come from a float32
decomposition that is then corrected in extended precision by the iterations of Ogita and Aishima: a step finds, from matrix
products alone, the correction that orthogonalises the vectors and takes the off-diagonal rest away. Eigenvalues too close for
that are clusters; each is solved as a small problem of its own, shifted by its mean, after which the next step can tell
them apart. A last pass over the fit list measures the covariance of what was whitened.

Rows go if the vector is null, holds a null or a non-finite entry, or has another length than most vectors of the fit list (of
equally common lengths, the longest counts). Entries beyond 2^52 units count as that. Components whose eigenvalue is zero
to double precision are left out, so equal vectors, one vector or none have no component. A null or repeated id is a row like
any other. ``deviation`` is exact, and null where it is beyond a long. Only matrices as wide as the vectors reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

SCALE, ORIGIN = 64, 1_000_000
COMPONENTS = 16
MOST_UNITS = float(1 << 52)
STEPS = 30                      # of the refinement, at most; it ends when a step no longer corrects
_EXACT = 1 << 53                # whole numbers below it are exact in a double
_LONG = 1 << 63
_ROWS = 4096                    # rows worked on at once
_WIDE = np.longdouble


@dataclass
class Whitening:
    """Units ``x`` become ``((x - shift) - rest / n) @ directions / sqrt(variances)``."""

    n: int = 0
    shift: list[int] = field(default_factory=list)
    rest: list[int] = field(default_factory=list)
    directions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    variances: np.ndarray = field(default_factory=lambda: np.zeros(0))
    total: float = 0.0

    def project(self, units: np.ndarray) -> np.ndarray:
        offset = np.array([r / max(self.n, 1) for r in self.rest])
        centred = (units - np.array(self.shift, np.int64)).astype(np.float64) - offset
        return centred @ (self.directions / np.sqrt(self.variances))

    def deviations(self, units: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - sum of x)^2``, of each row."""
        moved = units - np.array(self.shift, np.int64)
        largest = self.n * (int(np.abs(moved).max(initial=0)) + 1)
        if largest * largest * max(len(self.shift), 1) < _LONG:
            off = moved * self.n - np.array(self.rest, np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - r) ** 2 for v, r in zip(row, self.rest)) for row in moved]
        return [v if v < _LONG else None for v in exact]


# -- exact sums ----------------------------------------------------------------------------------------------------

def with_units(rows: DataFrame, vector: str, name: str = "__units") -> DataFrame:
    """``rows`` whose vector is whole and finite, with its units."""
    entry = lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))  # noqa: E731  (NaN is not below)
    bounded = lambda x: F.greatest(F.least(x.cast("double") * SCALE, F.lit(MOST_UNITS)), F.lit(-MOST_UNITS))
    held = F.col(f"`{vector}`")
    usable = rows.where(F.coalesce(F.forall(held, entry), F.lit(False)))
    return usable.withColumn(name, F.transform(held, lambda x: F.floor(bounded(x)) + F.lit(ORIGIN)))


def _matrices(batches: Iterator[pa.RecordBatch], width: int, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(units: np.ndarray) -> np.ndarray:
    small = int(np.abs(units).max(initial=0)) * len(units) < _LONG
    return (units if small else units.astype(object)).sum(axis=0).astype(object)


def _products(moved: np.ndarray) -> np.ndarray:
    """``moved.T @ moved`` in whole numbers: in doubles where every partial sum is exact in them."""
    largest = int(np.abs(moved).max(initial=0))
    if largest * largest * len(moved) < _EXACT:
        wide = moved.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = moved.astype(object)
    return wide.T @ wide


def _totals(values: list, at: list[tuple[int, int]]) -> pa.RecordBatch:
    first, second = zip(*at) if at else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(first, pa.int32()), pa.array(second, pa.int32()),
         pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["i", "j", "total"])


def _added(fit: DataFrame, run) -> dict[tuple[int, int], int]:
    """Partial sums of the tasks added by Spark; a row per pair of dimensions at most."""
    found = fit.mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(row["i"], row["j"]): int(row["total"]) for row in found.collect()}


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], dict[tuple[int, int], int]]:
    """Rows, sums of the units, and sums of products about the rounded mean, of a list of units."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for _, units in _matrices(batches, width, "units"):
            n, total = n + len(units), total + _sums(units)
        if n:
            yield _totals([n, *total], [(-1, -1), *((i, i) for i in range(width))])

    found = _added(fit, sums)
    n = found.get((-1, -1), 0)
    total = [found.get((i, i), 0) for i in range(width)]
    shift = _rounded(total, n)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((width, width), object)
        for _, units in _matrices(batches, width, "units"):
            held = held + _products(units - np.array(shift, np.int64))
        at = [(i, j) for i in range(width) for j in range(i, width)]
        yield _totals([held[i, j] for i, j in at], at)

    return n, total, _added(fit, products) if n else {}


def _rounded(total: list[int], n: int) -> list[int]:
    return [(2 * s + n) // (2 * n) if n else 0 for s in total]


def _covariance(n: int, rest: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Of whole numbers, rounded once."""
    width = len(rest)
    cov = np.zeros((width, width), _WIDE)
    for (i, j), product in products.items():
        whole, part = divmod(n * product - rest[i] * rest[j], n * n)
        cov[i, j] = cov[j, i] = _WIDE(str(whole)) + _WIDE(str(part)) / _WIDE(str(n * n))
    return cov


# -- eigenvectors --------------------------------------------------------------------------------------------------

def _clusters(values: np.ndarray, near: _WIDE) -> list[np.ndarray]:
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refine(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: better eigenvectors, their eigenvalues, and the largest entry of the correction."""
    width = len(matrix)
    rest = np.eye(width, dtype=_WIDE) - vectors.T @ vectors
    inner = vectors.T @ (matrix @ vectors)
    # symmetric to the last digit, as a step divides by small gaps: only then does it keep the vectors orthogonal
    rest, inner = (rest + rest.T) / 2, (inner + inner.T) / 2
    values = np.diag(inner) / (1 - np.diag(rest))
    near = 2 * (np.linalg.norm((inner - np.diag(values)).astype(float)) + np.linalg.norm(matrix.astype(float))
                * np.linalg.norm(rest.astype(float)))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > near
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.where(apart, (inner + values[None, :] * rest) / np.where(apart, gaps, 1), rest / 2)
    vectors = vectors + vectors @ step
    largest = float(np.abs(step).max())
    for cluster in _clusters(values, near):
        own = vectors[:, cluster]
        small = own.T @ (matrix @ own)
        small = small - np.eye(len(cluster), dtype=_WIDE) * (np.trace(small) / len(cluster))
        size = np.abs(small).max()
        if size > 0:
            turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(_WIDE)
            vectors[:, cluster] = own @ turn
            turned = np.abs(turn)
            # turned by more than signs and order: look again
            largest = max(largest, float((turned * (1 - turned)).max()))
    return vectors, values, largest


def eigen(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns, the largest entry positive) of a symmetric matrix, as doubles."""
    size = np.abs(cov).max(initial=_WIDE(0))
    if not len(cov) or size == 0:
        return np.zeros(len(cov)), np.eye(len(cov))
    matrix = (cov / size).astype(_WIDE)
    vectors = np.linalg.eigh(matrix.astype(np.float32))[1].astype(_WIDE)
    best = np.inf
    for _ in range(STEPS):
        vectors, values, moved = refine(matrix, vectors)
        if moved < 4 * np.finfo(_WIDE).eps or moved >= best and moved < 1e-15:
            break
        best = min(best, moved)
    for _ in range(2):      # what rounding over the smallest gaps left
        vectors = vectors + vectors @ ((np.eye(len(cov), dtype=_WIDE) - vectors.T @ vectors) / 2)
    values = np.diag(vectors.T @ (matrix @ vectors)) / np.diag(vectors.T @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order] * size, vectors[:, order] / np.sqrt((vectors[:, order] ** 2).sum(axis=0))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(cov))])
    return values.astype(np.float64), (vectors * signs).astype(np.float64)


# -- fitting and whitening -----------------------------------------------------------------------------------------

def fit_list(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Each distinct vector of units once (column ``units``, stored), and the length that most have."""
    distinct = materialize(with_units(rows, vector).select(F.col("__units").alias("units")).distinct(), "fit-list")
    most = (distinct.groupBy(F.size("units").alias("width")).count()
            .orderBy(F.desc("count"), F.desc("width")).first())
    width = most["width"] if most else 0
    return distinct.where(F.size("units") == width), width


def fit(units: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    if not width:
        return Whitening()
    n, total, products = moments(units, width)
    shift = _rounded(total, n)
    rest = [s - n * m for s, m in zip(total, shift)]
    cov = _covariance(n, rest, products)
    values, vectors = eigen(cov)
    least = width * np.finfo(np.float64).eps * max(values[0], 0.0)
    kept = min(components, int((values > least).sum()))
    return Whitening(n, shift, rest, vectors[:, :kept], values[:kept], float(np.trace(cov)))


def identity_error(units: DataFrame, width: int, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity, measured over the list."""
    kept = len(model.variances)
    if not kept:
        return 0.0
    shared = units.sparkSession.sparkContext.broadcast(model)      # width x components doubles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((kept + 1, kept + 1))
        for _, found in _matrices(batches, width, "units"):
            white = np.column_stack([shared.value.project(found), np.ones(len(found))])
            held += white.T @ white
        i, j = (x.ravel() for x in np.indices(held.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(held.ravel())], names=["i", "j", "total"])

    held = np.zeros((kept + 1, kept + 1))
    for row in (units.mapInArrow(run, "i int, j int, total double").groupBy("i", "j")
                .agg(F.sum("total").alias("total")).collect()):
        held[row["i"], row["j"]] = row["total"]
    mean = held[:kept, kept] / model.n
    return float(np.abs(held[:kept, :kept] / model.n - np.outer(mean, mean) - np.eye(kept)).max())


def _doubles(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The usable rows with ``n``, ``deviation``, ``whitened`` and ``explained`` (arrays by falling eigenvalue) and
    ``identity_error``. Columns of these names are replaced."""
    added = {"n": "long", "deviation": "long", "whitened": "array<double>", "explained": "array<double>",
             "identity_error": "double"}
    kept = [f for f in rows.columns if f not in added]
    units, width = fit_list(rows, vector)
    model = fit(units, width, components)
    error = identity_error(units, width, model)
    usable = with_units(rows, vector)
    usable = usable.where((F.size("__units") == width) & F.lit(width > 0)).select(*[f"`{c}`" for c in kept], "__units")
    schema = T.StructType([*(f for f in usable.schema.fields if f.name != "__units"),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    shared = rows.sparkSession.sparkContext.broadcast(model)       # width x components doubles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(shared.value.variances)
        for part, found in _matrices(batches, width, "__units"):
            white = shared.value.project(found) if size else np.zeros((len(found), 0))
            borders = pa.array(np.arange(len(found) + 1, dtype=np.int32) * size, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(shared.value.deviations(found), pa.int64()),
                 pa.ListArray.from_arrays(borders, pa.array(white.ravel(), pa.float64()))], names=schema.fieldNames())

    share = model.variances / model.total if model.total else model.variances
    return usable.mapInArrow(run, schema).withColumns({
        "n": F.lit(model.n).cast("long"), "explained": _doubles(share), "identity_error": F.lit(error)}).select(
        *[f"`{c}`" for c in kept], *added)
