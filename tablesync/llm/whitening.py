"""Whitening of embeddings by refined eigenvectors of their covariance.

Entries become whole numbers x (`grid`), so sums over the table are exact: the distinct vectors are written
once, their sums give the mean, their centred products the covariance, as fractions without rounding. The
eigenvectors are found in float32 and corrected by iterations of Ogita and Aishima, which need matrix products
only, in extended precision; where eigenvalues lie too close for them, the basis of such a cluster comes from a
small eigenproblem of its own, whose entries are the differences that matter there.

The matrices have the size of the dimension squared and are the only thing the driver sees; products are summed
entry by entry on the executors. Rows without a vector, or with null or non-finite entries (or entries whose x a
double does not hold exactly), are left out. The space is the one of the length most distinct vectors have, of
equally many the longest; vectors of other lengths have no coordinates in it and are left out too. Repeated rows
are rows of the result like others, but count once in the fit. Components of variance zero (constant tables, one
vector, fewer vectors than dimensions) cannot be scaled and are left out, so a table may have no component at
all; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.base import settled

EXACT = 2**53
REFINED = np.longdouble


@dataclass(frozen=True)
class Grid:
    """Entry c becomes floor(scale * c) + offset."""

    scale: int = 64
    offset: int = 1_000_000


@dataclass(frozen=True)
class Fit:
    """Mean and components of the distinct vectors; entry arrays have one value per dimension."""

    n: int
    near: list[int]  # the whole number next to the mean
    rest: list[int]  # sum - n * near
    vectors: np.ndarray  # one column per component
    values: np.ndarray  # eigenvalues, falling
    trace: float

    def offsets(self) -> np.ndarray:
        return np.array([float(Fraction(r, self.n)) for r in self.rest])


def gridded(vector: Column, g: Grid) -> Column:
    """The vector as whole numbers; null where it is to be left out."""
    entries = F.transform(vector.cast("array<double>"), lambda c: c * g.scale)
    fits = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < EXACT / 2))
    return F.when(fits, F.transform(entries, lambda c: F.floor(c) + g.offset))


def _matrices(column: pa.Array, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole-number matrix) for each length among the vectors, or for one."""
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(at)
    for size in np.unique(sizes).tolist() if length is None else [length]:
        rows = np.flatnonzero(sizes == size)
        if len(rows):
            yield rows, flat[at[rows][:, None] + np.arange(size)]


def _whole(matrix: np.ndarray) -> np.ndarray:
    """Column sums as Python numbers, which have no upper bound."""
    if not matrix.size or np.abs(matrix).max() * len(matrix) < 2**62:
        return matrix.sum(axis=0).astype(object)
    return matrix.astype(object).sum(axis=0)


def _products(d: np.ndarray) -> np.ndarray:
    """d.T @ d as Python numbers: in floats while their sums stay exact, else without them."""
    largest = int(np.abs(d).max()) ** 2 if d.size else 0
    if largest >= EXACT:
        return d.astype(object).T @ d.astype(object)
    out = np.zeros((d.shape[1], d.shape[1]), dtype=object)
    step = max(1, EXACT // max(1, largest))
    for i in range(0, len(d), step):
        part = d[i : i + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _entries(i: np.ndarray, j: np.ndarray, values: list[int]) -> pa.RecordBatch:
    kind = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(v) for v in values], kind)], ["i", "j", "value"])


def _sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length i and dimension j the sum; dimension -1 counts the vectors."""
    held: dict[int, np.ndarray] = {}
    for part in parts:
        for rows, x in _matrices(part.column(0)):
            found = np.concatenate(([len(rows)], _whole(x))).astype(object)
            size = x.shape[1]
            held[size] = held[size] + found if size in held else found
    for size, found in held.items():
        yield _entries(np.full(len(found), size), np.arange(-1, size), found.tolist())


def _summed(df: DataFrame, run, kind: str) -> dict[tuple[int, int], object]:
    """Entries (i, j, value) that tasks made, added up; as many as a matrix of the dimension has."""
    made = df.mapInArrow(run, f"i int, j int, value {kind}").groupBy("i", "j").agg(F.sum("value").cast(kind).alias("value"))
    return {(r.i, r.j): r.value for r in made.collect()}


def refined(matrix: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, from float32 to the precision given.

    One round sets X to X + X E, with E from R = I - X'X and S = X'AX alone. Pairs of eigenvalues closer than what
    the error of S, or its rounding, lets E tell apart are not separated by E; such clusters get the eigenvectors
    of their block of S, with the cluster's mean taken off first, so that small differences keep their digits.
    """
    a = matrix.astype(REFINED)
    size, eps = len(a), np.finfo(REFINED).eps
    scale = np.abs(a).max() or REFINED(1)
    a = a / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x, eye = start.astype(REFINED), np.eye(size, dtype=REFINED)
    for _ in range(rounds):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        if max(np.abs(r).max(), np.abs(off).max()) < 8 * size * eps:
            break
        # An entry of E is wrong by the rounding of S over the gap; its square must stay below the rounding.
        error = max(2 * (np.sqrt((off**2).sum()) + np.sqrt((r**2).sum())), size * np.sqrt(eps))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > error
        x = x + x @ np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        order = np.argsort(values)
        x, values = x[:, order], values[order]
        cuts = [0, *(np.flatnonzero(np.diff(values) > error) + 1).tolist(), size]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi - lo > 1:
                x[:, lo:hi] = _separated(a, x[:, lo:hi], values[lo:hi].mean())
    r = x.T @ x
    values = np.diag(x.T @ (a @ x)) / np.diag(r)
    x = x / np.sqrt(np.diag(r))
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _separated(a: np.ndarray, basis: np.ndarray, middle: np.floating) -> np.ndarray:
    """The basis of a cluster turned to the eigenvectors of its own small problem."""
    block = basis.T @ (a @ basis - middle * basis)
    largest = np.abs(block).max()
    if largest == 0:
        return basis
    _, turn = np.linalg.eigh(((block + block.T) / (2 * largest)).astype(np.float64))
    turn = turn.astype(REFINED)
    # float64 vectors are orthogonal to 16 digits; one step of Newton's iteration gives the rest.
    turn = turn @ (3 * np.eye(len(turn), dtype=REFINED) - turn.T @ turn) / 2
    return basis @ turn


def _extended(f: Fraction) -> np.floating:
    high = float(f)
    return REFINED(high) + REFINED(float(f - Fraction(high)))


def fit(distinct: DataFrame, most_components: int, most_dimensions: int) -> Fit | None:
    """Mean and components of a table of distinct whole-number vectors (column x)."""
    sums = _summed(distinct, _sums, "decimal(38,0)")
    counts = {size: int(n) for (size, j), n in sums.items() if j == -1 and size > 0}
    if not counts:
        return None
    size = max(counts, key=lambda s: (counts[s], s))
    if size > most_dimensions:
        raise ValueError(f"vectors have {size} entries; {most_dimensions} at most")
    n = counts[size]
    total = [int(sums[size, j]) for j in range(size)]
    near = [(2 * t + n) // (2 * n) for t in total]
    rest = [t - n * m for t, m in zip(total, near)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((size, size), dtype=object)
        for part in parts:
            for _, x in _matrices(part.column(0), size):
                held = held + _products(x - np.array(near, dtype=np.int64))
        i, j = np.triu_indices(size)
        if held.any():
            yield _entries(i, j, held[i, j].tolist())

    # Centred at the whole number next to the mean, so nothing rounds; the remaining shift is taken off exactly.
    products = _summed(distinct, run, "decimal(38,0)")
    covariance = np.zeros((size, size), dtype=REFINED)
    trace = Fraction(0)
    for i in range(size):
        for j in range(i, size):
            exact = Fraction(n * int(products.get((i, j), 0)) - rest[i] * rest[j], n * n)
            covariance[i, j] = covariance[j, i] = _extended(exact)
            trace += exact if i == j else 0
    if not trace:
        return Fit(n, near, rest, np.zeros((size, 0)), np.zeros(0), 0.0)
    values, vectors = refined(covariance)
    # What a double cannot tell from zero beside the largest is no direction of the data.
    kept = int((values[:most_components] > values[0] * size * np.finfo(np.float64).eps).sum())
    return Fit(n, near, rest, vectors[:, :kept].astype(np.float64), values[:kept].astype(np.float64), float(trace))


def _whitened(x: np.ndarray, f: Fit) -> np.ndarray:
    centred = (x - np.array(f.near, dtype=np.int64)).astype(np.float64) - f.offsets()
    return centred @ f.vectors / np.sqrt(f.values)


def identity_error(distinct: DataFrame, f: Fit) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, measured on them."""
    size, k = len(f.near), len(f.values)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(k), np.zeros((k, k))
        for part in parts:
            for _, x in _matrices(part.column(0), size):
                z = _whitened(x, f)
                total += z.sum(axis=0)
                product += z.T @ z
        i, j = np.triu_indices(k)
        i, j = np.concatenate((np.full(k, -1), i)), np.concatenate((np.arange(k), j))
        values = np.concatenate((total, product[np.triu_indices(k)]))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values)], ["i", "j", "value"])

    # The vectors are centred before they are projected, so their mean is zero but for rounding, which goes too.
    found = _summed(distinct, run, "double")
    mean = [found[-1, j] / f.n for j in range(k)]
    return max((abs(v / f.n - mean[i] * mean[j] - (i == j)) for (i, j), v in found.items() if i >= 0), default=0.0)


def _deviations(x: np.ndarray, f: Fit) -> list[int]:
    """Sums over dimensions of (n * x - sum) squared, exactly."""
    d = x - np.array(f.near, dtype=np.int64)
    largest = f.n * int(np.abs(d).max(initial=0)) + max(map(abs, f.rest))
    if largest**2 * len(f.near) < 2**62:
        y = f.n * d - np.array(f.rest, dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    y = f.n * d.astype(object) - np.array(f.rest, dtype=object)
    return (y * y).sum(axis=1).tolist()


def whiten(df: DataFrame, key: str, vector: str, components: int = 16, g: Grid = Grid(), most_dimensions: int = 4096) -> DataFrame:
    """Per row with a vector: key, n, deviation, whitened and explained (arrays, one entry per component), identity_error.

    `deviation` is a decimal of 38 digits, null beyond them. Vectors longer than `most_dimensions` are refused,
    since their covariance is a matrix of the driver.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    rows = df.select(F.col(f"`{key}`").alias("key"), gridded(F.col(f"`{vector}`"), g).alias("x")).filter("x IS NOT NULL")
    distinct = settled(rows.select("x").distinct(), "whitening-vectors")
    f = fit(distinct, components, most_dimensions)
    if f is None or not len(f.values):
        none = df.sparkSession.createDataFrame([], schema)
        return none.withColumnRenamed("key", key)
    size, error = len(f.near), identity_error(distinct, f)
    explained = (f.values / f.trace).tolist()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, x in _matrices(part.column(1), size):
                count, z = len(at), _whitened(x, f)
                wide = [v if v < 10**38 else None for v in _deviations(x, f)]
                offsets = pa.array(np.arange(count + 1, dtype=np.int32) * z.shape[1])
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(at)), pa.array(np.full(count, f.n)), pa.array(wide, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(offsets, pa.array(z.ravel())), pa.array([explained] * count, pa.list_(pa.float64())),
                    pa.array(np.full(count, error)),
                ], ["key", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def by_component(found: DataFrame, key: str) -> DataFrame:
    """The result of `whiten` with a row per component, numbered from 1."""
    at = found.select(key, "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"))
    return at.select(
        key, (F.col("at") + 1).cast("int").alias("component"), "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error")
