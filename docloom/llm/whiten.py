"""Operator 11, embedding whitening: an exact scatter counted in Spark, turned by cyclic Jacobi rotations on the driver.

Three passes over the vectors: count and sums; the scatter of entries centred at the whole number next to the mean;
the covariance of the whitened values, as a check. The scatter is summed in whole numbers, so what centring at a whole
number leaves is taken off exactly, in any order of partitions. Only sums come to the driver: d * (d + 1) / 2 numbers
for d entries a vector (bounded by the vectors' length, not by the rows), and the matrix that goes back is d by 32.
Jacobi rotations stop when no off-diagonal entry counts beside its two diagonal ones, so small eigenvalues keep
their leading digits.

Defined results: vectors that are null, or hold null or non-finite entries, or have another length than the most common,
are left out; repeated rows count each; null ids stay null; an empty table gives no rows; further columns do not matter.
Vectors of fewer than 32 entries have as many components as entries. A component without variance (an eigenvalue below
rounding) has null for whitened, and counts in no error; without any variance explained and identity_error are null.
A deviation beyond a long is null. An entry beyond 2^55 is an error, as its long would not be exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table
from .vectors import matrix, usable

SCALE, SHIFT, MOST = 64, 1_000_000, 32  # fixed values: x = floor(64 c) + 1000000; components returned
EXACT, LONG = 1 << 53, 1 << 62
SWEEPS = 60


def whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors' entries as longs."""
    x = np.floor(SCALE * matrix(batch))
    if x.size and np.abs(x).max() > float(LONG >> 1):
        raise ValueError("an entry is too large for exact sums")
    return x.astype(np.int64) + SHIFT


class Totals:
    """Whole numbers summed without loss: in longs as long as they fit, then in Python's."""

    def __init__(self, size: int):
        self.low, self.high, self.bound = np.zeros(size, np.int64), None, 0

    def add(self, values: np.ndarray, bound: int) -> None:
        """bound: no absolute value is above it."""
        if self.bound + bound > LONG:
            self.high = self.sums()
            self.low, self.bound = np.zeros(len(self.low), np.int64), 0
        if values.dtype == object or bound > LONG:
            self.high = self.sums() + values.astype(object)
            self.low, self.bound = np.zeros(len(self.low), np.int64), 0
        else:
            self.low += values
            self.bound += bound

    def sums(self) -> np.ndarray:
        low = self.low.astype(object)
        return low if self.high is None else self.high + low


def products(x: np.ndarray) -> tuple[np.ndarray, int]:
    """The upper triangle of x'x and a bound of its absolute values, exact: floating point only where no sum passes 2^53."""
    most = int(np.abs(x).max()) if x.size else 0
    bound = most * most * len(x)
    y = x.astype(np.float64) if bound < EXACT else x if bound < LONG else x.astype(object)
    full = y.T @ y
    upper = full[np.triu_indices(x.shape[1])]
    return upper.astype(np.int64) if bound < EXACT else upper, bound


def _summed(rows: DataFrame, sums_of) -> dict[int, int]:
    """sums_of(batches) gives whole numbers by place, one set a partition; summed over all of them."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = sums_of(it)
        if values is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(list(map(int, values)), pa.decimal128(38, 0))], ["place", "v"])

    got = rows.select("vector").mapInArrow(run, "place int, v decimal(38,0)").groupBy("place").agg(F.sum("v").alias("v")).collect()
    return {r.place: int(r.v) for r in got}


def _first_moments(it: Iterator[pa.RecordBatch]) -> np.ndarray | None:
    total = None
    for b in it:
        if b.num_rows:
            x = whole(b)
            total = total or Totals(1 + x.shape[1])
            most = int(np.abs(x).max()) * len(x)
            total.add(np.concatenate(([len(x)], x.sum(axis=0, dtype=np.int64 if most < LONG else object))), most)
    return total.sums() if total else None


def _scatter(center: np.ndarray):
    def run(it: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for b in it:
            if b.num_rows:
                upper, bound = products(whole(b) - center)
                total = total or Totals(len(upper))
                total.add(upper, bound)
        return total.sums() if total else None

    return run


def jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns, the largest entry positive) of a symmetric matrix.

    Row by row, each off-diagonal entry is rotated away; sweeps end when none is above rounding of its diagonal entries.
    """
    a, d = np.array(a, np.float64), len(a)
    v = np.eye(d)
    tiny = np.finfo(float).eps / 4
    for _ in range(SWEEPS):
        turned = False
        for p in range(d - 1):
            for q in range(p + 1, d):
                x = a[p, q]
                if abs(x) <= tiny * sqrt(abs(a[p, p] * a[q, q])):
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * x)
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                pp, qq = a[p, p] - t * x, a[q, q] + t * x
                for m in (a, v):
                    left, right = m[:, p].copy(), m[:, q].copy()
                    m[:, p], m[:, q] = c * left - s * right, s * left + c * right
                a[p, :], a[q, :] = a[:, p], a[:, q]
                a[p, p], a[q, q], a[p, q], a[q, p] = pp, qq, 0.0, 0.0
        if not turned:
            break
    e = np.diag(a)
    order = np.argsort(-e, kind="stable")
    v = v[:, order]
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0) if d else v
    return e[order], v


@dataclass
class Whitening:
    """What is fitted. into: d x components, null components as zero columns; flat: which have no variance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    trace: float
    into: np.ndarray
    flat: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S in longs, or in Python's whole numbers where a long is too short."""
        if self.n * int(np.abs(x).max(initial=0)) < LONG and max(map(abs, self.sums), default=0) < LONG:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.into


def fit(rows: DataFrame, most: int = MOST) -> Whitening | None:
    """rows: vector, as usable() gives them. None for no rows."""
    got = _summed(rows, _first_moments)
    if not got:
        return None
    n, sums = got[0], [got[k] for k in range(1, len(got))]
    d = len(sums)
    center = [(2 * s + n) // (2 * n) for s in sums]
    scatter = _summed(rows, _scatter(np.array(center, np.int64)))
    left = [s - n * c for s, c in zip(sums, center, strict=True)]
    v = np.zeros((d, d))
    for k, (i, j) in enumerate(zip(*map(list, np.triu_indices(d)), strict=True)):
        v[i, j] = v[j, i] = (n * scatter[k] - left[i] * left[j]) / (n * n)  # whole numbers, one rounding
    e, u = jacobi(v)
    flat = e[:most] <= d * np.finfo(float).eps * max(e[0], 0.0) if d else np.zeros(0, bool)
    into = np.where(flat, 0.0, u[:, :most] / np.sqrt(np.where(flat, 1.0, e[:most])))
    return Whitening(n, np.array(sums, object), e[:most], float(np.trace(v)), into, flat)


def identity_error(rows: DataFrame, w: Whitening) -> float | None:
    """The largest absolute entry of the whitened values' covariance less the identity, measured over all rows."""
    k = len(w.values)
    if w.flat.all():
        return None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for b in it:
            if b.num_rows:
                y = w.whitened(w.centred(whole(b)))
                total += np.concatenate((y.sum(axis=0), (y.T @ y).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "v"])

    got = rows.select("vector").mapInArrow(run, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(k + k * k)
    for r in got:
        total[r.place] = r.v
    mean = total[:k] / w.n
    off = np.abs(total[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k))
    return float(off[np.ix_(~w.flat, ~w.flat)].max())


def whitened(rows: DataFrame, w: Whitening, error: float | None) -> DataFrame:
    """A row for each of rows (vec_id, vector) and component."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    k = len(w.values)
    explained = [float(x) / w.trace if w.trace > 0 else None for x in np.maximum(w.values, 0.0)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            m = b.num_rows
            if not m:
                continue
            centred = w.centred(whole(b))
            if centred.dtype != object and int(np.abs(centred).max()) ** 2 * centred.shape[1] < LONG:
                far = pa.array((centred * centred).sum(axis=1), pa.int64())
            else:
                far = pa.array([s if (s := sum(int(y) ** 2 for y in x)) < 1 << 63 else None for x in centred], pa.int64())
            y = w.whitened(centred)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, w.n), pa.int64()), far.take(at),
                pa.array(y.ravel(), mask=np.tile(w.flat, m)), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened_embeddings(rows: DataFrame) -> DataFrame:
    """rows: vec_id, embedding."""
    some = usable(rows, "embedding", "vec_id")
    w = fit(some)
    if w is None:
        w = Whitening(1, np.zeros(0, object), np.zeros(0), 0.0, np.zeros((0, 0)), np.zeros(0, bool))
    return whitened(some, w, identity_error(some, w))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_whiten": op11_whiten}
