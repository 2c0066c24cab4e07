"""Whitening of embeddings by principal components (operator 11).

1. Codes: an entry c becomes the long ``floor(64 c) + 1000000``.
2. The fit list has each distinct vector of codes once (pre-aggregated in the map,
   so a vector in a third of all rows is one row in each task).
3. Scatter.  Each task centres its vectors on the exact mean, then multiplies; a
   task gives one d x d matrix, and the matrices are summed entry by entry in a
   grouping.  Only the d x d sum comes to the driver.
4. Pivoted Cholesky of the scatter: ``P^T A P = L L^T``.  It stops where the largest
   pivots left are rounding against their own dimension's variance (``RANK_EPS``), so
   collinear and constant dimensions give no component and small scales stay.
5. One-sided Jacobi on ``L``: plane rotations from the right make its columns
   orthogonal.  With ``L V = U S`` it holds that ``A = P L L^T P^T = (P U) S^2 (P U)^T``: the
   rotated columns' squared norms are the eigenvalues and the normalised columns,
   with the pivots undone, the components.  No product ``L^T L`` is formed, which
   keeps small eigenvalues to full relative accuracy.
6. Every row is centred and projected in one pass without a shuffle.

Defined results: a null vector and one with a null or non-finite entry is dropped;
so is a vector whose length is not the most frequent one (of equally frequent
lengths the larger counts; an empty vector never counts); null ids and repeated rows
are each returned; rows that share a vector get the same numbers; a fit list of
rank r gives ``min(16, r)`` components, so one distinct vector gives no row; an
empty table gives an empty result; other columns are ignored.  Codes are kept to
+-2^60, and a ``deviation`` that a long can't hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import staged, table

SCALE, SHIFT = 64, 1_000_000
#: Bound of scaled entries.
LARGEST = 1 << 60
COMPONENTS = 16
#: A pivot under this share of its own dimension's variance (times the dimensions) is rounding.
RANK_EPS = 4 * np.finfo(float).eps
#: Off-diagonal cosines at which the rotations end.
TOLERANCE = 1e-15
SWEEPS = 60


def coded(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that count."""
    usable = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(
            "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    most = F.lit(float(LARGEST))
    return usable.select("vec_id", F.transform(
        "v", lambda c: F.floor(F.greatest(F.least(c * SCALE, most), -most)).cast("long") + SHIFT).alias("x"))


def of_one_length(codes: DataFrame) -> DataFrame:
    """Rows of the most frequent length."""
    best = codes.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return codes.where(F.size("x") == (best["d"] if best else 0))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as one matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64, copy=False)


def summed(rows: DataFrame, parts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of ``parts(x)``'s columns and of their products: each task sums its own, a grouping adds them."""
    schema = pa.schema([("i", pa.int32()), ("line", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for b in slices(batches, 4096):
            z = parts(b.column(0))
            total[:width] += z.T @ z
            total[width] += z.sum(0)
        yield batch(schema, list(range(width + 1)), [list(x) for x in total])

    lines = rows.select("x").mapInArrow(run, "i int, line array<double>").select("i", F.posexplode("line").alias("j", "v"))
    found = lines.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()      # (d + 1) x d numbers
    out = np.zeros((width + 1, width))
    for r in found:
        out[r["i"], r["j"]] = r["v"]
    return out[:width], out[width]


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``L`` (d x rank, lower triangular) and the order ``p`` with ``a[p][:, p] = L L^T``."""
    a, d = a.copy(), len(a)
    order, limit = np.arange(d), RANK_EPS * d * a.diagonal()
    lower = np.zeros((d, d))
    for k in range(d):
        rest = a.diagonal()[k:]
        open_ = np.where(rest > limit[order[k:]], rest, 0.0)
        best = k + int(open_.argmax())
        if not open_[best - k] > 0:
            return lower[:, :k], order
        if best != k:
            for m in (a, a.T):
                m[[k, best]] = m[[best, k]]
            lower[[k, best], :k] = lower[[best, k], :k]
            order[[k, best]] = order[[best, k]]
        lower[k, k] = np.sqrt(a[k, k])
        lower[k + 1:, k] = a[k + 1:, k] / lower[k, k]
        a[k + 1:, k + 1:] -= np.outer(lower[k + 1:, k], lower[k + 1:, k])
    return lower, order


def rounds_of(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs that together hold every pair of ``n`` columns once (a tournament)."""
    even = n + n % 2
    seats, out = list(range(even)), []
    for _ in range(even - 1):
        pairs = [(a, b) for a, b in zip(seats[:even // 2], seats[::-1], strict=False) if a < n and b < n]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(lower: np.ndarray) -> np.ndarray:
    """``lower`` rotated from the right until its columns are orthogonal."""
    u = lower.copy()
    rounds = rounds_of(u.shape[1])
    for _ in range(SWEEPS):
        worst = 0.0
        for left, right in rounds:
            p, q = u[:, left], u[:, right]
            aa, bb, ab = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > TOLERANCE
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0.0)
            c = 1 / np.hypot(1, t)
            s = c * t
            u[:, left], u[:, right] = c * p - s * q, s * p + c * q
        if worst <= TOLERANCE * max(len(u), 16):
            break
    return u


def components_of(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors (columns); as many as the rank."""
    lower, order = pivoted_cholesky(covariance)
    u = one_sided_jacobi(lower)
    norms = np.sqrt((u * u).sum(0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(u)
    vectors[order] = u / norms
    return norms[by] ** 2, vectors[:, by]


@dataclass
class Whitening:
    """A fit: ``(x - mean) @ directions`` is white on the fit list."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``: the whole part of the mean goes in whole numbers, the fraction after."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of ``(n x - S)^2`` of each row, exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        z = x - whole
        most = int(np.abs(z).max(initial=0)) * self.n + self.n
        if most * most * x.shape[1] < 1 << 63:
            off = self.n * z - rest
            return (off * off).sum(1).tolist()
        exact = [sum((self.n * int(a) - int(b)) ** 2 for a, b in zip(row, rest, strict=True)) for row in z]
        return [v if v < 1 << 63 else None for v in exact]


def fit(codes: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The fit over the distinct vectors of ``codes``; none without rows."""
    distinct = staged(codes.select("x").distinct(), "whiten-fit")
    # Sums of longs in decimals: exact at any number of rows.
    totals = distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    if not totals:
        return None
    totals = sorted(totals, key=lambda r: r["i"])
    dim, n = len(totals), totals[0]["n"]
    out = Whitening(n, [int(r["s"]) for r in totals], np.zeros(0), np.zeros((dim, 0)), 0.0, 0.0)
    scatter, _ = summed(distinct, lambda col: out.centred(matrix(col, dim)), dim)
    covariance = scatter / n
    values, vectors = components_of(covariance)
    out.trace = float(covariance.trace())
    out.values = values[:k]
    out.directions = vectors[:, :k] / np.sqrt(out.values)
    if len(out.values):
        squares, sums = summed(distinct, lambda col: out.centred(matrix(col, dim)) @ out.directions, len(out.values))
        mean = sums / n
        out.identity_error = float(np.abs(squares / n - np.outer(mean, mean) - np.eye(len(out.values))).max())
    return out


OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component (``OUT``)."""
    codes = staged(of_one_length(coded(rows)), "whiten-codes")
    model = fit(codes, k)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], OUT)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    dim, width = model.directions.shape
    share = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2048):
            x = matrix(b.column(1), dim)
            m = len(x) * width
            white = np.ascontiguousarray(model.centred(x) @ model.directions).ravel()
            at = pa.array(np.repeat(np.arange(len(x)), width))
            yield batch(schema, b.column(0).take(at), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(m, model.n)), pa.array(model.deviations(x), pa.int64()).take(at), pa.array(white),
                        pa.array(np.tile(share, len(x))), pa.array(np.full(m, model.identity_error)))

    return codes.select("vec_id", "x").mapInArrow(run, OUT)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
