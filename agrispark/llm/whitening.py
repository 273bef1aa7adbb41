"""Whitening of embeddings by components found through contour integration.

``components`` finds the largest eigenpairs of a covariance. Counts of inertia (signs of the pivots of a symmetric
factorisation of ``V - shift``) bisect the axis into intervals that hold a few eigenvalues each, with ends in gaps.
For an interval, the integral of the resolvent along a circle through its ends, by Gauss-Legendre quadrature of complex
shifted solves, projects a block of vectors onto the eigenvectors inside; Rayleigh-Ritz extracts the pairs, and the
round is repeated until their residuals are those of rounding. The counts tell how many pairs there must be; an
interval with fewer is an error. One Rayleigh-Ritz step over all intervals makes the vectors orthogonal.

The rows stay in Spark: one pass for counts and sums, one for the covariance, one that projects, and one aggregation
for the covariance of the result. What comes to the driver grows with the square of the dimension, not with the rows.
Sums are of integers, centred by the nearest integer to the mean, so they are exact below 2^53; the rest of the
mean is taken out in exact arithmetic.

Edge cases: vectors that are null, hold null or non-finite entries, or are of another length than most (of equally many
the longer) are dropped; repeated and null ids are rows of their own; entries beyond 2^40 in size count as 2^40; a
deviation beyond a long is null; components whose eigenvalue is below 1e-12 of the largest have no scale and are left
out, so equal vectors or an empty table give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from agrispark.llm.common import slices, table, written

COMPONENTS, NODES, GROUP = 32, 8, 12
SCALE, SHIFT, MOST = 64.0, 1_000_000, 2.0**40
TINY = 1e-12


# eigenpairs of a dense symmetric matrix


def below(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues are below the shift: negative pivots of a factorisation with pivots of one or two rows."""
    a, count = v - shift * np.eye(len(v)), 0
    while len(a):
        n = len(a)
        d = np.abs(np.diagonal(a))
        off = np.abs(a - np.diag(np.diagonal(a)))
        p = int(np.argmax(d))
        i, j = divmod(int(np.argmax(off)), n)
        if d[p] >= 0.64 * off[i, j]:
            if a[p, p] == 0:
                return count  # nothing but zeros is left
            count += a[p, p] < 0
            rest = np.delete(np.arange(n), p)
            c = a[rest, p]
            a = a[np.ix_(rest, rest)] - np.outer(c, c / a[p, p])
        else:
            count += 1  # a pivot of two rows led by its off-diagonal has one sign of each
            two = np.array([i, j])
            rest = np.delete(np.arange(n), two)
            c = a[np.ix_(rest, two)]
            a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(a[np.ix_(two, two)], c.T)
        a = (a + a.T) / 2
    return count


def intervals(v: np.ndarray, wanted: int, group: int = GROUP) -> list[tuple[float, float, int, int]]:
    """``(low, high, number, about)`` of intervals that together hold the ``wanted`` largest eigenvalues, the last perhaps more.

    ``about`` counts the eigenvalues within one and a half times the interval's radius of its centre. Those just outside
    the circle pass the contour almost as well as those inside, so the block of vectors must have room for them;
    intervals are halved until few stand there or the interval is no wider than rounding allows.
    """
    n, radius = len(v), np.abs(v).sum(axis=1)
    low, high = float((np.diagonal(v) - radius).min()) - 1e-300, float(radius.max()) * 1.01 + 1e-300
    counts = {low: 0, high: n}

    def count(x: float) -> int:
        if x not in counts:
            counts[x] = 0 if x <= low else n if x >= high else below(v, x)
        return counts[x]

    out, todo = [], [(low, high)]
    while todo:
        a, b = todo.pop()
        if count(b) <= n - wanted or count(a) == count(b):
            continue
        m, rim = (a + b) / 2, (b - a) / 4
        about = count(b + rim) - count(a - rim)
        if (count(b) - count(a) > group or about > 3 * group) and b - a > 1e-10 * high and a < m < b:
            todo += [(a, m), (m, b)]
        else:
            out.append((a, b, count(b) - count(a), about))
    return out


def inside(v: np.ndarray, low: float, high: float, number: int, about: int, nodes: int = NODES) -> np.ndarray:
    """Orthonormal columns that span the eigenvectors of the ``number`` eigenvalues between low and high; ``about``: as above."""
    n = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - x)
    ring = radius * np.exp(1j * angle)
    width = min(n, max(about, number) + 4)
    q = np.linalg.qr(np.random.default_rng(width).standard_normal((n, width)))[0]
    scale = max(float(np.abs(v).sum(axis=1).max()), 1e-300)
    least, rounds = math.inf, 40
    for _ in range(rounds):
        # upper half of the circle; the lower half is its mirror image
        s = sum((weight / 2 * z * np.linalg.solve((centre + z) * np.eye(n) - v, q.astype(complex))).real for weight, z in zip(w, ring, strict=True))
        q = np.linalg.qr(s)[0]
        e, u = np.linalg.eigh(q.T @ v @ q)
        q = q @ u
        # vectors to spare may have Ritz values inside too; only eigenpairs have residuals of rounding
        residual = np.where((e > low - 1e-13 * scale) & (e < high + 1e-13 * scale), np.linalg.norm(v @ q - q * e, axis=0), np.inf)
        own = np.argsort(residual)[:number]
        now = residual[own].max(initial=0.0)
        if now <= 1e-13 * scale or now <= 1e-10 * scale and now > least / 2:  # as good as it gets
            return q[:, own]
        least = min(least, now)
    raise ArithmeticError(f"{number} eigenvalues lie between {low} and {high}; the residuals of as many pairs are {least:.3g} at best")


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a covariance: at most ``most``, none below ``TINY`` of the largest."""
    n = len(v)
    if not n or not np.any(v):
        return np.zeros(0), np.zeros((n, 0))
    found = [inside(v, *span) for span in intervals(v, min(most, n))]
    q = np.linalg.qr(np.concatenate(found, axis=1))[0]
    e, u = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-e)[:most]
    kept = order[e[order] > TINY * e[order[0]]]
    vectors = q @ u[:, kept]
    return e[kept], vectors / np.linalg.norm(vectors, axis=0)


# rows


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``(id, v)``: the vectors of the commonest length without null or non-finite entries, as doubles; and that length."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = rows.where(F.col(vector_col).isNotNull()).where(~bad).select(F.col(id_col).alias("id"), v.alias("v"))
    sizes = good.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    dims = common["size"] if common else 0
    return good.where(F.size("v") == dims), dims


def longs(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The x-vectors of a batch of ``(id, v)``."""
    c = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.clip(np.floor(c * SCALE), -MOST, MOST).astype(np.int64) + SHIFT


def sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension: a row for each dimension and task, added up in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for b in slices(batches, 1000):
            x = longs(b, dims)
            n, total = n + len(x), total + x.sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict({"k": range(dims), "s": [str(t) for t in total], "n": [n] * dims})

    added = rows.mapInArrow(run, "k bigint, s string, n bigint").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"), F.sum("n").alias("n"))
    got = sorted((r["k"], int(r["s"]), r["n"]) for r in added.collect())  # one row a dimension
    return (got[0][2] if got else 0), [s for _, s, _ in got]


def products(rows: DataFrame, dims: int, vectors, ddl: str = "k bigint, p array<double>") -> np.ndarray:
    """Sum over all rows of the outer product of ``vectors(batch)`` with itself; a row for each dimension and task, added up in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in slices(batches, 1000):
            y = vectors(b)
            total = y.T @ y + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims)), pa.array(list(total), pa.list_(pa.float64()))], names=["k", "p"])

    each = rows.mapInArrow(run, ddl).select("k", F.posexplode("p").alias("j", "p")).groupBy("k", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((dims, dims))
    for r in each.toLocalIterator():  # the square of the dimension
        out[r["k"], r["j"]] = r["p"]
    return out


def covariance(rows: DataFrame, dims: int, n: int, total: list[int]) -> np.ndarray:
    """Covariance with divisor n of the x-vectors, centred before multiplying."""
    near = np.array([round(Fraction(s, n)) for s in total], np.int64)

    def centred(b: pa.RecordBatch) -> np.ndarray:
        return (longs(b, dims) - near).astype(float)

    rest = np.array([float(Fraction(s - n * int(m), n)) for s, m in zip(total, near, strict=True)])
    v = products(rows, dims, centred) / n - np.outer(rest, rest)
    return (v + v.T) / 2


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> tuple[DataFrame, np.ndarray, float, int]:
    """``(id, deviation, w)`` of each usable vector, with the eigenvalues, the covariance's trace and the number of vectors."""
    good, dims = usable(rows, id_col, vector_col)
    kind = good.schema["id"].dataType.simpleString()
    n, total = sums(good, dims) if dims else (0, [])
    v = covariance(good, dims, n, total) if n else np.zeros((0, 0))
    e, u = components(v, most)
    near = np.array([s // n for s in total], np.int64)
    over = np.array([s % n for s in total], object)  # n * x - S = n * (x - near) - over
    rest = np.array([float(Fraction(s % n, n)) for s in total])
    to, ddl = u / np.sqrt(e), f"id {kind}, deviation bigint, w array<double>"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1000):
            y = longs(b, dims) - near
            if dims * (n * (int(np.abs(y).max()) + 1)) ** 2 < 2**62:
                far = ((n * y - over.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                far = [f if f < 2**63 else None for f in ((n * y.astype(object) - over) ** 2).sum(axis=1)]
            w = (y - rest) @ to
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(far, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], schema=schema)

    out = good.mapInArrow(run, ddl) if len(e) else good.sparkSession.createDataFrame([], ddl)
    return written(out, "whitened"), e, float(np.trace(v)), n


def identity_error(white: DataFrame, k: int, n: int) -> float:
    """The largest entry, without sign, of the whitened vectors' covariance less the identity."""
    def vectors(b: pa.RecordBatch) -> np.ndarray:
        return b.column(0).flatten().to_numpy().reshape(-1, k)

    means = np.array([r["m"] for r in white.select(F.posexplode("w").alias("j", "c")).groupBy("j").agg(F.avg("c").alias("m")).orderBy("j").collect()])

    def centred(b: pa.RecordBatch) -> np.ndarray:
        return vectors(b) - means

    return float(np.abs(products(white.select("w"), k, centred) / n - np.eye(k)).max())


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white, e, trace, n = whitened(table(spark, sf_dir, "embeddings"))
    error = identity_error(white, len(e), n) if len(e) else 0.0
    shares = F.array(*(F.lit(float(x / trace)) for x in e)) if len(e) else F.array().cast("array<double>")
    rows = white.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("w").alias("k", "whitened"))
    return rows.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )
