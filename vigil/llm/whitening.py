"""Whitening of vectors by shifted Cholesky QR.

Entries become whole numbers (``floor(SCALE * c) + OFFSET``), so sums, and the distance of ``n`` times a row from the
sums, are exact; rows are centred in whole numbers before anything is multiplied. Passes over the rows give the Gram
matrix of the centred rows after the triangular solves of the passes before:

1. and 2.: Cholesky factor of the Gram matrix plus a shift above its rounding error, which exists however dependent
   the columns are; each lifts directions that are small beside the largest.
3.: without a shift. A column that depends on those before it (its pivot is below ``LEAST_PIVOT``) has a zero row in
   the factor, and is not divided by it.

The product of the factors is the R of the centred rows; the singular value decomposition of R gives the components.
A last pass measures the covariance of the whitened rows.

Partial matrices are added by entry in a shuffle; a matrix of dimension x dimension numbers is all that the driver and
the tasks get, so its size doesn't hang on the number of rows (``MOST_DIMENSIONS`` bounds it).

Vectors that are null, hold null or non-finite entries or entries too large for a whole number, and vectors whose length
isn't the commonest one (of equally common ones the largest) take no part. Directions without variance are no components;
if there are none, or no rows, the result is empty. Repeated rows and ids count and return each time, null ids too; other columns are not read.
``deviation`` is null where it doesn't fit a long (some 10^7 rows at the given scale).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import ship, table

SCALE, OFFSET = 64, 1_000_000       # fixed by the contract
COMPONENTS = 32                     # fixed by the contract
LARGEST = 2.0 ** 52                 # entries whose whole number is not below this count like non-finite ones
MOST_DIMENSIONS = 4096              # a matrix of 128 MB
LEAST_PIVOT = 1e-3
LEAST_SHARE = 1e-13                 # eigenvalues below this share of the largest are no variance
ROWS = 4096                         # rows multiplied at once


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(id, v)`` of the rows that take part, and their dimension (0: none)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    found = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(F.abs(c) * SCALE < LARGEST, F.lit(False))))   # NaN is larger than all
    sizes = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0].d if sizes else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"{d} dimensions; {MOST_DIMENSIONS} at most")
    return found.where(F.size("v") == d), d


def _numbers(column: pa.Array, d: int) -> np.ndarray:
    """Whole numbers of a batch: one row for each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * flat).astype(np.int64) + OFFSET


def _added(parts: DataFrame) -> np.ndarray:
    """Sum, by entry, of the arrays in column ``part``."""
    sums = parts.select(F.posexplode("part").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()     # entries of one matrix
    out = np.zeros(len(sums))
    for r in sums:
        out[r.k] = r.x
    return out


def column_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            x = _numbers(batch.column("v"), d)
            n += len(x)
            for start in range(0, len(x), 1024):        # 1,024 numbers below 2^53 fit a long
                sums = [a + b for a, b in zip(sums, x[start:start + 1024].sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in sums]])], names=["n", "sums"])

    ship(rows.sparkSession)
    parts = rows.select("v").mapInArrow(run, "n long, sums array<string>")
    total = parts.select("n", F.posexplode("sums").alias("k", "s")).groupBy("k").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("k").collect()
    return (total[0].n, [int(r.s) for r in total]) if total else (0, [])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: longs where they fit, else Python's whole numbers."""
    fits = n * (int(np.abs(x).max(initial=0)) + 1) < 2 ** 62
    return n * x - np.array(sums, np.int64) if fits else n * x.astype(object) - np.array(sums, object)


def gram(rows: DataFrame, d: int, n: int, sums: list[int], *solves: np.ndarray) -> np.ndarray:
    """Gram matrix of the centred rows times the matrices of ``solves``, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = solves[-1].shape[1] if solves else d
        out = np.zeros((width, width))
        for batch in batches:
            x = _numbers(batch.column("v"), d)
            for start in range(0, len(x), ROWS):
                a = deviations(x[start:start + ROWS], n, sums).astype(np.float64) / n
                for s in solves:
                    a = a @ s
                out += a.T @ a
        yield pa.RecordBatch.from_arrays([pa.array([out[np.triu_indices(width)]])], names=["part"])

    width = solves[-1].shape[1] if solves else d
    half = _added(rows.select("v").mapInArrow(run, "part array<double>"))
    out = np.zeros((width, width))
    if len(half):
        out[np.triu_indices(width)] = half
    return out + np.triu(out, 1).T


def shifted_factor(g: np.ndarray, n: int) -> np.ndarray:
    """Upper triangle R with R'R = G + shift, the shift just above the rounding error of G (of its trace at least)."""
    d = len(g)
    shift = 11 * (np.sqrt(n) * d + d * (d + 1)) * np.finfo(float).eps * max(np.trace(g), np.finfo(float).tiny * 2.0 ** 60)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 100


def dependent_factor(g: np.ndarray) -> np.ndarray:
    """Upper triangle R with R'R = G, with a zero row for every column that depends on those before it."""
    rest, d = g.copy(), len(g)
    out = np.zeros((d, d))
    for k in range(d):
        if rest[k, k] > LEAST_PIVOT:
            out[k, k:] = rest[k, k:] / np.sqrt(rest[k, k])
            rest -= np.outer(out[k], out[k])
    return out


def solve(r: np.ndarray) -> np.ndarray:
    """The matrix that a row is multiplied with to be solved against R; zero rows of R are not divided by."""
    whole = r + np.diag((np.diag(r) == 0).astype(float))
    out = np.zeros_like(whole)
    for k in range(len(whole) - 1, -1, -1):     # back substitution against the unit matrix
        out[k] = (np.eye(len(whole))[k] - whole[k, k + 1:] @ out[k + 1:]) / whole[k, k]
    return out


def components(rows: DataFrame, d: int, most: int) -> tuple[int, list[int], np.ndarray, np.ndarray, np.ndarray] | None:
    """Number of rows, sums, the matrix that whitens a centred row, eigenvalues and their share of the variance; None
    without a component. A component's largest entry is positive."""
    n, sums = column_sums(rows, d)
    if not n:
        return None
    factors, solves = [], []
    for shifted in (True, True, False):
        g = gram(rows, d, n, sums, *solves)
        r = shifted_factor(g, n) if shifted else dependent_factor(g)
        factors.append(r)
        solves.append(solve(r))
    r = factors[2] @ factors[1] @ factors[0]
    _, sigma, vt = np.linalg.svd(r)
    e = sigma ** 2 / n
    some = int(min(most, (e > LEAST_SHARE * e[0]).sum())) if e[0] > 0 else 0
    if not some:
        return None
    v = vt[:some].T
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(some)] < 0, -1.0, 1.0)
    return n, sums, v / np.sqrt(e[:some]), e[:some], e[:some] / e.sum()


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, n, deviation, whitened, explained, identity_error)`` of every row that takes part: ``whitened`` has one entry
    for each component (``most`` at most, by falling eigenvalue), ``explained`` their shares of the variance."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    spark = vectors.sparkSession
    rows, d = whole_vectors(vectors, id_col, vector_col)
    fitted = components(rows, d, most) if d else None
    if fitted is None:
        return spark.createDataFrame([], schema)
    n, sums, matrix, _, share = fitted
    measured = gram(rows, d, n, sums, matrix) / n
    error = float(np.abs(measured - np.eye(len(measured))).max())
    shares = share.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _numbers(batch.column("v"), d)
            for start in range(0, len(x), ROWS):
                away = deviations(x[start:start + ROWS], n, sums)
                if float(np.abs(away).max(initial=0)) ** 2 * d < 2.0 ** 62:
                    square = (away * away).sum(axis=1).tolist()
                else:
                    square = [s if (s := sum(int(c) ** 2 for c in row)) < 2 ** 63 else None for row in away.tolist()]
                white = away.astype(np.float64) / n @ matrix
                m, k = white.shape
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, m), pa.array([n] * m, pa.int64()), pa.array(square, pa.int64()),
                     pa.ListArray.from_arrays(np.arange(0, m * k + 1, k, dtype=np.int32), pa.array(white.ravel())),
                     pa.array([shares] * m, pa.list_(pa.float64())), pa.array([error] * m)],
                    names=[id_col, "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector that takes part and component."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "x")).select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "x.whitened", "x.explained", "identity_error")
