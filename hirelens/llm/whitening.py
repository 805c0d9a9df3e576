"""Embedding whitening: exact integer vectors, covariance by Spark SQL aggregates over the upper triangle, LAPACK, one projection.

Entries c become x = floor(64 * c) + 1000000. One aggregation gives the number of vectors and each dimension's exact sum; a second one
has a generated SQL expression for every pair of dimensions i <= j that sums the products of centred columns; the covariance put
together from it (a matrix of the dimensions, whatever the number of rows) is decomposed on the driver by LAPACK. Rows are then
projected where they lie. The whitened vectors' own covariance is measured by the same two aggregations. No row is shuffled: only
partial sums are.

Defined results: a vector that is null, or holds null or non-finite entries, takes no part and gives no row, and so does one of another
length than the longest of the rest, and an empty one; an empty table (or one without usable vectors) gives no rows. Repeated rows count
as often as they are there, and a null vec_id stays. Where vectors have fewer directions than components asked for, only those of an
eigenvalue above rounding (1e-12 of the greatest) are given, as nothing varies along the others. An entry whose 64-fold is beyond a
long, or a deviation beyond one, is an error. Other columns, whatever their names, are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import materialise

#: Entries are scaled by this, and moved by the offset.
SCALE, OFFSET = 64, 1_000_000
#: An eigenvalue counts as none up to this share of the greatest.
LEAST_SHARE = 1e-12
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, x (array of long) of every usable vector."""
    entries = F.col("embedding").cast("array<double>")
    good = F.col("embedding").isNotNull() & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    # A null condition (a null entry) drops the row as well.
    fits = lambda c: F.when(F.abs(c) < float(1 << 62) / SCALE, c * SCALE).otherwise(F.raise_error(F.lit("an entry is beyond a long")).cast("double"))
    x = F.transform(entries, lambda c: F.floor(fits(c)) + OFFSET)
    return embeddings.where(good & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _sums(vectors: DataFrame, column: str, dims: int) -> Row:
    return vectors.agg(F.count("*").alias("n"), *[F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(dims)]).first()


def covariance(vectors: DataFrame, column: str, dims: int) -> tuple[int, list, np.ndarray]:
    """(rows, sums, covariance with divisor n) of an array column of so many entries, centred before multiplying."""
    sums = _sums(vectors, column, dims)
    n, totals = sums["n"], [sums[f"s{i}"] for i in range(dims)]
    centred = vectors.select(*[(F.col(column)[i].cast("double") - F.lit(float(totals[i]) / n)).alias(f"c{i}") for i in range(dims)])
    pairs = [(i, j) for i in range(dims) for j in range(i, dims)]
    found = centred.selectExpr(*[f"sum(c{i} * c{j}) AS p{i}_{j}" for i, j in pairs]).first()
    out = np.zeros((dims, dims))
    for (i, j), value in zip(pairs, found, strict=True):
        out[i, j] = out[j, i] = value / n
    return n, totals, out


def principal(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of at most so many components that vary."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    order = order[(values[order] > LEAST_SHARE * max(values.max(), 0)) & (values[order] > 0)][:most]
    return values[order], vectors[:, order]


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exact sums over dimensions of (n * x - sum)^2; an error where one is beyond a long."""
    away = np.abs(x - sums / n).max(initial=0) * n
    if n * (np.abs(x).max(initial=0) + 1.0) < 2**62 and away * away * x.shape[1] < 2**62:
        moved = n * x - sums
        return (moved * moved).sum(axis=1)
    out = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    if max(out, default=0) >= 1 << 63:
        raise OverflowError("a deviation is beyond a long")
    return np.array(out, np.int64)


def projected(vectors: DataFrame, n: int, sums: list[int], values: np.ndarray, axes: np.ndarray) -> DataFrame:
    """vec_id, deviation, w (array of whitened coordinates): one matrix product a batch."""
    total, mean, scaled = np.array(sums, np.int64), np.array([s / n for s in sums]), axes / np.sqrt(values)
    width = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten(), np.int64).reshape(batch.num_rows, len(total))
            w = (x - mean) @ scaled
            ends = np.arange(0, (batch.num_rows + 1) * width, width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_deviations(x, n, total)), pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))], names=["vec_id", "deviation", "w"])

    return vectors.mapInArrow(run, "vec_id long, deviation long, w array<double>")


def whiten(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained and identity_error for every usable vector.

    The vectors are written once as integers, and the whitened ones once, so every aggregation reads the same rows.
    """
    spark = embeddings.sparkSession
    found = materialise(integer_vectors(embeddings))
    dims = found.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], SCHEMA)
    vectors = found.where(F.size("x") == dims)
    n, sums, cov = covariance(vectors, "x", dims)
    values, axes = principal(cov, components)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)
    whitened = materialise(projected(vectors, n, sums, values, axes))
    error = float(np.abs(covariance(whitened, "w", len(values))[2] - np.eye(len(values))).max())
    share = F.array(*[F.lit(float(v / np.trace(cov))) for v in values])
    rows = whitened.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
