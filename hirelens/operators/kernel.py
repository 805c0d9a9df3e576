"""Support vector machines with a kernel of radial basis functions, and probabilities, on Spark.

Rows are mapped by the Nystroem method: with landmarks l (LANDMARKS rows, drawn by a seeded hash of their keys) a row x becomes
K(x, l) U / sqrt(e), of the eigenvectors U and eigenvalues e of K(l, l). Products of mapped rows are the kernel exactly wherever one of
the two is a landmark, so on tables of at most LANDMARKS rows the machine is that of the kernel itself; elsewhere they are the kernel's
projection on the landmarks, never above it on the diagonal. The machine is then linear, and is fitted with any others as a column of one
optimisation (operators.logistic). What is sent to workers is the landmarks, a bounded number of rows.

Probabilities follow Platt: margins of rows held out of five folds, and one sigmoid fitted to them, with targets drawn in by a pseudo-count
a label, so that a machine that parts its rows does not say 0 and 1.

Defined results: fewer rows than landmarks give them all; rows that are equal count once (their eigenvalues are 0 and left out); a table
without rows, or with rows of one label, gives constant margins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import SparseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .logistic import _column, _matrix, fit_many, part_sizes, probabilities
from .sampling import stratified_folds

#: Rows that a map is made of.
LANDMARKS = 256
#: Folds whose held-out margins the sigmoid is fitted to.
FOLDS = 5
#: Eigenvalues up to this share of the greatest are none.
LEAST_SHARE = 1e-10


def width_of(rows: DataFrame) -> int:
    """The size of the feature vectors."""
    first = rows.where(F.col("features").isNotNull()).select("features").first()
    return len(first[0]) if first else 0


class KernelMap:
    """x -> K(x, landmarks) projection; without a gamma, x itself."""

    def __init__(self, landmarks: np.ndarray, gamma: float | None):
        self.landmarks, self.gamma = landmarks, gamma
        if gamma is not None:
            values, vectors = np.linalg.eigh(self.kernel(landmarks @ landmarks.T, (landmarks * landmarks).sum(axis=1)))
            some = values > LEAST_SHARE * max(values.max(initial=0), 1e-300)
            self.projection = vectors[:, some] / np.sqrt(values[some])

    def kernel(self, products: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """K of rows and landmarks, from their products and the rows' squared lengths."""
        own = (self.landmarks * self.landmarks).sum(axis=1)
        return np.exp(-self.gamma * np.maximum(squares[:, None] + own - 2 * products, 0))

    @property
    def width(self) -> int:
        return self.landmarks.shape[1] if self.gamma is None else self.projection.shape[1]

    def rows(self, features: pa.StructArray) -> np.ndarray:
        out = np.zeros((len(features), self.width))
        for some, a, at in _matrix(features, self.landmarks.shape[1]):
            out[some] = self.kernel(a @ self.landmarks[:, at].T, (a * a).sum(axis=1)) @ self.projection
        return out

    def mapped(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The columns keep of rows, and features mapped, as a dense vector's struct."""
        if self.gamma is None:
            return rows.select(*keep, "features")
        sent, kinds = rows.sparkSession.sparkContext.broadcast(self), dict(rows.dtypes)
        kind = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, x = batch.num_rows, sent.value.rows(_column(batch, "features"))
                values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                vector = pa.StructArray.from_arrays([pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), values], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*(_column(batch, c) for c in keep), vector], names=[*keep, "features"])

        return rows.select(*keep, "features").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"features {kind}"]))


def landmarks_of(rows: DataFrame, seed: int = 0) -> np.ndarray:
    """The feature vectors (dense, a bounded number) of the rows that come first by the seeded hash of _row."""
    found = rows.where(F.col("features").isNotNull()).orderBy(F.xxhash64(F.lit(seed), "_row"), "_row").limit(LANDMARKS).select("features").collect()
    return np.unique([r[0].toArray() for r in found], axis=0) if found else np.zeros((0, 0))


class _HasSettings(Params):
    C = Param(Params._dummy(), "C", "inverse strength of the penalty", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel; not set: a linear machine", TypeConverters.toFloat)
    weightCol = Param(Params._dummy(), "weightCol", "set: the labels weigh the same", TypeConverters.toString)
    regParam = Param(Params._dummy(), "regParam", "1 / (C n)", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "passes", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least relative gain of a step", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the landmarks", TypeConverters.toInt)

    def _gamma(self) -> float | None:
        return self.getOrDefault("gamma") if self.isSet("gamma") else None


class KernelSVC(Estimator, _HasSettings, DefaultParamsWritable, DefaultParamsReadable):
    """fit takes rows with label, features and _row."""

    def __init__(self, C: float = 1.0, n: int = 1, gamma: float | None = None, balanced: bool = False, seed: int = 0):
        super().__init__()
        given = {"C": C, "regParam": 1 / (C * max(n, 1)), "maxIter": 1000, "tol": 1e-8, "seed": seed}
        self._set(**given | ({"gamma": gamma} if gamma is not None else {}) | ({"weightCol": "_weight"} if balanced else {}))

    def getRegParam(self) -> float:
        return self.getOrDefault("regParam")

    def getMaxIter(self) -> int:
        return self.getOrDefault("maxIter")

    def getTol(self) -> float:
        return self.getOrDefault("tol")

    def _fit(self, rows: DataFrame) -> KernelSVCModel:
        rows = rows.select("_row", "label", "features")
        found = landmarks_of(rows, self.getOrDefault("seed")) if self._gamma() is not None else np.zeros((0, width_of(rows)))
        kernel = KernelMap(found, self._gamma())
        folds = stratified_folds(rows, "label", "_row", FOLDS)
        parts = F.array(*[(F.col("fold") != k).cast("double") for k in range(FOLDS)], F.lit(1.0))
        vectors = kernel.mapped(folds.withColumn("parts", parts), ["label", "fold", "parts"]).persist()
        sizes = part_sizes(vectors, FOLDS + 1)
        fits = fit_many(vectors, [(p, self) for p in range(FOLDS + 1)], sizes, kernel.width, hinge=True)
        slope, offset = self._sigmoid(vectors, fits, sizes)
        vectors.unpersist()
        model = KernelSVCModel()
        sparse = [SparseVector(len(v), np.flatnonzero(v).tolist(), v[v != 0].tolist()) for v in found]
        model._set(indices=[v.indices.tolist() for v in sparse], values=[v.values.tolist() for v in sparse], width=found.shape[1], weights=fits.weights[:, -1].tolist(), intercept=float(fits.intercepts[-1]), slope=slope, offset=offset)
        return self._copyValues(model)

    @staticmethod
    def _sigmoid(vectors: DataFrame, fits, sizes: np.ndarray) -> tuple[float, float]:
        """Platt's sigmoid of the margins of held-out rows. A row counts for both labels, by its target; the fit is logistic."""
        said = F.get("members", F.col("fold"))
        margin = F.log(said / (1 - said))
        # A probability beyond doubles has a margin of about 37.
        margins = probabilities(vectors, fits, ["label", "fold"]).select("label", F.greatest(F.least(F.coalesce(margin, F.lit(0.0)), F.lit(37.0)), F.lit(-37.0)).alias("margin"))
        high, low = float((sizes[1, -1] + 1) / (sizes[1, -1] + 2)), float(1 / (sizes[0, -1] + 2))
        target = F.when(F.col("label") == 1, high).otherwise(low)
        both = margins.select("margin", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), target.alias("share")), F.struct(F.lit(0.0).alias("label"), (1 - target).alias("share")))).alias("x"))
        empty = F.lit(None).cast("array<int>")
        rows = both.select("x.label", F.array("x.share").alias("parts"), F.struct(F.lit(1).cast("tinyint").alias("type"), F.lit(None).cast("int").alias("size"), empty.alias("indices"), F.array("margin").alias("values")).alias("features")).persist()
        plain = KernelSVC()._set(regParam=0.0)
        found = fit_many(rows, [(0, plain)], part_sizes(rows, 1), 1)
        rows.unpersist()
        return float(found.weights[0, 0]), float(found.intercepts[0])


class KernelSVCModel(Model, _HasSettings, DefaultParamsWritable, DefaultParamsReadable):
    """transform adds margin, probability (of label 1) and prediction (by the margin)."""

    indices = Param(Params._dummy(), "indices", "of the landmarks", TypeConverters.identity)
    values = Param(Params._dummy(), "values", "of the landmarks", TypeConverters.identity)
    width = Param(Params._dummy(), "width", "size of the feature vectors", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "of mapped features", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "of the margin", TypeConverters.toFloat)
    slope = Param(Params._dummy(), "slope", "of the sigmoid", TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "of the sigmoid", TypeConverters.toFloat)

    def _map(self) -> KernelMap:
        landmarks = np.zeros((len(self.getOrDefault("indices")), self.getOrDefault("width")))
        for row, at, v in zip(landmarks, self.getOrDefault("indices"), self.getOrDefault("values"), strict=True):
            row[at] = v
        return KernelMap(landmarks, self._gamma())

    def _transform(self, rows: DataFrame) -> DataFrame:
        kernel, weights = self._map(), np.array(self.getOrDefault("weights"))
        intercept, slope, offset = (self.getOrDefault(p) for p in ("intercept", "slope", "offset"))
        sent = rows.sparkSession.sparkContext.broadcast(kernel)
        names = ["margin", "probability", "prediction"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kernel = sent.value
            for batch in batches:
                features, z = _column(batch, "features"), np.zeros(batch.num_rows)
                if kernel.gamma is None:
                    for some, a, at in _matrix(features, len(weights)):
                        z[some] = a @ weights[at]
                else:
                    z = kernel.rows(features) @ weights
                z = z + intercept
                p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -500, 500)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(z), pa.array(p), pa.array((z > 0).astype(float))], names=[*batch.schema.names, *names])

        return rows.mapInArrow(run, StructType(rows.schema.fields + [StructField(n, DoubleType()) for n in names]))

