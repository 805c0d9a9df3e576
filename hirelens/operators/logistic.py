"""Many linear classifiers (logistic regressions, support vector machines) over the same rows at once.

A grid in folds, or an ensemble, is one optimisation: the weights are a matrix with a column a fit, and each iteration computes the losses
and gradients of all columns in one pass over the rows. A row has a multiplicity in each part (a fold's training rows, a member's split; 0:
held out), and a column reads one part. Each column goes its own way (L-BFGS with its own history, steps and end), and columns that have
converged leave the passes.

The rows stay where they are, and what moves is a matrix: the weights go out once a pass, and the gradients come back in slices: to the
driver if all tasks' together are small, or else to tasks that sum a slice each as it streams by, before the driver puts them together. Columns are taken in blocks of at most
MOST_ENTRIES weights, so that the driver holds a bounded matrix (and HISTORY pairs of it) whatever the number of fits.

Features may be scaled by column: then a row's features a in a block of the columns become a * scale / |a * scale|, as TF-IDF weights do
whose document frequencies differ from fit to fit.

Defined results: a part without rows, or with rows of one label only, gives the weights that the optimiser reaches (all probabilities go to
that label); rows with a null label, features or parts take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import release, written

#: Weights of one block of columns.
MOST_ENTRIES = 1 << 21
#: Steps that a column remembers.
HISTORY = 8
#: Bytes of one slice of the gradients.
SLICE_BYTES = 1 << 20
#: A column ends where no entry of its gradient is beyond this, or where two steps in a row gain no more than the estimator's tolerance.
GRADIENT = 1e-6
#: Bytes of gradients that the tasks of a pass send to the driver themselves; beyond, slices are summed by tasks first.
DRIVER_BYTES = 32 << 20
#: Products of a feature and a weight in one task of a pass; a small table is read by few tasks.
TASK_WORK = 1 << 25
#: The hinge loss is a parabola over so much of the margin before 1, as the optimiser wants a gradient everywhere.
BEND = 0.05
#: Entries of a matrix that a worker makes of some rows.
_CHUNK = 1 << 20


@dataclass
class Fits:
    """A column a fit: weights (features by fits), intercepts, passes in which the fit took part, and whether it converged."""

    weights: np.ndarray
    intercepts: np.ndarray
    passes: np.ndarray
    converged: np.ndarray
    scale: np.ndarray | None = None
    cuts: list[int] = field(default_factory=list)


def part_sizes(rows: DataFrame, parts: int) -> np.ndarray:
    """label (0, 1) by part: the sums of multiplicities."""
    out = np.zeros((2, parts))
    found = rows.where(F.col("label").isin(0.0, 1.0)).groupBy("label").agg(*[F.sum(F.get("parts", F.lit(i))).alias(f"p{i}") for i in range(parts)])
    for row in found.collect():
        out[int(row["label"])] = row[1:]
    return out


def _matrix(features: pa.StructArray, width: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray | slice]]:
    """(rows, their features in a dense matrix, the positions of its columns) of some rows at a time; only positions that occur."""
    values, indices = pc.struct_field(features, "values"), pc.struct_field(features, "indices")
    n = len(features)
    flat, count = np.asarray(values.flatten(), float), np.asarray(pc.fill_null(pc.list_value_length(values), 0), np.int64)
    ends = np.r_[0, np.cumsum(count)]
    if indices.null_count == n:
        step = max(1, _CHUNK // max(width, 1))
        for a in range(0, n, step):
            b = min(n, a + step)
            yield slice(a, b), flat[ends[a] : ends[b]].reshape(b - a, width), slice(0, width)
        return
    dense = np.asarray(indices.is_null())
    at = np.asarray(indices.flatten(), np.int64)
    if dense.any():
        parts, k = [], 0
        for row in range(n):
            parts.append(np.arange(width) if dense[row] else at[k : k + count[row]])
            k += 0 if dense[row] else count[row]
        at = np.concatenate(parts)
    step = 64
    for a in range(0, n, step):
        b = min(n, a + step)
        some, where = np.unique(at[ends[a] : ends[b]], return_inverse=True)
        out = np.zeros((b - a, len(some)))
        out[np.repeat(np.arange(b - a), count[a:b]), where] = flat[ends[a] : ends[b]]
        yield slice(a, b), out, some


class Linear:
    """Margins of rows by columns of weights, and the gradient of a function of the margins."""

    def __init__(self, weights: np.ndarray, intercepts: np.ndarray, scale: np.ndarray | None = None, cuts: list[int] | None = None):
        self.weights, self.intercepts, self.scale, self.cuts = weights, intercepts, scale, cuts or []

    def _blocks(self, at: np.ndarray | slice) -> list[tuple[slice, np.ndarray | slice]]:
        """(columns of the matrix, their positions) of each block."""
        if isinstance(at, slice):
            ends = [0, *self.cuts, at.stop]
            return [(slice(a, b), slice(a, b)) for a, b in zip(ends, ends[1:])]
        ends = [0, *np.searchsorted(at, self.cuts).tolist(), len(at)]
        return [(slice(a, b), at[a:b]) for a, b in zip(ends, ends[1:])]

    def margins(self, a: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        if self.scale is None:
            self.kept = None
            return a @ self.weights[at] + self.intercepts
        z, self.kept = np.tile(self.intercepts, (len(a), 1)), []
        for columns, places in self._blocks(at):
            x, scale = a[:, columns], self.scale[places]
            length = np.sqrt((x * x) @ (scale * scale))
            length[length == 0] = 1
            self.kept.append(length)
            z += x @ (scale * self.weights[places]) / length
        return z

    def add_gradient(self, out: np.ndarray, a: np.ndarray, at: np.ndarray | slice, residual: np.ndarray) -> None:
        """Of the rows of the last margins."""
        if self.kept is None:
            out[at] += a.T @ residual
            return
        for (columns, places), length in zip(self._blocks(at), self.kept, strict=True):
            out[places] += self.scale[places] * (a[:, columns].T @ (residual / length))


def _losses(z: np.ndarray, y: np.ndarray, hinge: bool) -> tuple[np.ndarray, np.ndarray]:
    """(loss, its derivative by the margin) of margins of rows whose labels are a column."""
    if hinge:
        sign = np.where(y > 0, 1.0, -1.0)
        short = np.maximum(1 - sign * z, 0)
        return np.where(short < BEND, short * short / (2 * BEND), short - BEND / 2), -sign * np.minimum(short / BEND, 1)
    small = np.exp(-np.abs(z))
    return np.log1p(small) + np.maximum(np.where(y > 0, -z, z), 0), np.where(z >= 0, 1, small) / (1 + small) - y


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _lists(column: pa.ListArray, rows: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(rows, -1) if rows else np.zeros((0, 0))


def _evaluate(rows: DataFrame, spread: int, weights: np.ndarray, intercepts: np.ndarray, fixed, columns: np.ndarray, part: np.ndarray, by_label: np.ndarray, hinge: bool) -> tuple[np.ndarray, np.ndarray]:
    """(loss of each column, gradients with the intercept's in the last row) in one pass, without the penalty."""
    sc = rows.sparkSession.sparkContext
    width, fits = weights.shape
    sent = sc.broadcast((weights, intercepts))
    held = max(1, SLICE_BYTES // (8 * fits))
    slices = -(-(width + 2) // held)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        scale, cuts = fixed.value
        model = Linear(w, b, None if scale is None else scale[:, columns], cuts)
        out = np.zeros((width + 2, fits))
        for batch in batches:
            label = np.asarray(_column(batch, "label"))
            share = _lists(_column(batch, "parts"), batch.num_rows)
            for some, a, at in _matrix(_column(batch, "features"), width):
                y = label[some]
                omega = share[some][:, part] * np.where(y[:, None] > 0, by_label[1], by_label[0])
                z = model.margins(a, at)
                loss, slope = _losses(z, y[:, None], hinge)
                out[width + 1] += (omega * loss).sum(axis=0)
                residual = omega * slope
                out[width] += residual.sum(axis=0)
                model.add_gradient(out[:width], a, at, residual)
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([out[k * held : (k + 1) * held].tobytes() for k in range(slices)], pa.binary())], names=["slice", "part"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(raw.as_buffer())
                found[k] = found[k] + values if k in found else values
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["slice", "part"])

    partials = rows.mapInArrow(partial, "slice int, part binary")
    if spread * (width + 2) * fits * 8 > DRIVER_BYTES:
        partials = partials.repartition(min(slices, spread), "slice").mapInArrow(summed, "slice int, part binary")
    out = np.zeros((width + 2, fits))
    for r in partials.collect():
        at = r["slice"] * held
        out[at : at + held] += np.frombuffer(r["part"]).reshape(-1, fits)
    sent.destroy()
    return out[width + 1], out[: width + 1]


def _direction(gradient: np.ndarray, pairs: list, which: np.ndarray) -> np.ndarray:
    """Minus the L-BFGS estimate of the Newton step of the columns which, each by its own pairs."""
    q, taken = gradient.copy(), []
    gamma = np.ones(q.shape[1])
    seen = np.zeros(q.shape[1], bool)
    for s, y, rho in reversed(pairs):
        s, y, rho = s[:, which], y[:, which], rho[which]
        alpha = rho * (s * q).sum(axis=0)
        q -= alpha * y
        taken.append((s, y, rho, alpha))
        fresh = ~seen & (rho > 0)
        gamma[fresh] = 1 / (rho * (y * y).sum(axis=0))[fresh]
        seen |= fresh
    q *= gamma
    for s, y, rho, alpha in reversed(taken):
        q += (alpha - rho * (y * q).sum(axis=0)) * s
    return -q


def _minimise(evaluate, width: int, regular: np.ndarray, tolerance: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the intercept last, passes, converged) of columns that evaluate(x, columns) gives losses and gradients of."""
    fits = len(regular)
    x, penalty = np.zeros((width + 1, fits)), np.ones((width + 1, 1))
    penalty[-1] = 0

    def value(at: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loss, gradient = evaluate(at, columns)
        penalised = at * penalty
        return loss + regular[columns] / 2 * (penalised * at).sum(axis=0), gradient + regular[columns] * penalised

    active, passes, converged = np.arange(fits), np.zeros(fits, int), np.zeros(fits, bool)
    f, g = value(x, active)
    passes += 1
    active = np.flatnonzero(np.abs(g).max(axis=0) > GRADIENT)
    converged[:] = True
    converged[active] = False
    direction, pairs, small = -g, [], np.zeros(fits, int)
    step = 1 / np.maximum(np.sqrt((g * g).sum(axis=0)), 1)
    slope = (g * direction).sum(axis=0)
    while len(active):
        trial = x[:, active] + step[active] * direction[:, active]
        new, gradient = value(trial, active)
        passes[active] += 1
        good = new <= f[active] + 1e-4 * step[active] * slope[active] + 1e-15
        took, back = active[good], active[~good]
        # The lowest point of the parabola through both values and the slope, within bounds.
        rise = new[~good] - f[back] - step[back] * slope[back]
        with np.errstate(divide="ignore", invalid="ignore"):
            inside = -slope[back] * step[back] / (2 * rise)
        step[back] *= np.where(np.isfinite(inside), np.clip(inside, 0.1, 0.5), 0.1)
        s, y, rho = np.zeros_like(x), np.zeros_like(x), np.zeros(fits)
        s[:, took], y[:, took] = trial[:, good] - x[:, took], gradient[:, good] - g[:, took]
        curve = (s[:, took] * y[:, took]).sum(axis=0)
        rho[took] = np.where(curve > 1e-14 * (y[:, took] ** 2).sum(axis=0), 1 / np.maximum(curve, 1e-300), 0)
        if len(took):
            pairs = [*pairs[1 - HISTORY :], (s, y, rho)]
        gain = f[took] - new[good]
        small[took] = np.where(gain <= tolerance[took] * np.maximum(np.abs(new[good]), 1e-12), small[took] + 1, 0)
        x[:, took], f[took], g[:, took] = trial[:, good], new[good], gradient[:, good]
        converged[took] = (np.abs(g[:, took]).max(axis=0) <= GRADIENT) | (small[took] >= 2)
        direction[:, took] = _direction(g[:, took], pairs, took)
        slope[took] = (g[:, took] * direction[:, took]).sum(axis=0)
        lost = took[slope[took] >= 0]
        direction[:, lost], slope[lost] = -g[:, lost], -(g[:, lost] ** 2).sum(axis=0)
        step[took] = 1
        # A step that has shrunk to nothing: rounding is all that is left.
        converged[active] |= step[active] < 1e-12
        active = active[~converged[active] & (passes[active] < most[active])]
    return x, passes, converged


def _entries(rows: DataFrame) -> int:
    """Features that rows hold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(pc.struct_field(batch.column(0), "values").flatten())], pa.int64())], names=["n"])

    return rows.select("features").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def fit_many(rows: DataFrame, fits: list[tuple[int, Estimator]], sizes: np.ndarray, width: int, scale: np.ndarray | None = None, cuts: list[int] | None = None, hinge: bool = False) -> Fits:
    """The fits (part, estimator) over rows (label, features, parts). sizes is part_sizes(rows). Of an estimator its penalty (regParam, L2),
    its tolerance, its limit of iterations, and whether it has weights, which are those that balance the labels of its part. The loss is
    logistic, or with hinge that of a support vector machine."""
    # Written first: every pass is a query of its own, whose plan would hold all that the rows come from.
    table = written(rows.where(F.col("label").isin(0.0, 1.0) & F.col("features").isNotNull() & F.col("parts").isNotNull()).select("label", "features", "parts"))
    cached = table.persist()
    spread = max(1, min(cached.rdd.getNumPartitions(), _entries(cached) * len(fits) // TASK_WORK + 1))
    rows = cached.coalesce(spread)
    sc = rows.sparkSession.sparkContext
    part = np.array([p for p, _ in fits])
    count = np.maximum(sizes[:, part], 0)
    total = np.maximum(count.sum(axis=0), 1)
    weighted = np.array([e.isSet(e.weightCol) for _, e in fits])
    # Weights n / (2 n_class) sum to n; the loss is the mean over the part.
    by_label = np.where(weighted, 1 / (2 * np.maximum(count, 1)), 1 / total)
    regular = np.array([e.getRegParam() for _, e in fits])
    tolerance, most = np.array([e.getTol() for _, e in fits]), np.array([e.getMaxIter() for _, e in fits])
    out = Fits(np.zeros((width, len(fits))), np.zeros(len(fits)), np.zeros(len(fits), int), np.zeros(len(fits), bool), scale, cuts or [])
    block = max(1, MOST_ENTRIES // (width + 1))
    try:
        for a in range(0, len(fits), block):
            here = np.arange(a, min(a + block, len(fits)))
            fixed = sc.broadcast((None if scale is None else scale[:, here], cuts or []))

            def evaluate(x: np.ndarray, columns: np.ndarray, here=here, fixed=fixed) -> tuple[np.ndarray, np.ndarray]:
                chosen = here[columns]
                return _evaluate(rows, spread, x[:-1], x[-1], fixed, columns, part[chosen], by_label[:, chosen], hinge)

            x, out.passes[here], out.converged[here] = _minimise(evaluate, width, regular[here], tolerance[here], most[here])
            out.weights[:, here], out.intercepts[here] = x[:-1], x[-1]
            fixed.destroy()
    finally:
        cached.unpersist()
        release(table)
    return out


def probabilities(rows: DataFrame, fits: Fits, keep: list[str]) -> DataFrame:
    """The columns keep of rows, and members: P(label 1) by every fit, one product a batch of rows."""
    sent = rows.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = sent.value
        model, width = Linear(fits.weights, fits.intercepts, fits.scale, fits.cuts), len(fits.weights)
        for batch in batches:
            out = np.zeros((batch.num_rows, len(fits.intercepts)))
            for some, a, at in _matrix(_column(batch, "features"), width):
                z = model.margins(a, at)
                small = np.exp(-np.abs(z))
                out[some] = np.where(z >= 0, 1, small) / (1 + small)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * out.shape[1])
            yield pa.RecordBatch.from_arrays([*(_column(batch, c) for c in keep), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))], names=[*keep, "members"])

    kinds = dict(rows.dtypes)
    return rows.select(*keep, "features").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "members array<double>"]))


def confusions(rows: DataFrame, fits: Fits, part: list[int]) -> DataFrame:
    """fit, tp, fp, fn, tn: each fit over the rows that are held (a list of booleans a row) for its part, counted where the rows lie."""
    sent, parts = rows.sparkSession.sparkContext.broadcast(fits), np.array(part)
    names = ["tp", "fp", "fn", "tn"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = sent.value
        model, width = Linear(fits.weights, fits.intercepts, fits.scale, fits.cuts), len(fits.weights)
        out = np.zeros((4, len(parts)), np.int64)
        for batch in batches:
            label, held = np.asarray(_column(batch, "label")), _lists(_column(batch, "held"), batch.num_rows).astype(bool)
            for some, a, at in _matrix(_column(batch, "features"), width):
                y, yes, here = label[some][:, None] > 0, model.margins(a, at) > 0, held[some][:, parts]
                for k, cell in enumerate((y & yes, ~y & yes, y & ~yes, ~y & ~yes)):
                    out[k] += (cell & here).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), *(pa.array(x) for x in out)], names=["fit", *names])

    counted = rows.select("label", "features", "held").mapInArrow(run, "fit int, tp long, fp long, fn long, tn long")
    return counted.groupBy("fit").agg(*[F.sum(c).alias(c) for c in names])
