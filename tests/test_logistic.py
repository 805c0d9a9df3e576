"""Many logistic regressions at once against a plain Newton solution, one fit at a time."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hirelens import queries
from hirelens.operators import logistic, sampling
from hirelens.plans import train
from hirelens.schemas import SCORES


def newton(x, y, share, c, balance):
    """Weights and intercept of sum(share w loss) C + |w|^2 / 2, by damped Newton steps."""
    n, counts = share.sum(), [share[y == k].sum() for k in (0, 1)]
    omega = share * (n / (2 * np.array(counts))[y.astype(int)] if balance else 1)
    a = np.c_[x, np.ones(len(x))]
    penalty = np.r_[np.ones(x.shape[1]), 0]

    def value(w):
        z = a @ w
        return c * (omega * (np.logaddexp(0, -np.abs(z)) + np.maximum(np.where(y > 0, -z, z), 0))).sum() + (penalty * w * w).sum() / 2

    w = np.zeros(a.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        g = c * a.T @ (omega * (p - y)) + penalty * w
        h = c * (a.T * (omega * p * (1 - p))) @ a + np.diag(penalty) + 1e-12 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-10:
            t /= 2
        w = w - t * step
        if np.abs(g).max() < 1e-10:
            break
    return w[:-1], w[-1]


def folds_of(keys, labels, k):
    """fold by key, as contiguous blocks of each label's keys."""
    out = {}
    for label in set(labels):
        own = sorted(key for key, y in zip(keys, labels) if y == label)
        for fold, block in enumerate(np.array_split(own, k)):
            out |= dict.fromkeys(block.tolist(), fold)
    return out


def scores(y, p):
    yes = p > 0.5
    tp, fp, fn, tn = ((y == a) & (yes == b) for a, b in ((1, True), (0, True), (1, False), (0, False)))
    tp, fp, fn, tn = (int(v.sum()) for v in (tp, fp, fn, tn))
    z = lambda a, b: a / b if b else 0.0
    won = [(a > b) + (a == b) / 2 for a in p[y == 1] for b in p[y == 0]]
    return {"precision": z(tp, tp + fp), "recall": z(tp, tp + fn), "f1": z(2 * tp, 2 * tp + fp + fn), "balanced_accuracy": (z(tp, tp + fn) + z(tn, tn + fp)) / 2, "roc_auc": z(sum(won), len(won))}


def plain_nested(keys, x, y, points, scoring, k):
    """scores of the outer folds, and the parameters chosen by each search, the last over all rows."""

    def best(rows):
        inner, found = folds_of([keys[i] for i in rows], y[rows].tolist(), k), []
        for point in points:
            one = []
            for j in range(k):
                a, b = ([i for i in rows if (inner[keys[i]] == j) == out] for out in (False, True))
                w, bias = newton(x[a], y[a], np.ones(len(a)), point["C"], point.get("class_weight") == "balanced")
                one.append(scores(y[b], 1 / (1 + np.exp(-(x[b] @ w + bias))))[scoring])
            found.append(np.mean(one))
        return points[int(np.argmax(found))]

    outer, everything = folds_of(keys, y.tolist(), k), list(range(len(keys)))
    chosen, out = [], []
    for s in range(k):
        a, b = ([i for i in everything if (outer[keys[i]] == s) == held] for held in (False, True))
        chosen.append(best(a))
        w, bias = newton(x[a], y[a], np.ones(len(a)), chosen[-1]["C"], chosen[-1].get("class_weight") == "balanced")
        out.append(scores(y[b], 1 / (1 + np.exp(-(x[b] @ w + bias)))))
    return out, [*chosen, best(everything)]


def table(spark, n=90, d=3, seed=0, sparse=False):
    r = np.random.RandomState(seed)
    y = (r.rand(n) < 0.4).astype(float)
    x = r.randn(n, d) + y[:, None] * np.linspace(1.2, 0, d)
    x[r.rand(n, d) < 0.3] = 0
    keys = r.permutation(n).tolist()
    vector = lambda v, i: Vectors.sparse(d, np.flatnonzero(v).tolist(), v[v != 0].tolist()) if sparse and i % 3 else Vectors.dense(v.tolist())
    rows = [(k, float(v), vector(row, i)) for i, (k, v, row) in enumerate(zip(keys, y, x))]
    return keys, x, y, spark.createDataFrame(rows, ["_row", "label", "features"]).repartition(3)


@pytest.mark.parametrize("sparse", [False, True])
def test_every_column_is_its_own_optimum(spark, sparse, monkeypatch):
    """Penalties from strong to weak, balanced or not, over parts with repeated and held-out rows, in blocks of columns and slices."""
    keys, x, y, df = table(spark, sparse=sparse)
    shares = [np.ones(90), np.arange(90) % 3.0, (np.arange(90) % 4 > 0) * 1.0]
    by_key = {k: [s[i] for s in shares] for i, k in enumerate(keys)}
    parts = spark.createDataFrame([(k, [float(v) for v in s]) for k, s in by_key.items()], "_row long, parts array<double>")
    rows = df.join(parts, "_row").persist()
    sizes = logistic.part_sizes(rows, 3)
    assert np.allclose(sizes, [[s[y == k].sum() for s in shares] for k in (0, 1)])
    wanted = [(p, c, b) for p in range(3) for c in (1e-3, 1.0, 1e3) for b in (False, True)]
    model = lambda p, c, b: train.get_model("LogReg", {"C": c, "class_weight": "balanced" if b else None}, int(sizes[:, p].sum()))
    monkeypatch.setattr(logistic, "MOST_ENTRIES", 28)
    monkeypatch.setattr(logistic, "SLICE_BYTES", 64)
    monkeypatch.setattr(logistic, "TASK_WORK", 500)
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0 if sparse else 1 << 20)
    fits = logistic.fit_many(rows, [(p, model(p, c, b)) for p, c, b in wanted], sizes, 3)
    assert fits.converged.all()
    for i, (p, c, b) in enumerate(wanted):
        w, bias = newton(x, y, shares[p], c, b)
        assert np.allclose(np.r_[fits.weights[:, i], fits.intercepts[i]], np.r_[w, bias], rtol=2e-3, atol=2e-4), (p, c, b)
    got = {r["_row"]: r.members for r in logistic.probabilities(rows, fits, ["_row"]).collect()}
    z = x @ fits.weights + fits.intercepts
    assert np.allclose([got[k] for k in keys], 1 / (1 + np.exp(-z)))


def test_columns_that_have_converged_leave(spark, monkeypatch):
    _, _, _, df = table(spark)
    rows = df.withColumn("parts", F.array(F.lit(1.0))).persist()
    sizes, seen = logistic.part_sizes(rows, 1), []
    plain = logistic._evaluate
    monkeypatch.setattr(logistic, "_evaluate", lambda *a: seen.append(len(a[5])) or plain(*a))
    fits = logistic.fit_many(rows, [(0, train.get_model("LogReg", {"C": c}, 90)) for c in (1e-4, 1.0, 1e4)], sizes, 3)
    assert seen[0] == 3 and seen[-1] < 3 and len(seen) == fits.passes.max() and sorted(seen, reverse=True) == seen


def test_nested_folds_are_those_of_each_search_alone(spark):
    keys, _, y, df = table(spark, 47)
    for k in (2, 5):
        rows = {r["_row"]: r for r in sampling.nested_folds(df, "label", "_row", k).collect()}
        outer = folds_of(keys, y.tolist(), k)
        assert {i: r.fold for i, r in rows.items()} == outer
        for s in range(k + 1):
            here = [(i, v) for i, v in zip(keys, y.tolist()) if s == k or outer[i] != s]
            inner = folds_of(*zip(*here), k)
            for i in keys:
                assert rows[i].parts[s * k : s * k + k] == [float(i in inner and inner[i] != j) for j in range(k)]
                assert rows[i].held[s * k : s * k + k] == [i in inner and inner[i] == j for j in range(k)]
        assert all(r.parts[k * (k + 1) :] == [float(r.fold != s) for s in range(k)] for r in rows.values())


def test_parts_are_oversampled_as_tables_are(spark):
    _, _, _, df = table(spark, 50)
    rows = sampling.nested_folds(df.select("_row", "label"), "label", "_row", 2)
    got = {r["_row"]: r.parts for r in sampling.oversampled_parts(rows, "label", "_row", 3).collect()}
    for p in range(8):
        part = rows.where(F.get("parts", F.lit(p)) > 0).select("_row", "label")
        want = {r["_row"]: r["count"] for r in sampling.oversampled(part, "label", "_row", 3).groupBy("_row").count().collect()}
        assert {i: v[p] for i, v in got.items() if v[p]} == want


def test_splits_hold_the_share_out(spark):
    df = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(31)], "_row long, label double")
    rows = sampling.split_parts(df, "label", "_row", 6).collect()
    for m in range(6):
        assert [sum(1 for r in rows if r.label == y and r.parts[m] == 0) for y in (0.0, 1.0)] == [4, 3]
    assert len({tuple(r.parts[m] for r in sorted(rows)) for m in range(6)}) == 6


@pytest.mark.parametrize("scoring", ["f1", "roc_auc"])
def test_nested_cross_validation_equals_a_plain_one(spark, scoring):
    keys, x, y, df = table(spark, 80, 3, 4)
    points = [{"C": c, "class_weight": w} for c in (1e-3, 0.1, 10.0) for w in ("balanced", None)]
    got, best, params = train.nested_cross_validation(df, ["LogReg"], scoring, 3, grids={"LogReg": [{"C": [1e-3, 0.1, 10.0], "class_weight": ["balanced", None]}]})
    want, chosen = plain_nested(keys, x, y, points, scoring, 3)
    row = got.first()
    assert best == "LogReg" and params == chosen[-1]
    for k in range(3):
        assert {s: row[f"{s}_{k + 1}"] for s in SCORES} == pytest.approx({s: want[k][s] for s in SCORES})


def test_one_label_and_no_rows(spark):
    _, _, _, df = table(spark, 20)
    rows = df.where("label = 1").withColumn("parts", F.array(F.lit(1.0), F.lit(0.0)))
    sizes = logistic.part_sizes(rows, 2)
    fits = logistic.fit_many(rows, [(p, train.get_model("LogReg", {"C": 1.0}, 20)) for p in range(2)], sizes, 3)
    assert np.isfinite(fits.weights).all() and fits.intercepts[0] > 5 and fits.intercepts[1] == 0
    assert logistic.fit_many(rows.where("false"), [(0, train.get_model("LogReg", {}, 1))], sizes * 0, 3).weights.shape == (3, 1)


def test_train_logreg_equals_a_plain_version_on_the_whole_table(spark):
    """The whole grid of forty points in five by five folds, on the whole table."""
    folder = "/root/testdata/sf0.01"
    found = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    keys, x, y = [r.vec_id for r in found], np.array([r.embedding for r in found], float), np.array([r.label % 2 for r in found], float)
    row = queries.queries()["train_logreg"](spark, folder).first()
    want, _ = plain_nested(keys, x, y, train.grid("LogReg"), "f1", 5)
    for k in range(5):
        assert {s: row[f"{s}_{k + 1}"] for s in SCORES} == pytest.approx({s: want[k][s] for s in SCORES}, abs=1e-9)
