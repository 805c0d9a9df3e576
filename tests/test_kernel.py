"""Support vector machines on data that no line parts, their kernel, their optimum, and their probabilities."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import functions as F

from hirelens import queries
from hirelens.operators import kernel, logistic
from hirelens.plans import train


def frame(spark, x, y, sparse=False):
    vector = lambda v, i: Vectors.sparse(len(v), np.flatnonzero(v).tolist(), v[v != 0].tolist()) if sparse and i % 2 else Vectors.dense(v.tolist())
    return spark.createDataFrame([(i, float(b), vector(a, i)) for i, (a, b) in enumerate(zip(x, y))], ["_row", "label", "features"]).repartition(3).persist()


def rings(n=240, seed=0):
    r = np.random.RandomState(seed)
    y = np.arange(n) % 2
    at, far = r.rand(n) * 2 * np.pi, np.where(y == 1, 1.0, 2.0) + r.randn(n) * 0.12
    return np.c_[far * np.cos(at), far * np.sin(at)], y


def test_two_rings(spark):
    x, y = rings()
    df = frame(spark, x, y)
    grids = {"SVC": [{"C": [0.1, 10.0], "gamma": [1e-3, 1.0], "kernel": ["rbf"], "class_weight": ["balanced", None]}, {"C": [1.0], "kernel": ["linear"]}]}
    scores, best, params = train.nested_cross_validation(df, ["SVC", "LogReg"], "f1", 3, grids=grids | {"LogReg": [{"C": [1.0]}]})
    rows = {r.model: r for r in scores.collect()}
    assert best == "SVC" and params["kernel"] == "rbf" and params["gamma"] == 1.0
    assert rows["SVC"].mean_balanced_accuracy > 0.95 and rows["SVC"].mean_roc_auc > 0.97 and rows["LogReg"].mean_balanced_accuracy < 0.7
    # Rows that the machine was not fitted to.
    model = train.get_model("SVC", params, len(x)).fit(df)
    new, label = rings(100, 9)
    got = {r["_row"]: r for r in train.probability(model.transform(frame(spark, new, label))).collect()}
    assert np.mean([(got[i].prediction == 1) == (label[i] == 1) for i in range(100)]) > 0.95
    assert np.mean([(got[i].probability > 0.5) == (label[i] == 1) for i in range(100)]) > 0.95


@pytest.mark.parametrize("sparse", [False, True])
def test_mapped_rows_have_the_kernel_s_products(spark, sparse):
    x = np.random.RandomState(1).randn(40, 3).round(1) * (np.random.RandomState(2).rand(40, 3) < 0.7)
    df = frame(spark, x, np.arange(40) % 2, sparse)
    found = kernel.KernelMap(kernel.landmarks_of(df), 0.7)
    rows = {r["_row"]: r.features["values"] for r in found.mapped(df, ["_row"]).collect()}
    z = np.array([rows[i] for i in range(40)])
    assert np.allclose(z @ z.T, np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(-1)), atol=1e-5)


def test_fewer_landmarks_are_a_projection(spark, monkeypatch):
    monkeypatch.setattr(kernel, "LANDMARKS", 12)
    x, y = rings(60)
    df = frame(spark, x, y)
    found = kernel.KernelMap(kernel.landmarks_of(df), 1.0)
    assert found.landmarks.shape == (12, 2)
    z = {r["_row"]: np.array(r.features["values"]) for r in found.mapped(df, ["_row"]).collect()}
    assert all(v @ v <= 1 + 1e-6 for v in z.values()) and sum(abs(v @ v - 1) < 1e-6 for v in z.values()) >= 12


@pytest.mark.parametrize("balanced", [False, True])
def test_the_machine_is_at_its_optimum(spark, balanced):
    """No step from the weights lowers the plain objective C sum(weight hinge) + |w|^2 / 2 of overlapping classes by much."""
    r = np.random.RandomState(3)
    y = (r.rand(80) < 0.3).astype(float)
    x = r.randn(80, 2) + y[:, None]
    model = train.get_model("SVC", {"C": 0.5, "kernel": "linear", "class_weight": "balanced" if balanced else None}, 80).fit(frame(spark, x, y))
    w = np.r_[model.getOrDefault("weights"), model.getOrDefault("intercept")]
    omega = np.where(y == 1, 80 / (2 * y.sum()), 80 / (2 * (80 - y.sum()))) if balanced else np.ones(80)

    def value(w):
        return 0.5 * (omega * np.maximum(1 - (2 * y - 1) * (x @ w[:2] + w[2]), 0)).sum() + w[:2] @ w[:2] / 2

    here = value(w)
    for _ in range(3000):
        assert value(w + r.randn(3) * 10 ** r.uniform(-4, 0)) > here - 0.5 * logistic.BEND / 2 * omega.sum() * 0.05


def test_probabilities_are_calibrated(spark):
    r = np.random.RandomState(4)
    x = r.uniform(-3, 3, (900, 1))
    true = 1 / (1 + np.exp(-1.5 * x[:, 0]))
    y = (r.rand(900) < true).astype(float)
    model = train.get_model("SVC", {"C": 1.0, "gamma": 0.5}, 900).fit(frame(spark, x, y))
    at = np.linspace(-2.5, 2.5, 41)[:, None]
    p = {q["_row"]: q.probability for q in model.transform(frame(spark, at, np.zeros(41))).collect()}
    assert np.abs(np.array([p[i] for i in range(41)]) - 1 / (1 + np.exp(-1.5 * at[:, 0]))).mean() < 0.08


def test_a_saved_machine_is_the_same(spark, tmp_path):
    x, y = rings(60)
    df = frame(spark, x, y, True)
    for name, params in (("a", {"gamma": 1.0}), ("b", {"kernel": "linear", "class_weight": "balanced"})):
        model = train.get_model("SVC", params, 60).fit(df)
        model.write().save(str(tmp_path / name))
        again = DefaultParamsReader.loadParamsInstance(str(tmp_path / name), spark)
        one, two = ({r["_row"]: (r.margin, r.probability) for r in m.transform(df).collect()} for m in (model, again))
        assert one == two and set(model.transform(df.withColumn("more", F.lit("x"))).columns) == {"_row", "label", "features", "more", "margin", "probability", "prediction"}


def test_the_grid(spark):
    assert len(train.grid("SVC")) == 252
    one = frame(spark, np.ones((6, 2)), np.ones(6))
    got = train.get_model("SVC", {"gamma": 1.0}, 6).fit(one).transform(one).collect()
    assert len({r.margin for r in got}) == 1 and all(r.prediction == 1 and r.probability > 0.5 for r in got)


def test_svc_predict_equals_a_plain_machine(spark):
    """Of the registered query on a table of more rows than landmarks: the margins are those of a plain descent over the same map."""
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x, y = np.array([r.embedding for r in table], float), np.array([r.label % 2 for r in table], float)
    got = {r.vec_id: r for r in queries.queries()["svc_predict"](spark, folder).collect()}
    assert len(got) == len(table) > kernel.LANDMARKS
    found = kernel.KernelMap(kernel.landmarks_of(queries._labelled_vectors(spark, folder)), 1.0)
    z = found.kernel(x @ found.landmarks.T, (x * x).sum(1)) @ found.projection
    omega = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, b, speed = np.zeros(z.shape[1]), 0.0, 1 / (omega.sum() * 2 / logistic.BEND)
    sign, wp, bp, t = 2 * y - 1, w.copy(), 0.0, 1.0
    for _ in range(30000):  # accelerated descent on C sum(weight loss) + |w|^2 / 2
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wq, bq, t = w + (t - 1) / u * (w - wp), b + (t - 1) / u * (b - bp), u
        slope = omega * -sign * np.minimum(np.maximum(1 - sign * (z @ wq + bq), 0) / logistic.BEND, 1)
        wp, bp, w, b = w, b, wq - speed * (z.T @ slope + wq), bq - speed * slope.sum()
    margins = z @ w + b
    assert np.allclose([got[r.vec_id].margin for r in table], margins, atol=0.05)
    # Labels that have nothing to do with the vectors may turn the sigmoid; it is one of the margin all the same.
    assert abs(np.corrcoef([got[r.vec_id].probability for r in table], margins)[0, 1]) > 0.9
