"""The ensemble as one model against members fitted one at a time."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hirelens.operators import ensemble, features, sampling
from hirelens.plans import predict, train

from .test_logistic import newton

MEMBERS = 5


class Few(features.TextFeatures):
    required = ["description", "job_title"]
    blocks = [("description", 12), ("job_title", None)]


@pytest.fixture(scope="module")
def data(spark):
    """Texts of few words, so that many terms have the very count at which the limit of twelve cuts."""
    r = random.Random(5)
    words = [f"{a}{b}zz" for a in "bcdfg" for b in "aeiou"]
    rows = []
    for i in range(48):
        y = i % 3 == 0
        text = " ".join(r.choice(words[: 12 if y else 25]) for _ in range(r.randrange(1, 9)))
        rows.append((f"j{i}", "" if i == 7 else text, None if i == 11 else f"post {r.choice(words)} {'senior' if y else 'junior'}", int(y), i))
    return spark.createDataFrame(rows, "jobid string, description string, job_title string, aggregate_tags int, _row long").repartition(4).persist()


def one_by_one(spark, data, documents, params):
    """jobid -> probabilities, by a vocabulary, a transform and a Newton solution a member."""
    rows = features.labelled(data.dropna(subset=["description", "job_title"]), "aggregate_tags")
    split = sampling.split_parts(rows, "label", "_row", MEMBERS).persist()
    out = {}
    for m in range(MEMBERS):
        part = split.where(F.get("parts", F.lit(m)) > 0).drop("parts")
        own = Few().fit(part)
        dense = lambda df: {r["_row"]: np.array(r.x) for r in own.transform(df).select("_row", vector_to_array("features").alias("x")).collect()}
        x, labels = dense(part), {r["_row"]: r.label for r in part.collect()}
        keys = sorted(x)
        w, b = newton(np.array([x[k] for k in keys]), np.array([labels[k] for k in keys]), np.ones(len(keys)), params["C"], params.get("class_weight") == "balanced")
        for k, v in dense(documents).items():
            out.setdefault(k, []).append(1 / (1 + np.exp(-(v @ w + b))))
    return out


@pytest.mark.parametrize("params", [{"C": 1.0, "class_weight": "balanced"}, {"C": 20.0}])
def test_members_are_those_fitted_one_at_a_time(spark, data, monkeypatch, tmp_path, params):
    monkeypatch.setitem(features.FEATURE_SETS, "few", Few)
    made = train.train_ensemble(data, "aggregate_tags", "few", MEMBERS, params=params)
    assert len(made) == MEMBERS and made.fits.converged.all()
    new = spark.createDataFrame([("n1", "unknown words only", "none"), ("n2", "", ""), ("n3", "bazz bazz cazz", None)], "jobid string, description string, job_title string")
    documents = data.select("jobid", "description", "job_title").unionByName(new).withColumn("_row", F.col("jobid"))
    got = {r.jobid: r.members for r in made.members(documents, "jobid").collect()}
    want = one_by_one(spark, data, documents, params)
    assert set(got) == set(want)
    for k, v in want.items():
        assert np.allclose(got[k], v, atol=2e-3), k
    made.save(tmp_path, {"members": MEMBERS})
    loaded = ensemble.LogisticEnsemble.load(spark, tmp_path)
    again = {r.jobid: r.members for r in loaded.members(documents, "jobid").collect()}
    assert all(np.allclose(again[k], v, atol=1e-12) for k, v in got.items())


def test_each_member_has_its_own_vocabulary(spark, data, monkeypatch):
    """Terms, frequencies and the choice at the cut, over ranges and batches of any size."""
    monkeypatch.setitem(features.FEATURE_SETS, "few", Few)
    rows = sampling.split_parts(features.labelled(data.dropna(), "aggregate_tags"), "label", "_row", MEMBERS).persist()
    want = []
    for m in range(MEMBERS):
        own = Few().fit(rows.where(F.get("parts", F.lit(m)) > 0))
        want.append({(b, r.term): r.idf for b, (c, _) in enumerate(Few.blocks) for r in own.tables[c].collect()})
    for records, parts in ((10000, 4), (7, 11)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            counted = ensemble.counted_terms(rows, Few(), MEMBERS).persist()
            terms = ensemble._placed(ensemble.chosen_terms(counted, Few.blocks, np.array([rows.where(F.get("parts", F.lit(m)) > 0).count() for m in range(MEMBERS)]))).collect()
            counted.unpersist()
        finally:
            for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", 10000), ("spark.sql.shuffle.partitions", 4), ("spark.sql.adaptive.coalescePartitions.enabled", "true")):
                spark.conf.set(key, value)
        assert [r.at for r in sorted(terms, key=lambda r: (r.block, r.term))] == list(range(len(terms)))
        for m in range(MEMBERS):
            assert {(r.block, r.term): r.idf[m] for r in terms if r.idf[m]} == pytest.approx(want[m])


def test_scoring_has_one_join_whatever_the_members(spark, data, monkeypatch):
    monkeypatch.setitem(features.FEATURE_SETS, "few", Few)
    jobs = data.select("jobid", "description", "job_title")
    for members in (2, 7):
        made = train.train_ensemble(data, "aggregate_tags", "few", members)
        plan = predict.member_probabilities(jobs, made)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1
        assert predict.predict(jobs, None, made, "s", 20).count() == 47


def test_no_rows_to_train_on(spark, data, monkeypatch):
    monkeypatch.setitem(features.FEATURE_SETS, "few", Few)
    made = train.train_ensemble(data.where("false"), "aggregate_tags", "few", 2)
    assert [r.members for r in made.members(data.where("_row < 2").select("jobid", "description", "job_title"), "jobid").collect()] == [[0.5, 0.5]] * 2
