"""Ranks in ranges against windows over whole groups."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelens.operators import information, sampling


def keyed(spark, kind, n=3000):
    r = random.Random(7)
    if kind == "prefix":  # nine of ten keys begin alike
        keys = [f"{'advert-2024-' if i % 10 else r.choice('éxA0')}{r.randrange(10**9):09d}" for i in range(n)]
    elif kind == "outlier":
        keys = [r.randrange(10**5) for _ in range(n - 1)] + [10**18]
    else:
        keys = [r.choice([r.gauss(0, 1e-6), r.gauss(5, 1)]) for _ in range(n)]
    keys = list(dict.fromkeys(keys))
    return spark.createDataFrame([(k, r.choice("aab"), i % 5) for i, k in enumerate(keys)], ["k", "g", "w"]).repartition(3).persist()


@pytest.mark.parametrize("kind", ["prefix", "outlier", "double"])
def test_places_are_those_of_a_window(spark, kind, monkeypatch):
    monkeypatch.setattr(sampling, "SAMPLE", 500)
    monkeypatch.setattr(sampling, "BUCKETS", 64)
    df = keyed(spark, kind)
    for by in ([], ["g"]):
        group = W.partitionBy(*by)
        want = df.withColumns({"_place": F.row_number().over(group.orderBy("k")), "_n": F.count("*").over(group)})
        assert sorted(map(tuple, sampling.placed(df, by, "k").collect())) == sorted(map(tuple, want.collect()))
        upto = group.orderBy("k").rowsBetween(W.unboundedPreceding, -1)
        want = df.withColumns({"_place": F.coalesce(F.sum("w").over(upto), F.lit(0)) + 1, "_n": F.sum("w").over(group)})
        assert sorted(map(tuple, sampling.placed(df, by, "k", weight="w").collect())) == sorted(map(tuple, want.collect()))
    parts = df.crossJoin(sampling._ends(df, "k")).groupBy(sampling._part("k").alias("b")).count().collect()
    assert len(parts) > 32 and max(r["count"] for r in parts) < 3000 / 8


def test_splits_and_oversampling_are_those_of_a_window(spark):
    df = keyed(spark, "prefix", 400)
    for seed in (None, 4):
        order = [F.col("k")] if seed is None else [F.xxhash64(F.lit(seed), "k"), F.col("k")]
        w = W.partitionBy("g")
        want = df.withColumn("is_test", F.row_number().over(w.orderBy(*order)) <= F.ceil(F.count("*").over(w) * F.lit(0.3)))
        assert sorted(map(tuple, sampling.stratified_split(df, "g", "k", 0.3, seed).collect())) == sorted(map(tuple, want.collect()))
    times = {r.k: r["count"] for r in sampling.oversampled(df, "g", "k", 2).groupBy("k").count().collect()}
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    most = max(sizes.values())
    ranks = df.withColumn("p", F.row_number().over(W.partitionBy("g").orderBy(F.xxhash64(F.lit(2), "k"), "k"))).collect()
    assert times == {r.k: most // sizes[r.g] + (r.p <= most % sizes[r.g]) for r in ranks}
    rows = sampling.split_parts(df, "g", "k", 3)
    for m in range(3):
        want = {r.k for r in sampling.stratified_split(df, "g", "k", 0.2, m).where("is_test").collect()}
        assert {r.k for r in rows.collect() if r.parts[m] == 0} == want


def test_term_ranks(spark, capfd):
    r = random.Random(1)
    df = spark.createDataFrame([(r.choice([0.5, 0.5, 0.5, round(r.random(), 2)]), f"term{i}") for i in range(500)], "information double, ngram string").persist()
    for method, rank in (("dense", F.dense_rank), ("min", F.rank), ("ordinal", F.row_number)):
        order = W.orderBy("information", "ngram") if method == "ordinal" else W.orderBy("information")
        want = {x.ngram: x.r for x in df.withColumn("r", rank().over(order)).collect()}
        plan = information.ranked(df, method)
        assert {x.ngram: x["rank"] for x in plan.collect()} == want
        assert "[], [" not in "".join(line for line in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in line)
    with pytest.raises(ValueError):
        information.ranked(df, "none")


def test_ties_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1), ("b", 1), ("a", 1), ("b", 1)], "k string, g int")
    assert sorted(x["_place"] for x in sampling.placed(df, ["g"], "k").collect()) == [1, 2, 3, 4]
    assert {(x.k, x["_place"]) for x in sampling.placed(df, [], "k").collect()} >= {(None, 1), ("a", 2)}
    assert sampling.placed(df.where("false"), ["g"], "k").collect() == []
    only = spark.createDataFrame([(None, 1), (None, 1)], "k string, g int")
    assert sorted(x["_place"] for x in sampling.placed(only, ["g"], "k").collect()) == [1, 2]


def test_the_area_of_ungrouped_scores(spark):
    r = random.Random(3)
    rows = [(float(r.random() < 0.4), r.choice([0.1, 0.5, r.random()])) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, probability double").withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    won = [(a > b) + (a == b) / 2 for y, a in rows if y for z, b in rows if not z]
    assert sampling.binary_scores(df).first().roc_auc == pytest.approx(sum(won) / len(won))
    by = {x.g: x.roc_auc for x in sampling.binary_scores(df.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert by[1] == pytest.approx(sum(won) / len(won))
