"""Whitening against numpy on whole tables and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(x, components):
    """(eigenvalues, whitened, deviations) of integer vectors; whitened up to sign."""
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    away = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return values[order], centred @ axes[:, order] / np.sqrt(values[order]), away


def compare(rows, ids, x, components):
    values, w, away = plain(x, components)
    trace = np.var(x, axis=0).sum()
    found = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(found) == len(ids) * components
    got = np.array([[found[i, k + 1].whitened for k in range(components)] for i in ids])
    sign = np.sign((got * w).sum(0))
    assert np.allclose(got * sign, w, atol=1e-7)
    for i, a in zip(ids, away, strict=True):
        assert {found[i, k + 1].deviation for k in range(components)} == {a}
    assert np.allclose([found[ids[0], k + 1].explained for k in range(components)], values / trace, rtol=1e-9)
    assert {r.n for r in rows} == {len(x)}
    cov = np.cov(got.T, bias=True) - np.eye(components)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error == pytest.approx(np.abs(cov).max(), abs=1e-9) and rows[0].identity_error < 1e-4


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in table], float)).astype(np.int64) + 1_000_000
    compare(queries.op13_whitening(spark, folder).collect(), [r.vec_id for r in table], x, 32)


def test_unusable_vectors_repeated_rows_and_clashing_names(spark):
    r = np.random.RandomState(0)
    good = [(i, r.randn(4).astype(np.float32).tolist()) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan"), 0.0, 0.0, 0.0]), (103, [0.0, float("inf"), 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({"x": F.lit("a"), "n": F.lit(1), "w": F.lit(2), "s0": F.lit(0)})
    x = np.floor(64 * np.array([v for _, v in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    compare(whitening.whiten(df, components=3).collect(), list(range(40)), x, 3)
    twice = whitening.whiten(df.unionByName(df.where("vec_id = 7").withColumn("vec_id", F.lit(None).cast("long"))), components=4).collect()
    compare(twice, [*range(40), None], np.vstack([x, x[7]]), 4)


def test_few_directions_and_empty_tables(spark):
    one = spark.createDataFrame([(i, [0.5 * i, -1.0, 0.25 * i]) for i in range(9)], SCHEMA)
    rows = whitening.whiten(one, components=3).collect()
    # All vary along one line (up to the floor of their entries, which these have none of).
    assert {r.component for r in rows} == {1} and len(rows) == 9 and rows[0].explained == pytest.approx(1)
    assert whitening.whiten(one.where("vec_id = 3")).collect() == []
    empty = whitening.whiten(one.where("false"))
    assert empty.collect() == [] and empty.columns == whitening.whiten(one).columns


def test_great_entries(spark):
    """Entries whose n-fold is beyond a long are counted exactly while the deviation is within one; else there is an error."""
    rows = [(i, [float(1 << 52) + 2.0 * i, 1.0 * (i % 3)]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([[int(64 * v[0]) + 1_000_000, int(64 * v[1]) + 1_000_000] for _, v in rows], object)
    n, sums = 8, [sum(x[:, d]) for d in range(2)]
    want = {i: sum((n * x[i, d] - sums[d]) ** 2 for d in range(2)) for i in range(8)}
    assert {r.vec_id: r.deviation for r in whitening.whiten(df, components=1).collect()} == want
    for value in (1e30, -1e30, 4e16):
        with pytest.raises(Exception, match="beyond a long|overflow|OVERFLOW"):
            whitening.whiten(spark.createDataFrame([(0, [value, 1.0]), (1, [0.0, 2.0]), (2, [3.0, 0.0])], "vec_id long, embedding array<double>")).collect()
