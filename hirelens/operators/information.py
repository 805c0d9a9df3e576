"""Ranking of terms by what they say about a binary label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import placed


def _entropy(joint: Column, marginal: Column) -> Column:
    q = (joint + 1) / (marginal + 2)
    return q * F.log2(1 / q)


def term_counts(documents: DataFrame, terms: str, label: str) -> DataFrame:
    """ngram, f (documents that have it), j (of those, labelled 1), n (documents), n1 (labelled 1). Absent terms are the complement,
    so no dense matrix is made; the totals are one row."""
    totals = documents.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("n1"))
    rows = documents.select(F.explode(F.array_distinct(terms)).alias("ngram"), F.col(label).cast("long").alias("y"))
    return rows.groupBy("ngram").agg(F.count("*").alias("f"), F.sum("y").alias("j")).crossJoin(F.broadcast(totals))


def information(counts: DataFrame) -> DataFrame:
    """ngram, information: the smoothed entropy of the label given the term's presence. Not in order: a sink that wants it sorts."""
    f, j, n, n1 = (F.col(c) for c in ("f", "j", "n", "n1"))
    present = (f + 1) / (n + 2) * (_entropy(j, f) + _entropy(f - j, f))
    absent = (n - f + 1) / (n + 2) * (_entropy(n1 - j, n - f) + _entropy(n - f - (n1 - j), n - f))
    return counts.select("ngram", (present + absent).alias("information"))


def contingency(counts: DataFrame) -> DataFrame:
    """ngram and the six cells: term absent and present, and each with either label."""
    return counts.selectExpr("ngram", "n - f AS absent", "f AS present", "n - f - (n1 - j) AS absent_0", "n1 - j AS absent_1", "f - j AS present_0", "j AS present_1")


def ranked(informed: DataFrame, method: str = "dense", digits: int = 12) -> DataFrame:
    """informed with rank (by rounded information, so that summation order does not part equals): dense, min (1 and the terms before) or
    ordinal (equals by term). The distinct values are ranked in ranges, then joined back; most terms share few values, so equals are
    ranked in ranges of terms too."""
    if method not in ("dense", "min", "ordinal"):
        raise ValueError(f"no such rank: {method}")
    keyed = informed.withColumn("_v", F.round("information", digits))
    values = keyed.groupBy("_v").agg(F.count("*").alias("_terms"))
    ranks = placed(values, [], "_v", weight=None if method == "dense" else "_terms").select("_v", F.col("_place").cast("long").alias("rank"))
    if method == "ordinal":
        keyed = placed(keyed, ["_v"], "ngram").withColumnRenamed("_place", "_nth").drop("_n")
        return keyed.join(ranks, "_v").withColumn("rank", F.col("rank") + F.col("_nth") - 1).drop("_v", "_nth")
    return keyed.join(ranks, "_v").drop("_v")


def till_rank(ranked_terms: DataFrame, rank: int) -> DataFrame:
    """Ranks up to rank, or for a negative one that many ranks from the end."""
    if rank == 0:
        raise ValueError("rank 0 selects nothing")
    if rank > 0:
        return ranked_terms.where(F.col("rank") <= rank)
    most = ranked_terms.agg(F.max("rank").alias("_most"))
    return ranked_terms.crossJoin(F.broadcast(most)).where(F.col("rank") >= F.col("_most") + rank + 1).drop("_most")


def at_rank(ranked_terms: DataFrame, rank: int) -> DataFrame:
    return ranked_terms.where(F.col("rank") == rank)
