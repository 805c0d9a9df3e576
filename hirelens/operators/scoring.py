"""Ensemble scores and bootstrap intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bootstrap_weights(n: int, draws: int = 1000, seed: int = 0) -> np.ndarray:
    """How often draw k takes member i. Each draw has its own seed (seed + k), so the draws are the same for every record."""
    out = np.zeros((draws, n))
    for k in range(draws):
        out[k] = np.bincount(np.random.RandomState(seed + k).randint(0, n, n), minlength=n)
    return out / n


def bootstrap_interval(members: Column | str, n: int, draws: int = 1000, seed: int = 0) -> Column:
    """struct(probability, lower, upper): mean of the members, and the 2.5 and 97.5 percentiles of the means of the draws. The weights
    (draws times n numbers) go with the function."""
    weights = bootstrap_weights(n, draws, seed).T

    @F.pandas_udf("probability double, lower double, upper double")
    def interval(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            usable = batch.map(lambda x: x is not None and len(x) == n and not any(v is None for v in x))
            out = pd.DataFrame(np.nan, index=batch.index, columns=["probability", "lower", "upper"])
            if usable.any():
                means = np.array([np.asarray(x, float) for x in batch[usable]]) @ weights
                low, high = np.percentile(means, [2.5, 97.5], axis=1)
                out.loc[usable, ["probability", "lower", "upper"]] = np.column_stack([means.mean(axis=1), low, high])
            yield out.astype(object).where(out.notna(), None)

    return interval(F.col(members) if isinstance(members, str) else members)


def logistic_members(vectors: Column, weights: np.ndarray, bias: np.ndarray) -> Column:
    """array of P(label 1) by each member of an ensemble of logistic models over shared dense features: one product a batch."""

    @F.pandas_udf("array<double>")
    def members(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([np.asarray(v, float) for v in batch]).reshape(len(batch), weights.shape[1])
            yield pd.Series(list(1 / (1 + np.exp(-(x @ weights.T + bias)))))

    return members(vectors)


def new_only(documents: DataFrame, predictions: DataFrame, snapshot: str) -> DataFrame:
    """Documents without a prediction of the snapshot."""
    return documents.join(predictions.where(F.col("snapshot") == snapshot).select("jobid"), "jobid", "left_anti")


def enriched(predictions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Predictions with their job's columns, without the long text; orphans drop out."""
    return predictions.join(jobs.drop("description"), "jobid")


def orphans(predictions: DataFrame, jobs: DataFrame) -> DataFrame:
    return predictions.join(jobs.select("jobid"), "jobid", "left_anti")
