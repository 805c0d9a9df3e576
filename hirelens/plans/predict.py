"""Score jobs with an ensemble and store the predictions."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ensemble import LogisticEnsemble
from ..operators.features import valid_documents
from ..operators.scoring import bootstrap_interval, enriched, new_only
from ..schemas import SCORES
from .train import probability


def member_probabilities(documents: DataFrame, ensemble: LogisticEnsemble | list) -> DataFrame:
    """jobid, members: P(label 1) by each member in order. documents has one row a jobid. Logistic members are one model, with one join;
    others are a join each, by jobid, and not by a number that another run of the plan could give to another row."""
    if isinstance(ensemble, LogisticEnsemble):
        return ensemble.members(documents, "jobid")
    documents = documents.withColumn("_row", F.col("jobid"))
    out = documents.select("jobid", "_row")
    for i, (features, model) in enumerate(ensemble):
        scored = probability(model.transform(features.transform(documents))).select("_row", F.col("probability").alias(f"m{i}"))
        out = out.join(scored, "_row")
    return out.select("jobid", F.array(*[f"m{i}" for i in range(len(ensemble))]).alias("members"))


def run_counts(jobs: DataFrame, stored: DataFrame | None, snapshot: str) -> dict[str, int]:
    """How many jobs a run scores, how many lack a title or description, and how many have a prediction of this snapshot."""
    marked = jobs.select("jobid", (F.col("job_title").isNotNull() & F.col("description").isNotNull()).alias("valid"))
    if stored is None:
        marked = marked.withColumn("done", F.lit(False))
    else:
        old = stored.where(F.col("snapshot") == snapshot).select("jobid").distinct().withColumn("old", F.lit(True))
        marked = marked.join(old, "jobid", "left").withColumn("done", F.col("old").isNotNull())
    row = marked.agg(F.count_if(F.col("valid") & ~F.col("done")).alias("scored"), F.count_if(~F.col("valid")).alias("invalid"), F.count_if(F.col("valid") & F.col("done")).alias("skipped")).first()
    return row.asDict()


def predict(jobs: DataFrame, stored: DataFrame | None, ensemble: LogisticEnsemble | list, snapshot: str, draws: int = 1000) -> DataFrame:
    """Predictions of the valid jobs that have none of this snapshot, joined to their jobs; of rows with one jobid the least by title and
    description is scored."""
    documents = valid_documents(jobs.select("jobid", "job_title", "description"), ["jobid", "job_title", "description"])
    documents = documents.groupBy("jobid").agg(F.min(F.struct("job_title", "description")).alias("_d")).select("jobid", "_d.job_title", "_d.description")
    if stored is not None:
        documents = new_only(documents, stored, snapshot)
    members = member_probabilities(documents, ensemble)
    ci = bootstrap_interval("members", len(ensemble), draws)
    scored = members.select("jobid", F.lit(snapshot).alias("snapshot"), ci.alias("ci")).select("jobid", "snapshot", "ci.probability", F.col("ci.lower").alias("probability_lower"), F.col("ci.upper").alias("probability_upper"))
    return enriched(scored, jobs)


def upsert(stored: DataFrame | None, new: DataFrame) -> DataFrame:
    """One row per (jobid, snapshot): the new one where there is one."""
    if stored is None:
        return new
    return stored.join(new.select("jobid", "snapshot"), ["jobid", "snapshot"], "left_anti").unionByName(new, allowMissingColumns=True)


def metadata(model_metadata: dict, scores: DataFrame, now: datetime.datetime | None = None) -> dict:
    """The model's metadata with the best mean precision, whatever the scoring was."""
    best = scores.agg(F.max(f"mean_{SCORES[0]}")).first()[0]
    return model_metadata | {"best_model_average_score": best, "created": (now or datetime.datetime.now()).isoformat()}
