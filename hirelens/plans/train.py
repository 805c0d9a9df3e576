"""Model grids, nested cross-validation and the ensemble."""

from __future__ import annotations

import datetime
import json
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..operators import sampling
from ..operators.ensemble import LogisticEnsemble
from ..operators.features import labelled, select_features
from ..operators.kernel import KernelMap, KernelSVC, landmarks_of, width_of
from ..operators.logistic import Fits, confusions, fit_many, part_sizes, probabilities
from ..operators.metrics import best_score
from ..operators.sampling import binary_scores, oversampled, stratified_folds, stratified_split
from ..schemas import SCORES
from ..shared import release, written

# The hyper-parameters that the grids search, in the range language of expand().
GRIDS: dict[str, list[dict[str, Any]]] = {
    "SVC": [{"C": "=e-3:8:12", "gamma": "=e-5:4:10", "kernel": ["rbf"], "class_weight": ["balanced", None]}, {"C": "=e-3:8:12", "kernel": ["linear"]}],
    "LogReg": [{"C": "=e-4:4:20", "class_weight": ["balanced", None]}],
    "RandomForest": [{"n_estimators": "=10:101:10", "max_features": "=6:32:5"}],
    "CART": [{"max_depth": "=3:20"}],
    "GradientBoosting": [{"learning_rate": [0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2], "min_samples_leaf": [1, 21], "max_depth": [3, 5, 8], "max_features": ["log2", "sqrt"], "subsample": [0.5, 0.618, 0.8, 0.85, 0.9, 0.95, 1.0]}],
}
#: A member of an ensemble without a search before it: the best model of the published runs.
MEMBER = {"C": 10000.0, "class_weight": "balanced"}


def expand(description: Any) -> list:
    """=a:b[:s] is a range, =ea:b[:n] n powers of ten from a to b, anything else is itself."""
    if not isinstance(description, str) or not description.startswith("="):
        return list(description) if isinstance(description, (list, tuple)) else [description]
    if description.startswith("=e"):
        low, high, *n = description[2:].split(":")
        return np.logspace(float(low), float(high), int(n[0]) if n else 50).tolist()
    return list(range(*map(int, description[1:].split(":"))))


def grid(model: str, grids: dict | None = None) -> list[dict[str, Any]]:
    out = []
    for part in (grids or GRIDS)[model]:
        values = [expand(v) for v in part.values()]
        out += [dict(zip(part, v, strict=True)) for v in product(*values)]
    return out


def get_model(name: str, params: dict[str, Any], n: int, seed: int = 0) -> Estimator | None:
    """The Spark estimator of a model name; None for an unknown name. C becomes regParam 1 / (C n); forests grow to Spark's deepest."""
    weight = {"weightCol": "_weight"} if params.get("class_weight") == "balanced" else {}
    regular = 1 / (params.get("C", 1.0) * max(n, 1))
    if name == "LogReg":
        return LogisticRegression(regParam=regular, elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-8, **weight)
    if name == "SVC":
        return KernelSVC(params.get("C", 1.0), n, params.get("gamma", 1.0) if params.get("kernel", "rbf") == "rbf" else None, bool(weight), seed)
    if name == "RandomForest":
        return RandomForestClassifier(numTrees=params.get("n_estimators", 100), maxDepth=30, featureSubsetStrategy=str(params.get("max_features", "auto")), seed=seed)
    if name == "CART":
        return DecisionTreeClassifier(maxDepth=params.get("max_depth", 5), seed=seed)
    if name == "GradientBoosting":
        return GBTClassifier(stepSize=params.get("learning_rate", 0.1), maxDepth=params.get("max_depth", 3), featureSubsetStrategy=params.get("max_features", "all"), subsamplingRate=params.get("subsample", 1.0), minInstancesPerNode=params.get("min_samples_leaf", 1), maxIter=params.get("n_estimators", 100), seed=seed)
    return None


def balanced(df: DataFrame) -> DataFrame:
    """_weight: n / (2 n_class). The labels' sizes are two numbers in the plan."""
    sizes = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    n, weight = sum(sizes.values()), F.lit(None).cast("double")
    for label, count in sizes.items():
        weight = F.when(F.col("label") == label, n / (2 * count)).otherwise(weight)
    return df.withColumn("_weight", weight)


def probability(scored: DataFrame) -> DataFrame:
    """probability as P(label 1); a model with margins only gets their logistic."""
    if dict(scored.dtypes).get("probability") == "double":
        return scored
    if "probability" in scored.columns:
        return scored.withColumn("probability", vector_to_array("probability")[1])
    return scored.withColumn("probability", 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1])))


def _prepared(df: DataFrame, oversampling: bool, seed: int) -> tuple[DataFrame, int]:
    """The rows to fit on, with their weights, and how many there are."""
    rows = oversampled(df, "label", "_row", seed) if oversampling else df
    return balanced(rows), rows.count()


def _fit(df: DataFrame, model: str, params: dict, oversampling: bool, seed: int):
    rows, n = _prepared(df, oversampling, seed)
    rows = rows.cache()
    try:
        return get_model(model, params, n, seed).fit(rows)
    finally:
        rows.unpersist()


def search(df: DataFrame, model: str, scoring: str, folds: int, oversampling: bool, seed: int, grids: dict | None, fold_column: str, parallelism: int = 8) -> dict:
    """The best of a grid by its mean score over inner folds; the earlier of equals. Points and folds are fitted at the same time."""
    choices = grid(model, grids)
    if len(choices) == 1:
        return choices[0]
    # Written, as each of the many fits shows the plan of its rows.
    inner = written(stratified_folds(df, "label", "_row", folds).withColumnRenamed("fold", fold_column))
    parts = []
    for k in range(folds):
        rows, n = _prepared(inner.where(F.col(fold_column) != k), oversampling, seed)
        parts.append((rows.cache(), n, inner.where(F.col(fold_column) == k).cache()))

    def score(point: tuple[dict, int]) -> float:
        rows, n, held = parts[point[1]]
        fitted = get_model(model, point[0], n, seed).fit(rows)
        return binary_scores(probability(fitted.transform(held))).first()[scoring]

    with ThreadPoolExecutor(parallelism) as pool:
        values = np.array(list(pool.map(score, product(choices, range(folds)))), float).reshape(len(choices), folds)
    for rows, _, held in parts:
        rows.unpersist()
        held.unpersist()
    release(inner)
    return choices[int(np.argmax([np.mean(v) for v in values]))]


def _nested_many(df: DataFrame, model: str, scoring: str, folds: int, oversampling: bool, seed: int, grids: dict | None) -> tuple[list[dict[str, float]], dict]:
    """(scores of each outer fold, parameters that the search over all rows chooses) of a model that is linear in its (mapped) features:
    every search's points and folds are columns of one matrix of fits, and the refits of the outer folds of another. Points that share a
    kernel are fitted together; its landmarks are drawn from all rows, without their labels."""
    choices, whole = grid(model, grids), folds * (folds + 1)
    rows = sampling.nested_folds(df.select("_row", "label", "features"), "label", "_row", folds)
    rows = written(sampling.oversampled_parts(rows, "label", "_row", seed) if oversampling else rows)
    sizes, width = part_sizes(rows, whole + folds), width_of(rows)
    gamma = lambda c: c.get("gamma", 1.0) if model == "SVC" and c.get("kernel", "rbf") == "rbf" else None
    gammas = list(dict.fromkeys(map(gamma, choices)))
    landmarks = landmarks_of(rows, seed) if gammas != [None] else None
    kernels = {g: KernelMap(np.zeros((0, width)) if g is None else landmarks, g) for g in gammas}

    def fitted(g: float | None, columns: list[tuple[int, dict]]) -> tuple[DataFrame, Fits]:
        mapped = kernels[g].mapped(rows, ["label", "fold", "parts", "held"])
        made = [(part, get_model(model, c, int(sizes[:, part].sum()), seed)) for part, c in columns]
        return mapped, fit_many(mapped, made, sizes, kernels[g].width, hinge=model == "SVC")

    chosen = [choices[0]] * (folds + 1)
    if len(choices) > 1:
        found = np.zeros((folds + 1, folds, len(choices)))
        for g in gammas:
            some = [i for i, c in enumerate(choices) if gamma(c) == g]
            mapped, fits = fitted(g, [(part, choices[i]) for part in range(whole) for i in some])
            found[:, :, some] = _column_scores(mapped, fits, [part for part in range(whole) for _ in some], scoring).reshape(folds + 1, folds, len(some))
        chosen = [choices[int(np.argmax(s.mean(axis=0)))] for s in found]
    outer = {}
    for g in dict.fromkeys(gamma(c) for c in chosen[:-1]):
        here = [k for k in range(folds) if gamma(chosen[k]) == g]
        mapped, fits = fitted(g, [(whole + k, chosen[k]) for k in here])
        column = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(here) for x in (k, i)]), F.col("fold"))
        scored = probabilities(mapped.where(F.col("fold").isin(here)), fits, ["label", "fold"]).select("label", "fold", F.get("members", column).alias("probability"))
        outer |= {r["fold"]: r for r in sampling.binary_scores(scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), ["fold"]).collect()}
    release(rows)
    return [{s: float(outer[k][s]) if k in outer else 0.0 for s in SCORES} for k in range(folds)], chosen[-1]


def _column_scores(rows: DataFrame, fitted: Fits, part: list[int], scoring: str) -> np.ndarray:
    """The score of each fit over the rows held for its part."""
    if scoring == "roc_auc":
        members = probabilities(rows, fitted, ["label", "held"]).select("label", "held", F.posexplode("members").alias("fit", "probability"))
        here = members.where(F.get("held", F.get(F.array(*[F.lit(p) for p in part]), F.col("fit"))))
        found = sampling.binary_scores(here.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), ["fit"])
    else:
        found = sampling.rates(confusions(rows, fitted, part), ["fit"])
    out = np.zeros(len(part))
    for r in found.select("fit", scoring).collect():
        out[r["fit"]] = r[scoring]
    return out


def nested_cross_validation(df: DataFrame, models: list[str], scoring: str = "precision", folds: int = 5, oversampling: bool = False, seed: int = 0, grids: dict | None = None) -> tuple[DataFrame, str, dict]:
    """(scores, best model, its parameters); df has label, features, _row. scores: model, <score>_<fold>, mean_<score>."""
    outer, rows, found_params = None, [], {}
    for place, model in enumerate(models):
        row: dict[str, Any] = {"model": model, "place": place}
        if model in ("LogReg", "SVC"):
            scores, found_params[model] = _nested_many(df, model, scoring, folds, oversampling, seed, grids)
            for k, found in enumerate(scores):
                row |= {f"{s}_{k + 1}": found[s] for s in SCORES}
        else:
            if outer is None:
                outer = written(stratified_folds(df, "label", "_row", folds))
            for k in range(folds):
                train = outer.where(F.col("fold") != k).drop("fold")
                params = search(train, model, scoring, folds, oversampling, seed, grids, "_inner")
                scored = probability(_fit(train, model, params, oversampling, seed).transform(outer.where(F.col("fold") == k)))
                found = binary_scores(scored).first()
                row |= {f"{s}_{k + 1}": float(found[s]) for s in SCORES}
        row |= {f"mean_{s}": float(np.mean([row[f"{s}_{k + 1}"] for k in range(folds)])) for s in SCORES}
        rows.append(row)
    scores = df.sparkSession.createDataFrame(rows)
    best = best_score(scores, scoring).first()["model"]
    params = found_params[best] if best in found_params else search(df, best, scoring, folds, oversampling, seed, grids, "_inner")
    if outer is not None:
        release(outer)
    return scores, best, params


def train_ensemble(data: DataFrame, label: str, featureset: str, members: int = 100, parallelism: int = 4, model: str = "LogReg", params: dict | None = None) -> LogisticEnsemble | list:
    """Members in numeric order, each fit on four fifths by its own seed, features fit anew; without params, MEMBER. Logistic members are
    one model; of any other kind it is a list of (features, model)."""
    params = MEMBER if params is None else params
    if model == "LogReg":
        rows = labelled(data.dropna(subset=select_features(featureset).required), label)
        return LogisticEnsemble.fit(rows, featureset, members, lambda n: get_model(model, params, n))

    def one(seed: int):
        part = written(stratified_split(data, label, "_row", 0.2, seed).where(~F.col("is_test")).drop("is_test"))
        features = select_features(featureset)().fit(part)
        rows = labelled(features.transform(part), label)
        return features, _fit(rows, model, params, False, seed)

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(one, range(members)))


def train(data: DataFrame, folder: str, training_snapshot: str, label: str = "aggregate_tags", featureset: str = "rse", models: list[str] | None = None, scoring: str = "precision", folds: int = 5, oversampling: bool = False, members: int = 100, grids: dict | None = None, now: datetime.datetime | None = None) -> Path:
    """Writes a model snapshot: metadata.json, scores (Parquet), model, and the members with their features (logistic ones as one model, in
    members; others each in a folder of its own); returns its folder."""
    models = models or list(GRIDS)
    name = f"{featureset}_{(now or datetime.datetime.now()).strftime('%Y-%m-%dT%H-%M-%S')}_{__version__}"
    target = Path(folder) / name
    target.mkdir(parents=True)
    rows = labelled(data, label)
    if "_row" not in data.columns:
        # Numbered once and written, so that every member and fold sees the same number for a row.
        rows = labelled(data.dropna(subset=select_features(featureset).required), label).withColumn("_row", F.monotonically_increasing_id())
        rows.write.parquet(str(target / "training"))
        rows = data.sparkSession.read.parquet(str(target / "training"))
    features = select_features(featureset)().fit(rows)
    matrix = written(features.transform(rows).select("_row", "label", "features"))
    scores, best, params = nested_cross_validation(matrix, models, scoring, folds, oversampling, 0, grids)
    scores.write.parquet(str(target / "scores"))
    _fit(matrix, best, params, oversampling, 0).write().save(str(target / "model"))
    release(matrix)
    ensemble = train_ensemble(rows, label, featureset, members, model=best, params=params)
    if isinstance(ensemble, LogisticEnsemble):
        (target / "members").mkdir()
        ensemble.save(target / "members", {"members": members, "model": best, "parameters": params})
    else:
        for i, (own, model) in enumerate(ensemble):
            model.write().save(str(target / f"member_{i:03d}"))
            own.save(str(target / f"features_{i:03d}"))
    metadata = {"snapshot": name, "training": {"training_snapshot": str(training_snapshot), "models": models, "featureset": featureset, "prediction_field": label, "oversampling": oversampling, "scoring": scoring}, "best_model": best, "best_parameters": params, "version": __version__, "spark": data.sparkSession.version}
    (target / "metadata.json").write_text(json.dumps(metadata, sort_keys=True, indent=2, default=str))
    return target


def load_ensemble(spark: SparkSession, folder: str | Path) -> LogisticEnsemble | list:
    """The members of a model snapshot, in numeric order, as train_ensemble returns them."""
    folder = Path(folder)
    if (folder / "members").exists():
        return LogisticEnsemble.load(spark, folder / "members")
    featureset = json.loads((folder / "metadata.json").read_text())["training"]["featureset"]
    members = sorted(folder.glob("member_*"), key=lambda p: int(p.name.split("_")[1]))
    return [(select_features(featureset)().load(spark, str(folder / f"features_{p.name.split('_')[1]}")), DefaultParamsReader.loadParamsInstance(str(p), spark)) for p in members]
