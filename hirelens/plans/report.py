"""Reports: metrics as JSON and a page that shows them."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame

from ..functions.clean import alert_level, verdict, verdict_alert
from ..operators import metrics

#: Metric columns that the page's charts show; every one is a column of the period metrics.
CHARTS = {
    "npos": "Jobs",
    "proportion_pos": "Share of jobs",
    "njob_match": "Title matches",
    "salary_mean_pos": "Mean salary",
    "propcontract_permanent": "Permanent contracts",
    "propcontract_fixed_term": "Fixed-term contracts",
    "nloc_london": "London",
    "nloc_scotland": "Scotland",
    "nloc_asia_middle_east": "Asia and Middle East",
    "nloc_north_south_central_america": "The Americas",
    "nloc_wales": "Wales",
}


def verdict_of(scores: DataFrame, scoring: str = "precision") -> DataFrame:
    """The best model with its alert levels and verdict."""
    best = metrics.best_score(scores, scoring)
    levels = best.withColumns({"precision_level": alert_level("mean_precision"), "recall_level": alert_level("mean_recall")})
    judged = levels.withColumn("verdict", verdict(levels["precision_level"], levels["recall_level"]))
    return judged.withColumn("verdict_level", verdict_alert("verdict"))


def write_report(predictions: DataFrame, training: DataFrame | None, folder: str, title: str = "Jobs") -> Path:
    """by_year.json, by_month.json, training_by_month.json and index.html. What comes to the driver is a row a period."""
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    rows = metrics.report_rows(predictions)
    tables = {"by_year": metrics.by_year(rows), "by_month": metrics.by_month(rows)}
    if training is not None:
        tables["training_by_month"] = metrics.training_by_month(training)
    found = {}
    for name, df in tables.items():
        found[name] = [r.asDict() for r in df.collect()]
        (target / f"{name}.json").write_text(json.dumps(found[name], sort_keys=True, indent=2))
    scalars = metrics.report_scalars(rows).first().asDict()
    (target / "index.html").write_text(_page(title, found["by_year"], scalars))
    return target


def _page(title: str, years: list[dict], scalars: dict) -> str:
    head = "".join(f"<th>{html.escape(t)}</th>" for t in CHARTS.values())
    shown = lambda v: "" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v)
    body = "".join(f"<tr><th>{html.escape(y['group'])}</th>{''.join(f'<td>{shown(y[c])}</td>' for c in CHARTS)}</tr>" for y in years)
    facts = "".join(f"<li>{html.escape(k)}: {shown(v)}</li>" for k, v in scalars.items())
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><ul>{facts}</ul><table><tr><th></th>{head}</tr>{body}</table>\n"
