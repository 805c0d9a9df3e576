"""Grouped report metrics: every figure of a period in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import location_slug, month_key, not_phd, title_matches
from ..schemas import REGIONS

POSITIVE = 0.5
KEYWORDS = ["research", "software"]


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _slug(name: str) -> str:
    return "nloc_" + "_".join(name.replace("&", "").replace(",", "").lower().split())


def metric_expressions() -> list[Column]:
    """The 26 figures of a period. npos_lower counts upper bounds above a half and npos_upper lower ones, as readers of the reports know
    them; njob_match is over all rows."""
    p = F.col("probability") > POSITIVE
    npos = _count(p)
    permanent, fixed = _count(p & (F.col("contract") == "Permanent")), _count(p & (F.col("contract") == "FixedTerm"))
    share = lambda n: F.coalesce(F.try_divide(n, npos), F.lit(0.0))
    return [
        F.count("*").alias("total"),
        npos.alias("npos"),
        F.try_divide(npos, F.count("*")).alias("proportion_pos"),
        _count(F.col("job_title_match")).alias("njob_match"),
        _count(F.col("probability_upper") > POSITIVE).alias("npos_lower"),
        _count(F.col("probability_lower") > POSITIVE).alias("npos_upper"),
        permanent.alias("ncontract_permanent"),
        fixed.alias("ncontract_fixed_term"),
        share(permanent).alias("propcontract_permanent"),
        share(fixed).alias("propcontract_fixed_term"),
        F.avg("salary_median").alias("salary_mean"),
        F.avg(F.when(p, F.col("salary_median"))).alias("salary_mean_pos"),
        *[_count(p & (F.col("extra_location") == r)).alias(_slug(r)) for r in REGIONS],
    ]


def report_rows(predictions: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Rows with a salary and a date and no PhD in the title, with year_month and job_title_match."""
    kept = predictions.where(F.col("salary_median").isNotNull() & F.col("date").isNotNull() & not_phd("job_title"))
    return kept.withColumns({"year_month": month_key("date"), "job_title_match": title_matches("job_title", keywords or KEYWORDS)})


def by_month(rows: DataFrame) -> DataFrame:
    return rows.where("year_month is not null").groupBy(F.col("year_month").alias("group")).agg(*metric_expressions()).orderBy("group")


def by_year(rows: DataFrame) -> DataFrame:
    return rows.where("date is not null").groupBy(F.year("date").cast("string").alias("group")).agg(*metric_expressions()).orderBy("group")


def training_by_month(training: DataFrame, label: str = "aggregate_tags", positive: int = 1, negative: int = 0, date: str = "placed_on") -> DataFrame:
    phd = F.col("job_title").contains("PhD")
    return training.where(F.col(date).isNotNull()).groupBy(month_key(date).alias("group")).agg(
        F.count("*").alias("total"),
        _count(F.col(label) == positive).alias("npos"),
        _count(F.col(label) == negative).alias("nneg"),
        _count(phd).alias("nphd"),
        _count(~phd).alias("nnotphd"),
        F.try_divide(_count(F.col(label) == positive), F.count("*")).alias("proportion_pos"),
    ).orderBy("group")


def report_scalars(rows: DataFrame) -> DataFrame:
    """One row: mean salaries on both sides of a half, and title matches (over all rows) per cent of positives."""
    p = F.col("probability")
    return rows.agg(
        F.avg(F.when(p > POSITIVE, F.col("salary_median"))).alias("salary_mean_pos"),
        F.avg(F.when(p <= POSITIVE, F.col("salary_median"))).alias("salary_mean_neg"),
        F.try_divide(100 * _count(F.col("job_title_match")), _count(p > POSITIVE)).alias("percent_match"),
    )


def distribution(dated: DataFrame, kind: str, date: str = "date") -> DataFrame:
    """Counts by month (yyyy-MM) or, for any other kind, by year, ascending; the last row, with a null period, is the total."""
    period = F.date_format(date, "yyyy-MM") if kind == "monthly" else F.date_format(date, "yyyy")
    name = kind.removesuffix("ly")
    return dated.where(F.col(date).isNotNull()).select(period.alias(name)).rollup(name).count().withColumnRenamed("count", "n").orderBy(F.col(name).asc_nulls_last())


def best_score(scores: DataFrame, scoring: str) -> DataFrame:
    """The row with the highest mean of the scoring; the earlier row of equals."""
    order = [F.desc(f"mean_{scoring}")] + ([F.col("place")] if "place" in scores.columns else [F.col("model")])
    return scores.orderBy(*order).limit(1)


def best_within(scores: DataFrame, least_precision: float = 0.90) -> DataFrame:
    """The stricter choice: of the models above a precision, the one of highest recall."""
    return scores.where(F.col("mean_precision") > least_precision).orderBy(F.desc("mean_recall"), "model").limit(1)


def alpha_ordinal(ratings: DataFrame, coders: list[str]) -> DataFrame:
    """One row: Krippendorff's alpha for ordinal ratings, from coincidences of pairs within a unit and category totals.

    A unit has as many ratings as coders, so its pairs are bounded by them.
    """
    units = ratings.select(F.filter(F.array(*coders), lambda x: x.isNotNull()).alias("r")).where(F.size("r") >= 2)
    pairs = units.select(F.size("r").alias("m"), F.posexplode("r").alias("i", "a"), "r").select("m", "i", "a", F.posexplode("r").alias("j", "b")).where("i <> j")
    o = pairs.groupBy("a", "b").agg(F.sum(1 / (F.col("m") - 1)).alias("o"))
    n = o.groupBy("a").agg(F.sum("o").alias("n"))
    c = n.select(F.col("a").alias("k"), F.col("n").alias("nk"))
    # Categories are ranks; the squared difference of two is of the totals between them.
    grid = n.alias("x").join(n.alias("y"), F.col("x.a") < F.col("y.a")).join(c, (F.col("k") >= F.col("x.a")) & (F.col("k") <= F.col("y.a")))
    d = grid.groupBy(F.col("x.a").alias("a"), F.col("y.a").alias("b")).agg(F.pow(F.sum("nk") - (F.first("x.n") + F.first("y.n")) / 2, 2).alias("d"), (F.first("x.n") * F.first("y.n")).alias("e"))
    total = n.agg(F.sum("n").alias("all"))
    both = d.join(o.where("a < b"), ["a", "b"], "left").crossJoin(F.broadcast(total))
    return both.agg((1 - (F.first("all") - 1) * F.sum(F.coalesce("o", F.lit(0.0)) * F.col("d")) / F.sum(F.col("e") * F.col("d"))).alias("alpha"))


__all__ = ["alpha_ordinal", "best_score", "best_within", "by_month", "by_year", "distribution", "location_slug", "report_rows", "report_scalars", "training_by_month"]
