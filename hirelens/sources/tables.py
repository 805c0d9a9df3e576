"""Training sets, predictions, scores, jobs, lookups: typed scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.clean import contract_type, job_date, mongo_date, valid_prediction
from ..schemas import PREDICTION, TRAINING


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """The known columns, typed, by the names in the header, whatever their order there; one that is not there is null, and a value
    that does not fit its type is null."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')

    def typed(field: StructField) -> Column:
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.col(f"`{field.name}`")
        # A column of whole numbers with gaps is often written as 1.0.
        value = text.try_cast("double").cast("int") if isinstance(field.dataType, IntegerType) else text.try_cast(field.dataType)
        return value.alias(field.name)

    return raw.select(*[typed(f) for f in StructType.fromDDL(TRAINING)])


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, typed; see typed_predictions."""
    return typed_predictions(spark.read.schema(PREDICTION).json(path))


def typed_predictions(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The 17 columns of a prediction. A probability or bound outside [0, 1] is an error, or with strict=False drops the row."""
    dated = raw.withColumns({c: mongo_date(f"{c}.`$date`") for c in ("placed_on", "date", "closes")})
    typed = dated.select(
        "jobid", "snapshot", contract_type("contract").alias("contract"), "employer", "hours", "job_title", job_date("date", "placed_on", "closes").alias("date"), F.col("placed_on").alias("posted"), "extra_location",
        "probability", F.col("lower_ci").alias("probability_lower"), F.col("upper_ci").alias("probability_upper"), "department", "location", "salary_max", "salary_min", "salary_median",
    )
    if not strict:
        return typed.where(valid_prediction())
    checked = F.when(valid_prediction(), F.col("probability")).otherwise(F.raise_error(F.concat(F.lit("probability out of range: "), F.coalesce("jobid", F.lit("?")))).cast("double"))
    return typed.withColumn("probability", checked)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """JSON lines with sorted keys."""
    predictions.select(*sorted(predictions.columns)).write.mode("overwrite").json(path)


def write_sample(df: DataFrame, path: str) -> None:
    """One CSV file of a bounded sample."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """name: trimmed lines that are not empty."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


def job_ids(jobs: DataFrame) -> DataFrame:
    return jobs.select("jobid").distinct()


def with_description(df: DataFrame, jobs: DataFrame) -> DataFrame:
    """All point lookups of a table at once, as one left join."""
    return df.join(jobs.select("jobid", "description"), "jobid", "left")


def sorted_json(df: DataFrame, output: str = "value") -> DataFrame:
    """Each row as JSON with sorted keys and ISO dates."""
    columns = [F.date_format(c, "yyyy-MM-dd").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in sorted(df.dtypes)]
    return df.select(F.to_json(F.struct(*columns), {"pretty": "true"}).alias(output))
