"""Load adverts: parse, clean, insert what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import missing_attributes
from ..functions.html import parse_adverts

ATTRIBUTES = ["description", "job_title", "date"]


def insert_new(rows: DataFrame, stored: DataFrame | None, key: str = "jobid") -> DataFrame:
    """One row of each key that is not stored, of several the least by the other columns; rows without a key are left out. Only keys
    of the stored table are read."""
    others = [c for c in rows.columns if c != key]
    known = rows.where(F.col(key).isNotNull())
    fresh = known.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) if c != key else key for c in rows.columns]) if others else known.distinct()
    return fresh if stored is None else fresh.join(stored.select(key), key, "left_anti")


def load(pages: DataFrame, stored: DataFrame | None, path: str, as_of: str) -> dict[str, int]:
    """Appends new adverts to the Parquet table at path; returns how many were inserted and how many were duplicates. The counts are
    of keys alone, by one pass before anything is parsed. (An observed metric would stay in the session, and model closures could then
    not be sent.)"""
    keys = pages.groupBy("jobid").agg(F.count("*").alias("n"))
    old = F.lit(False).alias("old") if stored is None else F.col("old").isNotNull().alias("old")
    marked = keys if stored is None else keys.join(stored.select("jobid").distinct().withColumn("old", F.lit(True)), "jobid", "left")
    seen, inserted = marked.select("jobid", "n", old).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("jobid").isNotNull() & ~F.col("old"))).first()
    parse_adverts(insert_new(pages.select("jobid", "html"), stored), as_of).write.mode("append").parquet(path)
    return {"inserted": inserted, "duplicate": seen - inserted}


def dry_run(pages: DataFrame, as_of: str) -> DataFrame:
    """(jobid, missing) of adverts that lack a description, title or date."""
    return missing_attributes(parse_adverts(pages, as_of), "jobid", ATTRIBUTES)
