"""Views of the driver's tables in the shapes of this package. The SQL runs unchanged in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .schemas import REGIONS

_TITLES = ["Research Software Engineer", "PhD Studentship in Research Software", "Lecturer in History", "Research Associate", "Software Developer", "Senior RESEARCH and software Officer"]

_P = "CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000"

JOBS = f"""
SELECT o_orderkey AS jobid,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS salary_median,
  CASE o_orderstatus WHEN 'F' THEN 'Permanent' WHEN 'O' THEN 'FixedTerm' END AS contract,
  CASE o_custkey % 14 {" ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(REGIONS[:-1]))} ELSE 'Wales' END AS extra_location,
  CASE o_orderkey % 7 {" ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TITLES))} ELSE 'Technician' END AS job_title,
  {_P} AS probability,
  greatest({_P} - CAST(0.05 AS DOUBLE), CAST(0 AS DOUBLE)) AS probability_lower,
  least({_P} + CAST(0.05 AS DOUBLE), CAST(1 AS DOUBLE)) AS probability_upper
FROM orders"""

TRAINING = """
SELECT d.doc_id AS jobid, d.text AS description, substr(d.text, 1, 60) AS job_title, CAST(l.quality AS BIGINT) AS aggregate_tags,
  CAST(d.doc_id % 24 AS BIGINT) AS month_index
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

RATINGS = """
SELECT doc_id AS jobid,
  CASE WHEN quality = 1 THEN 'Most' ELSE 'No' END AS tags_1,
  CASE WHEN toxic = 1 THEN 'Some' WHEN quality = 1 THEN 'Most' ELSE 'No' END AS tags_2,
  CASE WHEN doc_id % 5 = 0 THEN 'Insufficient Evidence' WHEN doc_id % 3 = 0 THEN 'Some' END AS tags_3
FROM labels"""

_THOUSANDS = "CAST(CAST(floor(o_totalprice / 10) AS BIGINT) % 190 + 5 AS BIGINT)"
_AMOUNT = f"'£' || CASE WHEN {_THOUSANDS} < 10 THEN '0' ELSE '' END || CAST({_THOUSANDS} AS VARCHAR(9)) || ',' || lpad(CAST(o_custkey % 1000 AS VARCHAR(9)), 3, '0')"
_SECOND = "'£' || CAST(CAST(o_orderkey % 80 + 10 AS BIGINT) AS VARCHAR(9)) || ',500'"

#: Zero to three amounts by key, with words around them.
SALARIES = f"""
SELECT o_orderkey AS jobid, o_orderpriority AS employer, CASE WHEN o_orderkey % 13 = 0 THEN ' Not Specified ' WHEN o_orderkey % 19 = 0 THEN '' ELSE o_orderstatus END AS contract,
  CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Competitive' ELSE 'Grade 7' END WHEN 1 THEN {_AMOUNT} || '  per annum'
    WHEN 2 THEN 'From ' || {_AMOUNT} || ' to ' || {_SECOND} ELSE {_AMOUNT} || ', ' || {_SECOND} || ' or £99,999' END AS salary
FROM orders"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapted(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """The rows of an adapter's SQL over the tables of a folder."""
    return spark.sql(_bound(sql, tables), **{t: table(spark, sf_dir, t) for t in tables})


def _bound(sql: str, tables: tuple[str, ...]) -> str:
    for t in tables:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return sql


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, JOBS, "orders")


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, TRAINING, "documents", "labels")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, RATINGS, "labels")


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, SALARIES, "orders")
