"""Judge URLs by host and path rules.

Each distinct (host, path) is expanded into the host-suffix and path-prefix expressions that the rules' shapes allow (a shape is
a number of host labels and a path length; there are at most as many as URL lengths, whatever the number of rules).
Expressions meet the rules by an equi-join on 8 hexadecimal digits of their SHA-256; the full digests confirm; the longest rule
(then the longer host, then block before allow) wins. Expanding distinct pairs keeps a URL repeated in a third of all rows at
one expansion, and every exchange is an equi-join or a partial aggregate.

Defined results: a null URL or one without :// has an empty host and path and no rule; no rule means the default verdict;
a null page_id stays; rows repeat as in the input; columns other than page_id and url are not carried, so their names cannot clash; a
very long URL is one expression a shape; an empty table gives no rows, and no rules give the default verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host up to / ? #, then the path up to ? #, both after the first ://.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX = 8


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (host and path of the rule that won, or null), verdict."""
    parsed = pages.select(
        F.col("page_id"),
        F.translate(F.coalesce(F.regexp_extract("url", PARTS, 1), F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce(F.regexp_extract("url", PARTS, 2), F.lit("")).alias("path"),
    )
    rules = rules.where("host is not null and verdict is not null").select(
        "verdict", F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path")
    )
    shapes = rules.select(F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars")).distinct()
    shape_list = F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.chars).alias("chars")) for s in shapes.collect()] or [F.struct(F.lit(0).alias("labels"), F.lit(0).alias("chars"))])
    labels = F.split("host", r"\.")
    fitting = F.filter(shape_list, lambda s: (s.labels >= 1) & (s.labels <= F.size("parts")) & (s.chars <= F.length("path")))
    expressions = F.transform(fitting, lambda s: F.concat(F.array_join(F.slice("parts", F.size("parts") - s.labels + 1, s.labels), "."), F.substring("path", F.lit(1), s.chars)))
    expanded = (
        parsed.where("host <> ''").select("host", "path").distinct()
        .withColumn("parts", labels)
        .select("host", "path", F.explode(expressions).alias("expression"))
        .withColumn("digest", F.sha2("expression", 256))
        .withColumn("short", F.substring("digest", 1, PREFIX))
    )
    rule_text = F.concat("rule_host", "rule_path")
    listed = rules.select("verdict", rule_text.alias("rule"), F.length("rule_host").alias("host_chars"), F.sha2(rule_text, 256).alias("rule_digest")).withColumn("short", F.substring("rule_digest", 1, PREFIX))
    hits = expanded.join(listed, "short").where(F.col("digest") == F.col("rule_digest"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("chars"), "host_chars", (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
