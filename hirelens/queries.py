"""Registered queries over the driver's tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import JOBS, RATINGS, REGIONS, SALARIES, TRAINING, jobs, ratings, salaries, table, training
from .functions import clean, html, text
from .operators import features, information, logistic, metrics, sampling, scoring
from .operators.metrics import _slug
from .plans import load, predict, train
from .sources import pages as page_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# Reports

_KEPT = f"""j AS ({JOBS}), k AS (SELECT *, strftime(date_trunc('month', date), '%Y-%m-%d') AS year_month,
  contains(lower(job_title), 'research') AND contains(lower(job_title), 'software') AS m
  FROM j WHERE salary_median IS NOT NULL AND date IS NOT NULL AND NOT contains(job_title, 'PhD'))"""
_METRICS = """CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE probability > 0.5) AS BIGINT) AS npos,
  round(count(*) FILTER (WHERE probability > 0.5) / count(*), 6) AS proportion_pos, CAST(count(*) FILTER (WHERE m) AS BIGINT) AS njob_match,
  CAST(count(*) FILTER (WHERE probability_upper > 0.5) AS BIGINT) AS npos_lower, CAST(count(*) FILTER (WHERE probability_lower > 0.5) AS BIGINT) AS npos_upper,
  CAST(count(*) FILTER (WHERE probability > 0.5 AND contract = 'Permanent') AS BIGINT) AS ncontract_permanent,
  CAST(count(*) FILTER (WHERE probability > 0.5 AND contract = 'FixedTerm') AS BIGINT) AS ncontract_fixed_term,
  round(coalesce(count(*) FILTER (WHERE probability > 0.5 AND contract = 'Permanent') / nullif(count(*) FILTER (WHERE probability > 0.5), 0), 0), 6) AS propcontract_permanent,
  round(coalesce(count(*) FILTER (WHERE probability > 0.5 AND contract = 'FixedTerm') / nullif(count(*) FILTER (WHERE probability > 0.5), 0), 0), 6) AS propcontract_fixed_term,
  round(avg(salary_median), 6) AS salary_mean, round(avg(CASE WHEN probability > 0.5 THEN salary_median END), 6) AS salary_mean_pos, """ + ", ".join(
    f"CAST(count(*) FILTER (WHERE probability > 0.5 AND extra_location = '{r}') AS BIGINT) AS {_slug(r)}" for r in REGIONS
)


@query(f'WITH {_KEPT} SELECT CAST(year(date) AS VARCHAR) AS "group", {_METRICS} FROM k GROUP BY 1')
def report_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.by_year(metrics.report_rows(jobs(spark, sf_dir))))


@query(f'WITH {_KEPT} SELECT year_month AS "group", {_METRICS} FROM k GROUP BY 1')
def report_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.by_month(metrics.report_rows(jobs(spark, sf_dir))))


@query(f"""WITH {_KEPT} SELECT round(avg(CASE WHEN probability > 0.5 THEN salary_median END), 6) AS salary_mean_pos,
  round(avg(CASE WHEN probability <= 0.5 THEN salary_median END), 6) AS salary_mean_neg, round(100 * count_if(m) / nullif(count_if(probability > 0.5), 0), 6) AS percent_match FROM k""")
def report_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.report_scalars(metrics.report_rows(jobs(spark, sf_dir))))


def _dated_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training(spark, sf_dir).withColumn("placed_on", F.add_months(F.lit("2018-01-01").cast("date"), F.col("month_index").cast("int")))


@query(f"""WITH t AS ({TRAINING}) SELECT strftime(DATE '2018-01-01' + to_months(CAST(month_index AS INTEGER)), '%Y-%m-%d') AS "group", CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(aggregate_tags = 1) AS BIGINT) AS npos, CAST(count_if(aggregate_tags = 0) AS BIGINT) AS nneg, CAST(count_if(contains(job_title, 'PhD')) AS BIGINT) AS nphd,
  CAST(count_if(NOT contains(job_title, 'PhD')) AS BIGINT) AS nnotphd, round(count_if(aggregate_tags = 1) / count(*), 6) AS proportion_pos FROM t GROUP BY 1""")
def training_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.training_by_month(_dated_training(spark, sf_dir)))


@query(f"WITH j AS ({JOBS}) SELECT strftime(date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n FROM j WHERE date IS NOT NULL GROUP BY ROLLUP (1)")
def distribution_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distribution(jobs(spark, sf_dir), "monthly")


@query("SELECT strftime(CAST(o_orderdate AS DATE), '%Y') AS year, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ROLLUP (1)")
def distribution_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(clean.job_date("o_orderdate").cast("date").alias("date"))
    return metrics.distribution(dated, "yearly")


@query("""WITH d AS (SELECT event_id, CAST(ts AS DATE) AS date FROM events)
  SELECT event_id, strftime(date_trunc('month', date), '%Y-%m-%d') AS month_key, strftime(date, '%b %Y') AS month_label FROM d""")
def month_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("date"))
    return d.select("event_id", clean.month_key("date").alias("month_key"), clean.month_label("date").alias("month_label"))


_SCORES_SQL = """s AS (SELECT 'model_' || lpad(CAST(o_custkey % 50 AS VARCHAR), 2, '0') AS model, round(avg((o_orderkey * 31 % 1000) / 1000.0), 6) AS mean_precision, round(avg((o_orderkey * 17 % 1000) / 1000.0), 6) AS mean_recall FROM orders GROUP BY 1)"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = F.concat(F.lit("model_"), F.lpad((F.col("o_custkey") % 50).cast("string"), 2, "0")).alias("model")
    return table(spark, sf_dir, "orders").groupBy(model).agg(F.round(F.avg(F.col("o_orderkey") * 31 % 1000 / 1000), 6).alias("mean_precision"), F.round(F.avg(F.col("o_orderkey") * 17 % 1000 / 1000), 6).alias("mean_recall"))


@query(f"WITH {_SCORES_SQL} SELECT * FROM s ORDER BY mean_precision DESC, model LIMIT 1")
def best_score_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_score(_scores(spark, sf_dir), "precision")


@query(f"WITH {_SCORES_SQL} SELECT * FROM s WHERE mean_precision > 0.49 ORDER BY mean_recall DESC, model LIMIT 1")
def best_within_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_within(_scores(spark, sf_dir), 0.49)


@query(f"""WITH {_SCORES_SQL}, l AS (SELECT model, CASE WHEN mean_precision * 1.6 > 0.80 THEN 'High' WHEN mean_precision * 1.6 > 0.60 THEN 'Medium' ELSE 'Low' END AS p,
    CASE WHEN mean_recall * 1.6 > 0.80 THEN 'High' WHEN mean_recall * 1.6 > 0.60 THEN 'Medium' ELSE 'Low' END AS r FROM s),
  v AS (SELECT *, CASE WHEN p = 'High' AND r = 'High' THEN 'High' WHEN p = 'High' THEN 'HighLow' WHEN r = 'High' THEN 'LowHigh' ELSE 'Low' END AS verdict FROM l)
  SELECT *, CASE WHEN verdict IN ('High', 'Low') THEN verdict ELSE 'Medium' END AS alert, lower(p) AS tag FROM v""")
def alert_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = _scores(spark, sf_dir).select("model", clean.alert_level(F.col("mean_precision") * 1.6).alias("p"), clean.alert_level(F.col("mean_recall") * 1.6).alias("r"))
    judged = levels.withColumn("verdict", clean.verdict(F.col("p"), F.col("r")))
    return judged.withColumns({"alert": clean.verdict_alert("verdict"), "tag": F.lower("p")})


# Cleaning

_AMOUNTS = f"""s AS ({SALARIES}), a AS (SELECT *, list_sort([CAST(replace(replace(x, '£', ''), ',', '') AS DOUBLE) FOR x IN regexp_extract_all(salary, '£[0-9]?[0-9][0-9],[0-9][0-9][0-9]')]) AS v FROM s),
  b AS (SELECT *, len(v) BETWEEN 1 AND 2 AND coalesce(v[1] >= 8000, FALSE) AS good FROM a),
  c AS (SELECT *, CASE WHEN good THEN v[1] END AS lo, CASE WHEN good THEN v[-1] END AS hi, (len(v) = 0 AND regexp_matches(salary, '[0-9]')) OR (len(v) > 0 AND NOT good) AS bad FROM b)"""


@query(f"WITH {_AMOUNTS} SELECT jobid, lo AS salary_min, hi AS salary_max, (lo + hi) / 2 AS salary_median, bad AS invalid FROM c")
def salary_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = salaries(spark, sf_dir).select("jobid", clean.salary("salary").alias("s"))
    return s.select("jobid", F.col("s.min").alias("salary_min"), F.col("s.max").alias("salary_max"), clean.median_salary("s.min", "s.max").alias("salary_median"), F.col("s.invalid").alias("invalid"))


@query(f"""WITH {_AMOUNTS} SELECT jobid, contract, salary_min, salary_max, array_to_string(list_sort(codes), ',') AS invalid_code FROM (SELECT jobid, trim(contract) AS contract, lo AS salary_min, hi AS salary_max,
  list_filter([CASE WHEN lower(trim(contract)) IN ('', 'not specified') THEN 'contract' END, 'closes', 'description', 'hours', 'job_title', 'location', 'placed_on', 'subject_area',
    CASE WHEN lo IS NULL THEN 'salary' END], lambda x: x IS NOT NULL) AS codes FROM c)""")
def validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.clean_rows(salaries(spark, sf_dir).withColumn("jobid", F.col("jobid").cast("string")))
    return rows.select(F.col("jobid").cast("long").alias("jobid"), "contract", "salary_min", "salary_max", F.array_join("invalid_code", ",").alias("invalid_code"))


@query(f"""WITH s AS ({SALARIES}), u AS (SELECT jobid, 'contract' AS missing FROM s WHERE lower(trim(contract)) IN ('', 'not specified')) SELECT * FROM u""")
def dry_run_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.missing_attributes(salaries(spark, sf_dir), "jobid", ["contract", "salary"])


_SLUG = r"replace(rtrim(regexp_replace(lower({c}), '[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]', ' ', 'g')), ' ', '_')"


@query("SELECT p_partkey, " + _SLUG.format(c="p_name || ' / (' || p_type || '):'") + " AS slug FROM part")
def key_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", clean.heading_slug(F.concat("p_name", F.lit(" / ("), "p_type", F.lit("):"))).alias("slug"))


@query(f"""WITH j AS ({JOBS}) SELECT jobid, 'nloc_' || regexp_replace(lower(replace(replace(extra_location, '&', ''), ',', '')), ' +', '_', 'g') AS slug,
  CASE WHEN extra_location IN ({", ".join(f"'{r}'" for r in clean.UK_REGIONS)}) THEN TRUE END AS in_uk FROM j""")
def location_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).select("jobid", clean.location_slug("extra_location").alias("slug"), clean.in_uk("extra_location").alias("in_uk"))


@query("""SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'closes' WHEN 1 THEN 'job_title' WHEN 2 THEN 'placed_on' WHEN 3 THEN 'location' ELSE lower(n_name) END AS key FROM nation""")
def key_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE n_nationkey % 5 WHEN 0 THEN 'Expires ' WHEN 1 THEN 'Name' WHEN 2 THEN 'Placed On' WHEN 3 THEN 'location_s' ELSE n_name END")
    return table(spark, sf_dir, "nation").select("n_nationkey", clean.matching_key(raw).alias("key"))


@query("""WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_custkey % 60 AS INTEGER) AS b FROM orders)
  SELECT o_orderkey, strftime(a, '%Y-%m-%d') AS placed_on, strftime(b, '%Y-%m-%d') AS closes, CAST(b - a AS BIGINT) AS days FROM d""")
def dates_and_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in four ways and read again."""
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"), F.expr("date_add(to_date(o_orderdate), cast(o_custkey % 60 as int))").alias("b"))
    written = d.select("o_orderkey", F.expr("CASE o_orderkey % 4 WHEN 0 THEN date_format(a, 'yyyy-MM-dd') WHEN 1 THEN date_format(a, 'd/M/yyyy') WHEN 2 THEN concat(date_format(a, 'd'), 'th ', date_format(a, 'MMMM yyyy')) ELSE date_format(a, 'd MMM, yyyy') END").alias("p"), F.date_format("b", "d MMMM yyyy").alias("c"))
    read = written.select("o_orderkey", clean.parse_date("p").alias("p"), clean.parse_date("c").alias("c"))
    return read.select("o_orderkey", F.date_format("p", "yyyy-MM-dd").alias("placed_on"), F.date_format("c", "yyyy-MM-dd").alias("closes"), clean.duration_days("p", "c").cast("long").alias("days"))


@query(f"""WITH j AS ({JOBS}) SELECT CAST(count_if(probability BETWEEN 0 AND 1 AND probability_lower BETWEEN 0 AND 1 AND probability_upper BETWEEN 0 AND 1) AS BIGINT) AS valid,
  CAST(count_if(contract = 'FixedTerm') AS BIGINT) AS fixed_term, CAST(count_if(contract IS NULL) AS BIGINT) AS no_contract FROM j""")
def prediction_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = jobs(spark, sf_dir).withColumn("contract", clean.contract_type("contract"))
    return j.agg(F.count_if(clean.valid_prediction()).alias("valid"), F.count_if(F.col("contract") == "FixedTerm").alias("fixed_term"), F.count_if(F.col("contract").isNull()).alias("no_contract"))


_RANK = "CASE {c} WHEN 'No' THEN 1 WHEN 'Some' THEN 2 WHEN 'Most' THEN 3 END"


@query(f"WITH r AS ({RATINGS}) SELECT jobid, " + ", ".join(f"CAST({_RANK.format(c=f'tags_{i}')} AS INTEGER) AS coder{i}" for i in (1, 2, 3)) + " FROM r")
def reliability_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir).select("jobid", *[clean.rating(f"tags_{i}").alias(f"coder{i}") for i in (1, 2, 3)])


@query(f"""WITH r AS ({RATINGS}), u AS (SELECT jobid, {", ".join(f"{_RANK.format(c=f'tags_{i}')} AS c{i}" for i in (1, 2, 3))} FROM r),
  l AS (SELECT jobid, c1 AS v, 1 AS k FROM u UNION ALL SELECT jobid, c2, 2 FROM u UNION ALL SELECT jobid, c3, 3 FROM u), f AS (SELECT *, count(*) OVER (PARTITION BY jobid) AS m FROM l WHERE v IS NOT NULL),
  o AS (SELECT a.v AS a, b.v AS b, sum(1.0 / (a.m - 1)) AS o FROM f a JOIN f b ON a.jobid = b.jobid AND a.k <> b.k GROUP BY 1, 2), n AS (SELECT a AS v, sum(o) AS n FROM o GROUP BY 1), t AS (SELECT sum(n) AS t FROM n),
  d AS (SELECT x.v AS a, y.v AS b, x.n * y.n AS e, power((SELECT sum(n) FROM n WHERE v BETWEEN x.v AND y.v) - (x.n + y.n) / 2, 2) AS d FROM n x JOIN n y ON x.v < y.v)
  SELECT round(1 - ((SELECT t FROM t) - 1) * sum(coalesce(o.o, 0) * d.d) / sum(d.e * d.d), 6) AS alpha FROM d LEFT JOIN o ON o.a = d.a AND o.b = d.b""")
def rater_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.alpha_ordinal(reliability_matrix(spark, sf_dir), ["coder1", "coder2", "coder3"]))


# Pages


@query("""WITH p AS (SELECT page_id, list_filter(string_split(split_part(url, '://', 2), '/'), lambda x: x <> '') AS parts FROM pages)
  SELECT page_id, CASE WHEN len(parts) = 3 THEN parts[2] END AS jobid, CASE WHEN len(parts) = 3 THEN parts[3] END AS name, CASE WHEN len(parts) = 3 THEN 'https://jobs.example/' || array_to_string(parts, '/') END AS url FROM p""")
def url_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", html.split_job_url("https://jobs.example/", F.try_element_at(F.split("url", "://", 2), F.lit(2))).alias("j"))
    return p.select("page_id", "j.jobid", "j.name", "j.url")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent.deeper') AS absent FROM events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", html.json_path("props", "k").alias("k"), html.json_path("props", "absent.deeper").alias("absent"))


@query()
def page_title_h1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.page_fields("html").alias("p")).select("page_id", F.col("p.name").alias("job_title"), "p.enhanced")


@query()
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(html.tag_texts("html", "p")).alias("place", "paragraph"))


@query()
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(html.tag_texts("html", "a")).alias("link_text"))


@query()
def parsed_adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = page_source.pages_from(table(spark, sf_dir, "pages"), "page_id", "html")
    return html.parse_adverts(pages, "2024-06-01").select("jobid", "job_title", "description", "enhanced", "invalid_code", "date")


@query("SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def dedup_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return load.insert_new(d, table(spark, sf_dir, "labels"), "doc_id")


@query("""WITH s AS (SELECT o_orderkey AS jobid, 'a' AS snapshot, 1.0 AS probability FROM orders WHERE o_orderkey % 3 = 0), n AS (SELECT o_orderkey AS jobid, 'a' AS snapshot, 0.5 AS probability FROM orders WHERE o_orderkey % 2 = 0)
  SELECT jobid, snapshot, CAST(probability AS DOUBLE) AS probability FROM n UNION ALL SELECT jobid, snapshot, CAST(probability AS DOUBLE) FROM s WHERE jobid NOT IN (SELECT jobid FROM n)""")
def prediction_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("jobid"), F.lit("a").alias("snapshot"))
    return predict.upsert(o.where("jobid % 3 = 0").withColumn("probability", F.lit(1.0)), o.where("jobid % 2 = 0").withColumn("probability", F.lit(0.5)))


@query(f"WITH j AS ({JOBS}) SELECT l.doc_id AS jobid, j.job_title, j.probability FROM labels l JOIN j ON j.jobid = l.doc_id")
def prediction_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("jobid"))
    return scoring.enriched(p, jobs(spark, sf_dir).withColumn("description", F.lit("long"))).select("jobid", "job_title", "probability")


@query(f"WITH j AS ({JOBS}) SELECT doc_id AS jobid FROM labels WHERE doc_id NOT IN (SELECT jobid FROM j)")
def prediction_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.orphans(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("jobid")), jobs(spark, sf_dir))


# Text

_WORDS = "list_filter(regexp_split_to_array(lower({c}), '[^a-z]+'), lambda x: length(x) >= {n})"


@query(f"SELECT doc_id, CAST(len({_WORDS.format(c='text', n=1)}) AS INTEGER) AS n_tokens, array_to_string({_WORDS.format(c='text', n=1)}[1:5], ' ') AS head FROM documents")
def text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", text.ascii_words("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.array_join(F.slice("t", 1, 5), " ").alias("head"))


@query(f"SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_WORDS.format(c='text', n=2)}) AS word FROM documents) WHERE word NOT IN ({', '.join(repr(w) for w in text.STOP_WORDS)}) GROUP BY 1")
def token_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.remove_stop_words(text.ascii_words("text", 2))
    return table(spark, sf_dir, "documents").select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, sha256(regexp_replace(text, '([a-z0-9!#$%&''*+/=?^_`{|}~-]+(?:\.[a-z0-9!#$%&''*+/=?^_`{|}~-]+)*(@|\sat\s)(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(\.|\sdot\s))+[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)', '', 'g')) AS digest FROM documents""")
def email_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.remove_email("text"), 256).alias("digest"))


@query()
def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.clean_text("text"), " ").alias("cleaned"))


_TERMS = ["the", "tion", "the", "Research", "and "]


@query("SELECT doc_id, CAST(" + " + ".join(f"CASE WHEN contains(text, '{t}') THEN 1 ELSE 0 END" for t in dict.fromkeys(_TERMS)) + " AS INTEGER) AS hits, CAST(length(text) AS DOUBLE) AS chars FROM documents")
def count_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", features.count_terms("text", _TERMS).alias("hits"), features.text_length("text").alias("chars"))


# Term ranking and features

_GRAMS = "list_concat({w}, [array_to_string({w}[i:i + 1], ' ') FOR i IN range(1, len({w}))])"
_COUNTS = f"""t AS ({TRAINING}), w AS (SELECT jobid, aggregate_tags AS y, {_WORDS.format(c="description", n=2)} AS w FROM t), g AS (SELECT jobid, y, unnest(list_distinct({_GRAMS.format(w="w")})) AS ngram FROM w),
  c AS (SELECT ngram, count(*) AS f, sum(y) AS j, (SELECT count(*) FROM t) AS n, (SELECT sum(aggregate_tags) FROM t) AS n1 FROM g GROUP BY 1)"""
_H = "(({j} + 1) / ({f} + 2) * log2(({f} + 2) / ({j} + 1)))"
_INFORMATION = f"""{_COUNTS}, i AS (SELECT ngram, (f + 1) / (n + 2) * ({_H.format(j="j", f="f")} + {_H.format(j="(f - j)", f="f")})
    + (n - f + 1) / (n + 2) * ({_H.format(j="(n1 - j)", f="(n - f)")} + {_H.format(j="(n - f - (n1 - j))", f="(n - f)")}) AS information FROM c)"""


def _information(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training(spark, sf_dir).withColumn("terms", text.ngrams(text.ascii_words("description", 2)))
    return information.term_counts(rows, "terms", "aggregate_tags")


@query(f"WITH {_INFORMATION} SELECT ngram, round(information, 6) AS information FROM i")
def ngram_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(information.information(_information(spark, sf_dir)))


@query(f"WITH {_INFORMATION}, r AS (SELECT ngram, information, dense_rank() OVER (ORDER BY round(information, 10)) AS rank FROM i) SELECT ngram, round(information, 6) AS information, rank FROM r WHERE rank <= 20")
def info_top_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = information.ranked(information.information(_information(spark, sf_dir)), digits=10)
    return _rounded(information.till_rank(ranked, 20).select("ngram", "information", "rank"))


@query(f"WITH {_INFORMATION}, r AS (SELECT ngram, dense_rank() OVER (ORDER BY round(information, 10)) AS rank FROM i) SELECT ngram, rank FROM r WHERE rank >= (SELECT max(rank) FROM r) - 2")
def info_bottom_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = information.ranked(information.information(_information(spark, sf_dir)), digits=10)
    return information.till_rank(ranked, -3).select("ngram", "rank")


@query(f"WITH {_COUNTS} SELECT ngram, CAST(n - f AS BIGINT) AS absent, CAST(f AS BIGINT) AS present, CAST(n - f - (n1 - j) AS BIGINT) AS absent_0, CAST(n1 - j AS BIGINT) AS absent_1, CAST(f - j AS BIGINT) AS present_0, CAST(j AS BIGINT) AS present_1 FROM c")
def ngram_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return information.contingency(_information(spark, sf_dir))


_MOST = 500


@query(f"""WITH t AS ({TRAINING}), g AS (SELECT jobid, unnest({_WORDS.format(c="description", n=2)}) AS term FROM t), r AS (SELECT jobid, term, count(*) AS c FROM g GROUP BY 1, 2),
  v AS (SELECT term, sum(c) AS total, count(*) AS df FROM r GROUP BY 1 ORDER BY total DESC, term LIMIT {_MOST}), i AS (SELECT term, ln((1 + (SELECT count(*) FROM t)) / (1 + df)) + 1 AS idf FROM v),
  w AS (SELECT jobid, r.term, (1 + ln(c)) * idf AS w FROM r JOIN i ON r.term = i.term) SELECT jobid, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY jobid)), 6) AS weight FROM w""")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training(spark, sf_dir).select("jobid", F.col("jobid").alias("_row"), text.ascii_words("description", 2).alias("terms"))
    return _rounded(features.tfidf(rows, "jobid", "terms", features.vocabulary(rows, "terms", _MOST)))


@query()
def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature set of the models at its own blocks: words and word pairs, 24 000 of description and all of job_title."""
    # The training view's rows; titles are cut before the join, so that their vocabulary does not shuffle whole texts.
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_row"), F.col("text").alias("description"), F.substring("text", 1, 60).alias("job_title"))
    rows = texts.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_row")), "_row")
    found = features.ResearchSoftware().fit(rows).parts(rows, dealt=True)
    return found.select(F.col("_row").alias("jobid"), "size", "indices", F.transform("weights", lambda w: F.round(w, 6)).alias("weights"))


# Folds, samples, scores


@query("""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)
  SELECT doc_id, quality, CAST(CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1) ELSE n % 5 + (r - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS INTEGER) AS fold FROM r""")
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_folds(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)
  SELECT doc_id, quality, r <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test FROM r""")
def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_split(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id", seed=None)


@query("SELECT quality, (SELECT max(c) FROM (SELECT count(*) AS c FROM labels GROUP BY quality)) AS n FROM labels GROUP BY quality")
def oversampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.oversampled(table(spark, sf_dir, "labels"), "quality", "doc_id").groupBy("quality").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT doc_id % 5 AS fold, quality AS y, (doc_id * 7919 % 101) / 101.0 AS p FROM labels), c AS (SELECT fold, count_if(y = 1 AND p > 0.5) AS tp, count_if(y = 0 AND p > 0.5) AS fp, count_if(y = 1 AND p <= 0.5) AS fn, count_if(y = 0 AND p <= 0.5) AS tn FROM s GROUP BY 1),
  a AS (SELECT x.fold, sum(CASE WHEN x.p > z.p THEN 1 WHEN x.p = z.p THEN 0.5 ELSE 0 END) / count(*) AS roc_auc FROM s x JOIN s z ON x.fold = z.fold AND x.y = 1 AND z.y = 0 GROUP BY 1)
  SELECT c.fold, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(roc_auc, 6) AS roc_auc FROM c JOIN a ON a.fold = c.fold""")
def cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "labels").select((F.col("doc_id") % 5).alias("fold"), F.col("quality").alias("label"), (F.col("doc_id") * 7919 % 101 / 101).alias("probability"))
    return _rounded(sampling.binary_scores(s.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), ["fold"]))


@query(f"WITH j AS ({JOBS}) SELECT CASE WHEN probability_lower > 0.5 THEN 'positive' ELSE 'negative' END AS job_type, CAST(count(*) AS BIGINT) AS n FROM j WHERE NOT contains(job_title, 'PhD') GROUP BY 1")
def partition_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.partition_jobs(jobs(spark, sf_dir)).groupBy("job_type").agg(F.count("*").alias("n"))


@query()
def partition_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.partition_jobs(jobs(spark, sf_dir), 50, seed=3).select("jobid", "job_type", "probability_lower")


@query("SELECT CAST(i AS BIGINT) AS place, CAST(10 + 10 * i AS DOUBLE) AS value FROM range(0, 10) t(i)")
def range_dsl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(train.expand("=10:101:10"))], "place long, value double")


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: 1 / (1 + F.exp(-4 * x.cast("double")))).alias("members"))


@query("SELECT vec_id, round(list_avg([1 / (1 + exp(-4 * CAST(x AS DOUBLE))) FOR x IN embedding]), 6) AS probability FROM embeddings")
def ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir).select("vec_id", F.round(F.aggregate("members", F.lit(0.0), lambda a, x: a + x) / F.size("members"), 6).alias("probability"))


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir).select("vec_id", scoring.bootstrap_interval("members", 64).alias("ci")).select("vec_id", "ci.*")


def _labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("_row"), (F.col("label") % 2).cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def damaged_parts(parts: DataFrame) -> DataFrame:
    """p_partkey, full (name, brand and type) and damaged: full without one of its characters."""
    full = parts.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("full"))
    at = (F.col("p_partkey") * 7 % F.length("full")).cast("int")
    return full.withColumn("damaged", F.concat(F.substring("full", F.lit(1), at), F.substring(F.col("full"), at + 2, F.length("full"))))


@query()
def closest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's damaged description with the most similar of all descriptions."""
    parts = damaged_parts(table(spark, sf_dir, "part"))
    names = parts.select(F.col("full").alias("name"), F.col("p_partkey").alias("position"))
    return clean.closest_match(parts.select("p_partkey", "damaged"), "damaged", names, "closest")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR, '%Y-%m-%d') END AS earliest FROM orders""")
def advert_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest date named by a notice of each order, 25 years on: written in one of four ways, with a later one of another form, or none."""
    d = F.add_months(F.col("o_orderdate").cast("date"), 300)
    forms = ["'the 'd' of 'MMMM, yyyy", "MMM d yyyy", "dd/MM/yyyy", "yyyy-MM-dd"]
    said = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == i, F.date_format(d, f)) for i, f in enumerate(forms)])
    closes = F.date_format(F.date_add(d, 30), "EEEE d MMMM yyyy")
    notice = F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.lit("Ref 12/34, may close 3 March, grade "), F.col("o_orderpriority"))).otherwise(F.concat(F.lit("Closes "), closes, F.lit(" at 17:00; posted "), said, F.lit(" by post 7a.")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(html.earliest_date(notice), "yyyy-MM-dd").alias("earliest"))


@query()
def train_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested cross-validation of logistic regression over its whole grid."""
    return train.nested_cross_validation(_labelled_vectors(spark, sf_dir), ["LogReg"], "f1")[0]


@query()
def ensemble_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred members on seeded splits, fitted as columns of one matrix, scored by one product a batch, with bootstrap intervals."""
    rows = sampling.split_parts(_labelled_vectors(spark, sf_dir), "label", "_row", 100).persist()
    sizes = logistic.part_sizes(rows, 100)
    model = lambda m: train.get_model("LogReg", {"C": 1.0, "class_weight": "balanced"}, int(sizes[:, m].sum()))
    fitted = logistic.fit_many(rows, [(m, model(m)) for m in range(100)], sizes, rows.select(F.max(F.size(vector_to_array("features")))).first()[0] or 0)
    rows.unpersist()
    scored = logistic.probabilities(_labelled_vectors(spark, sf_dir).withColumnRenamed("_row", "vec_id"), fitted, ["vec_id"])
    return scored.select("vec_id", scoring.bootstrap_interval("members", 100).alias("ci")).select("vec_id", "ci.*")


@query()
def svc_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A support vector machine with a radial basis kernel on all labelled vectors, and its margins and probabilities of the same."""
    rows = _labelled_vectors(spark, sf_dir)
    model = train.get_model("SVC", {"C": 1.0, "gamma": 1.0, "class_weight": "balanced"}, rows.count()).fit(rows)
    return model.transform(rows).select(F.col("_row").alias("vec_id"), "margin", "probability")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
