"""The registered queries of this subpackage and, where DuckDB can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, line_dedup, mixing, ngram_join, piece_codec, quality, sharding, substring_dedup, suffix_dedup, token_counts, topk, url_filter, whitening

#: (verdict, host, path) of the registered URL query: fixed values.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
#: Bytes of text in one shard of the registered sharding query.
SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def piece_model_path() -> str:
    return _tokenizer_path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.verdicts(_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_documents(_table(spark, sf_dir, "documents"), piece_model_path())


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer_path("byte_bpe_50k.json"), limit=512)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(_table(spark, sf_dir, "conversations")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_threshold_topk": op2_threshold_topk,
        "op3_extendible_sharding": op3_extendible_sharding,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_line_dedup": op5_line_dedup,
        "op6_ngram_join": op6_ngram_join,
        "op7_quality_rules": op7_quality_rules,
        "op8_url_rules": op8_url_rules,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_piece_codec": op10_piece_codec,
        "op11_token_counts": op11_token_counts,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_whitening": op13_whitening,
    }


_TOP_K = """
WITH v AS (SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 5
"""

_SHARDS = f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes FROM documents),
c AS (SELECT doc_id, n_bytes, row_number() OVER (PARTITION BY doc_id, n_bytes) AS copy FROM d),
h AS (SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'null'), n_bytes, copy)), 1, 15) AS BIGINT) AS h, copy FROM c),
e AS (SELECT h.*, CAST(t.depth AS BIGINT) AS depth, h >> CAST(60 - t.depth AS INTEGER) AS p FROM h, range(0, 41) t(depth)),
s AS (SELECT *, CAST(sum(n_bytes) OVER (PARTITION BY depth, p) AS BIGINT) AS shard_bytes, count(*) OVER (PARTITION BY depth, p) AS shard_docs FROM e),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n_bytes, copy ORDER BY depth) AS nth FROM s WHERE shard_bytes <= {SHARD_BYTES} OR shard_docs = 1)
SELECT doc_id, n_bytes, substr(lpad(bin(h), 60, '0'), 1, CAST(depth AS INTEGER)) AS shard, depth, shard_bytes, shard_docs FROM f WHERE nth = 1
"""

_SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, t.pos AS pos, array_to_string(words[t.pos:t.pos + 49], ' ') AS run FROM d, unnest(range(1, len(words) - 48)) t(pos)),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY run) < doc_id AS hit FROM w),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS at FROM f WHERE hit),
e AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM d),
k AS (SELECT e.doc_id, count(*) AS n_words, count(g.at) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY e.at) FILTER (WHERE g.at IS NULL), '') AS kept
  FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.at = g.at GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

_LINES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM d),
e AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM l),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
hot AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY doc_id
"""

_NGRAMS = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

_URLS = r"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_threshold_topk": _TOP_K,
        "op3_extendible_sharding": _SHARDS,
        "op4_substring_dedup": _SUBSTRINGS,
        "op5_line_dedup": _LINES,
        "op6_ngram_join": _NGRAMS,
        "op8_url_rules": _URLS,
    }
