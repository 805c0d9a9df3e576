"""Extendible hashing: shards named by hash-prefix bits.

Depth 0 is one bucket with everything; a bucket over its byte limit splits on the next bit, and only such a bucket does, until
every bucket fits or holds one document. Bits come STEP at a time: a round sums bytes by the prefix at its deepest bit (partial
sums before the shuffle), adds these up to every shallower prefix (at most 2**STEP rows a prefix), and gives each deepest
prefix the shallowest depth that fits. Only documents under prefixes that still overflow enter the next round. DataFrame
functions throughout.

Defined results: a null text has 0 bytes; a document over the limit has a shard of its own; repeated rows (same doc_id and size)
hash by their copy number, so that they can part; a null doc_id hashes as the word null; an empty table gives no rows; other
columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

BITS = 60
STEP = 12


def assign_shards(docs: DataFrame, limit_bytes: int) -> DataFrame:
    """doc_id, n_bytes, shard (its bits as text), depth, shard_bytes, shard_docs: one row per document row."""
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    copies = sizes.groupBy("doc_id", "n_bytes").count().select("doc_id", "n_bytes", F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("copy"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "n_bytes", "copy")
    active = materialise(copies.select("doc_id", "n_bytes", F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long").alias("h")))
    done = None
    for low in range(0, BITS, STEP):
        high = low + STEP
        deepest = F.shiftright("h", BITS - high)
        sums = active.groupBy(deepest.alias("p")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        depths = sums.select("p", "b", "n", F.explode(F.sequence(F.lit(low if not low else low + 1), F.lit(high))).alias("depth"))
        at = W.partitionBy("depth", F.expr(f"shiftright(p, {high} - depth)"))
        fits = depths.select("p", "depth", F.sum("b").over(at).alias("shard_bytes"), F.sum("n").over(at).alias("shard_docs"))
        fits = fits.where((F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1) | ((F.lit(high) >= BITS) & (F.col("depth") == BITS)))
        leaves = fits.groupBy("p").agg(F.min(F.struct("depth", "shard_bytes", "shard_docs")).alias("leaf"))
        placed = materialise(active.withColumn("p", deepest).join(leaves, "p", "left").select("doc_id", "n_bytes", "h", "leaf"))
        part = placed.where("leaf is not null")
        done = part if done is None else done.unionByName(part)
        active = placed.where("leaf is null").drop("leaf")
        if active.isEmpty():
            break
    bits = F.lpad(F.conv(F.col("h").cast("string"), 10, 2), BITS, "0")
    return done.select("doc_id", "n_bytes", F.substring(bits, F.lit(1), F.col("leaf.depth")).alias("shard"), F.col("leaf.depth").cast("long").alias("depth"), F.col("leaf.shard_bytes").alias("shard_bytes"), F.col("leaf.shard_docs").alias("shard_docs"))
