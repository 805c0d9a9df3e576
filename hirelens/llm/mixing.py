"""Mix sources to target weights.

Sizes (ASCII words) are counted once; targets are shared by weight over the sources, none above its cap, by water filling.
A source's whole passes come first; what its target leaves is a subset sum over the exact counts of its document lengths: a
proportional part of every length, then a bounded-knapsack dynamic program for the last RESERVE words. Documents are then picked
per (source, length) in the order of a seeded hash. The rank in that order is the count of lower hash buckets plus the
rank within the own bucket; with sqrt(documents) buckets no group is larger than sqrt(documents) or a bucket's share, so a
source or a length that holds a third of all rows is not gathered in one task. What one task holds together is the length counts of one source (as
many as it has distinct lengths) and the list of sources.

Defined results: a null text has size 0; a null source is a source of its own, last in order; repeated rows are ranked apart;
an empty table gives no rows; other columns are kept in row, so their names cannot clash; a
very long text is a step of its own when words are counted; documents of size 0 follow their source's whole passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, materialise, word_bounds

#: Words that the dynamic program fits exactly, at the end of every target.
RESERVE = 1 << 16


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches):
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(word_bounds(data, offsets)[2]), pa.int64())], names=["row", "size"])


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, reserve: int = RESERVE) -> np.ndarray:
    """How many documents of each length to take so that their words come as near below the budget as the lengths allow."""
    take = np.zeros(len(sizes), np.int64)
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    share = max(0.0, (budget - reserve) / total)
    carry = 0.0
    for i in np.argsort(-sizes, kind="stable"):
        size, n = int(sizes[i]), int(counts[i])
        if size:
            carry += share * n * size
            take[i] = min(n, int(carry // size))
            carry -= float(take[i] * size)
    rest = budget - int((take * sizes).sum())
    left = counts - take
    reached = np.zeros(rest + 1, bool)
    reached[0] = True
    by = np.full(rest + 1, -1, np.int32)
    items: list[tuple[int, int]] = []
    for i in np.argsort(sizes, kind="stable"):
        size, n, k = int(sizes[i]), int(left[i]), 1
        while n and 0 < size <= rest and not reached[rest]:
            k = min(k, n)
            step = k * size
            if step > rest:
                break
            new = reached[:-step] & ~reached[step:]
            if new.any():
                by[step:][new] = len(items)
                reached[step:] |= new
                items.append((int(i), k))
            n -= k
            k *= 2
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, k = items[by[at]]
        take[i] += k
        at -= k * int(sizes[i])
    return take


def targets(by_source: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """by_source (key, source, source_size) with its target: share times all sizes by weight, excess over the cap reshared."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(1))
    weighted = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    weighted = weighted.withColumn("most", F.lit(cap) * F.col("source_size"))
    filling = W.partitionBy(F.lit(1)).orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(everything) - before) / weight_left
    leveled = weighted.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("most"))
    first = F.min(F.when(~F.col("full"), F.struct((F.col("most") / F.col("weight")).alias("r"), "level"))).over(everything)["level"]
    return leveled.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(first * F.col("weight"))).select("key", "source_size", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """row (a struct of the input's columns without text), size, source_size, target, copies (how often the mix takes it)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"), "text")
    row_type = rows.schema["row"].dataType.simpleString()
    source, doc_id = F.col("row.source"), F.col("row.doc_id").cast("long")
    key: Column = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), source.cast("string")))
    base = materialise(rows.mapInArrow(_sizes, f"row {row_type}, size long").select("row", "size", key.alias("key"), F.xxhash64(F.lit(seed), doc_id).alias("h")))
    buckets = max(1, int(np.ceil(np.sqrt(base.count()))))
    base = base.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    cells = materialise(base.groupBy("key", "size", "bucket").count())
    counts = cells.groupBy("key", "size").agg(F.sum("count").alias("n"))
    sources = counts.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = sources.withColumn("source", F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)))
    plan = targets(sources, weights, share, cap)
    plan = plan.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = materialise(plan.withColumn("budget", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        budget = int(part["budget"].iloc[0])
        part["extra"] = fit_counts(part["size"].to_numpy(), part["n"].to_numpy(), budget)
        return part[["key", "size", "extra"]]

    extras = counts.join(plan, "key").groupBy("key").applyInPandas(fit, "key string, size long, extra long")
    below = W.partitionBy("key", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.withColumn("below", F.coalesce(F.sum("count").over(below), F.lit(0))).drop("count")
    starts = starts.join(extras, ["key", "size"]).join(plan, "key")
    own = W.partitionBy("key", "size", "bucket").orderBy("h", doc_id, F.to_json("row"))
    ranked = base.withColumn("rank", F.row_number().over(own)).join(starts, ["key", "size", "bucket"])
    taken = F.col("passes") + (F.col("rank") + F.col("below") <= F.col("extra")).cast("long")
    return ranked.select("row", "size", "source_size", "target", taken.alias("copies"))
