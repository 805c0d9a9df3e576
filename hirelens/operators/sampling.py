"""Folds, splits, samples and oversampling, each decided by row keys and not by physical order.

All rank rows within groups; ranks are counted in ranges of the order, so that a group of half the rows is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Parts of an order that are ranked apart.
BUCKETS = 1024
#: Keys, about, that the ends of the parts are chosen from.
SAMPLE = 16384


def _seeded(seed: int | None, *keys: str) -> Column:
    return F.xxhash64(F.lit(seed), *keys) if seed is not None else F.lit(0)


def _ends(df: DataFrame, key: str) -> DataFrame:
    """One row, _ends: keys that cut the order of df's keys into about equal parts, from a sample of the keys by their hash. All keys that
    begin alike, or an outlier far from the others, do not make one part of all."""
    step = df.agg(F.greatest(F.floor(F.count("*") / SAMPLE), F.lit(1)).alias("_step"))
    chosen = df.select(key).crossJoin(F.broadcast(step)).where(F.pmod(F.xxhash64(key), F.col("_step")) == 0)
    sample = chosen.agg(F.array_sort(F.collect_set(key)).alias("_s"))
    at = F.sequence(F.lit(1), F.lit(BUCKETS - 1))
    return sample.select(F.when(F.size("_s") == 0, F.slice("_s", 1, 0)).otherwise(F.transform(at, lambda i: F.get("_s", F.floor(i * F.size("_s") / BUCKETS).cast("int")))).alias("_ends"))


def _part(key: str) -> Column:
    """How many of _ends are not above the key, by halving steps; none for a null key."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(BUCKETS.bit_length() - 1))])
    past = lambda at: F.coalesce(F.get("_ends", at - 1) <= F.col(key), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(past(at + step), at + step).otherwise(at))


def placed(df: DataFrame, by: list[str], key: str, seed: int | None = None, weight: str | None = None) -> DataFrame:
    """df with _place, the row's rank from 1 in its group, and _n, the group's rows: in seeded order or, without a seed, by key (null
    first). With a weight, _place is 1 and the weights of the rows before, and _n the group's weights.

    The order is cut into parts that ascend with it: the hash's high bits, or ranges between sampled keys. A rank is the count of the
    lower parts, from one aggregate, plus the rank in the own part.
    """
    order = [F.col(key)] if seed is None else [_seeded(seed, key), F.col(key)]
    if seed is not None:
        cut = df.withColumn("_b", F.shiftright(_seeded(seed, key), 64 - BUCKETS.bit_length() + 1).cast("int"))
    else:
        cut = df.crossJoin(F.broadcast(_ends(df, key))).withColumn("_b", _part(key)).drop("_ends")
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    counts = cut.groupBy(*by, "_b").agg(F.sum(one).alias("_c"))
    # A group has BUCKETS rows at most here; pmod by one is a partition of all where there is no group.
    groups = [F.col(c) for c in by] or [F.pmod("_b", F.lit(1))]
    upto = W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    below = counts.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_b").alias("_bb"), F.coalesce(F.sum("_c").over(upto), F.lit(0)).alias("_below"), F.sum("_c").over(W.partitionBy(*groups)).alias("_n"))
    same = F.expr(" AND ".join(["_b = _bb", *[f"`{c}` <=> _by{i}" for i, c in enumerate(by)]]))
    own = W.partitionBy(*by, "_b").orderBy(*order)
    rank = F.row_number().over(own) if weight is None else F.coalesce(F.sum(one).over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + 1
    ranked = cut.withColumn("_own", rank).join(below, same)
    return ranked.select(*df.columns, (F.col("_own") + F.col("_below")).alias("_place"), "_n")


def fold_of(place: Column, n: Column, k: int) -> Column:
    """The fold 0 .. k - 1 of a place from 0 among n: contiguous blocks, the first ones a row longer."""
    size, longer = F.floor(n / k), n % k
    in_longer = place < longer * (size + 1)
    fold = F.when(in_longer, F.floor(place / (size + 1))).otherwise(longer + F.floor((place - longer * (size + 1)) / F.greatest(size, F.lit(1))))
    return fold.cast("int")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5) -> DataFrame:
    """fold 0 .. k - 1: contiguous blocks of each label's rows in key order, the first ones a row longer."""
    return placed(df, [label], key).select(*df.columns, fold_of(F.col("_place") - 1, F.col("_n"), k).alias("fold"))


def nested_folds(df: DataFrame, label: str, key: str, k: int = 5) -> DataFrame:
    """df with fold, parts (array of double) and held (array of boolean), for nested cross-validation in one pass over the rows.

    Part s * k + j is search s without its inner fold j, and what is held for it is that fold; search s has the rows outside fold s,
    search k all. Part (k + 1) * k + s is all of search s, held is fold s. The inner folds are those that stratified_folds gives for the
    search's rows alone: fold s is one run of each label's places, so a row's place without it is a difference.
    """
    place, n = F.col("_place") - 1, F.col("_n")
    found = placed(df, [label], key).withColumn("fold", fold_of(place, n, k))
    inner = []
    for s in range(k):
        length = F.floor(n / k) + (F.lit(s) < n % k).cast("long")
        inner.append(F.when(F.col("fold") != s, fold_of(F.when(F.col("fold") < s, place).otherwise(place - length), n - length, k)))
    inner.append(F.col("fold"))
    none = lambda c: F.coalesce(c, F.lit(False))
    parts = [none(i != j) for i in inner for j in range(k)] + [F.col("fold") != s for s in range(k)]
    held = [none(i == j) for i in inner for j in range(k)] + [F.col("fold") == s for s in range(k)]
    return found.select(*df.columns, "fold", F.array(*[c.cast("double") for c in parts]).alias("parts"), F.array(*held).alias("held"))


def oversampled_parts(df: DataFrame, label: str, key: str, seed: int = 0) -> DataFrame:
    """df with parts such that both labels weigh the same in each: rows of the smaller one repeat in seeded order, as oversampled does."""
    long = df.select(key, label, F.posexplode("parts").alias("_part", "_times")).where("_times > 0")
    ranks = placed(long.select(key, label, "_part"), ["_part", label], key, seed)
    most = ranks.groupBy("_part", label).agg(F.max("_n").alias("_n")).groupBy("_part").agg(F.max("_n").alias("_most"))
    times = F.floor(F.col("_most") / F.col("_n")) + (F.col("_place") <= F.col("_most") % F.col("_n")).cast("long")
    again = ranks.join(most, "_part").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_part", times.cast("double").alias("_times")))).alias("_times"))
    kept = df.join(again, key, "left")
    return kept.withColumn("parts", F.transform("parts", lambda _, i: F.coalesce(F.try_element_at("_times", i), F.lit(0.0)))).drop("_times")


def split_parts(df: DataFrame, label: str, key: str, members: int, test_share: float = 0.2) -> DataFrame:
    """df with parts: for each seed 0 .. members - 1 whether stratified_split of that seed trains on the row, all splits in one pass."""
    long = df.select(key, label, F.explode(F.sequence(F.lit(0), F.lit(members - 1))).alias("_part"))
    # Ordered by the member's hash of the key, as a group's rows are; equal hashes are in the order of the second one.
    long = long.withColumn("_at", F.xxhash64("_part", key)).withColumn("_b", F.shiftright("_at", 64 - BUCKETS.bit_length() + 1).cast("int"))
    counts = long.groupBy("_part", label, "_b").count()
    upto = W.partitionBy("_part", label).orderBy("_b")
    taken = F.ceil(F.sum("count").over(W.partitionBy("_part", label)) * F.lit(test_share))
    below = F.coalesce(F.sum("count").over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # Parts wholly before or after the cut are decided by their counts; only the part of the cut is ranked.
    cuts = counts.withColumns({"_below": below, "_taken": taken}).where(F.col("_below") < F.col("_taken")).select(F.col("_part").alias("_p"), F.col(label).alias("_y"), F.col("_b").alias("_bb"), (F.col("_taken") - F.col("_below")).alias("_left"), "count")
    near = long.join(cuts, (F.col("_part") == F.col("_p")) & F.col(label).eqNullSafe(F.col("_y")) & (F.col("_b") == F.col("_bb")))
    place = F.row_number().over(W.partitionBy("_part", label, "_b").orderBy("_at", key))
    out = near.where(F.col("_left") >= F.col("count")).select(key, "_part").unionByName(near.where(F.col("_left") < F.col("count")).withColumn("_place", place).where(F.col("_place") <= F.col("_left")).select(key, "_part"))
    out = out.groupBy(key).agg(F.collect_list("_part").alias("_held"))
    every = F.sequence(F.lit(0), F.lit(members - 1))
    trained = F.transform(every, lambda m: F.when(F.array_contains(F.col("_held"), m), 0.0).otherwise(1.0))
    return df.join(out, key, "left").withColumn("parts", F.when(F.col("_held").isNull(), F.transform(every, lambda _: F.lit(1.0))).otherwise(trained)).drop("_held")


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int | None = 0) -> DataFrame:
    """is_test: of each label the share first in seeded (without a seed, key) order; the test part is rounded up."""
    return placed(df, [label], key, seed).select(*df.columns, (F.col("_place") <= F.ceil(F.col("_n") * F.lit(test_share))).alias("is_test"))


def oversampled(df: DataFrame, label: str, key: str, seed: int = 0) -> DataFrame:
    """Labels of equal size: rows of the smaller ones repeat in seeded order."""
    most = df.groupBy(label).count().agg(F.max("count").alias("_most"))
    ranked = placed(df, [label], key, seed).crossJoin(F.broadcast(most))
    times = F.floor(F.col("_most") / F.col("_n")) + (F.col("_place") <= F.col("_most") % F.col("_n")).cast("long")
    return ranked.withColumn("_times", times).withColumn("_t", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select(*df.columns)


def partition_jobs(predictions: DataFrame, n: int | None = None, seed: int | None = 0) -> DataFrame:
    """Rows without PhD in the title, with job_type positive where the lower bound is above a half; at most n of each, by seeded key."""
    kept = predictions.where(~F.col("job_title").contains("PhD")).withColumn("job_type", F.when(F.col("probability_lower") > 0.5, "positive").otherwise("negative"))
    return kept if n is None else placed(kept, ["job_type"], "jobid", seed).where(F.col("_place") <= n).select(*kept.columns)


def rates(counts: DataFrame, by: list[str]) -> DataFrame:
    """precision, balanced_accuracy, f1, recall from tp, fp, fn, tn; a ratio without cases is 0."""
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return counts.select(*by, z(tp, tp + fp).alias("precision"), ((z(tp, tp + fn) + z(tn, tn + fp)) / 2).alias("balanced_accuracy"), z(2 * tp, 2 * tp + fp + fn).alias("f1"), z(tp, tp + fn).alias("recall"))


def binary_scores(scored: DataFrame, by: list[str] | None = None, label: str = "label", prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """precision, balanced_accuracy, f1, recall, roc_auc per group; a ratio without cases is 0. The area is the share of (positive,
    negative) pairs in order, ties half, from counts per distinct probability."""
    by = by or []
    y, p = F.col(label) == 1, F.col(prediction) == 1
    c = scored.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    found = rates(c, by)
    levels = scored.groupBy(*by, probability).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    below = F.col("_place") - 1
    ranked = placed(levels, by, probability, weight="neg")
    won = ranked.withColumn("won", F.col("pos") * (below + F.col("neg") / 2)).groupBy(*by).agg(F.coalesce(F.try_divide(F.sum("won"), F.sum("pos") * F.sum("neg")), F.lit(0.0)).alias("roc_auc"))
    return found.join(won, by) if by else found.crossJoin(won)
