"""Connected components of a link table, and a bounded bitmap that thins a table before a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release

#: Words of the bitmap, 64 bits each: a fixed 2**25 bits, so many of them in a row: at most about 9 MB when broadcast, in 2**15
#: rows. A row a word took the driver 21 MB, and more while it was collected and hashed.
BITMAP_WORDS = 1 << 19
ROW_WORDS = 16


def thinned(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """df without most of the rows whose column is no key. The bitmap has a fixed size, so its broadcast is bounded whatever the
    number of keys; more keys only let more rows pass. A join on the keys has to follow."""
    bits = BITMAP_WORDS * 64
    at = keys.select(F.pmod(F.xxhash64(F.col(key)), F.lit(bits)).alias("_place"))
    words = at.selectExpr("_place div 64 AS _word", "shiftleft(1L, cast(pmod(_place, 64) as int)) AS _bit").groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    lines = words.groupBy(F.expr(f"_word div {ROW_WORDS}").alias("_line")).agg(*(F.expr(f"bit_or(if(pmod(_word, {ROW_WORDS}) = {i}, _bits, 0L))").alias(f"_bits{i}") for i in range(ROW_WORDS)))
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    marked = df.withColumn("_place", place).withColumn("_line", F.expr(f"_place div {64 * ROW_WORDS}"))
    word = "CASE cast(pmod(_place div 64, {}) as int) {} END".format(ROW_WORDS, " ".join(f"WHEN {i} THEN _bits{i}" for i in range(ROW_WORDS)))
    hit = marked.join(F.broadcast(lines), "_line").where(F.expr(f"shiftright({word}, cast(pmod(_place, 64) as int)) & 1 = 1"))
    return hit.select(*df.columns)


def components(links: DataFrame) -> DataFrame:
    """node, root (one node of its component, the same for all of it) for every node of links (a, b).

    Each round every remaining group takes the first of its neighbours and itself as parent, follows parents twice, and the links are
    contracted; nothing is collected, and each round's labels are written out. First is by value in even rounds, which ends stars in
    two of them, and by a hash of the round in odd ones, so that no chain of ascending values lasts: the rounds grow with the logarithm.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.where("a <> b").distinct())
    labels, turn = None, 0
    while True:
        parents = materialise(_parents(edges, turn))
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
        before, labels = labels, parents if labels is None else materialise(labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        # The links' ends are names of this round's groups, so the round's parents rename them, as they rename the labels.
        left = parents.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = parents.select(F.col("node").alias("b"), F.col("root").alias("y"))
        spent, edges = edges, materialise(edges.join(left, "a").join(right, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        release(spent, *([before, parents] if before is not None else []))
        if edges.isEmpty():
            return labels
        turn += 1


def _parents(edges: DataFrame, turn: int) -> DataFrame:
    """node, root: each node's parent of this round, followed twice."""
    order = lambda c: F.struct((F.xxhash64(c, F.lit(turn)) if turn % 2 else F.col(c)).alias("place"), F.col(c).alias("at"))
    first = edges.groupBy("a").agg(F.min(order("b")).alias("first"))
    return _jump(_jump(first.select(F.col("a").alias("node"), F.least(order("a"), "first")["at"].alias("root"))))


def _jump(parents: DataFrame) -> DataFrame:
    up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
    return parents.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
