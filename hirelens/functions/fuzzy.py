"""The closest of many names by the share of matching characters (difflib's ratio), without comparing all pairs.

M matching characters of T in both texts are a ratio of 2 M / T. They bound what the texts share, whatever the order of the blocks:
M is at most the shorter length and at most the number of characters that the texts share (repeats counted), and as a gap between two
blocks has an unmatched character on one side at least, there are T - 2 M + 1 blocks at most, which leave 3 M - T - 1 pairs of
neighbouring characters whole. Texts of which one is the other without one of its characters meet first, on that text: nothing but
an equal text has a higher ratio, so a value that finds its best there goes no further. Other texts meet by an equi-join on the rarest of their pairs of neighbours, of which any two that can reach
the ratio share one; where that bound leaves no pair (short texts, low ratios), on the rarest of their characters. What passes the three
bounds gets the exact ratio.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..shared import release, written

# Shares in percent, tried one after the other: a value whose best name is found at a higher one goes no further.
TIERS = (100, 97, 92, 85)
# Frequencies of characters and of pairs are kept in so many counters, whatever the alphabet.
COUNTERS = 512
# Texts of so many characters meet those of one character less or more by the texts that are left without one of their characters.
SHORT, LONG = 4, 128


@F.pandas_udf(DoubleType())
def _ratio(values: pd.Series, names: pd.Series) -> pd.Series:
    matcher, last, out = difflib.SequenceMatcher(), None, []
    for value, name in zip(values, names, strict=True):
        if name != last:
            matcher.set_seq2(name)
            last = name
        matcher.set_seq1(value)
        out.append(matcher.ratio())
    return pd.Series(out, dtype=float)


def _numbered(parts: Column) -> Column:
    """Parts as a set: each with the number of its occurrence."""

    def number(ordered: Column) -> Column:
        return F.transform(ordered, lambda x, i: F.concat(x, (i + 2 - F.array_position(ordered, x)).cast("string")))

    # Sorted once: a one-element array gives it a name that the inner function can use.
    return F.get(F.transform(F.array(F.array_sort(parts)), number), F.lit(0))


def _shares(rows: DataFrame) -> DataFrame:
    """text with n (its characters), chars (as a set; of an empty text one mark of its own) and pairs of neighbours (as a set)."""
    rows = rows.withColumn("n", F.length("text")).withColumn("_c", F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)))
    pairs = F.transform(F.slice("_c", F.lit(1), F.greatest(F.col("n") - 1, F.lit(0))), lambda x, i: F.concat(x, F.get("_c", i + 1)))
    return rows.withColumns({"chars": F.when(F.col("n") == 0, F.array(F.lit(""))).otherwise(_numbered(F.col("_c"))), "pairs": _numbered(pairs)}).drop("_c")


def _counter(mark: Column) -> Column:
    return F.pmod(F.xxhash64(mark), F.lit(COUNTERS)).cast("int")


def _frequencies(names: DataFrame) -> dict[str, Column]:
    """Uses of each counter among the names' chars and pairs: COUNTERS numbers of each, however many names there are."""
    out = {}
    for kind in ("chars", "pairs"):
        found = dict(names.select(F.explode(kind).alias("c")).select(_counter(F.col("c")).alias("k")).groupBy("k").count().collect())
        out[kind] = F.array(*[F.lit(found.get(i, 0)).cast("long") for i in range(COUNTERS)])
    return out


def _rare_first(rows: DataFrame, frequencies: dict[str, Column]) -> DataFrame:
    def ordered(kind: str) -> Column:
        found = F.array_sort(F.transform(kind, lambda x: F.struct(F.get(frequencies[kind], _counter(x)).alias("uses"), x.alias("x"))))
        return F.transform(found, lambda x: x["x"])

    return rows.withColumns({kind: ordered(kind) for kind in frequencies})


def _marks(rows: DataFrame, percent: int) -> DataFrame:
    """rows with rare: the marks of which any two texts that reach the ratio share one.

    A text of n characters shares least characters with any other, which so has least characters or more, and
    (n + least) (3 percent / 200 - 1) - 1 pairs. Texts that share a pair by this bound meet on pairs, and those that may meet a text
    for which it gives none on characters too."""
    n, few, many = F.col("n"), F.lit(percent), F.lit(200 - percent)
    least = F.ceil(n * few / many)
    shared = lambda n: F.ceil((n + F.ceil(n * few / many)) * (3 * percent - 200) / 200) - 1
    chars = F.transform(F.slice("chars", F.lit(1), (n - least + 1).cast("int")), lambda x: F.concat(F.lit("c"), x))
    pairs = F.transform(F.slice("pairs", F.lit(1), F.greatest(n - shared(n), F.lit(0)).cast("int")), lambda x: F.concat(F.lit("p"), x))
    none = F.array().cast("array<string>")
    on_pairs, on_chars = shared(n) > 0, shared(least) <= 0
    return rows.withColumn("rare", F.concat(F.when(on_pairs, pairs).otherwise(none), F.when(on_chars, chars).otherwise(none)))


def _band(n: Column) -> Column:
    return F.length(F.bin(n.cast("long")))


def candidates(values: DataFrame, names: DataFrame, percent: int) -> DataFrame:
    """(value, name, position) that the bounds leave at a ratio of percent: every pair that reaches it, and each pair once.

    values and names have the columns of `_shares`, rarest characters first, and names a position.
    """
    few, many = F.lit(percent), F.lit(200 - percent)
    least = F.ceil(F.col("n") * few / many)  # characters shared with any text that reaches the ratio
    values, names = _marks(values, percent), _marks(names, percent)
    bands = F.sequence(_band(least), _band(F.floor(F.col("n") * many / few)))
    v = values.select("*", F.explode(bands).alias("band")).select("*", F.explode("rare").alias("mark"))
    v = v.select("band", "mark", F.struct("text", "n", "chars", "pairs", "rare").alias("v"))
    w = names.select(_band(F.col("n")).alias("band"), F.explode("rare").alias("mark"), F.struct("text", "n", "chars", "pairs", "rare", "position").alias("w"))
    both = F.col("v.n") + F.col("w.n")
    matching = F.ceil(both * few / 200)
    return (
        v.join(w, ["band", "mark"])
        .where(200 * F.least("v.n", "w.n") >= few * both)
        .where(F.get(F.array_intersect("v.rare", "w.rare"), F.lit(0)) == F.col("mark"))
        .where(F.size(F.array_intersect("v.chars", "w.chars")) >= matching)
        .where(F.size(F.array_intersect("v.pairs", "w.pairs")) >= 3 * matching - both - 1)
        .select(F.col("v.text").alias("value"), F.col("w.text").alias("name"), F.col("w.position").alias("position"))
    )


def _without_one(text: Column) -> Column:
    """Digests of the texts without one of their characters, each once."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))))


def one_apart(values: DataFrame, names: DataFrame) -> DataFrame:
    """(value, name, position) of equal texts, and of those of which one is the other without one of its characters; each pair once.

    values, of SHORT to LONG characters, and names have text and n. Equal digests propose; lengths tell the kinds of pairs apart, and
    the ratio judges them.
    """
    near = names.where(F.col("n").between(SHORT - 1, LONG + 1))
    whole = lambda df: df.select("text", "n", F.xxhash64("text").alias("digest"))
    less = lambda df: df.select("text", "n", F.explode(_without_one(F.col("text"))).alias("digest"))
    wide = near.select(F.col("text").alias("name"), F.col("n").alias("m"), "position", F.xxhash64("text").alias("digest"))
    fewer = near.select(F.col("text").alias("name"), F.col("n").alias("m"), "position", F.explode(_without_one(F.col("text"))).alias("digest"))
    same = whole(values).join(wide, "digest").where("text = name")
    shorter = whole(values).join(fewer, "digest").where("n + 1 = m")
    longer = less(values).join(wide, "digest").where("n = m + 1")
    return same.unionByName(shorter).unionByName(longer).select(F.col("text").alias("value"), "name", "position")


def closest_names(values: DataFrame, names: DataFrame, percent: int = 70) -> DataFrame:
    """(value, name, ratio): of each value the name of highest ratio, if that is percent or more; of equal ones that of least position.

    values has a column value, names has name and position. Values may repeat and are matched once. Null values and names match
    nothing, an empty text matches an empty name only, and an empty table of either kind gives no rows. Only names as long as the
    longest that can match are looked at, so one very long value costs nothing.
    """
    listed = names.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("text")).agg(F.min("position").alias("position"))
    listed = written(_shares(listed))
    longest = listed.select(F.max("n")).first()[0]
    if longest is None:
        longest = -1
    left = values.select(F.col("value").alias("text")).where(F.col("text").isNotNull() & (F.length("text") * percent <= longest * (200 - percent))).distinct()
    frequencies = _frequencies(listed)
    listed, plain = written(_rare_first(listed, frequencies)), listed
    best = F.max(F.struct("ratio", (-F.col("position")).alias("place"), "name")).alias("best")
    left, tables, found = written(_rare_first(_shares(left), frequencies)), [], []
    # With n characters and T in both, one character apart is a ratio of 1 - 1 / T, where T is 2 n - 1 at least; any other two texts that are
    # not equal have 1 - 2 / T at most, where T is 2 n + 2 at most. That is less for n over 2.
    values, both = left.where(F.col("n").between(SHORT, LONG)), F.length("value") + F.length("name")
    scored = one_apart(values, listed).withColumn("ratio", _ratio("value", "name")).where((F.col("ratio") >= (both - 1) / both) & (F.col("ratio") >= percent / 100))
    found.append(written(scored.groupBy("value").agg(best).select("value", "best.name", "best.ratio")))
    tables.append(left)
    left = written(left.join(found[0].select(F.col("value").alias("text")), "text", "left_anti"))
    for share in [t for t in TIERS if t > percent] + [percent]:
        if left.isEmpty():
            break
        scored = candidates(left, listed, share).withColumn("ratio", _ratio("value", "name")).where(F.col("ratio") >= share / 100)
        done = written(scored.groupBy("value").agg(best).select("value", "best.name", "best.ratio"))
        found.append(done)
        if share > percent:
            tables.append(left)
            left = written(left.join(done.select(F.col("value").alias("text")), "text", "left_anti"))
    release(plain, listed, left, *tables)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out
