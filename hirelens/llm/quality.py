"""Quality rules: robust multivariate outliers by minimum covariance determinant, per language and source.

Each document has four counts over its whole text; transformed to a vector, it is rejected when its Mahalanobis distance to its
group's robust centre is too large. Every language and source, of any size, has its own estimate: it starts from medians and quartiles
and takes C-steps: the SHARE of rows nearest by the last estimate give the next mean and covariance, until the estimate stays (or
STEPS are taken). The covariance is made regular as in the minimum regularised covariance determinant: it is mixed with a diagonal
target, the robust variances of the group's language, which weighs as much as RIDGE rows, and FLOORS are added to its diagonal; the
centre is drawn to the language's median by the same weight, and a language's own values to the whole table's likewise. The
same formula holds for one row and for a million, where the targets have no weight to speak of. Medians, quartiles and nearest shares come from
counts in fixed bins (bounded rows a group), so every step is one aggregate with partial sums, however much of the table one source
holds; rows meet their group's parameters through a broadcast of at most BROADCAST_GROUPS rows or, beyond, through a join on the group and
one of SALTS numbers, so no task holds a group. Reruns agree. DataFrame functions throughout.

Defined results: a null or empty text has no words and fails the base rules; null languages and sources are groups of their own;
a group's only row is judged by its language as far as the weights go; rows repeat as in the input and equal rows have equal verdicts;
a very long text is one row like any other; other columns are kept in row, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, release

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
GRAM = 5
MIN_WORDS = 10
#: Per cent of words in repeated windows above which the base rules reject.
MOST_REPEATED = 20
DIMS = 4
SHARE = 0.75
#: Makes the covariance of the nearest SHARE of a 4-variate normal consistent: 0.75 / P(chi2_6 <= chi2_4 quantile of 0.75).
CONSISTENT = 1.49
#: The 0.9999 quantile of chi2 with 4 degrees of freedom.
CUTOFF = 23.51
STEPS = 20
#: The C-steps end when no mean, factor or logged variance moves by more.
STAYS = 1e-4
#: Weight, in rows, of the language's median in every centre and of its variances in every covariance.
RIDGE = 20
#: Standard deviations added to each component's variance.
FLOORS = (0.12, 0.2, 0.2, 0.2)
#: Groups whose parameters (some 150 bytes each) are broadcast; more of them are joined by salted keys.
BROADCAST_GROUPS = 50_000
SALTS = 64


def _let(value: Column, body) -> Column:
    """body of value, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of GRAM words that occur twice or more, by window hashes."""

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - (GRAM - 1)), lambda x, i: F.xxhash64(x, *[h[i + k] for k in range(1, GRAM)]))

    def positions(s: Column) -> Column:
        n = F.size(s)
        twice = lambda x, k: F.when(k > 0, s[k - 1]["h"] == x["h"]).otherwise(False) | F.when(k < n - 1, s[F.least(k + 1, n - 1)]["h"] == x["h"]).otherwise(False)
        return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        n = F.size(p)
        return F.aggregate(F.transform(p, lambda v, k: F.when(k < n - 1, F.least(F.lit(GRAM), p[F.least(k + 1, n - 1)] - v)).otherwise(GRAM)), F.lit(0), lambda a, b: a + b)

    def count(w: Column) -> Column:
        sorted_windows = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(_let(sorted_windows, positions), covered))

    many = F.size(words) >= GRAM
    return F.when(many, _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), count)).otherwise(F.lit(0)).cast("long")


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs as a struct column row, text, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim("text", F.lit(SPACES))
    shaped = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"), docs["text"].alias("original"), text.alias("text"))
    packed = F.translate("text", SPACES, "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    counted = shaped.select(
        "row",
        "original",
        _let(F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).alias("r"))).alias("w"),
        _let(packed, lambda p: F.struct(F.length(p).cast("long").alias("c"), (F.length(p) - F.length(F.translate(p, SYMBOLS, ""))).cast("long").alias("s"))).alias("c"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    values = F.struct(F.col("w.n").alias("n_words"), F.col("c.c").alias("word_chars"), F.col("c.s").alias("n_symbols"), "n_dup_lines", F.col("w.r").alias("n_repeat_words"))
    # Through a one-row generator, so that later filters are not pushed below and the counts computed again for each use.
    out = counted.select("row", "original", F.explode_outer(F.array(values)).alias("v")).select("row", "original", "v.*")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED))


def _vector() -> list[Column]:
    """Mean word length, symbols per character, repeated lines and repeated words per word; shrunk for short texts, then logged."""
    return [
        F.log((F.col("word_chars") + 20) / (F.col("n_words") + 4)),
        F.log1p(100 * F.col("n_symbols") / (F.col("word_chars") + 100)),
        F.log1p(100 * F.col("n_dup_lines") / (F.col("n_words") + 50)),
        F.log1p(10 * F.col("n_repeat_words") / (F.col("n_words") + 50)),
    ]


def _own_group(row: str = "row") -> Column:
    part = lambda c: F.when(F.col(f"{row}.{c}").isNull(), "").otherwise(F.concat(F.lit("+"), F.col(f"{row}.{c}").cast("string")))
    return F.concat_ws("\n", part("lang"), part("source"))


def _quantiles(counts: DataFrame, keys: list[str], value: str, shares: dict[str, float], down: bool = False) -> DataFrame:
    """Per key, the least bin that holds each share of the rows (rounded down to whole rows, but one, if so said) at or below it, from
    the counts n of bins."""
    rows = lambda share: F.greatest(F.floor(F.col("all") * share), F.lit(1)) if down else F.col("all") * share
    upto = W.partitionBy(*keys).orderBy(value)
    sums = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(W.partitionBy(*keys)))
    return sums.groupBy(*keys).agg(*[F.min(F.when(F.col("upto") >= rows(share), F.col(value))).alias(name) for name, share in shares.items()])


def _distance(x: list[Column], params: str) -> Column:
    """Squared Mahalanobis distance, by forward substitution through the unit lower factor and diagonal held in params."""
    z: list[Column] = []
    total = F.lit(0.0)
    for i in range(DIMS):
        value = x[i] - F.col(f"{params}.m{i}")
        for j in range(i):
            value = value - F.col(f"{params}.l{i}{j}") * z[j]
        z.append(value)
        total = total + value * value / F.col(f"{params}.d{i}")
    return total


def _drawn(own: Column, n: Column, target: Column) -> Column:
    """The mean of a group's own value of n rows and a target that weighs as much as RIDGE."""
    return (own * n + target * RIDGE) / (n + RIDGE)


def _factored(sums: DataFrame, key: str) -> DataFrame:
    """key and p: centre, unit lower factor and diagonal of the covariance, from counts, sums, sums of products, and the targets c and t."""
    out, n = sums, F.col("n")
    mean = [F.col(f"s{i}") / n for i in range(DIMS)]
    for i in range(DIMS):
        out = out.withColumn(f"m{i}", _drawn(mean[i], n, F.col(f"c{i}")))
    names = [f"m{i}" for i in range(DIMS)]
    for j in range(DIMS):
        for i in range(j, DIMS):
            value = (F.col(f"s{j}{i}") / n - mean[i] * mean[j]) * CONSISTENT
            value = _drawn(F.greatest(value, F.lit(0.0)), n, F.col(f"t{i}")) + FLOORS[i] ** 2 if i == j else _drawn(value, n, F.lit(0.0))
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}")
            name = f"d{j}" if i == j else f"l{i}{j}"
            out = out.withColumn(name, F.greatest(value, F.lit(FLOORS[j] ** 2 / 4)) if i == j else value / F.col(f"d{j}"))
            names.append(name)
    # Rounded, so that the order of summation does not show.
    return out.select(key, F.struct(*[F.round(c, 10).alias(c) for c in names]).alias("p"))


def _meet(rows: DataFrame, params: DataFrame, groups: int, how: str = "inner") -> DataFrame:
    """rows with their group's parameters; rows have salt, any number below SALTS."""
    if groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(params), "g", how)
    return rows.join(params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["g", "salt"], how)


def _salted() -> Column:
    return F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")


def fit(statistics: DataFrame) -> DataFrame:
    """g (a group), p: the robust estimate of every language and source with a row that passes the base rules."""
    lang = F.col("row.lang").cast("string")
    rows = materialise(statistics.where("not base_failed").select(lang.alias("l"), _own_group().alias("g"), _salted(), *[x.alias(f"x{i}") for i, x in enumerate(_vector())]))
    xs = [F.col(f"x{i}") for i in range(DIMS)]
    bins = rows.select("l", "g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(xs[i] * 200).alias("b")) for i in range(DIMS)])).alias("e")).select("l", "g", "e.i", "e.b")
    counts = materialise(bins.groupBy("l", "g", "i", "b").agg(F.count("*").alias("n")))

    def middles(keys: list[str], mark: str) -> DataFrame:
        """By the keys: n rows, medians m and robust variances v, named with the mark."""
        binned = counts.groupBy(*keys, "i", "b").agg(F.sum("n").alias("n"))
        found = _quantiles(binned, [*keys, "i"], "b", {"q1": 0.25, "q2": 0.5, "q3": 0.75}).join(binned.groupBy(*keys, "i").agg(F.sum("n").alias("n")).withColumnsRenamed({k: f"{k}_" for k in keys}).withColumnRenamed("i", "i_"), F.expr(" AND ".join(["i = i_", *[f"{k} <=> {k}_" for k in keys]])))
        of = lambda value, name: [F.max(F.when(F.col("i") == i, value)).alias(f"{mark}{name}{i}") for i in range(DIMS)]
        return found.groupBy(*keys).agg(F.max("n").alias(f"{mark}n"), *of((F.col("q2") + 0.5) / 200, "m"), *of(((F.col("q3") - F.col("q1")) / 200 / 1.349) ** 2, "v"))

    drawn = lambda a, b: [_drawn(F.col(f"{a}m{i}"), F.col(f"{a}n"), F.col(f"{b}{i}")).alias(f"c{i}") for i in range(DIMS)]
    spread = lambda a, b: [_drawn(F.col(f"{a}v{i}"), F.col(f"{a}n"), F.col(f"{b}{i}")).alias(f"t{i}") for i in range(DIMS)]
    languages = middles(["l"], "l").crossJoin(F.broadcast(middles([], "a"))).select("l", *drawn("l", "am"), *spread("l", "av"))
    own = middles(["l", "g"], "g").join(languages.withColumnRenamed("l", "l_"), F.expr("l <=> l_"))
    places = materialise(own.select("g", *[f"{x}{i}" for x in ("gm", "gv", "c", "t") for i in range(DIMS)], "gn"))
    zero = [F.lit(0.0).alias(f"l{i}{j}") for j in range(DIMS) for i in range(j + 1, DIMS)]
    first = [c.alias(f"m{i}") for i, c in enumerate(drawn("g", "c"))] + [(c + FLOORS[i] ** 2).alias(f"d{i}") for i, c in enumerate(spread("g", "t"))]
    params = materialise(places.select("g", F.struct(*first, *zero).alias("p")))
    places = places.select("g", *[f"{x}{i}" for x in ("c", "t") for i in range(DIMS)])
    groups = params.count()
    for _ in range(STEPS):
        near = _meet(rows, params, groups).withColumn("b", F.floor(F.log(_distance(xs, "p") + 1e-9) * 100)).drop("p")
        edge = materialise(_quantiles(near.groupBy("g", "b").agg(F.count("*").alias("n")), ["g"], "b", {"edge": SHARE}, down=True))
        inside = _meet(near, edge, groups).where("b <= edge")
        sums = [F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(xs)]]
        sums += [F.sum(xs[i] * xs[j]).alias(f"s{j}{i}") for j in range(DIMS) for i in range(j, DIMS)]
        spent, params = params, materialise(_factored(inside.groupBy("g").agg(*sums).join(places, "g"), "g"))
        moves = [F.abs(F.col(f"p.{c}") - F.col(f"o.{c}")) for c in params.schema["p"].dataType.names if c[0] != "d"]
        moves += [F.abs(F.log(F.col(f"p.d{i}") / F.col(f"o.d{i}"))) for i in range(DIMS)]
        moved = params.join(spent.withColumnRenamed("p", "o"), "g").agg(F.max(F.greatest(*moves))).first()[0]
        release(edge, spent)
        if moved is None or moved <= STAYS:
            break
    release(rows, counts)
    return params


def judge(statistics: DataFrame, params: DataFrame) -> DataFrame:
    """statistics with kept: false where the base rules fail or the distance is above the cutoff."""
    placed = _meet(statistics.withColumn("g", _own_group()).withColumn("salt", _salted()), params, params.count(), "left").drop("g", "salt")
    far = F.round(_distance(_vector(), "p"), 6) > CUTOFF
    return placed.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).drop("p")


def verdicts(docs: DataFrame) -> DataFrame:
    """row, the statistics, base_failed and kept of every document."""
    statistics = materialise(with_statistics(docs).drop("original"))
    return judge(statistics, fit(statistics))


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the input's columns. Statistics are computed once to fit and once to filter, so that no
    text is moved or written."""
    statistics = with_statistics(docs)
    kept = judge(statistics, fit(statistics.drop("original"))).where("kept")
    return kept.select(*[F.col("original").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
