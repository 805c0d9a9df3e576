"""Features: substring counts, lengths, and TF-IDF in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.text import clean_text, ngrams, remove_stop_words
from .sampling import placed


def count_terms(text: Column | str, terms: list[str]) -> Column:
    """How many of the distinct terms occur in the text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.size(F.filter(F.array_distinct(F.array(*[F.lit(t) for t in terms])), lambda t: F.contains(c, t)))


def text_length(text: str) -> Column:
    return F.length(text).cast("double")


def valid_documents(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows whose required columns are all there; an empty text is there."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.na.drop(subset=required)


def labelled(df: DataFrame, column: str) -> DataFrame:
    """Rows whose label is 0 or 1, with label as double."""
    text = F.col(column).cast("string")
    return df.where(text.isin("0", "1")).withColumn("label", text.cast("double"))


def tokens(text: str) -> Column:
    """Words of two or more word characters, without stop words."""
    return remove_stop_words(F.filter(F.split(F.lower(text), r"(?U:\W)+"), lambda t: F.length(t) >= 2))


#: Bytes of terms (and 32 a term) up to which a vocabulary is broadcast; a larger one meets the documents' terms in a shuffled join.
BROADCAST_BYTES = 32 << 20


def vocabulary(documents: DataFrame, terms: str, max_features: int | None = None) -> DataFrame:
    """term, df, idf (smoothed, plus one): all terms, or those of the highest corpus counts, the earlier term of equals. A document adds
    its terms and its distinct terms, so counters are summed by term alone, before the shuffle too."""
    found = F.array(F.struct(F.lit(0).alias("df"), F.array_distinct(terms).alias("t")), F.struct(F.lit(1).alias("df"), F.col(terms).alias("t")))
    if max_features is None:
        found = F.slice(found, 1, 1)
    rows = documents.select(F.explode(found).alias("f")).select("f.df", F.explode("f.t").alias("term"))
    counts = rows.groupBy("term").agg(F.sum("df").alias("total"), F.sum(1 - F.col("df")).alias("df"))
    if max_features is not None:
        counts = counts.orderBy(F.desc("total"), "term").limit(max_features)
    n = documents.agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(n)).select("term", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf(documents: DataFrame, key: str, terms: str, vocabulary_table: DataFrame) -> DataFrame:
    """key, term, weight: (1 + ln count) * idf, of unit length per document."""
    rows = documents.select(key, F.explode(terms).alias("term")).groupBy(key, "term").count()
    raw = rows.join(vocabulary_table.select("term", "idf"), "term").select(key, "term", ((1 + F.log("count")) * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))
    return raw.select(key, "term", (F.col("w") / norm).alias("weight"))


def _length(entries: str, block: int) -> Column:
    """The Euclidean length of a block's weights."""
    return F.sqrt(F.aggregate(F.filter(entries, lambda x: x["block"] == block), F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))


def as_vector(struct: Column) -> Column:
    """The vector whose stored form (type, size, indices, values) the struct is. Spark casts no struct to a vector, but its JSON reader makes
    one of the same fields, without Python; doubles are written so that they are read as they were."""
    schema = StructType([StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(struct.alias("v"))), schema)["v"]


def weighted(term_rows: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """_row, features: as a sparse vector's struct, the damped counts 1 + ln count at the positions of known (block, term, at). A row
    without known terms has none. One join, whatever the positions are used for."""
    counts = term_rows.join(known.select("block", "term", "at"), ["block", "term"], "left").groupBy("_row", "at").count()
    entry = F.when(F.col("at").isNotNull(), F.struct("at", (1 + F.log("count")).alias("w")))
    lists = counts.groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return lists.select("_row", F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"), F.col("e.at").alias("indices"), F.col("e.w").alias("values")).alias("features"))


class TextFeatures:
    """Blocks of TF-IDF features side by side; fit keeps one vocabulary per block."""

    required: list[str] = []
    blocks: list[tuple[str, int | None]] = []

    def __init__(self, clean: bool = True):
        self.clean = clean
        self.tables: dict[str, DataFrame] = {}
        self.sizes: dict[str, int] = {}
        self.bytes: dict[str, int] = {}

    def _terms(self, column: str) -> Column:
        text = F.array_join(clean_text(column), " ") if self.clean else F.col(column)
        return ngrams(tokens(text))

    def _keep(self, column: str, table: DataFrame) -> None:
        self.tables[column] = table = table.cache()
        row = table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()
        self.sizes[column], self.bytes[column] = row[0], row[1]

    def fit(self, df: DataFrame) -> TextFeatures:
        """df has _row, a unique number. Positions are by term."""
        for column, most in self.blocks:
            found = vocabulary(df.select(self._terms(column).alias("terms")), "terms", most).cache()
            self._keep(column, placed(found, [], "term").withColumn("at", (F.col("_place") - 1).cast("int")).drop("_place", "_n"))
            found.unpersist()
        return self

    def save(self, folder: str) -> None:
        """One table per block."""
        for column, table in self.tables.items():
            table.write.parquet(f"{folder}/{column}")

    def load(self, spark: SparkSession, folder: str) -> TextFeatures:
        for column, _ in self.blocks:
            self._keep(column, spark.read.parquet(f"{folder}/{column}"))
        return self

    def term_rows(self, df: DataFrame, *more: str) -> DataFrame:
        """_row, block, term (null once for a block without terms) and the columns more: a row a term of each block of df."""
        none = F.array().cast("array<string>")
        found = F.array(*[F.struct(F.lit(block).alias("block"), F.coalesce(self._terms(c), none).alias("terms")) for block, (c, _) in enumerate(self.blocks)])
        return df.select("_row", F.explode(found).alias("b"), *more).select("_row", "b.block", F.explode_outer("b.terms").alias("term"), *more)

    def parts(self, df: DataFrame, dealt: bool = False) -> DataFrame:
        """_row, size, indices (ascending), weights of every row of df: what a sparse vector holds. Texts are dealt by _row once; with
        vocabularies that may be broadcast nothing else is shuffled. Not even that where df is dealt by _row already, as after a join on
        it; if it is not after all, counts are shuffled and the result is the same."""
        known, base = None, 0
        for block, (column, _) in enumerate(self.blocks):
            table = self.tables[column].select(F.lit(block).alias("block"), "term", (F.col("at") + base).alias("at"), "idf")
            known = table if known is None else known.unionByName(table)
            base += self.sizes[column]
        if sum(self.bytes.values()) <= BROADCAST_BYTES:
            known = F.broadcast(known)
        texts = df.select("_row", *[c for c, _ in self.blocks])
        rows = self.term_rows(texts if dealt else texts.repartition("_row"))
        counts = rows.join(known, ["block", "term"], "left").groupBy("_row", "block", "at", "idf").count()
        entry = F.struct("at", "block", ((1 + F.log("count")) * F.col("idf")).alias("w"))
        lists = counts.groupBy("_row").agg(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), entry))).alias("e"))
        # The lengths are bound once, so that they are not summed again for every entry.
        bound = F.array(F.struct("e", F.array(*[_length("e", block) for block in range(len(self.blocks))]).alias("norms")))
        weights = F.transform(bound, lambda s: F.transform(s["e"], lambda x: x["w"] / F.get(s["norms"], x["block"])))[0]
        return lists.select("_row", F.lit(base).alias("size"), F.col("e.at").alias("indices"), weights.alias("weights"))

    def transform(self, df: DataFrame) -> DataFrame:
        """df with features, one sparse vector, put together by the JVM."""
        struct = F.struct(F.lit(0).cast("tinyint").alias("type"), "size", "indices", F.col("weights").alias("values"))
        return df.join(self.parts(df).select("_row", as_vector(struct).alias("features")), "_row")


class ResearchSoftware(TextFeatures):
    """Words and word pairs of description (24 000 at most) and title."""

    required = ["description", "job_title"]
    blocks = [("description", 24000), ("job_title", None)]


FEATURE_SETS: dict[str, Callable[..., TextFeatures]] = {"rse": ResearchSoftware}


def select_features(name: str) -> Callable[..., TextFeatures]:
    return FEATURE_SETS[name]


def list_features() -> list[str]:
    return sorted(FEATURE_SETS)
