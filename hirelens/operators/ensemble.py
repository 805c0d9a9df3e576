"""An ensemble of logistic models over text features, as one model.

Each member is fitted on its own seeded split, with document frequencies, a choice of terms and an inverse document frequency of its own.
Instead of a vocabulary, a fit and a join a member there is one of each:

- One pass counts: a row carries a bit a member, and a term's rows, which meet sorted in ranges of terms, add up to its counts by member.
- The terms that any member chooses are the union vocabulary; a member's inverse document frequency is 0 where it does not choose a term.
- Rows meet the union vocabulary in one join, which gives positions and damped counts, the same for every member.
- The weights of all members are columns of one optimisation, scaled by their inverse document frequencies (operators.logistic).
- Scores come from the same product, so scoring has one join whatever the number of members.

The matrices (terms of the union by members) are on the driver and are sent to workers, as a linear model's coefficients are: their size is
the model's, not the corpus's.

Defined results: a row with a null text has no terms of that block; a term that no member chooses is unknown; a member without any term
scores by its intercept alone; rows without a label do not train.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import written
from .features import TextFeatures, select_features, weighted
from .logistic import Fits, fit_many, part_sizes, probabilities
from .sampling import split_parts

_COUNTED = "pid int, block int, term string, df array<int>, total array<int>"
_CHOSEN = "pid int, nth int, block int, term string, idf array<double>"


def _arrays(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), kind))


def _listed(column: pa.Array, rows: int, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(rows, width)


def counted_terms(rows: DataFrame, features: TextFeatures, members: int) -> DataFrame:
    """pid, block, term, df, total: by member, how many of its rows hold a term and how often they do. rows has the blocks' columns and
    parts. Sorted by block and term within pid, and pid ascends with them."""
    pairs = features.term_rows(rows.withColumn("_mask", F.transform("parts", lambda p: (p > 0).cast("tinyint"))), "_mask")
    counts = pairs.where("term is not null").groupBy("_row", "block", "term").agg(F.count("*").cast("int").alias("c"), F.any_value("_mask").alias("_mask"))
    ordered = counts.repartitionByRange("block", "term").sortWithinPartitions("block", "term").select(F.spark_partition_id().alias("pid"), "block", "term", "c", "_mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, one, two = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            mask = _listed(batch.column(4), batch.num_rows, members).astype(np.int32)
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            begins = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            df = np.add.reduceat(mask, begins)
            total = np.add.reduceat(mask * np.asarray(batch.column(3))[:, None], begins)
            names = [keys[i] for i in begins]
            # The last term of a batch may go on in the next one.
            if held == names[0]:
                df[0] += one
                total[0] += two
            elif held is not None:
                names, df, total = [held, *names], np.vstack([one, df]), np.vstack([two, total])
            held, one, two = names[-1], df[-1], total[-1]
            if len(names) > 1:
                yield _counted(names[:-1], df[:-1], total[:-1])
        if held is not None:
            yield _counted([held], one[None], two[None])

    return ordered.mapInArrow(run, _COUNTED)


def _counted(names: list[tuple], df: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    pid, block, term = zip(*names, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(pid, pa.int32()), pa.array(block, pa.int32()), pa.array(term, pa.string()), _arrays(df, pa.int32()), _arrays(total, pa.int32())], names=["pid", "block", "term", "df", "total"])


def _cuts(counted: DataFrame, block: int, most: int, members: int) -> tuple[np.ndarray, np.ndarray]:
    """By member: the count at which the most frequent terms of a block end, and how many terms of that very count are still among them."""
    totals = counted.where(F.col("block") == block).select(F.posexplode("total").alias("member", "total")).where("total > 0").groupBy("member", "total").agg(F.count("*").alias("n"))
    upto = W.partitionBy("member").orderBy(F.desc("total"))
    ranked = totals.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") - F.col("n") < most)
    last = ranked.groupBy("member").agg(F.min_by(F.struct("total", "upto", "n"), "total").alias("last")).select("member", "last.*")
    cut, left = np.zeros(members, np.int64), np.full(members, 1 << 60)
    for r in last.collect():
        cut[r["member"]], left[r["member"]] = r["total"], min(r["n"], most - (r["upto"] - r["n"]))
    return cut, left


def chosen_terms(counted: DataFrame, blocks: list[tuple[str, int | None]], sizes: np.ndarray) -> DataFrame:
    """pid, nth, block, term, idf: the terms that any member chooses, numbered within pid; the idf is 0 where a member does not. Of a
    limited block a member takes the terms of its highest counts, the earlier term of equals; of any other, all that its rows hold."""
    members = len(sizes)
    limits = {b: _cuts(counted, b, most, members) for b, (_, most) in enumerate(blocks) if most is not None}
    # Terms of the very count at a cut are taken in order: how many of them lie in earlier ranges.
    before: dict[tuple[int, int], np.ndarray] = {}
    for b, (cut, _) in limits.items():
        at = F.array(*[F.lit(int(c)) for c in cut])
        ties = counted.where(F.col("block") == b).select("pid", F.posexplode(F.transform("total", lambda t, i: (t == F.get(at, i)).cast("int"))).alias("member", "tie"))
        upto = np.zeros(members, np.int64)
        found = ties.groupBy("pid", "member").agg(F.sum("tie").alias("n")).collect()
        for pid in sorted({r["pid"] for r in found}):
            before[pid, b] = upto.copy()
            for r in found:
                if r["pid"] == pid:
                    upto[r["member"]] += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, ties = 0, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            pid, block = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            df, total = _listed(batch.column(3), n, members), _listed(batch.column(4), n, members)
            takes = df > 0
            for b, (cut, left) in limits.items():
                here = np.flatnonzero(block == b)
                if not len(here):
                    continue
                key = int(pid[0]), b
                tie = total[here] == cut
                upto = np.cumsum(tie, axis=0) + ties.get(key, before[key])
                ties[key] = upto[-1]
                takes[here] &= (total[here] > cut) | (tie & (upto <= left))
            idf = np.where(takes, np.log((1 + sizes) / (1 + df)) + 1, 0.0)
            some = np.flatnonzero(takes.any(axis=1))
            rows = batch.take(pa.array(some))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.arange(nth, nth + len(some), dtype=np.int32)), rows.column(1), rows.column(2), _arrays(idf[some], pa.float64())], names=["pid", "nth", "block", "term", "idf"])
            nth += len(some)

    return counted.mapInArrow(run, _CHOSEN)


def _placed(chosen: DataFrame) -> DataFrame:
    """block, term, at, idf: positions by block and term, from the sizes of the ranges."""
    sizes = {r["pid"]: r["count"] for r in chosen.groupBy("pid").count().collect()}
    below, total = {}, 0
    for pid in sorted(sizes):
        below[pid], total = total, total + sizes[pid]
    spark = chosen.sparkSession
    offsets = spark.createDataFrame(list(below.items()) or [(0, 0)], "pid int, below int")
    return chosen.join(F.broadcast(offsets), "pid").select("block", "term", (F.col("below") + F.col("nth")).alias("at"), "idf")


class LogisticEnsemble:
    """Members as columns: terms (block, term, at, idf, weight) in a table, intercepts beside it."""

    def __init__(self, featureset: str, terms: DataFrame, fits: Fits):
        self.featureset, self.terms, self.fits = featureset, terms, fits

    def __len__(self) -> int:
        return len(self.fits.intercepts)

    @classmethod
    def fit(cls, data: DataFrame, featureset: str, members: int, estimator) -> LogisticEnsemble:
        """data has _row, label and the feature set's columns; estimator(n) is the LogisticRegression of a member with n rows."""
        features = select_features(featureset)()
        rows = split_parts(data, "label", "_row", members).persist()
        sizes = part_sizes(rows, members)
        counted = counted_terms(rows, features, members).persist()
        chosen = chosen_terms(counted, features.blocks, sizes.sum(axis=0)).persist()
        terms = written(_placed(chosen))
        scale, cuts = _matrix_of(terms, "idf", members), _cuts_of(terms, len(features.blocks))
        vectors = weighted(features.term_rows(rows), terms, len(scale)).join(rows.select("_row", "label", "parts"), "_row")
        fits = fit_many(vectors, [(m, estimator(int(sizes[:, m].sum()))) for m in range(members)], sizes, len(scale), scale, cuts)
        for spent in (rows, counted, chosen):
            spent.unpersist()
        return cls(featureset, terms, fits)

    def members(self, documents: DataFrame, key: str) -> DataFrame:
        """key, members: P(label 1) by each member in order, of each of the documents, which have one row a key."""
        features = select_features(self.featureset)()
        found = features.term_rows(documents.withColumn("_row", F.col(key)))
        return probabilities(weighted(found, self.terms, len(self.fits.weights)).withColumnRenamed("_row", key), self.fits, [key])

    def save(self, folder: str | Path, about: dict) -> None:
        """The terms with their idf and weights by member as Parquet, and the intercepts with what about says as JSON."""
        folder = Path(folder)
        weights, spark = self.fits.weights, self.terms.sparkSession
        sent = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, _arrays(sent.value[np.asarray(batch.column(2))], pa.float64())], names=["block", "term", "at", "idf", "weight"])

        self.terms.select("block", "term", "at", "idf").mapInArrow(run, "block int, term string, at int, idf array<double>, weight array<double>").write.parquet(str(folder / "terms"))
        (folder / "members.json").write_text(json.dumps({"featureset": self.featureset, "intercepts": self.fits.intercepts.tolist(), "converged": self.fits.converged.tolist()} | about, indent=2))

    @classmethod
    def load(cls, spark: SparkSession, folder: str | Path) -> LogisticEnsemble:
        about = json.loads((Path(folder) / "members.json").read_text())
        terms = spark.read.parquet(str(Path(folder) / "terms"))
        members = len(about["intercepts"])
        scale, weights = _matrix_of(terms, "idf", members), _matrix_of(terms, "weight", members)
        blocks = len(select_features(about["featureset"]).blocks)
        fits = Fits(weights, np.array(about["intercepts"]), np.zeros(members, int), np.array(about["converged"]), scale, _cuts_of(terms, blocks))
        return cls(about["featureset"], terms, fits)


def _matrix_of(terms: DataFrame, column: str, members: int) -> np.ndarray:
    """positions by members."""
    found = terms.select("at", column).toArrow()
    if not found.num_rows:
        return np.zeros((0, members))
    out = np.zeros((found.num_rows, members))
    out[np.asarray(found.column(0))] = np.asarray(found.column(1).combine_chunks().flatten()).reshape(-1, members)
    return out


def _cuts_of(terms: DataFrame, blocks: int) -> list[int]:
    """Where the positions of each block but the first begin."""
    sizes = {r["block"]: r["count"] for r in terms.groupBy("block").count().collect()}
    return np.cumsum([sizes.get(b, 0) for b in range(blocks - 1)]).tolist()
