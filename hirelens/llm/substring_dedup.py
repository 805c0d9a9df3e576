"""Remove passages of LENGTH or more words that an earlier document has: seed and extend.

Seeds: winnowing picks, in every run of LENGTH words, the ANCHOR-word gram of least hash, so that equal runs pick the same gram
at the same place. Documents meet on these anchors through one aggregate (least and greatest doc_id of an anchor), never as
pairs. Extension: each occurrence of an anchor that more documents have is extended both ways to all the LENGTH-word runs that
picked it, and the runs meet by their own 128-bit digest (of all their words), again through an aggregate. Runs that a smaller doc_id has too are matches;
matches that overlap or touch join to maximal repeats, and their words go.

A document with the words of an earlier one takes no part in the search: all its runs match. So a group of copies that holds a
third of all rows is one row of the search, and what remains of hot anchors is pre-aggregated before each shuffle; the joins
back to documents are equi-joins that adaptive execution splits. Only documents with a seed move their text on.

Defined results: a null or empty text has no words; documents under LENGTH words stay; rows with one doc_id never remove each
other's words; rows with a null doc_id stay whole and remove nothing; repeated rows repeat in the result; other columns are not
carried; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, covered, documents, gram_hashes, gram_starts, lists, materialise, members, release, row_sets, row_texts, unique_pairs, unique_per_row, window_minima, word_bounds, word_hashes

LENGTH = 50
ANCHOR = 12


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR, whole: bool = True) -> dict[str, np.ndarray]:
    """Of a chunk: words (n + 1 row offsets), start (first word of each run), row, anchor (digest of the gram it picks), run and more
    (the two halves of its 128-bit digest)."""
    starts, ends, words = word_bounds(data, offsets)
    out = {"first": starts, "last": ends, "words": words}
    at = gram_starts(words, length)
    none = np.zeros(0, np.uint64)
    if not len(at):
        return out | {"start": at, "row": at, "anchor": none, "run": none, "more": none}
    digests = word_hashes(data, starts, ends)
    hashes = gram_hashes(digests, anchor)
    keys = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)  # the leftmost among equals
    picked = (window_minima(keys, length - anchor + 1)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return out | {"start": at, "row": np.searchsorted(words, at, side="right") - 1, "anchor": hashes[picked], "run": gram_hashes(digests, length)[at], "more": gram_hashes(word_hashes(data, starts, ends, 1), length)[at] if whole else none}


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches):
        r = runs(data, offsets, whole=False)
        values, at = unique_per_row(r["row"], r["anchor"], part.num_rows)
        sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in row_texts(data, offsets)]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.diff(r["words"]), pa.int64()), pa.array(sha), lists(values, at)], names=["doc_id", "th", "n_words", "sha", "anchors"])


def _runs_of_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches):
        r = runs(data, offsets)
        seeded = members(r["anchor"], r["row"], *row_sets(part, "seeds"))
        run, more, at = unique_pairs(r["row"][seeded], r["run"][seeded], r["more"][seeded], part.num_rows)
        ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), np.diff(at))
        yield pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array(more.view(np.int64)), pa.array(ids, pa.int64())], names=["run", "more", "doc_id"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches):
        r = runs(data, offsets)
        hit = r["start"][members(r["run"], r["row"], *row_sets(part, "matched")) & members(r["more"], r["row"], *row_sets(part, "matched_more"))]
        n = int(r["words"][-1])
        gone = covered(hit, hit + LENGTH, n)
        removed = np.diff(np.r_[0, np.cumsum(gone)][r["words"]])
        kept = []
        for i, text in enumerate(row_texts(data, offsets)):
            words = text.split()
            if removed[i]:
                stay = ~gone[r["words"][i] : r["words"][i + 1]]
                words = [words[j] for j in np.flatnonzero(stay).tolist()]
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(r["words"]), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and with text=True kept, the words left joined by one space)."""
    bounded_batches(docs.sparkSession)
    whole = documents(docs).withColumn("th", F.xxhash64("text"))
    found = materialise(whole.mapInArrow(_anchors, "doc_id long, th long, n_words long, sha string, anchors array<long>"))
    firsts = materialise(found.where(f"n_words >= {LENGTH} and doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    states = found.join(firsts, "sha", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    anchors = states.where("not copy and doc_id is not null").select("doc_id", F.explode("anchors").alias("anchor"))
    # Written out, so that the join's both sides are plain exchanges, of which adaptive execution splits a hot anchor's.
    shared = materialise(anchors.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("anchor"))
    seeds = anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("seeds"))
    marked = materialise(states.select("doc_id", "th", "n_words", "sha", "copy").join(seeds, "doc_id", "left"))
    searched = marked.where("seeds is not null and not copy").select("doc_id", "th", "seeds").dropDuplicates(["doc_id", "th"])
    seeded = materialise(whole.join(searched, ["doc_id", "th"]).select("doc_id", "text", "seeds"))
    found_runs = seeded.mapInArrow(_runs_of_seeds, "run long, more long, doc_id long")
    release(found, firsts, shared)
    repeats = materialise(found_runs.groupBy("run", "more").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("run", "more", "least"))
    matched = found_runs.join(repeats, ["run", "more"]).where("doc_id > least").groupBy("doc_id").agg(F.collect_list("run").alias("matched"), F.collect_list("more").alias("matched_more"))
    cut = seeded.select("doc_id", "text").join(matched, "doc_id", "left").mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept string")
    if not text:
        cut = cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
        rest = marked.where("copy or seeds is null").select("doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.lit(0).cast("long")).alias("n_removed"), F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"))
        return cut.unionByName(rest)
    plain = F.array_join(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0), " ")
    rest = whole.join(marked.where("copy or seeds is null").select("doc_id", "th", "n_words", "copy").dropDuplicates(["doc_id", "th"]).withColumnsRenamed({"doc_id": "i", "th": "t"}), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")))
    rest = rest.select("doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.lit(0).cast("long")).alias("n_removed"), F.when(F.col("copy"), F.lit("")).otherwise(plain).alias("kept"))
    return cut.unionByName(rest).withColumn("kept_sha256", F.sha2("kept", 256))
