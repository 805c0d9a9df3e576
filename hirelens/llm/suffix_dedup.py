"""Remove bytes of strings of LENGTH bytes that occur more than once: prefix-free parsing, spread over a cluster.

Rolling-hash triggers cut every text into phrases: a trigger is the 16-byte gram of least hash in some run of SPAN grams, so
the cuts depend on the bytes around them alone and any LENGTH bytes hold two at least. The dictionary of distinct phrases
with their counts leaves only texts that hold repeated phrases; the rest of the corpus is done.

Of a LENGTH-byte string, the cuts inside split it into a dictionary-suffix on the left, a run of whole phrases of the parse (its
core), and a dictionary-prefix on the right. The strings that start side by side with one core are a group. Corpus order by
(parse, left context, right context) is needed here only as far as equality of LENGTH bytes goes, so instead of one suffix array
that a single machine would have to hold, equality classes (of 128-bit digests) at three depths stand for its ranks: groups with the same core and the
same whole context are repeated as a whole (the long runs of highly repetitive text, one row each). Only where one core
has several contexts, each distinct context is cut into blocks of BLOCK starts, at places counted from the core: blocks that share
the middle (the bytes in all strings of a block) and the whole are repeated as a whole, a middle found once ends the search, and
only where one middle has several wholes do strings meet by their own hash. An edit so costs a few blocks, not all strings around it.

All meetings are aggregates with partial sums, or equi-joins that adaptive execution splits. A group of identical texts is one
text with a count. Defined results: a null or empty text has 0 bytes; texts under LENGTH bytes stay; identical texts of LENGTH
bytes or more lose everything; repeated rows are texts of their own; null ids are kept; other columns are not carried; an empty
table gives no rows. Removed bytes may split characters, so what stays is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Fingerprints, bounded_batches, chunks, covered, documents, gram_starts, lists, materialise, members, mix, release, row_sets, row_texts, window_minima
from .components import thinned

LENGTH = 400
GRAM = 16
SPAN = 192  # grams in a run; two disjoint runs fit into LENGTH bytes
BLOCK = 8
_STEP = 1 << 20


def gram_keys(data: np.ndarray) -> np.ndarray:
    """Rolling hash of every GRAM bytes, by doubling: high half hash, low half position, so the leftmost least is the least."""
    h = data.astype(np.uint64) + np.uint64(1)
    width, base = 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(pow(base, width, 1 << 64)) + h[width:]
        width *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)


class Parse:
    """Cuts, phrases and groups of the texts of a chunk; positions are bytes of the chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        none = np.zeros(0, np.int64)
        self.rows = len(offsets) - 1
        self.cuts = self.phrase_row = self.first = self.end = self.group_row = none
        self.phrases = self.cores = self.contexts = self.more = none.astype(np.uint64)
        self.prints, self._left, self._right = Fingerprints(data[:0]), none, none
        starts = gram_starts(offsets, LENGTH) if len(data) else none
        if not len(starts):
            return
        picked = (window_minima(gram_keys(data), SPAN) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = gram_starts(offsets, SPAN + GRAM - 1)
        self.cuts = np.unique(picked[inside])
        self.prints = Fingerprints(data)
        cut_row = np.searchsorted(offsets, self.cuts, side="right") - 1
        joined = np.flatnonzero(cut_row[1:] == cut_row[:-1])
        self.phrases = self.prints.of(self.cuts[joined], self.cuts[joined + 1] + GRAM)
        self.phrase_row, self._phrase_cut = cut_row[joined], joined
        left, right = picked[starts], picked[starts + LENGTH - (SPAN + GRAM - 1)]
        row = np.searchsorted(offsets, starts, side="right") - 1
        new = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (row[1:] != row[:-1])])
        last = np.r_[new[1:], len(starts)] - 1
        self.first, self.end, self.group_row = starts[new], starts[last] + 1, row[new]  # starts first .. end - 1
        self._left, self._right = left[new], right[new]

    def name(self) -> Parse:
        """Names the groups: cores, and contexts and more (the two halves of the digest of a group's whole bytes and its place in them)."""
        self.cores = self.prints.of(self._left, self._right + GRAM)
        self.contexts, self.more = self._placed(self.first, self.end, self._left - self.first)
        return self

    def _placed(self, first: np.ndarray, end: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The digest's halves of the bytes of the strings that start in first .. end - 1, with a number."""
        salt = mix(place.astype(np.uint64) + np.uint64(1))
        return mix(self.prints.of(first, end - 1 + LENGTH) ^ salt), mix(self.prints.of(first, end - 1 + LENGTH, 1) ^ salt)

    def repeated_groups(self, known: np.ndarray) -> np.ndarray:
        """Groups all of whose phrases are known (a mask over phrases)."""
        bad = np.zeros(len(self.cuts), np.int64)
        bad[self._phrase_cut[~known]] = 1
        sums = np.r_[0, np.cumsum(bad)]
        return sums[np.searchsorted(self.cuts, self._left)] == sums[np.searchsorted(self.cuts, self._right)]

    def blocks(self, groups: np.ndarray) -> tuple[np.ndarray, ...]:
        """Blocks of the groups (indices): rows, first starts, past-the-end starts, middles, and the halves of their wholes' digests.

        A string alone decides its block's number and middle: both are counted from the left end of its core, not from the group.
        """
        left = self._left[groups]
        low, high = (left - self.end[groups] + 1) // BLOCK, (left - self.first[groups]) // BLOCK
        group, ramp = _ramps(high - low + 1)
        number = high[group] - ramp
        top = left[group] - number * BLOCK
        first, end = np.maximum(self.first[groups][group], top - BLOCK + 1), np.minimum(self.end[groups][group], top + 1)
        middle = self.prints.of(top, top - BLOCK + 1 + LENGTH)
        middles = mix(middle ^ mix(self.cores[groups][group] + number.astype(np.uint64)))
        return self.group_row[groups][group], first, end, middles, *self._placed(first, end, left[group] - first)

    def strings(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """Block, start and the halves of the digest of all LENGTH-byte strings that start in the blocks first .. end - 1."""
        block, ramp = _ramps(end - first)
        starts = first[block] + ramp
        return block, starts, self.prints.of(starts, starts + LENGTH), self.prints.of(starts, starts + LENGTH, 1)


def _ramps(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n: i and 0 .. n[i] - 1, for each i in turn."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - (np.cumsum(n) - n)[owner]


def _once(first: np.ndarray, second: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Of the indices some, one for each digest."""
    some = some[np.lexsort((second[some], first[some]))]
    return some[np.r_[True, (first[some[1:]] != first[some[:-1]]) | (second[some[1:]] != second[some[:-1]])]] if len(some) else some


def _held(first: np.ndarray, second: np.ndarray, rows: np.ndarray, part: pa.RecordBatch, column: str) -> np.ndarray:
    """Whether each digest is among those of its row that the column (and column_more) lists."""
    return members(first, rows, *row_sets(part, column)) & members(second, rows, *row_sets(part, f"{column}_more"))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, limit=_STEP):
        p = Parse(data, offsets)
        at = np.searchsorted(p.phrase_row, np.arange(part.num_rows + 1))
        sha = [hashlib.sha256(t).hexdigest() for t in row_texts(data, offsets)]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.diff(offsets), pa.int64()), pa.array(sha), lists(p.phrases, at)], names=["doc_id", "th", "n_bytes", "sha", "phrases"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, limit=_STEP):
        p = Parse(data, offsets).name()
        some = np.flatnonzero(p.repeated_groups(members(p.phrases, p.phrase_row, *row_sets(part, "known")))) if len(p.phrases) else np.zeros(0, np.int64)
        rows = pa.array(p.group_row[some])
        yield pa.RecordBatch.from_arrays([_long(p.cores[some]), _long(p.contexts[some]), _long(p.more[some]), part.column(0).take(rows), part.column(3).take(rows)], names=["core", "context", "more", "key", "copies"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, limit=_STEP):
        p = Parse(data, offsets).name()
        row, _, _, middle, whole, more = p.blocks(_once(p.contexts, p.more, np.flatnonzero(_held(p.contexts, p.more, p.group_row, part, "open"))))
        yield pa.RecordBatch.from_arrays([_long(middle), _long(whole), _long(more), part.column(0).take(pa.array(row))], names=["middle", "whole", "more", "key"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, limit=_STEP):
        p = Parse(data, offsets).name()
        row, first, end, _, whole, more = p.blocks(np.arange(len(p.first)))
        some = _once(whole, more, np.flatnonzero(_held(whole, more, row, part, "open")))
        block, _, values, second = p.strings(first[some], end[some])
        yield pa.RecordBatch.from_arrays([_long(values), _long(second), part.column(0).take(pa.array(row[some][block]))], names=["string", "more", "key"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, limit=_STEP):
        p = Parse(data, offsets).name()
        whole = _held(p.contexts, p.more, p.group_row, part, "whole")
        starts, ends = p.first[whole], p.end[whole] - 1 + LENGTH
        blocks, strings = row_sets(part, "blocks"), row_sets(part, "strings")
        if len(blocks[0]) or len(strings[0]):
            row, first, end, _, wholes, more = p.blocks(np.flatnonzero(np.isin(p.group_row, np.r_[blocks[1], strings[1]]) & ~whole))
            hit = _held(wholes, more, row, part, "blocks")
            starts, ends = np.r_[starts, first[hit]], np.r_[ends, end[hit] - 1 + LENGTH]
            block, at, values, second = p.strings(first[~hit], end[~hit])
            at = at[_held(values, second, row[~hit][block], part, "strings")]
            starts, ends = np.r_[starts, at], np.r_[ends, at + LENGTH]
        gone = covered(starts, ends, len(data))
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        opens[offsets[1:-1][offsets[1:-1] < len(data)]] = gone[offsets[1:-1][offsets[1:-1] < len(data)]]
        n_removed, n_spans = (np.diff(np.r_[0, np.cumsum(x)][offsets]) for x in (gone, opens))
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _listed(rows: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """key, and the halves of its digests in two lists."""
    return rows.groupBy("key").agg(F.collect_list(first).alias(name), F.collect_list(second).alias(f"{name}_more"))


def remove_repeats(docs: DataFrame, kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and with kept=True the bytes that stay)."""
    bounded_batches(docs.sparkSession)
    whole = documents(docs).withColumn("th", F.xxhash64("text"))
    found = materialise(whole.mapInArrow(_phrases, "doc_id long, th long, n_bytes long, sha string, phrases array<long>"))
    # Such tables are written out, so that a join's both sides are plain exchanges, of which adaptive execution splits a hot key's.
    same = materialise(found.where(f"n_bytes >= {LENGTH}").groupBy("sha").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th")).alias("one")).where("copies > 1"))
    states = found.join(same.select("sha", "copies"), "sha", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    firsts = same.select("sha", "copies", "one")
    # One text of each group of copies; rows that repeat under one doc_id all stand for it.
    texts = found.where("size(phrases) > 0").join(firsts, "sha", "left").where(F.col("one").isNull() | F.struct("doc_id", "th").eqNullSafe(F.col("one")))
    texts = materialise(texts.select(F.xxhash64("doc_id", "th").alias("key"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"), "phrases"))
    phrases = texts.select("key", "copies", F.explode("phrases").alias("phrase"))
    dictionary = materialise(phrases.groupBy("phrase").agg(F.sum("copies").alias("n")).where("n > 1").select("phrase"))
    known = materialise(phrases.join(dictionary, "phrase").groupBy("key").agg(F.collect_set("phrase").alias("known"), F.max("copies").alias("copies")))
    # Rows that repeat under one doc_id bring their text more than once here; all its strings count as repeated anyway.
    placed = thinned(whole.withColumn("key", F.xxhash64("doc_id", "th")), "key", known, "key").join(known, "key")
    placed = materialise(placed.select("key", "doc_id", "th", "text", "known", "copies"))
    groups = materialise(placed.select("key", "text", "known", "copies").mapInArrow(_groups, "core long, context long, more long, key long, copies long"))
    release(known, dictionary, texts)
    classes = materialise(groups.groupBy("core", "context", "more").agg(F.sum("copies").alias("n"), F.min("key").alias("key")))
    mixed = materialise(classes.groupBy("core").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).where("contexts > 1 and least = 1").select("core"))
    reading = _listed(classes.join(mixed, "core"), "context", "more", "open")
    blocks = materialise(placed.select("key", "text").join(reading, "key").mapInArrow(_blocks, "middle long, whole long, more long, key long"))
    wholes = materialise(blocks.groupBy("middle", "whole", "more").agg(F.count("*").alias("n"), F.min("key").alias("key")))
    several = materialise(wholes.groupBy("middle").agg(F.count("*").alias("wholes"), F.min("n").alias("least")).where("wholes > 1 and least = 1").select("middle"))
    reading = _listed(wholes.join(several, "middle"), "whole", "more", "open")
    strings = materialise(placed.select("key", "text").join(reading, "key").mapInArrow(_strings, "string long, more long, key long"))
    release(mixed, several)
    twice = materialise(strings.groupBy("string", "more").count().where("count > 1").select("string", "more"))
    single = _listed(strings.join(twice, ["string", "more"]), "string", "more", "strings")
    runs = _listed(blocks.join(wholes.where("n > 1").select("middle", "whole", "more"), ["middle", "whole", "more"]).select("key", "whole", "more").distinct(), "whole", "more", "blocks")
    repeated = _listed(groups.join(classes.where("n > 1").select("core", "context", "more"), ["core", "context", "more"]).select("key", "context", "more").distinct(), "context", "more", "whole")
    lone = placed.where("copies = 1").select("key", "doc_id", "text").join(repeated, "key", "left").join(runs, "key", "left").join(single, "key", "left")
    cut = lone.select("doc_id", "text", *[f"{c}{m}" for c in ("whole", "blocks", "strings") for m in ("", "_more")]).mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    searched = placed.where("copies = 1").select("doc_id", "th", F.lit(True).alias("searched")).distinct().withColumnsRenamed({"doc_id": "i", "th": "t"})
    rest = states.join(searched, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")) & (F.col("copies") == 1), "left").where("searched is null")
    all_gone = F.col("copies") > 1
    zero = F.lit(0).cast("long")
    counts = ["doc_id", "n_bytes", F.when(all_gone, F.col("n_bytes")).otherwise(zero).alias("n_removed"), F.when(all_gone, F.lit(1).cast("long")).otherwise(zero).alias("n_spans")]
    if not kept:
        rest = rest.select(*counts, F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"))
        return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")).unionByName(rest)
    rest = rest.select("doc_id", "th", "n_bytes", "copies").distinct().withColumnsRenamed({"doc_id": "r", "th": "s"})
    rest = whole.join(rest, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("th") == F.col("s"))).select(*counts, F.when(all_gone, F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"))
    return cut.unionByName(rest).withColumn("kept_sha256", F.sha2("kept", 256))
