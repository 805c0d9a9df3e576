"""Drop lines that many documents share.

Lines are exploded to normalised keys (128-bit digests, once per document), distinct documents are counted per key with
partial sums before each shuffle, and every document gets the list of its own keys over the threshold, by which a last
pass drops lines and joins the rest in their order. A line shared by a third of all documents is one counter per map
task; the only list kept together is that of one document's own keys.

Defined results: a null or empty text is one empty line, which has no key and stays; a null doc_id is one document; rows with
one doc_id count as one document and each keeps its own row; other columns follow unchanged in row, so their names
cannot clash; a very long text is one row of a batch of its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, documents, materialise


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip(b" \t\n\v\f\r").lower()


def _digest(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(key)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, high, low = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for key in {line_key(x) for x in text.encode().split(b"\n")}:
                    if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        a, b = _digest(key)
                        ids.append(doc_id)
                        high.append(a)
                        low.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["doc_id", "high", "low"])

    return run


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        for text, drop in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = text.encode()
            n_lines.append(raw.count(b"\n") + 1)
            if not drop:
                kept.append(text)
                n_dropped.append(0)
                continue
            hot = {(d["high"], d["low"]) for d in drop}
            lines = raw.split(b"\n")
            stay = [x for x in lines if not (key := line_key(x)) or _digest(key) not in hot]
            kept.append(b"\n".join(stay).decode())
            n_dropped.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=["row", "kept", "n_lines", "n_dropped"])


def drop_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """row (a struct of the input's columns without text), kept (the text that stays), n_lines, n_dropped."""
    bounded_batches(docs.sparkSession)
    others = [docs[c] for c in docs.columns if c != "text"]
    keys = documents(docs).mapInArrow(_keys(min_chars), "doc_id long, high long, low long")
    hot = keys.groupBy("high", "low").agg(F.countDistinct(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()).alias("n")).where(F.col("n") >= min_docs).drop("n")
    hot = materialise(hot)  # so that the join is of plain exchanges, of which adaptive execution splits a hot line's
    drops = keys.join(hot, ["high", "low"]).groupBy("doc_id").agg(F.collect_set(F.struct("high", "low")).alias("drop")).withColumnRenamed("doc_id", "drop_id")
    whole = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.struct(*others).alias("row"))
    joined = whole.join(drops, F.col("row.doc_id").cast("long").eqNullSafe(F.col("drop_id")), "left").select("text", "row", "drop")
    row_type = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_reassemble, f"row {row_type}, kept string, n_lines long, n_dropped long")
