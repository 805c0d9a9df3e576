"""Token counts of whole texts: a tokenizer library's batch encoding inside Arrow functions that return lengths only.

A step takes texts of about STEP_BYTES and cuts them into pieces at safe boundaries. Each distinct piece is encoded once a step, in
library calls balanced by bytes (CALL_BYTES each, so the memory of a call's encodings does not depend on the lengths of texts), its
length is remembered within bounds, and a text's count is the sum over its pieces. Nothing is shuffled, and a lost task is run again on
its own split.

A boundary is safe where ASCII white space follows another character: the pattern of byte-level BPE ends a pre-token there whatever
comes before or after, and merges do not cross pre-tokens. That holds for a tokenizer of that kind without normaliser, leading space or
special strings that hold white space. With any other kind (and with a SentencePiece model, which adds a space to each text it is given)
texts are encoded whole.

Defined results: a null or empty text has no bytes and no tokens; an empty table gives no rows; rows repeat as often as in the input; a
null doc_id stays; other columns, whatever their names, are not carried. Special strings inside a text become their one id, as is the
library's default. Of a very long text, memory follows the longest run without white space.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded_batches, chunks

#: Bytes of text in one step.
STEP_BYTES = 4 << 20
#: Bytes of pieces in one library call.
CALL_BYTES = 1 << 20
#: Distinct pieces (and bytes of pieces) that a worker remembers before it starts anew; longer pieces are not remembered.
CACHE = 1_000_000
CACHE_BYTES = 32 << 20

# Lead bytes of the characters among which Unicode's white space beyond ASCII is; no cut is made after any of them.
_LEAD_OF_TWO, _LEADS_OF_THREE = 0xC2, (0xE1, 0xE2, 0xE3)


def _byte_level(path: str) -> bool:
    """Whether white space after another character is a safe boundary of this tokenizers file."""
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    before = parts.get("pre_tokenizer") or {}
    special = [t["content"] for t in parts.get("added_tokens", []) if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])]
    return before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and parts.get("normalizer") is None and not special


def load(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(the token counts of some texts, whether a text may be cut): tokenizers for .json, sentencepiece for .model."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
    # One thread a task: Spark runs the tasks of an executor side by side.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    found = tokenizers.Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return lambda texts: [len(e) for e in found.encode_batch_fast(texts, add_special_tokens=False)], _byte_level(path)


def piece_starts(data: np.ndarray, offsets: np.ndarray, cut: bool) -> np.ndarray:
    """Where pieces begin: at each text's begin and, if texts may be cut, at ASCII white space after another character."""
    begins = np.zeros(len(data), bool)
    if cut and len(data) > 1:
        space = SPACE[data]
        # Information separators are white space to some libraries only.
        before = ~(space | ((data >= 0x1C) & (data <= 0x1F)))
        after = data >= 0x80
        wide = np.zeros(len(data), bool)
        wide[1:] = after[1:] & (data[:-1] == _LEAD_OF_TWO)
        wide[2:] |= after[2:] & np.isin(data[:-2], _LEADS_OF_THREE)
        begins[1:] = space[1:] & (before & ~wide)[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


class Lengths:
    """Token counts of pieces, encoded once each while they are remembered."""

    def __init__(self, path: str):
        self.count, self.cut = load(path)
        self._forget()

    def _forget(self) -> None:
        self.pieces, self.lengths, self.bytes = pa.array([], pa.large_binary()), np.zeros(0, np.int64), 0

    def _encoded(self, pieces: pa.Array, sizes: np.ndarray) -> np.ndarray:
        """Library calls of about CALL_BYTES, or one piece."""
        out, at, ends = np.zeros(len(pieces), np.int64), 0, np.cumsum(sizes)
        while at < len(pieces):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CALL_BYTES, side="right")))
            out[at:end] = self.count([p.decode() for p in pieces.slice(at, end - at).to_pylist()])
            at = end
        return out

    def of(self, pieces: pa.Array) -> np.ndarray:
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        known = pc.fill_null(pc.index_in(distinct, value_set=self.pieces), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = known < 0
        out = np.zeros(len(distinct), np.int64)
        out[~new] = self.lengths[known[~new]]
        if new.any():
            some = distinct.filter(pa.array(new))
            sizes = pc.binary_length(some).to_numpy().astype(np.int64)
            out[new] = found = self._encoded(some, sizes)
            keep = sizes <= 256
            if len(self.pieces) + int(keep.sum()) > CACHE or self.bytes + int(sizes[keep].sum()) > CACHE_BYTES:
                self._forget()
            self.pieces = pa.concat_arrays([self.pieces, some.filter(pa.array(keep))])
            self.lengths, self.bytes = np.r_[self.lengths, found[keep]], self.bytes + int(sizes[keep].sum())
        return out[coded.indices.to_numpy()]

    def of_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Counts of texts that lie end to end."""
        starts = piece_starts(data, offsets, self.cut)
        total = np.r_[0, np.cumsum(self.of(_binary(data, np.r_[starts, len(data)])))] if len(starts) else np.zeros(1, np.int64)
        return np.diff(total[np.searchsorted(starts, offsets)])


_loaded: dict[str, Lengths] = {}


def counts(path: str, batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with the number of tokens of each row's text; a null text has none."""
    if path not in _loaded:
        _loaded[path] = Lengths(path)
    for part, data, offsets in chunks(batches, column, STEP_BYTES):
        yield part, _loaded[path].of_texts(data, offsets)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than limit tokens) of every whole text, by the tokenizer at path."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n in counts(path, batches):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    found = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
