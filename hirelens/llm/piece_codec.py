"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The text is split into words, each a run of space marks and the characters up to the next mark, which no piece joins. The words of
a step tile one byte buffer; its distinct words, less those remembered from earlier steps, lie end to end in flat numpy arrays of
symbols. A word is cut further where no piece that occurs there spans two characters. Each round finds the best pair rank of every
part (a segmented minimum), merges its occurrences from the left in all parts at once, looks up the two pairs beside each merge
again, and compacts the arrays, until no pair is left. Where a merge makes a pair that is better than the rank of the round, the
part takes its leftmost merge alone, so the order is that of merging one pair at a time, the best and then the leftmost first.
Ids, their decimal digits and their bytes are put together per word, and taken per text, by Arrow.

Defined results: a null or empty text gives no ids, an empty table no rows; a character that no piece holds becomes its UTF-8 bytes'
pieces; rows repeat as often as in the input; a null doc_id stays; other columns, whatever their names, are not carried. A text of
more than STEP_BYTES is taken in steps that end before a space, so memory follows the longest run of text without one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

MARK = "▁"
#: Bytes of text in one step.
STEP_BYTES = 4 << 20
#: Distinct words (and bytes of words) that a worker remembers before it starts anew.
CACHE = 400_000
CACHE_BYTES = 32 << 20
_NONE = np.iinfo(np.int32).max


class Table:
    """Whole numbers from 0 to values, in open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]  # the last of those that meet
            own = self.keys[slot] == keys[left]
            self.values[slot[own]] = values[left[own]]
            left, slot = left[~own], (slot[~own] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or _NONE."""
        slot = self._slots(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], _NONE)
        more = np.flatnonzero((held != keys) & (held != -1))
        while len(more):
            slot[more] = (slot[more] + 1) & self.mask
            held = self.keys[slot[more]]
            hit = held == keys[more]
            out[more[hit]] = self.values[slot[more[hit]]]
            more = more[~hit & (held != -1)]
        return out


class PieceModel:
    """The vocabulary of a SentencePiece BPE model with byte fallback, an added leading space and no other normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.pieces = [m.id_to_piece(i) for i in range(n)]
        special = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)]
        is_byte = [m.is_byte(i) for i in range(n)]
        plain = [i for i in range(n) if not special[i] and not is_byte[i]]
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if is_byte[i]:
                self.byte_ids[int(self.pieces[i][3:-1], 16)] = i
        ids = {self.pieces[i]: i for i in plain}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("a piece joins words; this vocabulary needs whole-text merges")
        self.raw = [b"" if special[i] else bytes([int(self.pieces[i][3:-1], 16)]) if is_byte[i] else self.pieces[i].replace(MARK, " ").encode() for i in range(n)]
        self.n = n
        order = sorted(plain, key=lambda i: (-m.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        pairs = []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs.append((a * n + b, rank[i]))
        self.by_rank = np.array(order, np.int32)
        self.pairs = Table(np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int32))
        # Symbols: the pieces, and n + code point for a character that is none. A space is the mark.
        self.symbol = np.arange(n, n + 0x110000, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.symbol[ord(" ")] = self.symbol[ord(MARK)]
        threes = {piece[k : k + 3] for piece in ids for k in range(len(piece) - 2)}
        points = np.array([[ord(" ") if c == MARK else ord(c) for c in t] for t in sorted(threes)], np.int64).reshape(-1, 3)
        self.threes = Table(self._three(points[:, 0], points[:, 1], points[:, 2]), np.zeros(len(points), np.int32))
        self.digits = pa.array([b",%d" % i for i in range(n)], pa.large_binary())
        self.bytes = pa.array(self.raw, pa.large_binary())

    @staticmethod
    def _three(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) << 42) | (b.astype(np.int64) << 21) | c

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair makes; _NONE where it makes none."""
        found = self.pairs.find(left.astype(np.int64) * self.n + right)
        found[right >= self.n] = _NONE  # n + code point is no second symbol of the next row of keys
        return found

    def parts(self, points: np.ndarray, first: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The part of each character: words (that begin where first is set) cut where no piece spans two characters."""
        spans = np.zeros(len(points) + 1, bool)  # spans[i + 1]: some piece holds characters i, i + 1 and i + 2
        if len(points) > 2:
            spans[1:-2] = self.threes.find(self._three(points[:-2], points[1:-1], points[2:])) != _NONE
        begins = np.ones(len(points), bool)
        begins[1:] = first[1:] | ((rank[:-1] == _NONE) & ~spans[:-2] & ~spans[1:-1])
        return np.cumsum(begins, dtype=np.int32)

    def merge_rounds(self, symbols: np.ndarray, part: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge parts that lie end to end; returns the symbols left and the part of each, in order.

        rank holds the rank of each symbol's pair with the next one, _NONE at the end of a part.
        """
        done_part, done_symbol = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(symbols)])
            if not (active := best < _NONE).all():
                live = np.repeat(active, length)
                done_part.append(part[~live])
                done_symbol.append(symbols[~live])
                symbols, part, rank, best, length = symbols[live], part[live], rank[live], best[active], length[active]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, length))
            # Of a row of overlapping pairs, every other one from the left.
            starts = np.r_[True, hit[1:] != hit[:-1] + 1]
            nth = np.arange(len(hit)) - np.maximum.accumulate(np.where(starts, np.arange(len(hit)), 0))
            hit = hit[nth % 2 == 0]
            made = self.by_rank[rank[hit]]
            before, after = self._beside(symbols, part, hit, made)
            worse = np.minimum(before, after) < rank[hit]
            if worse.any():
                alone = np.isin(part[hit], part[hit[worse]])
                hit = hit[~alone | np.r_[True, part[hit[1:]] != part[hit[:-1]]]]
                made = self.by_rank[rank[hit]]
                before, after = self._beside(symbols, part, hit, made)
            symbols[hit] = made
            rank[hit] = after
            place = hit - 1
            place[1:] -= hit[:-1] == hit[1:] - 2  # of two merges side by side the pair is held by the first's symbol
            rank[place[hit > 0]] = before[hit > 0]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, part, rank = symbols[keep], part[keep], rank[keep]
        part = np.concatenate(done_part) if done_part else np.zeros(0, np.int32)
        symbols = np.concatenate(done_symbol) if done_symbol else np.zeros(0, np.int32)
        order = np.argsort(part, kind="stable")
        return symbols[order], part[order]

    def _beside(self, symbols: np.ndarray, part: np.ndarray, hit: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the pairs of each merged symbol with the one before (merged, if it is) and with the one after (as it was)."""
        before, after = np.full(len(hit), _NONE, np.int32), np.full(len(hit), _NONE, np.int32)
        some = np.flatnonzero((hit > 0) & (part[hit - 1] == part[hit]))
        left = symbols[hit[some] - 1]
        joined = np.flatnonzero((some > 0) & (hit[some - 1] == hit[some] - 2))
        left[joined] = made[some[joined] - 1]
        before[some] = self.ranks(left, made[some])
        some = np.flatnonzero(hit + 2 < len(symbols))
        some = some[part[hit[some] + 2] == part[hit[some]]]
        after[some] = self.ranks(made[some], symbols[hit[some] + 2])
        return before, after

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (binary, each a run of spaces, then other characters) end to end, and the n + 1 offsets."""
        data, offsets = _buffers(words)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        starts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
        word = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(starts))
        first = np.r_[True, word[1:] != word[:-1]] if len(word) else np.zeros(0, bool)
        symbols = self.symbol[points]
        rank = np.full(len(points), _NONE, np.int32)
        if len(points) > 1:
            rank[:-1] = np.where(first[1:], _NONE, self.ranks(symbols[:-1], symbols[1:]))
        part = self.parts(points, first, rank)
        of_part = word[np.flatnonzero(np.r_[True, part[1:] != part[:-1]])] if len(part) else word
        symbols, part = self.merge_rounds(symbols, part - 1, rank)
        word = of_part[part] if len(part) else word
        if (symbols >= self.n).any():
            symbols, word = self._as_bytes(symbols, word)
        return symbols, np.searchsorted(word, np.arange(len(words) + 1))

    def _as_bytes(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that no piece holds become the pieces of their UTF-8 bytes."""
        unknown = symbols >= self.n
        distinct, inverse = np.unique(symbols[unknown], return_inverse=True)
        coded = [chr(c - self.n).encode() for c in distinct.tolist()]
        length = np.ones(len(symbols), np.int64)
        length[unknown] = np.array([len(c) for c in coded])[inverse]
        at = (np.cumsum(length) - length)[unknown]
        out, word = np.repeat(symbols, length), np.repeat(word, length)
        for k in range(4):
            nth = np.array([c[k] if k < len(c) else -1 for c in coded])[inverse]
            out[at[nth >= 0] + k] = self.byte_ids[nth[nth >= 0]]
        return out, word

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: pieces and byte runs joined, space marks as spaces, the added leading space removed."""
        return joined_text(b"".join(self.raw[i] for i in ids))


def joined_text(raw: bytes) -> str:
    """Bytes that are no UTF-8 become one replacement character each."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = _replaced(raw)
    return text[1:] if text.startswith(" ") else text


def _replaced(raw: bytes) -> str:
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def _buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a large_binary array without nulls."""
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8) if len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def _joined(array: pa.Array, picked: np.ndarray, at: np.ndarray) -> pa.Array:
    """Of the binaries picked from array, those between each two of the n + 1 numbers at, joined."""
    data, offsets = _buffers(array.take(pa.array(picked)))
    return _binary(data, offsets[at])


class Coder:
    """Encodes buffers of words, and remembers the words it has met."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_binary())
        self.ids, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.digits = self.bytes = self.words

    def _learn(self, words: pa.Array) -> None:
        ids, at = self.model.encode_words(words)
        self.words = pa.concat_arrays([self.words, words])
        self.digits = pa.concat_arrays([self.digits, _joined(self.model.digits, ids, at)])
        self.bytes = pa.concat_arrays([self.bytes, _joined(self.model.bytes, ids, at)])
        self.ids, self.at = np.r_[self.ids, ids], np.r_[self.at, at[1:] + self.at[-1]]

    def places(self, words: pa.Array) -> np.ndarray:
        """The place of each word among those remembered; what is new is encoded first."""
        coded = words.dictionary_encode()
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = known < 0
        if len(self.words) + int(new.sum()) > CACHE or len(_buffers(self.words)[0]) > CACHE_BYTES:
            self._forget()
            new[:] = True
        if new.any():
            known[new] = len(self.words) + np.arange(int(new.sum()))
            self._learn(coded.dictionary.filter(pa.array(new)))
        return known[coded.indices.to_numpy()]


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _model(path: str) -> PieceModel:
    return coder(path).model


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin in texts that each begin with a space: at a space after another character, and at a text's begin."""
    space = data == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def _steps(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(rows, their text with spaces for marks and one before it) of about STEP_BYTES; a long text in several steps."""
    rows, taken, size = [], [], 0
    for row, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        data, at = b" " + text.replace(MARK, " ").encode(), 0
        while at < len(data):
            end = len(data)
            if end - at > STEP_BYTES:
                # Before a space that follows another character.
                end = data.find(b" ", at + STEP_BYTES)
                while end > 0 and data[end - 1] == 0x20:
                    end = data.find(b" ", end + 1)
                end = end if end > 0 else len(data)
            rows.append(row)
            taken.append(data[at:end])
            size += end - at
            at = end
            if size >= STEP_BYTES:
                yield np.array(rows), taken
                rows, taken, size = [], [], 0
    if rows:
        yield np.array(rows), taken


def coded(path: str, texts: pa.Array, ids: bool = False) -> Iterator[tuple]:
    """(number of ids, digest of the ids joined by commas, digest of the decoded text, and with ids the ids and the decoded text) of each text."""
    found = coder(path)
    state = [[0, hashlib.sha256(), [], []] for _ in range(len(texts))]
    for rows, taken in _steps(texts):
        data = np.frombuffer(b"".join(taken), np.uint8)
        offsets = np.r_[0, np.cumsum([len(t) for t in taken])]
        starts = word_starts(data, offsets)
        place = found.places(_binary(data, np.r_[starts, len(data)]))
        words = np.searchsorted(starts, offsets)
        count = np.r_[0, np.cumsum(np.diff(found.at)[place])][words]
        digits, raw = (_buffers(_joined(column, place, words)) for column in (found.digits, found.bytes))
        digit_bytes, raw_bytes = digits[0].tobytes(), raw[0].tobytes()
        for k, row in enumerate(rows.tolist()):
            s = state[row]
            part = digit_bytes[digits[1][k] : digits[1][k + 1]]
            s[1].update(part if s[0] else part[1:])
            s[0] += int(count[k + 1] - count[k])
            s[3].append(raw_bytes[raw[1][k] : raw[1][k + 1]])
            if ids:
                s[2].append(np.concatenate([found.ids[found.at[p] : found.at[p + 1]] for p in place[words[k] : words[k + 1]]]))
    for n, digest, some, parts in state:
        decoded = joined_text(b"".join(parts))
        row = (n, digest.hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        yield (*row, np.concatenate(some) if some else np.zeros(0, np.int32), decoded) if ids else row


def encode(path: str, text: str | None) -> list[int]:
    """The ids of one text."""
    return next(coded(path, pa.array([text], pa.string()), ids=True))[3].tolist()


def encode_documents(docs: DataFrame, model_path: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; with ids=True also the ids and the decoded text.

    One narrow pass: no shuffle, and a lost task is run again on its own split.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*coded(model_path, batch.column(1), ids), strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * ids
    types = [pa.int64(), pa.string(), pa.string()] + ([pa.list_(pa.int32()), pa.string()] if ids else [])
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
