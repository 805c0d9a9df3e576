"""Shared helpers: shared-folder materialisation, Arrow text buffers, vectorised digests of words, word runs and byte spans."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII whitespace that separates words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text that one vectorised step takes; a longer text is a step of its own.
CHUNK_BYTES = 1 << 21
#: Bytes of one Arrow batch that Spark sends to Python.
BATCH_BYTES = 4 << 20

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one of our own in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


#: With it Spark deletes a query's shuffle files when the query ends, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage and survives lost executors. The shuffle files of
    the write go with it, so that those of one write at a time are on disk."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more: neither the result nor a table yet to be written."""
    for df in tables:
        _written.remove((df.sparkSession, df._written_at))
        _delete(df.sparkSession, df._written_at)


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended before the interpreter  # noqa: BLE001
            return


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that very long texts do not fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (a null text becomes an empty one) and the named columns; any other column is dropped."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, end to end, and the n + 1 row offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of at most limit bytes of the column (or one row), with their bytes and offsets."""
    for batch in batches:
        data, offsets = byte_buffer(batch.column(batch.schema.get_field_index(column)))
        row, n = 0, batch.num_rows
        while row < n:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
            end = min(end, n)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word, and the n + 1 word offsets of the rows. Words do not cross rows."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (shift, multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit digests of words, 8 bytes a round through the finaliser: words of one length up to 8 bytes never share one.

    Digests of two seeds are independent; together they are 128 bits.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = ends - starts
    out = mix(left.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))
    which = np.flatnonzero(left > 0)
    at, left = starts[which], left[which]
    while len(which):
        out[which] = mix(out[which] ^ (lanes[at] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return out


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Digests of every k consecutive values (digests themselves), by doubling: log k rounds of the finaliser."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    level, width, done, out = values, 1, 0, None
    while True:
        if k & width:
            some = level[done : done + n]
            out = some if out is None else _paired(out, some)
            done += width
        if 2 * width > k:
            return mix(out + np.uint64(k * 0xA24BAED4963EE407 % (1 << 64)))
        level, width = _paired(level[:-width], level[width:]), 2 * width


#: Fingerprints of byte spans are polynomials modulo this prime, at two fixed places.
PRIME = (1 << 61) - 1
_PLACES = (0x0DA5_4C32_D192_ED03 % PRIME, 0x1357_A9B1_1E52_8C6F % PRIME)
#: Exponents start anew at multiples of this, so the tables of powers are of one size whatever the text's.
_TURN = 1 << 20
_LOW31, _LOW30, _LOW61 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1), np.uint64(PRIME)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _LOW61) + (x >> np.uint64(61))
    return np.where(x >= _LOW61, x - _LOW61, x)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x * y modulo PRIME, of uint64 below it."""
    x1, x0, y1, y0 = x >> np.uint64(31), x & _LOW31, y >> np.uint64(31), y & _LOW31
    middle = x1 * y0 + x0 * y1
    return _reduced(np.uint64(2) * x1 * y1 + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + x0 * y0)


def _powers_of(base: int) -> np.ndarray:
    out = np.ones(_TURN, np.uint64)
    width = 1
    while width < _TURN:
        out[width : 2 * width] = _times(out[:width], np.full(width, pow(base, width, PRIME), np.uint64))
        width *= 2
    return out


_powers: list[tuple[np.ndarray, np.ndarray]] = []


class Fingerprints:
    """Karp-Rabin fingerprints of the spans of a chunk: equal spans have equal ones, and the two places are independent."""

    def __init__(self, data: np.ndarray):
        if not _powers:
            _powers.extend((_powers_of(b), _powers_of(pow(b, -1, PRIME))) for b in _PLACES)
        n = len(data)
        values = data.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for power, _ in _powers:
            low, high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
            for at in range(0, n, _TURN):
                some, p = values[at : at + _TURN], power[: min(_TURN, n - at)]
                low[at + 1 : at + 1 + len(some)] = some * (p & _LOW31)
                high[at + 1 : at + 1 + len(some)] = some * (p >> np.uint64(31))
            # Sums may pass 2**64; the differences of spans under 2**25 bytes do not.
            self.sums.append((np.cumsum(low, out=low), np.cumsum(high, out=high)))

    def _plain(self, start: np.ndarray, end: np.ndarray, place: int) -> np.ndarray:
        low, high = self.sums[place]
        high = _reduced(high[end] - high[start])
        total = _reduced(_reduced(low[end] - low[start]) + (high >> np.uint64(30)) + ((high & _LOW30) << np.uint64(31)))
        return _times(total, _powers[place][1][start % _TURN])

    def of(self, start: np.ndarray, end: np.ndarray, place: int = 0) -> np.ndarray:
        """Of the spans [start, end), none of them empty; the length enters the fingerprint."""
        turn = (start // _TURN + 1) * _TURN
        found = self._plain(start, np.minimum(end, turn), place)
        over = np.flatnonzero(end > turn)
        if len(over):
            rest = self._plain(turn[over], end[over], place)
            found[over] = _reduced(found[over] + _times(rest, _powers[place][0][(turn - start)[over]]))
        return mix(found ^ mix((end - start).astype(np.uint64) + np.uint64(place)))


def gram_starts(row_offsets: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k consecutive items of one row start."""
    n = int(row_offsets[-1])
    ok = np.ones(n, bool)
    counts = np.diff(row_offsets)
    for back in range(1, k):
        at = row_offsets[1:][counts >= back] - back
        ok[at] = False
    return np.flatnonzero(ok)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width keys, by doubling."""
    if len(keys) < width:
        return keys[:0]
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if width > span else keys


def row_sets(part: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column (as uint64) and the row of each."""
    found = part.column(part.schema.get_field_index(column))
    rows = np.repeat(np.arange(part.num_rows), np.asarray(pc.fill_null(pc.list_value_length(found), 0)))
    return np.asarray(found.flatten()).view(np.uint64) if len(rows) else np.zeros(0, np.uint64), rows


def members(values: np.ndarray, rows: np.ndarray, set_values: np.ndarray, set_rows: np.ndarray) -> np.ndarray:
    """Whether each (row, value) is among the (row, value) of the sets; both rows ascend."""
    out = np.zeros(len(values), bool)
    at = np.unique(set_rows)
    a, b = np.searchsorted(rows, at), np.searchsorted(rows, at, side="right")
    c, d = np.searchsorted(set_rows, at), np.searchsorted(set_rows, at, side="right")
    for i in range(len(at)):
        out[a[i] : b[i]] = np.isin(values[a[i] : b[i]], set_values[c[i] : d[i]])
    return out


def row_texts(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the spans."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """list<int64> with the given n + 1 offsets over uint64 values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.uint64).view(np.int64)))


def unique_pairs(rows: np.ndarray, first: np.ndarray, second: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each row, ascending, and the n + 1 offsets."""
    order = np.lexsort((second, first, rows))
    rows, first, second = rows[order], first[order], second[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return first[keep], second[keep], np.searchsorted(rows[keep], np.arange(n + 1))


def unique_per_row(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending, and the n + 1 offsets."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    rows, values = rows[keep], values[keep]
    return values, np.searchsorted(rows, np.arange(n + 1))
