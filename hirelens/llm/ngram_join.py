"""Link documents whose word n-gram sets have a Jaccard similarity of at least percent / 100; components of the links.

Universe partition: bands of set sizes grow by half; in a band, two linked sets differ in at most H tokens, so tokens hashed to
H + 1 segments leave one segment without a difference (pigeonhole). Every set indexes its segment subsets. Segments without
tokens are no evidence and cost nothing: for the e segments that are empty in a set, the allocation moves to the one-deletion
neighbourhoods of its first e segments of two tokens or more. If all equal segments of a linked pair are empty ones, k of them,
then at most k - 1 other segments differ by more than one token, so one of those first e differs by one and meets there; this needs
fewer than half of a set's segments to be empty, and the (practically never) other sets meet by prefix tokens. Sets of up to SMALL
tokens meet by prefix tokens too, where segments would hold too few. A set near a band's lower edge is also indexed in the band
below, as the larger partner.

Equal sets are one node (named by a 64-bit digest), so a group of exact copies costs one row per signature and map task. Signatures meet through an aggregate
(least and greatest node). Before any texts are fetched, parities of the tokens in SKETCH words of 64 places rule out pairs whose sets
surely differ in too many tokens: an odd place in the sum of two sets has a token of only one of them. Groups of up to FEW nodes give
their pairs, a bounded number each. Of larger groups only sketches meet, in blocks of about WIDE nodes, and a block pair gives a spanning
forest of what they leave, so that short sets with a frequent token in common are no cluster. What is left, pairs and the clusters that
the forests make, meets once more by finer sketches of FINE words, for the short ones say nothing of long sets. The clusters that
are left then are verified in blocks of about BLOCK nodes, or fewer where their texts have over BLOCK_BYTES, by matrix products; a block pair gives a
spanning forest of its links, never all pairs. All candidates are verified exactly on their sets.

Defined results: words are ASCII lower-cased; fewer words than n make one shingle; without words the set is empty and the
document is its own component; rows are documents of their own even under one doc_id; a null doc_id has a null component unless linked with another; other columns are
not carried; a very long text is taken whole, as a step of its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, byte_buffer, chunks, documents, gram_hashes, gram_starts, materialise, mix, release, unique_per_row, word_bounds, word_hashes
from .components import components, thinned

FEW = 16
BLOCK = 512
#: Nodes of a signature in a block of sketches, about.
WIDE = 4096
#: Bytes of text in a block of a cluster, about; a longer text has a block of its own.
BLOCK_BYTES = 32 << 20
SMALL = 27
#: Words of 64 bits in a set's sketch of parities.
SKETCH = 8
#: Words of the fine sketch, which tells long sets apart, and nodes in a block of them, about.
FINE = 64
FINE_BLOCK = 2048
#: Groups of up to so many sketches are compared as one matrix.
MATRIX = 128
#: Signature that marks sets of which too many segments are empty.
SPARSE = 0


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's distinct shingles, ascending, and the row offsets."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, words = word_bounds(data, offsets)
    rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    digests = word_hashes(data, starts, ends)
    at = gram_starts(words, n)
    counts = np.diff(words)
    values, of = [gram_hashes(digests, n)[at]], [np.searchsorted(words, at, side="right") - 1]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            values.append(gram_hashes(digests, k)[words[short]])
            of.append(short)
    return unique_per_row(np.concatenate(of), np.concatenate(values), rows)


def text_sets(texts: list[str], n: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, data, offsets in chunks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])])):
        values, at = shingle_sets(data, offsets, n)
        out += [values[at[i] : at[i + 1]] for i in range(len(at) - 1)]
    return out


def nodes(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A digest of each set (0 for an empty one)."""
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)))]
    return np.where(np.diff(at) > 0, mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)), np.uint64(0))


def parities(values: np.ndarray, at: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """For each of so many words (rows of the result), the bits at which an odd number of a set's tokens falls."""
    place = mix(values ^ np.uint64(0x3C79AC492BA7B653)) >> np.uint64(32)
    word, bit = place % np.uint64(words), np.uint64(1) << (place >> np.uint64(26))
    out = np.zeros((words, len(at) - 1), np.uint64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    np.bitwise_xor.at(out, (word.astype(np.int64), row), bit)
    return out


def near(sizes: np.ndarray, other_sizes: np.ndarray, odd: np.ndarray, percent: int) -> np.ndarray:
    """What `may_link` says, of arrays; odd is the number of odd places of both."""
    return (100 + percent) * np.maximum(odd, np.abs(sizes - other_sizes)) <= (100 - percent) * (sizes + other_sizes)


def may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets may link. Sets of x and y tokens that differ in d have a union of (x + y + d) / 2 and share
    (x + y - d) / 2, so they link when (100 + percent) * d <= (100 - percent) * (x + y); the odd places of both never exceed d."""
    names = ["n_shingles", *(f"s{k}" for k in range(SKETCH))]
    side = lambda c: sketches.select(F.col("node").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in names))
    odd = "+".join(f"bit_count(a_s{k} ^ b_s{k})" for k in range(SKETCH))
    least = f"greatest({odd}, abs(a_n_shingles - b_n_shingles))"
    fits = f"{100 + percent} * {least} <= {100 - percent} * (a_n_shingles + b_n_shingles)"
    return pairs.join(side("a"), "a").join(side("b"), "b").where(fits).select("a", "b")


def loose_forest(sizes: np.ndarray, sketches: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs that the sketches (columns) leave, as the rows at both ends of its edges."""
    left, size, sketch, fits = np.arange(len(sizes)), sizes, sketches, None
    if len(sizes) <= MATRIX:
        odd = np.bitwise_count(sketches[:, :, None] ^ sketches[:, None, :]).sum(axis=0, dtype=np.int64)
        fits = near(sizes[:, None], sizes[None, :], odd, percent)
        left = np.flatnonzero(fits.sum(axis=0) > 1)
    a, b = [], []
    while len(left):
        queue, left, size, sketch = [left[0]], left[1:], size[1:], sketch[:, 1:]
        while queue and len(left):
            x = queue.pop()
            if fits is not None:
                hit = fits[x, left]
            else:
                hit = near(size, sizes[x], np.bitwise_count(sketch ^ sketches[:, x : x + 1]).sum(axis=0, dtype=np.int64), percent)
            if hit.any():
                reached = left[hit]
                a.append(np.full(len(reached), x))
                b.append(reached)
                queue += reached.tolist()
                left = left[~hit]
                if fits is None:
                    size, sketch = size[~hit], sketch[:, ~hit]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _loose_links(percent: int):
    """Forests of groups of sketches, each group a row with a list of (node, n_shingles, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            cuts = np.r_[0, np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))]
            node, size, *words = rows.flatten().flatten()
            node, size = (x.to_numpy(zero_copy_only=False) for x in (node, size))
            if len(words) == 1:
                sketches = np.ascontiguousarray(byte_buffer(words[0])[0].view(np.uint64).reshape(len(node), FINE).T)
            else:
                sketches = np.stack([x.to_numpy(zero_copy_only=False).view(np.uint64) for x in words])
            a, b = [node[:0]], [node[:0]]
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                x, y = loose_forest(size[low:high], sketches[:, low:high], percent)
                a.append(node[low:high][x])
                b.append(node[low:high][y])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def loose_links(members: DataFrame, group: str, count: str, sketches: DataFrame, block: int, percent: int) -> DataFrame:
    """Links (a, b) that span what the sketches (of node) leave of the pairs of each group of members, met in blocks of about so many."""
    dealt = members.withColumn("blocks", F.ceil(F.col(count) / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).where("block != other or blocks = 1")
    dealt = dealt.select(group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node").join(sketches, "node")
    columns = ["node", "n_shingles", *(c for c in sketches.columns if c not in ("node", "n_shingles"))]
    return dealt.groupBy(group, "i", "j").agg(F.collect_list(F.struct(*columns)).alias("rows")).select("rows").mapInArrow(_loose_links(percent), "a long, b long")


class Bands:
    """Size bands for a threshold: edges grow by half, and a band has one segment more than its sets may differ in."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        edges = [SMALL + 1]
        while edges[-1] <= largest:
            edges.append(edges[-1] * 3 // 2)
        self.edges = np.array(edges, np.int64)  # band b holds sizes edges[b] .. edges[b + 1] - 1
        self.top = np.r_[self.edges[1:], self.edges[-1] * 3 // 2] - 1
        self.segments = self.top * (100 - percent) // percent + 1

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (-(-n * self.percent // 100)) + 1


def _prefix_rows(values: np.ndarray, at: np.ndarray, which: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and rows of the first tokens (sets ascend by hash, a common order) of the rows."""
    n = np.diff(at)[which]
    take = bands.prefix(n)
    index = np.repeat(at[which] - np.r_[0, np.cumsum(take)[:-1]], take) + np.arange(int(take.sum()))
    return mix(values[index] ^ np.uint64(0x1D8E4E27C47D124F)) | np.uint64(1), np.repeat(which, take)


def _segment_rows(values: np.ndarray, at: np.ndarray, which: np.ndarray, band: np.ndarray, bands: Bands, most_empty: float) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and rows: segment subsets, and one-deletion neighbourhoods in place of empty segments."""
    if not len(which):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = np.diff(at)[which]
    m = bands.segments[band]
    base = np.r_[0, np.cumsum(m)]
    owner = np.repeat(np.arange(len(which)), n)
    token = values[np.repeat(at[which] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))]
    segment = ((mix(token ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)) * m[owner].astype(np.uint64)) >> np.uint64(32)
    place = base[owner] + segment.astype(np.int64)
    order = np.argsort(place, kind="stable")
    place, weight = place[order], mix(token[order] ^ np.uint64(0x9FB21C651E98DF25))
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    size = np.diff(np.r_[first, len(place)])
    total = np.add.reduceat(weight, first)
    slot = place[first]
    slot_owner = np.searchsorted(base, slot, side="right") - 1
    salt = mix((slot - base[slot_owner]).astype(np.uint64) * np.uint64(2654435761) + band[slot_owner].astype(np.uint64) + np.uint64(7))
    signature = mix(total ^ salt)
    full = np.bincount(slot_owner, minlength=len(which))
    empty = m - full
    big = size >= 2
    nth = np.cumsum(big) - np.r_[0, np.cumsum(np.bincount(slot_owner, weights=big, minlength=len(which)).astype(np.int64))][slot_owner]
    open_slots = np.flatnonzero(big & (nth <= empty[slot_owner]))
    k = size[open_slots]
    index = np.repeat(first[open_slots] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(int(k.sum()))
    deleted = mix((np.repeat(total[open_slots], k) - weight[index]) ^ np.repeat(salt[open_slots], k))
    sparse = np.flatnonzero(2 * empty * 1.0 >= (m + 1) * 2 * most_empty)
    out = np.r_[signature, deleted] | np.uint64(1)
    return np.r_[out, np.zeros(len(sparse), np.uint64)], which[np.r_[slot_owner, np.repeat(slot_owner[open_slots], k), sparse]]


def signatures(values: np.ndarray, at: np.ndarray, percent: int, most_empty: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets and the row of each; SPARSE marks a set with too many empty segments."""
    n = np.diff(at)
    bands = Bands(percent, int(n.max(initial=0)))
    parts = [_prefix_rows(values, at, np.flatnonzero((n > 0) & (n * percent <= SMALL * 100)), bands)]
    own = np.searchsorted(bands.edges, n, side="right") - 1
    which = np.flatnonzero(n > SMALL)
    down = 0
    while len(which):
        parts.append(_segment_rows(values, at, which, own[which] - down, bands, most_empty))
        down += 1
        which = which[own[which] - down >= 0]
        which = which[100 * bands.top[own[which] - down] >= percent * n[which]]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class _Forest:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def linked_in_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets at left and those at right (indices; the same or disjoint)."""
    sizes = np.array([len(s) for s in sets])
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    shared = counts[inverse] > 1
    rows, columns = np.repeat(np.arange(len(sets)), sizes)[shared], number[inverse[shared]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common = np.zeros((len(left), len(right)), np.int64)
    step = 2048
    for low in range(0, int(columns[-1]) + 1 if len(columns) else 0, step):
        a, b = np.searchsorted(columns, [low, low + step])
        matrix = np.zeros((len(sets), step), np.float32)
        matrix[rows[a:b], columns[a:b] - low] = 1
        common += (matrix[left] @ matrix[right].T).astype(np.int64)  # a step's counts are at most 2048, exact as floats
    union = sizes[left][:, None] + sizes[right][None, :] - common
    forest, out = _Forest(), []
    for i, j in zip(*np.nonzero((100 * common >= percent * union) & (left[:, None] != right[None, :])), strict=True):
        a, b = int(left[i]), int(right[j])
        if forest.join(a, b):
            out.append((a, b))
    return out


def similar_components(docs: DataFrame, n: int = 5, percent: int = 80, most_empty: float = 0.5) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of docs."""
    bounded_batches(docs.sparkSession)
    # A text is fetched by the digest of its row's doc_id and text: rows that share a doc_id, or have none, are told apart.
    whole = documents(docs).withColumn("at", F.xxhash64("doc_id", "text"))
    columns = ["doc_id", "at", "n_shingles", "node", *(f"s{k}" for k in range(SKETCH)), "fine"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            values, at = shingle_sets(data, offsets, n)
            node = nodes(values, at).view(np.int64)
            sketch = [pa.array(x.view(np.int64)) for x in parities(values, at)]
            words = np.ascontiguousarray(parities(values, at, FINE).T).view(np.uint8).ravel()
            sketch.append(pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(np.arange(part.num_rows + 1, dtype=np.int32) * (8 * FINE)), pa.py_buffer(words)]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.diff(at), pa.int64()), pa.array(node, mask=np.diff(at) == 0), *sketch], names=columns)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in chunks(batches):
            values, at = shingle_sets(data, offsets, n)
            signature, row = signatures(values, at, percent, most_empty)
            yield pa.RecordBatch.from_arrays([pa.array(signature.view(np.int64)), pa.array(nodes(values, at)[row].view(np.int64))], names=["signature", "node"])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in chunks(batches):
            values, at = shingle_sets(data, offsets, n)
            signature, row = _prefix_rows(values, at, np.flatnonzero(np.diff(at)), Bands(percent, 1))
            yield pa.RecordBatch.from_arrays([pa.array(signature.view(np.int64)), pa.array(nodes(values, at)[row].view(np.int64))], names=["signature", "node"])

    found = materialise(whole.mapInArrow(digests, ", ".join(f"{c} {'binary' if c == 'fine' else 'long'}" for c in columns)))
    rows = whole.select("doc_id", "text").mapInArrow(signed, "signature long, node long")
    shared = materialise(rows.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high")).where(f"low < high or signature = {SPARSE}").select("signature"))
    members = materialise(thinned(rows, "signature", shared, "signature").join(shared, "signature").select("signature", "node").distinct())
    members, marked = members.where(f"signature <> {SPARSE}"), members.where(f"signature = {SPARSE}").select("node")
    sizes = materialise(members.groupBy("signature").count())
    few = members.join(sizes.where(f"count <= {FEW}").select("signature"), "signature")
    lists = few.groupBy("signature").agg(F.array_sort(F.collect_list("node")).alias("all"))
    firsts = lists.select("all", F.posexplode("all").alias("i", "a"))
    pairs = firsts.select("a", F.explode(F.expr("slice(all, i + 2, size(all))")).alias("b")).distinct()
    if not marked.isEmpty():
        tokens = whole.mapInArrow(prefixes, "signature long, node long")
        own = materialise(tokens.join(marked, "node").distinct())
        meet = tokens.join(own.withColumnRenamed("node", "other"), "signature").where("node <> other")
        pairs = pairs.unionByName(meet.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))).distinct()
    met = materialise(pairs)
    many = materialise(members.join(sizes.where(f"count > {FEW}"), "signature").select("signature", "count", "node"))
    ends = met.select(F.explode(F.array("a", "b")).alias("node")).unionByName(many.select("node")).distinct()
    sketches = materialise(found.join(ends, "node").groupBy("node").agg(*(F.max(c).alias(c) for c in columns if c not in ("doc_id", "at", "node", "fine"))))
    loose = materialise(may_link(met, sketches, percent))
    # Signatures of the same nodes, as near copies have many, are one group.
    same = many.groupBy("signature", "count").agg(F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("all"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("mark"))
    groups = same.groupBy("count", "all", "mark").agg(F.min("signature").alias("signature")).select("signature")
    wide = components(loose_links(many.join(groups, "signature"), "signature", "count", sketches, WIDE, percent))
    ends = loose.select(F.explode(F.array("a", "b")).alias("node")).unionByName(wide.select("node")).distinct()
    fine = materialise(thinned(found.select("node", "n_shingles", "fine"), "node", ends, "node").join(ends, "node").groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.max("fine").alias("fine")))

    def fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            left, right = (byte_buffer(batch.column(i))[0].view(np.uint64).reshape(len(x), FINE) for i in (4, 5))
            yield batch.select([0, 1]).filter(pa.array(near(x, y, np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64), percent)))

    end = lambda c: fine.select(F.col("node").alias(c), F.col("n_shingles").alias(f"{c}_n"), F.col("fine").alias(f"{c}_fine"))
    pairs = loose.join(end("a"), "a").join(end("b"), "b").select("a", "b", "a_n", "b_n", "a_fine", "b_fine")
    pairs = materialise(pairs.mapInArrow(fits, "a long, b long"))
    counted = wide.groupBy("root").count()
    clusters = components(loose_links(wide.join(counted, "root"), "root", "count", fine, FINE_BLOCK, percent))
    release(met, many, sketches, loose, fine)
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(clusters.select("node")).distinct()
    chosen = materialise(found.join(needed, "node").groupBy("node").agg(F.min("at").alias("at")))
    # Equal rows bring their text once each; texts that share a digest are told apart by the node below.
    keyed = whole.select("at", "text")
    texts = materialise(thinned(keyed, "at", chosen, "at").join(chosen, "at").select("at", "node", "text").distinct().drop("at").withColumn("n_bytes", F.octet_length("text").cast("long")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            left, right = (text_sets(batch.column(i).to_pylist(), n) for i in (2, 3))
            ok = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and _is(x, a[i]) and _is(y, b[i]):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    ok[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    def block_links(part: pd.DataFrame) -> pd.DataFrame:
        sets = text_sets(part["text"].tolist(), n)
        right_node = np.array([_is(s, x) for s, x in zip(sets, part["node"], strict=True)])
        block, i, j = part["block"].to_numpy(), int(part["i"].iloc[0]), int(part["j"].iloc[0])
        left, right = np.flatnonzero((block == i) & right_node), np.flatnonzero((block == j) & right_node)
        node = part["node"].to_numpy()
        links = linked_in_block(sets, left, right, percent) if len(left) and len(right) else []
        return pd.DataFrame({"a": [node[x] for x, _ in links], "b": [node[y] for _, y in links]}, dtype=np.int64)

    def _is(values: np.ndarray, node: int) -> bool:
        return bool(len(values)) and int(nodes(values, np.array([0, len(values)])).view(np.int64)[0]) == int(node)

    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"{c}_text"))
    checked = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_text", "b_text").mapInArrow(verify, "a long, b long")
    weighed = clusters.join(texts.select("node", "n_bytes"), "node")
    counted = weighed.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = clusters.join(counted, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(texts.drop("n_bytes"), "node")
    spread = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("root", "node", "block", "text", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = checked.unionByName(spread.groupBy("root", "i", "j").applyInPandas(block_links, "a long, b long"))
    labels = components(links)
    rooted = found.join(labels, "node", "left").select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root"))
    least = materialise(rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return rooted.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
