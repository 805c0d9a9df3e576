import random

import numpy as np
import pytest

from hirelens.llm import ngram_join as N

from .brute import jaccard, thue_morse
from .conftest import SMALL


def edited(r, words, share):
    out = []
    for w in words:
        x = r.random()
        if x < share:
            out += r.choice([[], [f"new{r.randrange(9)}"], [w, f"ins{r.randrange(9)}"]])
        else:
            out.append(w)
    return out


def made(seed=8):
    r = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "a b c d"), (7, "A b\tc d"), (None, "q r s t u"), (8, "q r s t u")]
    i = 10
    for n in (5, 9, 12, 15, 20, 27, 30, 33, 45, 60, 120, 300, 900):
        base = [f"w{r.randrange(400)}" for _ in range(n)]
        for k in range(6):
            words = edited(r, base, r.choice([0.0, 0.01, 0.02, 0.04]))
            rows.append((i, " ".join(words if k % 3 else [*words, *[f"z{r.randrange(99)}" for _ in range(n // 9)]])))
            i += 1
    base = [f"h{r.randrange(300)}" for _ in range(80)]
    rows += [(i + k, " ".join(edited(r, base, r.choice([0.002, 0.02, 0.05])))) for k in range(60)]
    rows += [(500, rows[30][1]), (500, rows[30][1]), (501, rows[60][1].upper()), (20, rows[70][1])]
    return rows


@pytest.mark.parametrize(("n", "percent", "most_empty"), [(4, 85, 0.5), (5, 80, 0.5), (4, 85, 0.05)])
def test_against_brute_force(spark, n, percent, most_empty):
    rows = made()
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, node int")
    got = sorted(map(tuple, N.similar_components(docs, n, percent, most_empty).collect()), key=str)
    assert got == sorted(jaccard(rows, n, percent), key=str)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_a_signature(percent):
    r = np.random.default_rng(2)
    missed = tried = 0
    for _ in range(3000):
        n = int(r.integers(6, 400))
        base = r.integers(0, 1 << 63, n).astype(np.uint64)
        k = max(1, n * (100 - percent) // 130)
        other = np.unique(np.r_[base[int(r.integers(0, k)) :], r.integers(0, 1 << 63, int(r.integers(0, k))).astype(np.uint64)])
        base = np.unique(base)
        common = len(np.intersect1d(base, other))
        if 100 * common < percent * (len(base) + len(other) - common) or common == len(base) == len(other):
            continue
        tried += 1
        signature, row = N.signatures(np.r_[base, other], np.array([0, len(base), len(base) + len(other)]), percent)
        missed += not set(signature[row == 0]) & set(signature[row == 1])
    assert tried > 500
    assert not missed


def test_whole_table_and_empty(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    assert sorted(map(tuple, N.similar_components(docs, 4, 85).collect())) == sorted(jaccard(rows, 4, 85))
    assert N.similar_components(docs.limit(0)).count() == 0


def test_words_that_polynomials_take_for_equal(spark):
    for n in (1024, 2048):
        a, b = thue_morse(n)
        rows = [(1, " ".join([a] * 50)), (2, " ".join([b] * 50)), (3, " ".join([a, b] * 50)), (4, " ".join([b] * 60))]
        got = sorted(map(tuple, N.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()))
        assert got == sorted(jaccard(rows, 4, 85)) == [(1, 1, 1), (2, 1, 2), (3, 2, 3), (4, 1, 2)]


def test_a_text_of_five_mebibytes(spark):
    r = random.Random(12)
    long = [f"w{r.randrange(90000)}" for _ in range(900_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[2000:])), (3, " ".join(long[:500_000])), (4, "w1 w2")]
    assert len(rows[0][1]) > 5 << 20
    got = {x.doc_id: x.component_id for x in N.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


@pytest.mark.parametrize("percent", [80, 85])
def test_parities_keep_linked_pairs_and_drop_most_others(spark, percent):
    r = np.random.default_rng(5)
    sets, linked = [], set()
    for pair in range(300):
        n = int(r.integers(1, 900))
        base = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        kept = base[int(n * (100 - percent) / 100 * r.choice([0.9, 1.0, 4.0])) :]
        sets += [base, kept if len(kept) else base]
        common = len(sets[-1])
        if 100 * common >= percent * len(base):
            linked.add(pair)
    at = np.r_[0, np.cumsum([len(s) for s in sets])]
    words = N.parities(np.concatenate(sets), at)
    names = ["node", "n_shingles", *(f"s{k}" for k in range(N.SKETCH))]
    rows = [(i, len(s), *(int(w[i].view(np.int64)) for w in words)) for i, s in enumerate(sets)]
    sketches = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names))
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(300)], "a long, b long")
    left = {x.a // 2 for x in N.may_link(pairs, sketches, percent).collect()}
    assert linked <= left
    assert len(left - linked) <= 30


def test_many_rows_without_an_id_fetch_a_text_each(spark, monkeypatch):
    r = random.Random(4)
    texts = []
    for _ in range(40):
        base = [f"n{r.randrange(500)}" for _ in range(60)]
        texts += [" ".join(edited(r, base, 0.004)) for _ in range(10)]
    stored, write = [], N.materialise

    def counted(df):
        out = write(df)
        if "text" in out.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(N, "materialise", counted)
    linked = {}
    for name, rows in (("ids", list(enumerate(texts))), ("none", [(None, t) for t in texts])):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        linked[name] = N.similar_components(docs, 4, 85).collect()
    assert sorted(map(tuple, linked["ids"])) == sorted(jaccard(list(enumerate(texts)), 4, 85))
    assert [x.component_id for x in linked["none"]] == [None] * len(texts)
    assert stored[0] == stored[1] <= len(texts)


def test_blocks_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(N, "FEW", 2)
    rows = made(9)
    got = sorted(map(tuple, N.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()), key=str)
    assert got == sorted(jaccard(rows, 4, 85), key=str)


def test_short_sets_with_a_frequent_token_are_no_cluster(spark, monkeypatch):
    """Their texts met in blocks, each block's with every other's: the square of the group."""
    monkeypatch.setattr(N, "WIDE", 100)
    r = random.Random(6)
    texts = [" ".join(["a", "b", "c", "d", *[f"v{r.randrange(10**6)}" for _ in range(r.randrange(6))]]) for _ in range(600)]
    near = " ".join(f"u{k}" for k in range(25))
    texts += [f"{near} x{k}" for k in range(40)]
    stored, write = [], N.materialise

    def counted(df):
        out = write(df)
        if "text" in out.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(N, "materialise", counted)
    rows = list(enumerate(texts))
    got = sorted(map(tuple, N.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()))
    assert got == sorted(jaccard(rows, 4, 85))
    assert stored[0] < 60


@pytest.mark.parametrize("matrix", [0, 1000])
def test_loose_forest_spans_what_parities_leave(matrix, monkeypatch):
    monkeypatch.setattr(N, "MATRIX", matrix)
    r = np.random.default_rng(3)
    base = [r.integers(0, 1 << 63, 60).astype(np.uint64) for _ in range(12)]
    sets = [np.unique(np.r_[base[i % 12][int(r.integers(0, 9)) :], r.integers(0, 1 << 63, 4).astype(np.uint64)]) for i in range(150)]
    sizes = np.array([len(s) for s in sets])
    sketches = np.stack(N.parities(np.concatenate(sets), np.r_[0, np.cumsum(sizes)]))
    odd = np.bitwise_count(sketches[:, :, None] ^ sketches[:, None, :]).sum(axis=0, dtype=np.int64)
    fits = 185 * np.maximum(odd, np.abs(sizes[:, None] - sizes)) <= 15 * (sizes[:, None] + sizes)
    forest, found, edges = N._Forest(), N._Forest(), 0
    for i, j in zip(*np.nonzero(fits), strict=True):
        forest.join(int(i), int(j))
    for x, y in zip(*(e.tolist() for e in N.loose_forest(sizes, sketches, 85)), strict=True):
        assert fits[x, y] and found.join(x, y)
        edges += 1
    assert edges
    assert [forest.find(i) for i in range(150)] == [found.find(i) for i in range(150)]
