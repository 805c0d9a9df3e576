"""Mixing, top-k, sharding, lines and URLs against plain versions on small tables."""

import hashlib
import math
import random

import numpy as np
import pytest

from hirelens.llm import line_dedup, mixing, queries, sharding, topk, url_filter

from .conftest import SMALL


def words(t):
    return len((t or "").encode().split())


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 2 * sizes[s]]
        if not over:
            return fixed | share
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= 2.0 * sizes[s]
        if len(fixed) == len(order):
            return fixed


def test_mixing(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["b", "a", "é", "zz", None, ""]) if i % 3 else "hot", "w " * r.choice([0, 1, 3, 50, 700, r.randint(1, 400)])) for i in range(900)]
    rows += [(1000, "a", None), (1001, "tiny", "x"), (7, "hot", rows[7][2]), (7, "hot", rows[7][2])]
    docs = spark.createDataFrame([(*x, 5) for x in rows], "doc_id long, source string, text string, size int")
    got = mixing.mix(docs).collect()
    assert sorted((x["row"].doc_id, x.size) for x in got) == sorted((i, words(t)) for i, _, t in rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for x in got:
        s = x["row"].source
        assert x.source_size == sizes[s] and math.isclose(x.target, want[s], rel_tol=1e-9) and 0 <= x.copies <= 2
        taken[s] += x.copies * x.size
    for s, t in taken.items():
        assert abs(t - want[s]) <= 1, (s, t, want[s])
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((x["row"].doc_id, x.size, x.copies) for x in got) == sorted((x["row"].doc_id, x.size, x.copies) for x in again)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_fit_counts_is_exact_where_it_can_be():
    r = np.random.default_rng(0)
    for _ in range(60):
        sizes = np.unique(r.integers(0, 300, 8))
        counts = r.integers(1, 5, len(sizes))
        total = int((sizes * counts).sum())
        reach = {0}
        for s, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            reach = {x + k * s for x in reach for k in range(c + 1)}
        budget = int(r.integers(0, total + 1))
        for reserve in (1 << 16, 50):
            take = mixing.fit_counts(sizes, counts, budget, reserve)
            assert (take >= 0).all() and (take <= counts).all()
            got = int((take * sizes).sum())
            assert got <= budget
            if reserve > total:
                assert got == max(x for x in reach if x <= budget)


def test_top_k(spark):
    r = np.random.RandomState(3)
    rows = [(i, r.randn(8).round(2).tolist()) for i in range(200)] + [(300 + i, [0.5] * 8) for i in range(20)]
    rows += [(400, None), (401, [1.0, None] * 4), (402, [math.nan] * 8), (403, [math.inf] * 8), (450, [0.0] * 8), (404, [1.0, 2.0]), (500, [2.0, 1.0]), (9, rows[9][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.scaled(df)
    got = [tuple(x) for x in topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, 64, 3).collect()]
    usable = [(i, [math.floor(float(np.float32(x)) * 256) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in usable:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    """Exact beyond 2**20 in longs and beyond them in Python's integers; an error where a score does not fit a long."""
    r = np.random.RandomState(5)
    rows = [(i, r.randn(4).round(2).tolist()) for i in range(60)] + [(100 + i, (r.randn(4) * 2.0 ** (16 + i // 4)).round().tolist()) for i in range(20)]
    # Products of 2**64 that cancel.
    rows += [(150, [2.0**24, 2.0**24, 0.0, 0.0]), (151, [2.0**24, -(2.0**24) + 2, 0.0, 0.0]), (152, [-(2.0**24), 2.0**24, 0.0, 1.0])]
    usable = {i: [math.floor(float(np.float32(x)) * 256) for x in v] for i, v in rows}
    vectors = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = [tuple(x) for x in topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, 64, 3).collect()]
    want = []
    for q in (0, 50, 100, 150):
        best = sorted((-sum(a * b for a, b in zip(usable[q], w, strict=True)), i) for i, w in usable.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)
    assert topk.scaled(spark.createDataFrame([(1, [2.0**20, -(2.0**54)])], "vec_id long, embedding array<float>")).first().v == [2**28, -(2**62)]
    for big in (2.0**30, 2.0**60):
        huge = topk.scaled(spark.createDataFrame([(0, [big, 1.0]), (1, [big, 2.0])], "vec_id long, embedding array<float>"))
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(huge, huge, 5).collect()


@pytest.mark.parametrize(("dim", "factor"), [(64, 1), (3, 1), (8, 1 << 14)])
def test_batches_of_queries_walk_together(dim, factor, monkeypatch):
    """As each query alone, with a product a step for all of them."""
    r = np.random.RandomState(dim)
    vectors = (r.randn(3000, dim).round(1) * 100).astype(np.int64) * factor
    ids = np.r_[np.arange(2900), np.arange(100)].astype(np.int64)
    lists = topk.SortedLists(ids, vectors)
    queries, own = np.r_[vectors[:300], np.zeros((1, dim), np.int64)], np.r_[np.arange(300), 5]
    place, rows, scores = lists.batch(queries, own, 5)
    for i, (q, o) in enumerate(zip(queries, own, strict=True)):
        want_rows, want = lists.top(q, o, 5)
        assert lists.ids[rows[place == i]].tolist() == lists.ids[want_rows].tolist()
        assert scores[place == i].tolist() == want.tolist()
    monkeypatch.setattr(lists, "top", None)  # none of them is walked alone
    lists.batch(queries, own, 5)


def test_sharding(spark):
    r = random.Random(2)
    rows = [(i, "x" * r.randint(0, 300)) for i in range(400)] + [(1000, "y" * 5000), (1001, None), (None, "z"), (5, "same"), (5, "same"), (5, "same")]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, depth int")
    out = sharding.assign_shards(docs, 1000).collect()
    assert sorted((str(x.doc_id), x.n_bytes) for x in out) == sorted((str(i), len(t or "")) for i, t in rows)
    names = {x.shard for x in out}
    for n in names:
        own = [x for x in out if x.shard == n]
        assert sum(x.n_bytes for x in own) == own[0].shard_bytes and len(own) == own[0].shard_docs and own[0].depth == len(n)
        assert own[0].shard_bytes <= 1000 or len(own) == 1
        assert not any(m != n and m.startswith(n) for m in names)
        if n:  # only a bucket over its limit was split
            assert sum(x.n_bytes for x in out if x.shard.startswith(n[:-1])) > 1000
    assert [x.shard for x in sharding.assign_shards(docs, 1 << 30).select("shard").distinct().collect()] == [""]
    assert sharding.assign_shards(docs.limit(0), 10).count() == 0


def test_lines(spark):
    r = random.Random(4)
    common = ["Shared line", " shared LINE\t", "É shared"]
    rows = [(i, "\n".join(r.choice([*common, "", f"own {i}", "x"]) for _ in range(r.randint(0, 9)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (3, "shared line\nrow of the same id"), (None, "x\ny"), (None, "x")]
    docs = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, kept string")
    seen = {}
    key = lambda x: x.encode().strip(b" \t\n\v\f\r").lower()
    for i, t in rows:
        for x in (t or "").split("\n"):
            seen.setdefault(key(x), set()).add(i)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not key(x) or len(seen[key(x)]) < 10]
        want.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    got = [(x["row"].doc_id, x.n_lines, x.n_dropped, x.kept) for x in line_dedup.drop_lines(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.drop_lines(docs.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://com/en/", "https://A.Example.COM/en/7x?q", "http://example.com/en/8", "http://xexample.com/en/7", "ftp://a.net/de/8", "ftp://a.example.net/de/81#f", "http://b.org/es/", "http://b.org/es", "x\nhttp://c.org/es/1", "http://u@d.org:80/es/", "http://e.org?/es/", "http://f.org/es/http://g.com/en/"] * 2
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {x.page_id: x for x in url_filter.judge(pages, url_filter.rules_frame(spark, queries.URL_RULES)).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert url_filter.judge(pages.limit(0), url_filter.rules_frame(spark, queries.URL_RULES)).count() == 0


def test_codec_digest_of_nothing(spark):
    out = queries.op10_piece_codec(spark, SMALL).where("n_tokens = 0").collect()
    assert all(x.ids_sha256 == hashlib.sha256(b"").hexdigest() for x in out)
