import random

from hirelens.llm import components as C


def test_long_ascending_chains_and_stars_end_in_few_rounds(spark, monkeypatch):
    """Chains whose values ascend, where each node points at the one before it, a star, and a ring."""
    links = [(i, i + 1) for i in range(3000)] + [(5000 + i, 9000) for i in range(500)] + [(10_000 + i, 10_000 + (i + 1) % 50) for i in range(50)] + [(20_000, 20_000)]
    random.Random(1).shuffle(links)
    written = []
    keep = C.materialise
    monkeypatch.setattr(C, "materialise", lambda df: written.append(1) or keep(df))
    rows = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for x in rows:
        groups.setdefault(x.root, set()).add(x.node)
    assert sorted(map(len, groups.values())) == [50, 501, 3001] and all(root in g for root, g in groups.items())
    assert len(written) < 50
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_full_bitmap_is_small_when_broadcast(spark):
    """2**25 bits are 4 MB; the driver collects and hashes no row a word."""
    keys, rows = spark.range(3_000_000).selectExpr("id * 3 AS k"), spark.range(200_000).selectExpr("id AS s", "id AS other")
    kept = C.thinned(rows, "s", keys, "k")
    found = {x.s for x in kept.collect()}
    assert found >= set(range(0, 200_000, 3)) and len(found) < 85_000 and kept.columns == ["s", "other"]
    todo, sizes = [kept._jdf.queryExecution().executedPlan().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if node.nodeName() == "BroadcastExchange":
            sizes.append(node.metrics().apply("dataSize").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert len(sizes) == 1 and sizes[0] < 12 << 20, sizes
    assert C.thinned(rows, "s", keys.limit(0), "k").count() == 0
