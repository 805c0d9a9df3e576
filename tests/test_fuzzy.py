"""Closest names against all pairs by difflib."""

import difflib
import random

import pytest

from hirelens.functions import clean, fuzzy
from hirelens.queries import closest_parts, damaged_parts

SF = "/root/testdata/sf0.001"


def plain(value, names, least=0.7):
    """The first of the best of names, by all comparisons."""
    best = max(((difflib.SequenceMatcher(None, value, n).ratio(), -i, n) for i, n in enumerate(names)), default=(0, 0, None))
    return best[2] if best[0] >= least else None


def matched(spark, values, names, **kw):
    v = spark.createDataFrame([(x,) for x in values], "value string")
    w = spark.createDataFrame(list(enumerate(names)), "position long, name string")
    return {r.value: (r.name, r.ratio) for r in fuzzy.closest_names(v, w, **kw).collect()}


@pytest.mark.parametrize("percent", [50, 70, 90])
def test_random_texts_equal_all_pairs(spark, percent):
    rng = random.Random(percent)
    names = ["".join(rng.choices("abcde é𝄞1", k=rng.randrange(0, 14))) for _ in range(120)]
    names += [" ".join(rng.sample(["univ", "of", "the", "royal", "leeds", "college", "arts", "science"], rng.randrange(3, 7))) for _ in range(60)]
    names = list(dict.fromkeys(names))
    values = names[::5] + ["".join(c for c in n if rng.random() > 0.2) + rng.choice(["", "x", " ltd"]) for n in names]
    found = matched(spark, values, names, percent=percent)
    for v in values:
        want = plain(v, names, percent / 100)
        assert found.get(v, (None, None))[0] == want, v
        if want is not None:
            assert found[v][1] == difflib.SequenceMatcher(None, v, want).ratio()


def test_long_texts_follow_the_ratio_of_popular_characters(spark):
    """From 200 characters on the ratio leaves out popular characters, even of equal texts."""
    names = ["ab" * 150, "".join(chr(0x4E00 + i) for i in range(300)), "short"]
    values = [names[0], names[1], names[1][:250], "a" * 1_000_000]
    found = matched(spark, values, names)
    assert {v: found.get(v, (None,))[0] for v in values} == {v: plain(v, names) for v in values}


def test_edges(spark):
    assert matched(spark, ["", "a", None, "a"], ["b", "", "", None, "a"]) == {"": ("", 1.0), "a": ("a", 1.0)}
    assert matched(spark, ["abc"], []) == {}
    assert matched(spark, [], ["abc"]) == {}
    # Equal ratios: the first of the list, although it is the greater text.
    assert matched(spark, ["abcd"], ["abcz", "abcy"]) == {"abcd": ("abcz", 0.75)}


def test_rows_are_kept_with_clashing_columns(spark):
    df = spark.createDataFrame([("colour", 1, "old"), ("colour", 1, "old"), (None, 2, "old"), ("zzz", 3, "old")], "name string, position int, match string")
    rows = clean.closest_match(df, "name", ["color", "colours"])
    assert rows.columns == ["name", "position", "match"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("colour", 1, "colours"), ("colour", 1, "colours"), (None, 2, None), ("zzz", 3, None)], key=str)


def test_few_pairs_are_compared(spark):
    parts = damaged_parts(spark.read.parquet(f"{SF}/part.parquet")).collect()
    names = list(dict.fromkeys(r.full for r in sorted(parts)))
    found = {r.p_partkey: r.closest for r in closest_parts(spark, SF).collect()}
    assert found == {r.p_partkey: plain(r.damaged, names) for r in parts}
    v = spark.createDataFrame([(r.damaged,) for r in parts], "text string").distinct()
    w = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "text string, position int")
    v, w = fuzzy._shares(v), fuzzy._shares(w)
    uses = fuzzy._frequencies(w)
    pairs = fuzzy.candidates(fuzzy._rare_first(v, uses), fuzzy._rare_first(w, uses), 85)
    assert pairs.count() == pairs.select("value", "name").distinct().count()
    print(pairs.count(), v.count() * w.count())
    assert pairs.count() < 0.1 * v.count() * w.count()


def test_far_fewer_pairs_meet_than_there_are(spark):
    """Texts over few characters nearly all met on one of them."""
    parts = damaged_parts(spark.read.parquet(f"{SF}/part.parquet"))
    v, w = fuzzy._shares(parts.selectExpr("damaged AS text").distinct()), fuzzy._shares(parts.selectExpr("full AS text").distinct())
    uses = fuzzy._frequencies(w)
    v, w = (fuzzy._marks(fuzzy._rare_first(x, uses), 97).selectExpr("text", "explode(rare) AS mark") for x in (v, w))
    met = v.join(w.withColumnRenamed("text", "name"), "mark").count()
    assert met < 0.2 * v.select("text").distinct().count() * w.select("text").distinct().count()


def test_values_one_character_apart_go_no_further(spark, monkeypatch):
    """No join on frequent neighbours where the best name has one character more, less, or none; equal ratios go to the first."""
    names = ["small ring", "small rings", "smal ring", "large bolt", "largebolt", "aaaa", "abab", "babab", "𝄞é𝄞é1", "𝄞é𝄞é2"]
    values = ["small ring", "small rin", "mall rings", "large  bolt", "aaaaa", "abaab", "𝄞é𝄞é", "smallring"]
    want = {v: plain(v, names) for v in values}

    def never(*_):
        raise AssertionError("a join on marks")

    monkeypatch.setattr(fuzzy, "candidates", never)
    found = matched(spark, values, names)
    assert {v: found[v][0] for v in values} == want
