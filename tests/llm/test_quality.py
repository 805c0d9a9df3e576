import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import quality as Q

from .brute import statistics
from .conftest import SMALL


def test_statistics(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "x " * 40, "l1\nl1\n l1\n\nl2 #\nl2 #", "é ß *$ \x0b%\x0c<"]
    texts += [" ".join(r.choice("abc") for _ in range(r.randint(0, 60))) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")
    got = {x["row"].doc_id: x for x in Q.with_statistics(docs).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == statistics(t), repr(t)
        assert x.base_failed == (x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words)


def quantile(values, share):
    values = np.sort(values)
    return values[int(np.ceil(share * len(values) - 1e-9)) - 1]


def middle(x):
    """Medians and robust variances from bins, and how many rows."""
    b = np.floor(x * 200)
    q1, q2, q3 = (np.array([quantile(c, share) for c in b.T]) for share in (0.25, 0.5, 0.75))
    return (q2 + 0.5) / 200, ((q3 - q1) / 200 / 1.349) ** 2, len(x)


def drawn(own, n, target):
    return (own * n + target * Q.RIDGE) / (n + Q.RIDGE)


def reference_distances(x, language, everything):
    """The same estimate of one group in numpy."""
    floors, (m0, v0, _), (m1, v1, n1), (m, v, n) = np.array(Q.FLOORS), middle(everything), middle(language), middle(x)
    centre, target = drawn(m1, n1, m0), drawn(v1, n1, v0)
    mean, cov = drawn(m, n, centre), np.diag(drawn(v, n, target) + floors**2)
    for _ in range(Q.STEPS):
        b = np.floor(np.log(np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean) + 1e-9) * 100)
        near = x[b <= np.sort(b)[max(1, int(Q.SHARE * len(x))) - 1]]
        own = near.mean(0)
        last, mean = mean, drawn(own, len(near), centre)
        old, cov = cov, drawn((near - own).T @ (near - own) / len(near) * Q.CONSISTENT, len(near), np.diag(target)) + np.diag(floors**2)
        if np.abs(mean - last).max() < 1e-9 and np.abs(cov - old).max() < 1e-9:
            break
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def vectors(rows):
    return np.array([[np.log((x.word_chars + 20) / (x.n_words + 4)), np.log1p(100 * x.n_symbols / (x.word_chars + 100)), np.log1p(100 * x.n_dup_lines / (x.n_words + 50)), np.log1p(10 * x.n_repeat_words / (x.n_words + 50))] for x in rows])


def agree(out):
    """Every group's verdicts are those of the plain estimate; none is left out."""
    judged = [x for x in out if not x.base_failed]
    everything, groups, languages = vectors(judged), {}, {}
    for x in judged:
        groups.setdefault((x["row"].lang, x["row"].source), []).append(x)
        languages.setdefault(x["row"].lang, []).append(x)
    languages = {k: vectors(v) for k, v in languages.items()}
    for (lang, _), rows in groups.items():
        d = reference_distances(vectors(rows), languages[lang], everything)
        sure = np.abs(d - Q.CUTOFF) > 0.02 * Q.CUTOFF  # the operator stops within STAYS
        assert [x.kept for x, s in zip(rows, sure, strict=True) if s] == (d <= Q.CUTOFF)[sure].tolist()
    assert not any(x.kept for x in out if x.base_failed)
    return len(groups)


def test_rejects_outliers_like_the_plain_estimate(spark):
    r = random.Random(5)
    rows = []
    for i in range(600):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(30, 200))]
        if i % 12 == 0:
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), "en" if i % 2 else None, "hot" if i % 3 else f"rare{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = Q.verdicts(docs).collect()
    assert {x["row"].doc_id for x in out if not x.kept} == {i for i in range(0, 600, 12)}
    assert agree(out) > 100
    assert sorted(x.doc_id for x in Q.good_documents(docs).collect()) == [i for i in range(600) if i % 12]


@pytest.mark.parametrize("most", [50_000, 0])
def test_all_groups_of_a_table(spark, monkeypatch, most):
    monkeypatch.setattr(Q, "BROADCAST_GROUPS", most)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "source", "text")
    out = Q.verdicts(docs).collect()
    assert len(out) == docs.count()
    assert agree(out) > 50
    assert sum(x.kept for x in out) > 0.8 * sum(not x.base_failed for x in out)


def test_small_groups_and_repeated_rows(spark):
    text = lambda k: " ".join(f"word{(k * 31 + i) % 997}" for i in range(60 + k))
    odd = " ".join("$$$$####" for _ in range(3)) + " " + " ".join(f"#{i}$$$$$$$$" for i in range(60))
    rows = [(1, text(1), "en", "one"), (2, text(2), "en", "two"), (3, text(3), "en", "two"), (None, None, None, None), (4, "", "en", "two")]
    rows += [(i, text(5), "de", None) for i in range(5, 25)] + [(25, odd, "de", None)] + [(26, text(6), None, "x")] * 3
    out = Q.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit(1)).withColumn("g", F.lit("g"))).collect()
    assert len(out) == len(rows)
    assert {x["row"].doc_id for x in out if not x.kept} == {None, 4, 25}
    agree(out)


def test_one_bad_row_of_few(spark):
    text = lambda k: " ".join(f"word{(k * 31 + i) % 997}" for i in range(60 + k))
    bad = lambda k: " ".join(f"word{(k * 31 + i) % 997}$$$" for i in range(60 + k))
    rows = [(i, text(i), "es", f"s{i % 12}") for i in range(40)] + [(100 + i, bad(i), "es", f"s{i}") for i in range(4)] + [(200, bad(9), "es", "new")]
    out = Q.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {x["row"].doc_id for x in out if not x.kept} == {100, 101, 102, 103, 200}


def test_table_empty_and_deterministic(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a = sorted((x["row"].doc_id, x.kept) for x in Q.verdicts(docs).collect())
    b = sorted((x["row"].doc_id, x.kept) for x in Q.verdicts(docs.repartition(7)).collect())
    assert a == b
    assert len(a) == docs.count()
    assert Q.verdicts(docs.limit(0)).count() == 0
