import random

from hirelens.llm import substring_dedup as S

from .brute import substring, thue_morse
from .conftest import SMALL


def made():
    r = random.Random(3)
    word = lambda: r.choice(["a", "be", "see", "dé", "e" * 40, "x.", "y", "zz"])
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 80, 200)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (None, " ".join(passages[4])), (4, "a " * 300), (5, "a\n" * 120)]
    for i in range(6, 60):
        words = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            a = r.randint(0, 20)
            words += [word() for _ in range(r.randint(0, 30))] + (p if r.random() < 0.5 else p[a : len(p) - r.randint(0, 5)])
        rows.append((i, r.choice([" ", "\n", "  "]).join(words)))
    rows += [(70, rows[20][1]), (70, rows[20][1]), (71, rows[21][1]), (71, rows[40][1]), (20, rows[41][1]), (72, " ".join(passages[4]))]
    return rows


def test_against_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame([(*x, 1, "s") for x in rows], "doc_id long, text string, n_words int, seeds string")
    got = sorted(map(tuple, S.remove_repeats(docs).collect()), key=str)
    assert got == sorted(substring(rows), key=str)
    assert any(0 < x[2] < x[1] for x in got)
    texts = S.remove_repeats(docs, text=True).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, texts), key=str) == got


def test_whole_table_and_empty(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    assert sorted(map(tuple, S.remove_repeats(docs).collect())) == sorted(substring(rows))
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_words_that_polynomials_take_for_equal(spark):
    for n in (1024, 2048):
        a, b = thue_morse(n)
        rows = [(1, " ".join([a] * 50)), (2, " ".join([b] * 50)), (3, " ".join([a] * 60))]
        got = sorted(map(tuple, S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
        assert got == sorted(substring(rows))
        assert [x[2] for x in got] == [0, 0, 60]


def test_a_text_of_five_mebibytes(spark):
    r = random.Random(12)
    word = lambda: f"w{r.randrange(90000)}"
    long = [word() for _ in range(900_000)]
    rows = [(1, " ".join(long)), (2, " ".join([word(), *long[400_000:400_070], word(), *long[899_940:]])), (3, "  ".join(long))]
    assert len(rows[0][1]) > 5 << 20
    got = {x.doc_id: (x.n_words, x.n_removed) for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (900_000, 0), 2: (132, 130), 3: (900_000, 900_000)}
