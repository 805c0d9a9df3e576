import random

from hirelens.llm import suffix_dedup as S

from .brute import suffix, thue_morse
from .conftest import SMALL


def made():
    r = random.Random(4)
    text = lambda n: "".join(r.choice("aabcé \n") for _ in range(n))
    passages = [text(n) for n in (380, 399, 400, 450, 700, 2000)]
    rows = [(0, None), (1, ""), (2, "x" * 399), (3, "y" * 400), (4, "z" * 401), (5, "ab" * 900), (6, "short"), (6, "short"), (None, passages[5])]
    for i in range(7, 60):
        parts = []
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            a = r.choice([0, 0, r.randint(0, 60)])
            parts += [text(r.randint(0, 80)), p[a : len(p) - r.choice([0, r.randint(0, 40)])]]
        rows.append((i, "".join(parts)))
    own = text(900)
    rows += [(60, rows[20][1]), (60, rows[20][1]), (61, rows[21][1]), (61, text(500)), (62, own + text(30) + own[100:600]), (63, text(5000))]
    return rows


def test_against_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, copies int")
    got = sorted(map(tuple, S.remove_repeats(docs).collect()), key=str)
    assert got == sorted(suffix(rows), key=str)
    assert any(0 < x[2] < x[1] for x in got)
    kept = S.remove_repeats(docs, kept=True).drop("kept").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, kept), key=str) == got


def test_whole_table_and_empty(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    assert sorted(map(tuple, S.remove_repeats(docs).collect())) == sorted(suffix(rows))
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_edits_in_copies(spark):
    r = random.Random(9)
    base = "".join(r.choice("abcdefgh ") for _ in range(3000))
    rows = []
    for i in range(24):
        text = list(base[r.choice([0, 0, 5, 333]) : r.choice([3000, 3000, 2991, 1500])])
        for _ in range(r.randint(0, 6)):
            text[r.randrange(len(text))] = r.choice(["X", "", "YZ"])
        rows.append((i, "".join(text)))
    rows += [(30, "ab" * 350 + "".join(r.choice("abc") for _ in range(600))), (31, "ab" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, S.remove_repeats(docs).collect()))
    assert got == sorted(suffix(rows))
    assert any(0 < x[2] < x[1] for x in got)


def test_bytes_that_polynomials_take_for_equal(spark):
    a, b = thue_morse(2048)
    rows = [(1, a), (2, b), (3, "x" * 9 + a[:1024] + "y" * 300), (4, b[:1024])]
    got = sorted(map(tuple, S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(suffix(rows))


def test_a_text_of_five_mebibytes(spark):
    r = random.Random(12)
    long = "".join(r.choice("abcdefghij klmnop") for _ in range((5 << 20) + 1000))
    turn = (1 << 20) - 200  # across the place at which exponents start anew
    rows = [(1, long), (2, "q" * 300 + long[turn : turn + 700] + "z" * 90), (3, long[(3 << 20) : (3 << 20) + 399])]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans) for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (len(long), 700, 1), 2: (1090, 700, 1), 3: (399, 0, 0)}
