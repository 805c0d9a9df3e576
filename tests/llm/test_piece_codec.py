import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402

from hirelens.llm import piece_codec as C  # noqa: E402

PATH = P.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "\n", "a\tb\r\n", "▁x", "x▁ y", "<s>hi</s>", "<0x41>", "ｆｕ", "é\u0000x", "\U0001f600\U0001f601 z", "a" * 500, "1234567890" * 30, "ab" * 3000, " " * 77, "=" * 120 + "-" * 64, "执梦" * 90]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_odd_texts_match_the_library(library):
    for t in ODD:
        ids = C.encode(PATH, t)
        assert ids == library.encode(t), repr(t[:40])
        assert C._model(PATH).decode(ids) == library.decode(library.encode(t)), repr(t[:40])


def test_random_texts_match_the_library(library):
    r = random.Random(5)
    alphabet = "aaabcdeeet hin .,\n\t-_/0123éß一\U0001f600▁<>"
    for _ in range(300):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 200)))
        assert C.encode(PATH, t) == library.encode(t), repr(t)


def test_bad_bytes_decode_like_the_library(library):
    m = C._model(PATH)
    r = random.Random(6)
    for _ in range(200):
        ids = [r.choice([int(m.byte_ids[r.randrange(256)]), r.randrange(259, 32000), 28705]) for _ in range(r.randint(1, 8))]
        assert m.decode(ids) == library.decode(ids), ids


def test_documents(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None, None, "same", "same"])] + [(3, "repeated id", "y"), (3, "repeated id", "y")]
    got = C.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PATH).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)
    assert C.encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_whole_table(spark, library):
    from tests.llm.conftest import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in C.encode_documents(docs, PATH, ids=True).collect()}
    for r in docs.collect():
        assert got[r.doc_id].ids == library.encode(r.text)
        assert got[r.doc_id].decoded == library.decode(got[r.doc_id].ids)


def test_long_words_and_steps_match_the_library(library, monkeypatch):
    r = random.Random(8)
    texts = ["".join(r.choice(a) for _ in range(n)) for a in ("ACGT", "abcdefghijklmnopqrstuvwxyzABCDEFG0123456789+/", "的一是不了人我在", "ab", "=-_*") for n in (49, 700, 4000)]
    texts += [" ".join(texts[:6]) + "  " * 40 + texts[4], " " * 900 + "x" + " " * 900]
    for t in texts:
        assert C.encode(PATH, t) == library.encode(t), repr(t[:40])
    for limit, words in ((1, 400_000), (64, 7), (1000, 50)):
        monkeypatch.setattr(C, "STEP_BYTES", limit)
        monkeypatch.setattr(C, "CACHE", words)
        import pyarrow as pa

        for t, row in zip([*ODD, *texts], C.coded(PATH, pa.array([*ODD, *texts]), ids=True), strict=True):
            assert row[3].tolist() == library.encode(t), repr(t[:40])
            assert row[4] == library.decode(library.encode(t))
            assert row[:3] == (len(row[3]), hashlib.sha256(",".join(map(str, row[3].tolist())).encode()).hexdigest(), hashlib.sha256(row[4].encode()).hexdigest())


def test_a_text_of_five_mebibytes(spark, library):
    r = random.Random(9)
    text = "".join(r.choice(["word ", "other ", "x" * 30 + " ", "é一 ", "\n"]) for _ in range(900_000))
    assert len(text.encode()) > 5 << 20
    row = C.encode_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    ids = library.encode(text)
    assert row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
