"""Token counts against the libraries."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens.llm import queries, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))


def library(path, texts):
    found = tokenizers.Tokenizer.from_file(path)
    return [len(e.ids) for e in found.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def counted(path, texts):
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    return np.concatenate([n for _, n in token_counts.counts(path, iter([batch]))]).tolist()


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(docs, library(BYTES, docs.values()), strict=True))
    got = queries.op11_token_counts(spark, folder).collect()
    assert len(got) == len(docs)
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {(i, len((t or "").encode()), want[i], want[i] > 512) for i, t in docs.items()}


def test_white_space_special_strings_and_signs():
    r = random.Random(1)
    signs = [*"ab1 2'sé\n\t\x0b   　᠎​\x1c\x1f\x85!?<|endoftext|>中文.  ", "<|endoftext|>", " 's", "'ll", " \n "]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(120))) for _ in range(5000)] + ["", None, " ", "<|endoftext|>", "a<|endoftext|>b <|endo"]
    assert counted(BYTES, texts) == library(BYTES, texts)


def test_very_long_texts_and_small_steps(monkeypatch):
    r = random.Random(2)
    texts = ["z" * 300_000, "word " * 400_000, "é中 " * 100_000 + "a" * 50_000, "".join(r.choice("abc 12.\n") for _ in range(500_000)), "x"]
    want = library(BYTES, texts)
    assert counted(BYTES, texts) == want
    for name, value in (("STEP_BYTES", 1000), ("CALL_BYTES", 200), ("CACHE", 50)):
        monkeypatch.setattr(token_counts, name, value)
    monkeypatch.setattr(token_counts, "_loaded", {})
    assert counted(BYTES, texts) == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_kinds_are_encoded_whole(name):
    path = str(public_tokenizers.path(name))
    texts = ["Hello  World 12", " lead", "", None, "naïve\n\ncafé ", "<|startoftext|>x", "a b" * 1000]
    if name.endswith(".json"):
        want = library(path, texts)
    else:
        model = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)
        want = [len(model.encode(t or "")) for t in texts]
    assert not token_counts.load(path)[1] and counted(path, texts) == want


def test_nulls_repeated_rows_clashing_names_and_an_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_bytes": F.lit("x"), "n_tokens": F.lit(1.5), "over_limit": F.lit(3)})
    got = token_counts.token_counts(docs, BYTES, limit=1)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 3, 2, True), (1, 3, 2, True), (None, 1, 1, False), (2, 0, 0, False), (3, 0, 0, False)], key=str)
    assert token_counts.token_counts(docs.where("false"), BYTES).collect() == []
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
