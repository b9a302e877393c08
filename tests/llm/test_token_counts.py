from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import prose
from pyspark.sql import functions as F

from statelake.llm import queries, token_counts
from statelake.llm.common import tokenizer_path
from statelake.llm.token_counts import Counting, by_units, count_tokens, frequent
from statelake.llm.units import ByteLevel, joined, units

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b\n\n c <|endoftext|> d\t e  f ", "<|endoftext|>", "a<|endoftext|>", "don't  we'll x　y 1 22  3.4 \r\n z", "\x1c a \x85b\xa0 c d", "é ñ 漢字 ☃\n☃",
    "x" * 70_000, "w. " * 30_000, " ".join("z" * k for k in range(60, 70)), "\n" * 50, " " * 50 + "a", "▁a ▁ b", "a\x00b", "᠎a ᠎",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("sample", [2, 4_000])
def test_counts_are_the_librarys(spark, corpus, library, sample):
    rows = [(d, t) for d, t, *_ in corpus] + [(5000 + i, t) for i, t in enumerate(ODD)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, count_tokens(documents, PATH, sample=sample).collect()), key=repr)
    assert got == sorted(((d, t, len((t or "").encode()), n, n > 1024) for d, t in rows for n in [library(t)]), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab1.'s \n\t\r\x1c\x85\xa0 　é漢<|>")) | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_units_add_up(text):
    parts = units(text)
    assert "".join(parts) == text
    coder = ByteLevel(PATH, plain=True)
    assert b"".join(coder.ids(parts)) == coder.ids([text])[0]


def test_the_table_only_saves_time(library):
    rnd = random.Random(2)
    texts = [prose(rnd, 200) for _ in range(9)] + ODD
    expected = [library(t) for t in texts]
    table = {u: library(u) for t in texts[:5] for u in units(t)}
    for kept in (1, 50, 10_000):
        count = Counting(PATH, kept)
        assert count(texts, {}) == count(texts, table) == count(texts, table) == expected


def test_table_of_a_sample(spark, corpus, monkeypatch):
    documents = spark.createDataFrame([(t,) for _, t, *_ in corpus], "text string")
    monkeypatch.setattr(token_counts, "TABLE", 20)
    table = frequent(documents, PATH)
    assert len(table) == 20 and all(len(u) <= token_counts.LONGEST for u in table)


def test_other_tokenizers_go_whole(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    word, piece = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")
    assert by_units(PATH) and not by_units(word) and not by_units(piece)
    texts = ["Some  text, twice.\nSome", "", " x", "a▁b"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, other = sentencepiece.SentencePieceProcessor(model_file=piece), Tokenizer.from_file(word)
    for path, n in ((piece, lambda t: len(model.encode(t))), (word, lambda t: len(other.encode(t, add_special_tokens=False).ids))):
        assert {r.text: r._n_tokens for r in count_tokens(documents, path).collect()} == {t: n(t) for t in texts}


def test_columns_nothing_and_query(spark, clashing, nothing, tmp_path, documents):
    assert count_tokens(nothing, PATH).count() == 0
    out = count_tokens(clashing.withColumn("_n_tokens", F.lit("mine")).withColumn("n_tokens", F.lit(1)), PATH)
    assert out.columns == [*clashing.columns, "n_tokens", "_n_bytes", "_n_tokens", "_over_limit"] and out.count() == clashing.count()
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_token_counts"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert got.count() == documents.count() and joined("a  b") and not joined("a b\n")
