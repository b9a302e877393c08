from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import prose
from pyspark.sql import functions as F

from statelake.llm import token_alignment
from statelake.llm.common import tokenizer_path
from statelake.llm.token_alignment import Aligner, alignment, pressed, unpressed

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [
    "", " ", "  two  spaces", " lead", "trail ", "a\nb\n\nc\t d", "<s> </s> <unk> <|endoftext|>", "a▁b", "é ñ 漢字 ☃", "a\x00b <0x41>", "nbsp\xa0x", "x" * 3000, "don't 'S 12 3.4!",
    "one\r\ntwo \n three", "\x1c a", "　wide", "é́",
]


@pytest.fixture(scope="module")
def library():
    """Tokens of a text by both libraries, as (id, bytes)."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict(zip(map(chr, shown), shown, strict=True)) | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}

    def both(text):
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i in second.encode(text) for p in [second.id_to_piece(i)]]
        line = (" " + text).encode()
        return (a, b) if text and b"".join(t for _, t in a) == line == b"".join(t for _, t in b) else ([], [])

    return both


def spans(tokens):
    at, out = 0, []
    for i, t in tokens:
        out.append((at, at + len(t), i))
        at += len(t)
    return out


def plainly(texts, both):
    """Every text's answer by comparing all its A with all its B tokens."""
    found, held = [], Counter()
    for text in texts:
        a, b = map(spans, both(text or ""))
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        held.update(set(links))
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = [(lo, hi) for lo, hi in zip([0, *ends], ends, strict=False)]
        inside = lambda side, lo, hi: ",".join(str(i) for s, e, i in side if lo <= s and e <= hi)
        shown = ";".join(f"{inside(a, lo, hi)}|{inside(b, lo, hi)}" for lo, hi in groups)
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    best: dict[int, int] = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    return [(a, b, g, len(links), sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links), sha) for a, b, g, links, sha in found]


@pytest.mark.parametrize("block", [300, 2_000_000])
def test_against_all_pairs_of_tokens(spark, corpus, library, block):
    rows = [(d, t) for d, t, *_ in corpus if len(t or "") < 9_000] + [(5000 + i, t) for i, t in enumerate(ODD)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, alignment(documents, A, B, block).collect()), key=repr)
    assert got == sorted(((d, *answer) for (d, _), answer in zip(rows, plainly([t for _, t in rows], library), strict=True)), key=repr)


@pytest.fixture(scope="module")
def aligner():
    return Aligner(A, B, kept=500)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("abist.'s \n\t\r\x1c\x85\xa0▁　é漢<|>0x")) | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_units_give_the_ids_of_the_whole(aligner, library, text):
    a, b = library(text)
    parts = aligner.encode([text])[0]
    for side, tokens in ((0, a), (1, b)):
        assert np.frombuffer(b"".join(p[side] for p in parts), "<u4").tolist() == [i for i, _ in tokens]


@pytest.mark.parametrize("text", ["\r0", "end.\r\nnext", "a();\r\n}\r\n", "a \r b", "x\r\r\ny"])
def test_carriage_returns_in_pieces(aligner, library, text):
    parts = aligner.encode([text])[0]
    for side, tokens in enumerate(library(text)):
        assert np.frombuffer(b"".join(p[side] for p in parts), "<u4").tolist() == [i for i, _ in tokens]


def test_long_texts_in_parts(aligner, monkeypatch):
    rnd = random.Random(6)
    texts = [prose(rnd, 300), "", prose(rnd, 2000), None or "", prose(rnd, 5)]
    expected = aligner(texts)
    monkeypatch.setattr(token_alignment, "PART", 17)
    monkeypatch.setattr(token_alignment, "LINE", 900)
    for one, other in zip(expected, aligner(texts), strict=True):
        assert np.array_equal(one, other)


def test_numbers_are_pressed():
    for numbers in ([], [0], [1, 2, 1 << 31, 5]):
        if numbers:
            assert unpressed(pressed(np.array(numbers)), len(numbers)).tolist() == numbers


def test_columns_and_nothing(clashing, nothing, documents):
    assert alignment(nothing, A, B).count() == 0
    assert alignment(clashing.withColumn("block", F.lit(1)).withColumn("pair", F.lit(1)), A, B).count() == documents.count()
