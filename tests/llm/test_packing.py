from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from statelake.llm.common import tokenizer_path
from statelake.llm.packing import Encoder, cut, pack, plan, slots

PATH = tokenizer_path("byte_bpe_50k.json")


def check_layout(rows, size):
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("size", [2048, 64])
def test_pieces_and_layout(documents, corpus, size):
    rows = pack(documents, PATH, size).collect()
    n = check_layout(rows, size)
    total = sum(r.length for r in rows)
    assert -(-total // size) <= n <= -(-total // size) * 1.3 + 2
    encode = Encoder(PATH)
    expected = []
    for doc, text, *_ in corpus:
        ids = encode.whole([text or ""])[0] + bytes(4)
        expected += [(doc, i, start, length, crc) for i, (start, length, crc) in enumerate(cut(ids, size))]
        assert b"".join(ids[4 * s:4 * (s + k)] for s, k, _ in cut(ids, size)) == ids
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(expected, key=repr)


def test_empty_and_clashing(nothing, clashing, documents):
    assert pack(nothing, PATH).count() == 0
    assert pack(clashing, PATH).count() == pack(documents, PATH).count()


def test_units_give_the_ids_of_the_whole():
    encode = Encoder(PATH, most_units=50)
    texts = ["  a  b\n\n c <|endoftext|> d\t e  f ", "", " ", "a b ", "\na b", "don't  we'll x　y 1 22  3.4 \r\n z", "a. b, é. ñ! .. 1. 'S. \n. a.\n b", "x" * 5000, "w. " * 300]
    assert list(encode(texts)) == encode.whole(texts) == list(encode(texts))


def test_literals_of_added_tokens_have_their_own_ids():
    from tokenizers import Tokenizer

    encode, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|endoftext|>", " x  <|endoftext|>\n<|endoftext|><|endoftext|> y. z", "a <|endof text|> <|ENDOFTEXT|> b", "w. " * 300, ""]
    expected = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(encode(texts)) == expected == list(encode(texts)) == encode.whole(texts)
    assert list(encode(texts[:1])) == [np.array([64, 220, 50256, 275], "<u4").tobytes()]


def test_cut_takes_the_odd_rest_first():
    ids = np.arange(25, dtype="<u4").tobytes()
    assert [(s, k) for s, k, _ in cut(ids, 10)] == [(0, 5), (5, 10), (15, 10)]
    assert [(s, k) for s, k, _ in cut(ids[:80], 10)] == [(0, 10), (10, 10)]
    assert cut(ids[:40], 10) == [(0, 10, zlib.crc32(ids[:40]))]


def test_plan_uses_up_all_lengths():
    rnd = random.Random(2)
    for size in (7, 32, 100):
        counts = {k: rnd.randint(0, 40) for k in range(1, size + 1)}
        patterns = plan(counts, size)
        used: Counter = Counter()
        for lengths, times in patterns:
            assert sum(lengths) <= size and times > 0
            for x in lengths:
                used[x] += times
        assert {k: v for k, v in counts.items() if v} == dict(used)
        total = sum(k * v for k, v in counts.items())
        least = max(-(-total // size), sum(v for k, v in counts.items() if 2 * k > size))
        assert sum(t for _, t in patterns) <= least * 1.05 + 2
        assert sum(len(s[0]) for s in slots(patterns).values()) == sum(len(p) for p, _ in patterns)


def test_exact_complements_come_first():
    assert plan({6: 1, 4: 1, 3: 1, 1: 1}, 10) == [((6, 4), 1), ((3, 1), 1)]
    assert plan({6: 1, 3: 1, 1: 1}, 10) == [((6, 3, 1), 1)]
    assert plan({5: 1, 2: 2, 1: 1}, 10) == [((5, 2, 2, 1), 1)]


def test_a_unit_is_looked_up_once_a_batch(monkeypatch):
    encode = Encoder(PATH)
    text = "one two. é漢 x\ny  z " * 50
    (expected,) = encode([text])
    assert expected == encode.whole([text])[0]
    asked = []
    monkeypatch.setattr(encode, "known", type("Asked", (type(encode.known),), {"get": lambda self, *a: asked.append(a) or dict.get(self, *a)})(encode.known.most))
    assert list(encode([text, text])) == [expected] * 2
    assert len(asked) == len({encode.bare(u) for u in encode.units(text)})


def library(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    return [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_any_white_space_and_marks():
    rnd = random.Random(3)
    alphabet = [*"abist.'s \n\t\r\x1c\x85\xa0　é漢<|>0_#́😀", "'ll", " ", "\n", "\n\n", "the", " of", "!!", "<|endoftext|>"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 14))) for _ in range(3000)]
    encode = Encoder(PATH, most_units=500)
    for at in range(0, len(texts), 300):
        part = texts[at:at + 300]
        assert list(encode(part)) == library(part)


def test_a_word_is_tokenized_once_beside_line_feeds_and_marks(monkeypatch):
    words = [f"{a}{b}o" for a in "bdfglm" for b in "aeiou"]
    texts = ["".join(f"{a}\n{b} {b}### {a}{mark} " for b in words for mark in (".", "%%", "!?"))[:-1] for a in words]
    encode, handed = Encoder(PATH), []
    whole, joined = encode.whole, encode.words
    monkeypatch.setattr(encode, "whole", lambda texts: handed.extend(texts) or whole(texts))
    monkeypatch.setattr(encode, "words", lambda texts: handed.extend(texts) or joined(texts))
    assert list(encode(texts)) == library(texts)
    assert len(handed) < 3 * len(words)


def test_small_batches_are_looked_up_together(monkeypatch):
    import pyarrow as pa

    from statelake.llm import packing

    texts = ["one two", "", "three\nfour", "two  one ", "x<|endoftext|>y"] * 40
    batches = [pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([t])], names=["doc_id", "text"]) for i, t in enumerate(texts)]
    encode, asked = Encoder(PATH), []
    provide = encode.known.provide
    monkeypatch.setattr(encode.known, "provide", lambda *a: asked.append(a) or provide(*a))
    monkeypatch.setattr(packing, "lasting", lambda name, make: encode)
    rows = [r for b in packing._pieces(iter(batches), PATH, 2048) for r in b.to_pylist()]
    assert [(r["doc_id"], r["ids_crc32"]) for r in rows] == [(i, zlib.crc32(ids + bytes(4))) for i, ids in enumerate(library(texts))]
    assert len(asked) == 1
