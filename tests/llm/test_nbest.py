from __future__ import annotations

import random

import pytest
from llm_cases import SCHEMA

from statelake.llm.common import tokenizer_path
from statelake.llm.nbest import SPACE_MARK, Segmenter, Vocabulary, decoded, segmentations

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def brute(vocabulary, text):
    """All segmentations, best first."""
    if not text:
        return [(0, b"")]
    text = SPACE_MARK + text.replace(" ", SPACE_MARK)
    edges = vocabulary.edges(text)

    def go(place):
        return [(0, b"")] if place == 0 else [(s + w, i + ids) for start, ids, w in edges[place] for s, i in go(start)]

    return sorted(go(len(text)), key=lambda x: -x[0])


def test_against_all_segmentations(vocabulary):
    rnd = random.Random(1)
    texts = ["", "a", "Hello world", "  ab  c", "x\ny z", "€é☃ 漢字", "aaaa aaa", " ", "thion.", "a☃b\nc  ", "▁a ▁"]
    texts += ["".join(rnd.choice("the or\nandé☃") for _ in range(rnd.randint(1, 9))) for _ in range(100)]
    segment = Segmenter(vocabulary, 5)
    for text, found in zip(texts, segment(texts), strict=True):
        every = brute(vocabulary, text)
        assert [s for s, _ in found] == [s for s, _ in every[:5]]
        assert len({ids for _, ids in found}) == len(found) and all(f in every for f in found)


def test_long_units_are_searched_alone(vocabulary):
    text = "abc" * 400 + "☃" * 50
    (found,) = Segmenter(vocabulary, 3)([text])
    assert len(found) == 3 and found[0][0] >= found[1][0] >= found[2][0]
    assert all(vocabulary.decode(ids) == text for _, ids in found)


def test_round_trip(spark, clashing, nothing, corpus):
    assert segmentations(nothing, PATH).count() == 0
    rows = segmentations(clashing, PATH, 3).cache()
    assert rows.where("NOT round_trip").count() == 0
    best = rows.where("rank = 1")
    assert best.count() == len(corpus)
    texts = {r[0]: r[1] or "" for r in corpus if r[0] is not None}
    assert all(r.text == texts[r.doc_id] for r in decoded(rows, PATH).collect() if r.doc_id is not None)
    assert segmentations(spark.createDataFrame([(1, None, None, None, None)], SCHEMA), PATH).collect()[0].n_pieces == 0
