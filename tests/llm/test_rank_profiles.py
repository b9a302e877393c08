from __future__ import annotations

import random
import zlib

from llm_cases import SCHEMA

from statelake.llm import rank_profiles
from statelake.llm.rank_profiles import NONE, Ranker, cut, grams, languages, letters, numbered, spelled


def speech(rnd, syllables, n):
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n))


TONGUES = {"xa": "the and ing er on re".split(), "xb": "eux ment oui le éa pa".split(), "xc": "sch ung der ei üb zu".split()}


def test_held_out_accuracy_and_odd_rows(spark, nothing):
    rnd = random.Random(2)
    rows = [(i, speech(rnd, TONGUES[lang], rnd.randint(5, 80)), lang, "s", 0) for i in range(150) for lang in [list(TONGUES)[i % 3]]]
    rows += [(900, None, "xa", None, None), (901, "", "xa", None, None), (902, "12 34 !!", None, None, None), (None, speech(rnd, TONGUES["xb"], 30), None, None, None), rows[0]]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = languages(frame.selectExpr("*", "1 AS held_out", "2 AS gram", "3 AS rank", "4 AS fold")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    truth = {r[0]: r[2] for r in rows if r[1] and r[0] is not None and r[0] < 900}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out)
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {NONE}
    assert [r.lang_pred for r in got if r.doc_id is None] == ["xb"]
    assert languages(nothing).count() == 0
    assert {r.lang_pred for r in languages(frame.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {NONE}


def test_long_texts_and_forgotten_grams(monkeypatch):
    rnd = random.Random(5)
    profiles = {k: list(dict.fromkeys(g for w in speech(rnd, s, 60).split() for g in grams(w)))[:50] for k, s in TONGUES.items()}
    texts = [speech(rnd, TONGUES[k], n) for k, n in (("xa", 30_000), ("xb", 7), ("xc", 400), ("xa", 1))] + ["漢字 " * 500, None, "1 2", "ÀÉ ß İ"]
    expected = Ranker(profiles, 50).many(texts)
    assert [x[0] for x in expected[:3]] == ["xa", "xb", "xc"] and expected[5] == expected[6] == (NONE, 0.0)
    monkeypatch.setattr(rank_profiles, "TOGETHER", 11)
    monkeypatch.setattr(rank_profiles, "WORDS", 20)
    again = Ranker(profiles, 50)
    assert [again(t) for t in texts] == expected and Ranker({}, 50).many(texts[:2]) == [(NONE, 0.0)] * 2


def test_distance_against_the_definition():
    rnd = random.Random(4)
    profiles = {k: list(dict.fromkeys(g for w in speech(rnd, s, 60).split() for g in grams(w)))[:50] for k, s in TONGUES.items()}
    text = speech(rnd, TONGUES["xa"] + TONGUES["xc"], 40)
    counts: dict[str, int] = {}
    for w in letters(text):
        for g in grams(w):
            counts[g] = counts.get(g, 0) + 1
    ranked = sorted(counts, key=lambda g: (-counts[g], g))[:50]
    away = {k: sum(abs(p.index(g) - i) if g in p else 50 for i, g in enumerate(ranked)) for k, p in profiles.items()}
    best = min(away, key=lambda k: (away[k], k))
    assert Ranker(profiles, 50)(text) == (best, 1 - away[best] / (50 * len(ranked)))


def test_words_are_cut_at_once():
    words = ["a", "éa", "über", "漢字", "\U00020000x", "the", "z" * 40]
    numbers, sizes = cut(words)
    ends = sizes.cumsum().tolist()
    for word, lo, hi in zip(words, [0, *ends], ends, strict=False):
        assert sorted(spelled(numbers[lo:hi])) == sorted(grams(word))
    names = sorted({g for w in words for g in grams(w)})
    assert numbered(names).tolist() == sorted(set(numbers.tolist())) and spelled(numbered(names)) == names
    assert [len(x) for x in cut([])] == [0, 0]


def test_new_words_cost_no_loop_over_their_grams(monkeypatch):
    monkeypatch.setattr(rank_profiles, "grams", None)
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcdefghij") for _ in range(9)) for _ in range(50)]
    assert [lang for lang, _ in Ranker({"x": ["a", "ab", " c"], "y": ["zz"]}, 5).many(texts)] == ["x"] * 50
