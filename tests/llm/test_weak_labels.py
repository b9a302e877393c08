from __future__ import annotations

import random

import numpy as np
from llm_cases import SCHEMA, prose

from statelake.llm.weak_labels import ABSTAIN, BAD, LABELLERS, accuracies, classify, fresh_words, posterior, votes


def test_em_finds_accuracies_of_simulated_labellers():
    draw = np.random.default_rng(3)
    truth = draw.random(20_000) < 0.8
    right = np.array([0.9, 0.8, 0.7, 0.85, 0.6])
    says = np.where(draw.random((20_000, 5)) < right, truth[:, None], ~truth[:, None])
    table = np.where(draw.random((20_000, 5)) < 0.3, 0, np.where(says, 1, -1))
    patterns, where, counts = np.unique(table, axis=0, return_inverse=True, return_counts=True)
    prior, found = accuracies(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.03
    for k in range(5):
        assert abs(found[k, 1, 2] / (found[k, 1, 2] + found[k, 1, 0]) - right[k]) < 0.05
    answer = posterior(patterns, prior, found)[where] > 0.5
    assert (answer == truth).mean() > max((np.sign(table[:, k] + 0.1) > 0).__eq__(truth).mean() for k in range(5)) - 0.01


def test_votes_of_odd_texts():
    assert all(len(votes(t)) == LABELLERS for t in ("", " ", "a", "a b", "\n", "é" * 10_000, "x " * 5000))


def test_junk_goes_and_prose_stays(spark, clashing, nothing, corpus):
    rnd = random.Random(9)
    good = [(i, prose(rnd, rnd.randint(30, 150)), "en", "s", 0) for i in range(120)]
    bad = [(1000 + i, [" ".join(w + "$$$" for w in prose(rnd, 60).split()), prose(rnd, 60).upper().replace(" ", "!! "), prose(rnd, 60).replace(" ", " | "), "the " * 80][i % 4], "en", "s", 0) for i in range(24)]
    odd = [(5000, None, None, None, None), (5001, "", None, None, None)]
    rows = classify(spark.createDataFrame(good + bad + odd, SCHEMA).repartition(3)).collect()
    kept = {r.doc_id: r._kept for r in rows}
    assert len(kept) == 146 and not kept[5000] and not kept[5001]
    assert sum(kept[r[0]] for r in good) >= 119
    assert sum(kept[r[0]] for r in bad) == 0
    assert classify(nothing).count() == 0
    out = classify(clashing)
    assert sorted(out.columns) == sorted(clashing.columns) and out.count() == len(corpus)


def test_nothing_to_learn_from(spark):
    rows = classify(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect()
    assert [(r._score, r._kept) for r in rows] == [(0.0, False)]


def test_few_words_are_bad_at_any_length():
    rnd = random.Random(9)
    vocabulary = prose(rnd, 400).split()
    for n in (200, 201, 350, 399, 2000, 20_000):
        salad = [rnd.choice(vocabulary[:20]) for _ in range(n)]
        assert votes(" ".join(salad))[-2] == BAD
        assert votes(" ".join(f"w{i % 300}" for i in range(n)))[-2] == ABSTAIN
    half = [f"w{i}" for i in range(1000)] + ["again"] * 1000
    assert fresh_words(half) == 0.5 + 0.5 / 200
