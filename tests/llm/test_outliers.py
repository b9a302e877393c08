from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_cases import SCHEMA, WORD, prose

from statelake.llm.outliers import FLOORS, NAMES, P, chi_square, chi_square_point, distances, factors, robust_outliers, sums


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = {w: windows.count(w) for w in set(windows)}
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def shown(frame):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in frame.collect()), key=repr)


def test_statistics_against_brute_force(clashing, nothing, corpus):
    assert robust_outliers(nothing).count() == 0
    short = [r for r in corpus if len(r[1] or "") < 9000]
    ids = {r[0] for r in corpus} - {r[0] for r in short}
    got = [r for r in shown(robust_outliers(clashing)) if r[0] not in ids]
    assert got == sorted(((r[0], *base(r[1])) for r in short), key=repr)


def test_junk_is_rejected_and_prose_kept(spark):
    rnd = random.Random(5)
    rows = [(i, prose(rnd, rnd.randint(60, 200)), "en", f"s{i % 2}", 0) for i in range(80)]
    rows += [(100 + i, " ".join(w + "***" for w in prose(rnd, 90).split()), "en", "s0", 0) for i in range(8)]
    rows += [(200 + i, prose(rnd, 90).upper().replace(" ", "!! "), "en", "s1", 0) for i in range(8)]
    rows += [(300, prose(rnd, 90), "fr", None, 0)]  # a group of one
    kept = {r.doc_id: r.kept for r in robust_outliers(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(kept[d] for d in kept if d < 100 or d == 300)
    assert not any(kept[d] for d in kept if 100 <= d < 300)


def test_distances_against_numpy(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(0, 1, (60, P)) @ draw.normal(0, 1, (P, P))
    frame = spark.createDataFrame([("g", *map(float, r)) for r in x], "grp string, " + ", ".join(f"v_{n} double" for n in NAMES))
    got = sorted(r.d2 for r in distances(frame, factors(sums(frame), 1.7)).collect())
    cov = np.cov(x.T, bias=True) * 1.7 + np.diag([f * f for f in FLOORS.values()])
    d = x - x.mean(0)
    assert got == pytest.approx(sorted(np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)), abs=1e-4)


def test_chi_square():
    # Tabulated points of the distribution.
    assert chi_square(12.5916, 6) == pytest.approx(0.95, abs=1e-5)
    assert chi_square_point(0.99, 6) == pytest.approx(16.8119, abs=1e-3)
