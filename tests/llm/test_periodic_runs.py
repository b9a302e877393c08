from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SCHEMA, WORD, prose
from pyspark.sql import functions as F

from statelake.llm.periodic_runs import digest, looped, periodic_runs, runs_of


def plainly(words, multiple=4, shortest=6):
    """Runs by their definition: for every period, its maximal stretches, unless a smaller period fits."""
    n, found = len(words), []
    for q in range(1, n // multiple + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i:j + q]
            least = next(p for p in range(1, q + 1) if all(x == y for x, y in zip(stretch, stretch[p:], strict=False)))
            if len(stretch) >= max(shortest, multiple * q) and least == q:
                found.append((i, len(stretch), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def rewritten(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def answer(doc, text):
    words = rewritten(doc, WORD.findall(text or ""))
    runs = plainly(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def odd_texts():
    rnd = random.Random(8)
    part = prose(rnd, 9)
    return [
        "x " * 700, "a b " * 40, "a a a a a", "a a a a a a", " ".join(["a a a a a a b"] * 5), " ".join(["a b a b a b a c"] * 6) + " z",
        " ".join([part] * 4), " ".join([part] * 3), " ".join([part] * 5 + [prose(rnd, 3)] + [part] * 5), "\t".join([part] * 7).replace(" ", "\n"),
        " ".join(["u v"] * 5 + ["u w"] * 5 + ["u v"] * 5), "a\x1cb " * 12, "é x " * 12,
    ]


def test_query_against_the_definition(spark, corpus):
    rows = [(d, t) for d, t, *_ in corpus if len(t or "") < 20_000] + [(9000 + i, t) for i, t in enumerate(odd_texts())]
    # The rewritten tenth.
    rows += [(i, prose(random.Random(i), 60)) for i in range(20_000, 21_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = digest(periodic_runs(documents, text=looped(F.col("text"), F.col("doc_id"))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((answer(*r) for r in rows), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=90) | st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)).map(lambda x: x[0] * x[1]), max_size=5),
       st.sampled_from([(4, 6), (3, 1), (3, 10), (5, 40)]))
def test_small_alphabets(texts, law):
    texts.append("".join(texts))
    codes = np.array([ord(c) for t in texts for c in t], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert runs_of(codes, bounds, *law) == [plainly(t, *law) for t in texts]


def test_long_periods_and_time():
    rnd = np.random.default_rng(1)
    period = rnd.integers(0, 50, 20_000)
    codes = np.concatenate([rnd.integers(0, 50, 777), np.tile(period, 5), rnd.integers(0, 50, 99), np.zeros(200_000, np.int64)])
    began = time.perf_counter()
    (runs,) = runs_of(codes, np.array([0, len(codes)]))
    assert time.perf_counter() - began < 20
    assert (777 + 100_000 + 99, 200_000, 1) in [(s if n < 200_000 else 100_876, min(n, 200_000), q) for s, n, q in runs]
    long = [r for r in runs if r[2] > 10]
    assert len(long) == 1 and long[0][2] == 20_000 and 777 - long[0][0] < 5 and 0 <= long[0][1] - 100_000 < 10


def test_columns_and_nothing(spark, clashing, nothing):
    assert periodic_runs(nothing).count() == 0 and digest(periodic_runs(nothing)).count() == 0
    more = clashing.withColumn("_runs", F.lit("mine")).withColumn("_words_of", F.lit("theirs"))
    out = periodic_runs(more)
    assert out.columns == clashing.columns + ["_words_of", "_n_words", "_runs", "_collapsed"]
    assert out.count() == clashing.count()
    empty = spark.createDataFrame([(1, None, None, None, None), (None, "  \n", None, None, None)], SCHEMA)
    assert [(r._n_words, r._runs, r._collapsed) for r in periodic_runs(empty).collect()] == [(0, [], "")] * 2
    with pytest.raises(ValueError):
        runs_of(np.zeros(9, np.int64), np.array([0, 9]), multiple=2)
