from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_cases import SCHEMA, prose

from statelake.llm.repeats import anchors, cut_repeats, repeated, without_repeats


def brute(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row; equal rows are one document."""
    texts = {(r[0], r[1] or "") for r in rows}
    last = float("inf")
    seen: dict[bytes, tuple] = {}
    found = {}
    for doc, text in sorted(texts, key=lambda x: (last if x[0] is None else x[0], x[1])):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            w = data[i:i + length]
            if w in seen and not (seen[w][0] is None and doc is None and seen[w][1] == text and i == seen[w][2]):
                gone[i:i + length] = True
            else:
                seen[w] = (doc, text, i)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        found[doc, text] = (doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
    return [found[r[0], r[1] or ""] for r in rows]


def test_against_brute_force(documents, corpus):
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in cut_repeats(documents).collect()), key=repr)
    assert got == sorted((x[:5] for x in brute(corpus)), key=repr)


def test_remaining_text(clashing, nothing, corpus):
    assert cut_repeats(nothing).count() == 0 and without_repeats(nothing).count() == 0
    out = without_repeats(clashing)
    assert out.columns == clashing.drop("_n_removed").columns + ["_n_removed"]
    got = sorted(((r.doc_id, r._n_removed, r.text or "") for r in out.collect()), key=repr)
    assert got == sorted(((x[0], x[2], x[5].decode("utf-8", "replace")) for x in brute(corpus)), key=repr)


def test_short_lengths_and_overlaps(spark):
    rnd = random.Random(4)
    texts = ["abc" * 60, prose(rnd, 40)]
    texts += [texts[1][:80] + prose(rnd, 6) + texts[1][40:], "é" * 70, "zé" * 50, texts[1][3:90]]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in cut_repeats(spark.createDataFrame(rows, SCHEMA), 33).collect())
    assert got == sorted(x[:5] for x in brute(rows, 33))
    with pytest.raises(ValueError):
        cut_repeats(spark.createDataFrame(rows, SCHEMA), 8)


def test_every_string_holds_an_anchor_at_the_same_place():
    rnd = random.Random(1)
    a, b = [bytes(rnd.choice(b"abcd") for _ in range(400)) for _ in range(2)]
    b = b[:150] + a[100:260] + b[150:]
    found = []
    for data in (a, b):
        places, _ = anchors(np.frombuffer(data, np.uint8), np.array([len(data)]), 100)
        found.append(set(places.tolist()))
        assert all(any(s <= p <= s + 68 for p in found[-1]) for s in range(len(data) - 99))
    inside = {p for p in found[0] if 168 <= p <= 160 + 100 - 68}
    assert {p + 50 for p in inside} <= found[1]


def test_columns_against_sorting():
    """Equal last symbols are found as by comparing the strings."""
    rnd = np.random.default_rng(2)
    rows, wide, length = 200, 30, 12
    groups = np.sort(rnd.integers(0, 5, rows))
    data = rnd.integers(0, 2, (rows, wide)).astype(np.uint8)
    data[::3] = data[0]
    data[::3, 20] = rnd.integers(0, 2, len(data[::3]))
    low, high = np.zeros(rows, np.int32), np.full(rows, wide - length, np.int32)
    begin, end = repeated(np.ascontiguousarray(data.T), groups, low, high, length)
    for i in range(rows):
        starts = [s for s in range(wide - length + 1) if any(groups[j] == groups[i] and (data[j, s:s + length] == data[i, s:s + length]).all() for j in range(i))]
        assert (begin[i], end[i]) == ((starts[0], starts[-1]) if starts else (-1, -1))
