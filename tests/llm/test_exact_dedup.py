from __future__ import annotations

import hashlib
import re

from statelake.llm.exact_dedup import OpenTable, exact_dedup, grace_groups


def expected(corpus):
    groups: dict[str, list] = {}
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for doc, text, *_ in corpus:
        groups.setdefault(normal(text), []).append(doc)
    out = []
    for doc, text, *_ in corpus:
        ids = groups[normal(text)]
        keep = min((d for d in ids if d is not None), default=None)
        out.append((doc, keep, len(ids), hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(frame, corpus):
    rows = frame.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == expected(corpus)
    kept: dict[str, list] = {}
    for r in rows:
        kept.setdefault(r.text_sha256, []).append((r.kept, r.doc_id == r.keep_id))
    for group in kept.values():
        assert sum(k for k, _ in group) == 1  # also where the smallest id occurs twice


def test_against_brute_force(documents, corpus):
    check(exact_dedup(documents), corpus)


def test_spilling_gives_the_same(documents, corpus):
    check(exact_dedup(documents, memory=2000), corpus)


def test_empty_and_clashing(nothing, clashing, corpus):
    assert exact_dedup(nothing).count() == 0
    check(exact_dedup(clashing), corpus)


def test_equal_hashes_are_told_apart_by_content():
    table = OpenTable(4)
    assert table.add(7, b"x", 1) and table.add(7, b"y", 2) and not table.add(7, b"x", 3)
    assert dict(zip(table.contents, table.members, strict=True)) == {b"x": [1, 3], b"y": [2]}


def test_recursion_ends_with_one_hash(tmp_path):
    rows = [(5, bytes([i % 3]) * 50, i) for i in range(300)]
    tables = list(grace_groups(rows, memory=500, folder=str(tmp_path)))
    found = {c: sorted(m) for t in tables for c, m in zip(t.contents, t.members, strict=True)}
    assert found == {bytes([k]) * 50: list(range(k, 300, 3)) for k in range(3)}
    assert not list(tmp_path.iterdir())
