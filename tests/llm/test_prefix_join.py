from __future__ import annotations

import random
from itertools import combinations

from llm_cases import SCHEMA, WORD, near, prose

from statelake.llm.prefix_join import one_of_each, shingle_components


def shingle_set(text):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """Per row: (doc_id, set size, smallest document of its component)."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least: dict[int, int | None] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i)) if least.get(find(i)) is not None else r[0])
    return sorted(((r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def test_against_brute_force(documents, corpus):
    assert found(shingle_components(documents)) == brute(corpus)


def test_clashing_and_empty(clashing, nothing, corpus):
    assert shingle_components(nothing).count() == 0
    assert one_of_each(nothing).count() == 0
    one = one_of_each(clashing)
    assert one.columns == clashing.columns
    kept = {r.doc_id for r in one.collect()}
    assert kept == {c if c is not None else d for d, _, c in brute(corpus)}


def test_large_families_and_chains(spark):
    rnd = random.Random(8)
    base, passage = prose(rnd, 90), prose(rnd, 50)
    rows = [(i, near(rnd, base, 1 + i % 5)) for i in range(60)]
    rows += [(100 + i, f"{passage} {prose(rnd, 8)}") for i in range(40)]
    chain = prose(rnd, 100).split(" ")
    for i in range(12):  # each near the one before, far from the first
        chain = chain[3:] + [f"y{i}a", f"y{i}b", f"y{i}c"]
        rows.append((200 + i, " ".join(chain)))
    rows = [(*r, None, None, None) for r in rows]
    assert found(shingle_components(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)
