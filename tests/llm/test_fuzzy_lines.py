from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from statelake.llm import fuzzy_lines
from statelake.llm.fuzzy_lines import BANDS, SKETCH, TRAITS, bands, dedup_lines, may_link, shingles, sketches


def brute(rows, percent=80):
    """The lines that stay of each (doc_id, text)."""
    last = float("inf")
    lines = [(last if d is None else d, t or "", i, x) for d, t in {(r[0], r[1]) for r in rows} for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    distinct = sorted({x for *_, x in lines})
    sets = [shingles(x) for x in distinct]
    parent = list(range(len(distinct)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(distinct)):
        for b in range(a):
            if 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    place = {x: i for i, x in enumerate(distinct)}
    first: dict[int, tuple] = {}
    for d, t, i, x in lines:
        root = find(place[x])
        first[root] = min(first.get(root, (last, "\U0010ffff", 0)), (d, t, i))
    stays = set(first.values())
    return {(d, t): [i for i, x in enumerate((t or "").split("\n")) if not x.strip(" \t\n\x0b\x0c\r") or (last if d is None else d, t or "", i) in stays] for d, t in {(r[0], r[1]) for r in rows}}


def test_against_brute_force(clashing, nothing, corpus):
    assert dedup_lines(nothing).count() == 0
    out = dedup_lines(clashing)
    assert out.columns == clashing.drop("_n_removed").columns + ["_n_lines", "_n_removed"]
    want = brute(corpus)
    expected = sorted(((d, None if t is None else "\n".join(t.split("\n")[i] for i in want[d, t])) for d, t, *_ in corpus), key=repr)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == expected


def test_bands_of_equal_and_odd_lines():
    lines = ["", " ", "a", "A ", "the quick brown fox " * 30, "THE quick  brown fox " * 30, "é☃漢字" * 5000]
    found = bands(lines)
    assert found.shape == (7, BANDS)
    assert (found[2] == found[3]).all() and (found[4] == found[5]).all() and (found[0] == found[1]).all()
    assert not (found[2] == found[4]).any()


def test_recall_of_bands():
    draw = np.random.default_rng(5)
    hit = total = 0
    for _ in range(150):
        words = [f"w{draw.integers(0, 10**6)}" for _ in range(40)]
        other = list(words)
        for i in draw.integers(0, 40, 2):
            other[i] = f"v{draw.integers(0, 10**6)}"
        a, b = " ".join(words), " ".join(other)
        if len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)):
            total += 1
            hit += bool((bands([a])[0] == bands([b])[0]).any())
    assert total > 20 and hit >= 0.95 * total


def test_one_changed_character_of_a_line_of_sixty(spark):
    pairs = [
        ("the committee met in the old town hall on 12 march 1987 again", "the committee met in the old town hall on 12 march 1957 again"),
        ("a quick survey of northern rivers and their many fishes", "a quick survey of northern ravers and their many fishes"),
    ]
    assert all(len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)) for a, b in pairs)
    assert all((bands([a])[0] == bands([b])[0]).any() for a, b in pairs)
    rows = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r._n_removed) for r in out.collect()) == [(0, 0), (1, 1), (2, 0), (3, 1)]


def test_sizes_and_sketches_never_part_similar_lines(spark):
    draw = np.random.default_rng(11)
    lines = ["", "a", "ab", "word " * 300, "word " * 301]
    for _ in range(40):
        words = [f"w{draw.integers(0, 300)}" for _ in range(draw.integers(3, 300))]
        for edits in (0, 1, 2, len(words) // 12, len(words) // 2):
            other = list(words)
            for i in draw.integers(0, len(words), edits):
                other[i] = f"v{draw.integers(0, 300)}"
            lines.append(" ".join(other))
    sizes, bits = sketches(lines)
    assert sizes.tolist() == [len(shingles(x)) for x in lines]
    rows = spark.createDataFrame([(i, int(n), *map(int, b)) for i, (n, b) in enumerate(zip(sizes, bits, strict=True))], f"i int, {TRAITS}")
    kept = {(r.i, r.j) for r in rows.alias("x").join(rows.withColumnRenamed("i", "j").alias("y"), may_link("x", "y", 80)).select("i", "j").collect()}
    sets = [shingles(x) for x in lines]
    alike = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if 100 * len(x & y) >= 80 * len(x | y)}
    assert alike <= kept and len(kept) < 2 * len(alike) and len(alike) > 2 * len(lines)
    assert bits.shape == (len(lines), len(SKETCH))


def test_recall_of_short_lines():
    draw = np.random.default_rng(6)
    hit = total = 0
    for _ in range(400):
        words = [f"w{draw.integers(0, 10**4)}" for _ in range(9)]
        other = list(words)
        other[0 if draw.random() < 0.5 else -1] = f"v{draw.integers(0, 10**4)}"
        a, b = " ".join(words), " ".join(other)
        if len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)):
            total += 1
            hit += bool((bands([a])[0] == bands([b])[0]).any())
    assert total > 100 and hit >= 0.95 * total


def test_variants_of_one_line_and_lists_of_unlike_lines(spark):
    """Variants that are like the frequent line and not like one another, in lists of over 16."""
    words = [f"word{i}" for i in range(24)]
    variants = [" ".join(f"other{i}{j}" if j in (i, (i + 7) % 24) else w for j, w in enumerate(words)) for i in range(24)]
    middle = " ".join(words)
    assert all(len(shingles(v) & shingles(middle)) < len(shingles(v) | shingles(middle)) for v in variants)
    rows = [(100 + i, middle) for i in range(5)] + [(i, v) for i, v in enumerate(variants)]
    out = {(r.doc_id, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert out == {(d, "\n".join(t.split("\n")[i] for i in want[d, t])) for d, t in rows}


def family():
    words = [f"word{i}" for i in range(40)]
    return [(i, " ".join(f"other{i}" if j in (i, 39 - i) else w for j, w in enumerate(words))) for i in range(12)]


def test_a_pair_of_lines_is_met_in_one_of_its_bands(spark, monkeypatch):
    met = []

    def watched(lists, members, may_link, verified, traits, hubs, families=fuzzy_lines.families):
        entries = lists.join(traits, "gid")
        same = (F.col("x.feature") == F.col("y.feature")) & (F.col("x.gid") < F.col("y.gid"))
        met.append([(r.feature, r.a, r.b) for r in entries.alias("x").join(entries.alias("y"), same).select("x.feature", F.col("x.gid").alias("a"), F.col("y.gid").alias("b")).collect()])
        met.append([(r.a, r.b) for r in entries.alias("x").join(entries.alias("y"), same & may_link("x", "y")).select(F.col("x.gid").alias("a"), F.col("y.gid").alias("b")).collect()])
        return families(lists, members, may_link, verified, traits, hubs)

    monkeypatch.setattr(fuzzy_lines, "families", watched)
    rows = family()
    out = {(r.doc_id, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert out == {(d, "\n".join(t.split("\n")[i] for i in want[d, t])) for d, t in rows}
    shared, pairs = met
    assert len(shared) > len({(a, b) for _, a, b in shared}) >= len(pairs) > 0
    assert len(pairs) == len(set(pairs))


def test_a_task_that_cuts_lines_has_one_python_worker(spark, monkeypatch):
    """Cutting, telling lines apart and hashing them were steps with a worker each, which counts where memory is short."""
    steps = {}

    def watched(df, name, write=fuzzy_lines.written):
        steps[name] = df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
        return write(df, name)

    monkeypatch.setattr(fuzzy_lines, "written", watched)
    dedup_lines(spark.createDataFrame(family(), "doc_id long, text string"))
    assert steps["places"] == 1 and steps["bands"] == 1 and steps["lines"] == 2
