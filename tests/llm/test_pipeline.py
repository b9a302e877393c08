from __future__ import annotations

import random

import corpus_pipeline as pipeline
from llm_cases import SCHEMA, near, prose
from test_fuzzy_lines import brute as lines_brute
from test_packing import check_layout
from test_prefix_join import brute as near_brute
from test_repeats import brute as repeats_brute


def test_stages_one_after_the_other(spark, tmp_path):
    rnd = random.Random(12)
    passage = prose(rnd, 70)
    base = prose(rnd, 130)
    texts = [prose(rnd, rnd.randint(20, 150)) for _ in range(40)] + [base, base] + [near(rnd, base, 5) for _ in range(4)]
    texts += [f"{prose(rnd, 30)} {passage} {prose(rnd, 30)}" for _ in range(4)] + [" ".join(w + "###" for w in prose(rnd, 60).split()) for _ in range(6)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "suffix-array dedup", "best-fit packing"]
    results = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        results.append([tuple(r) for r in docs.collect()])
        if k < 4:
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            assert all(r[4] == len(r[1]) for r in results[-1])

    quality, lines, unlike, cut, packed = results
    assert {r[0] for r in quality} == set(range(50))  # all junk goes, all prose stays
    want = lines_brute(quality)
    kept = {d: "\n".join(t.split("\n")[i] for i in keep) for (d, t), keep in want.items()}
    assert {r[0]: r[1] for r in lines} == {d: t for d, t in kept.items() if t.strip()}
    assert {r[0] for r in unlike} == {c for _, _, c in near_brute(lines)}
    assert {r[0]: r[1] for r in cut} == {x[0]: x[5].decode("utf-8", "replace") for x in repeats_brute(unlike) if x[5].strip()}
    assert any(x[2] for x in repeats_brute(unlike))
    assert {r[0] for r in packed} == {r[0] for r in cut}
    assert check_layout(docs.collect(), 2048) <= 1 + sum(r[3] for r in packed) // 2048

    assert sorted(map(tuple, pipeline.run(spark, str(tmp_path)).select(docs.columns).collect()))[0][0] == 0


def test_entry_registers_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names if n.startswith("op")} and names["pipeline"] is pipeline.run
    assert "pipeline" not in entry.oracle_sql() and "op1_exact_dedup" in entry.oracle_sql()
