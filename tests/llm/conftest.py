from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_cases import SCHEMA, near, prose  # noqa: E402


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Prose with exact and near copies, shared passages, repeated lines, and odd rows."""
    rnd = random.Random(3)
    texts: list[str | None] = [prose(rnd, rnd.randint(5, 160)) for _ in range(30)]
    base = prose(rnd, 120)
    texts += [base] * 6 + [near(rnd, base, k) for k in (1, 1, 2, 3, 4, 5, 6, 8, 9, 12)]
    passage = prose(rnd, 60)
    texts += [f"{prose(rnd, 20)}\n{passage}\n{prose(rnd, 30)}" for _ in range(8)]
    line = prose(rnd, 12)
    texts += [f"{line}\n{prose(rnd, 40)}\n{line}\n{near(rnd, line, 1)}" for _ in range(4)]
    texts += [None, "", "   ", "\n\n", "a", "a b c d", "a b c d", "A  b\tC d", "é☃ 漢字 " * 40, "ab" * 3000, "word " * 900, texts[0], f" {texts[1]} "]
    texts += [prose(rnd, 4000)]
    texts += [texts[-1][5000:9000]]
    rows = [(i * 3, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[4])
    rows.append((None, texts[3], "en", "s0", None))
    rows.append((None, None, None, None, None))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["key", "label", "first", "content", "gid", "node", "h", "n", "kept", "words", "place", "range", "part", "gone", "_kept", "_score", "_n_removed", "c0", "number", "slice"]
    return documents.select("*", *[F.lit(1).alias(n) for n in names])
