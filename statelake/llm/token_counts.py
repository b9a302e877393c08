"""Token counts of whole texts by a look-up in two tiers, inside the task that reads a text.

1. A table of the most frequent units (a word with the space before it, see ``units``) and
   their numbers of tokens, at most TABLE entries of at most LONGEST characters, is made
   from a bounded sample of documents and broadcast.
2. A unit that is not in it is encoded by the tokenizer, once for all of a batch, and kept
   by the worker, up to KEPT units; frequent ones survive when the store starts anew.

No unit is ever shuffled, and a document's row never leaves its task. The table decides how
fast a count is found, never what it is: units are encoded apart from each other, so the
numbers add up to the tokenizer's own. Texts with the literal of an added token go to the
tokenizer whole, and so do all texts of a tokenizer that is not byte-level, with its pattern
and no normalizer, or of a SentencePiece model.

Defined results: null text is empty, with no bytes and no tokens; repeated rows are each
answered; other columns are passed on, those called _n_bytes, _n_tokens or _over_limit are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Lately, lasting, plain, small_batches
from .units import ByteLevel, Pieces, units

LIMIT = 1024
SAMPLE = 4_000
TABLE = 1 << 16
LONGEST = 64
KEPT = 300_000
# Tasks that count the sample's units; each passes on at most TABLE of them.
COUNTERS = 4


def by_units(path: str) -> bool:
    """Whether a tokenizer's file is byte-level, so that units may be encoded apart."""
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cutter = spec.get("pre_tokenizer") or {}
    model = spec["model"]
    return (
        spec.get("normalizer") is None and spec.get("truncation") is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
        and not cutter.get("add_prefix_space") and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    )


class Counting:
    """Numbers of tokens of texts."""

    def __init__(self, path: str, kept: int = KEPT):
        self.coder = Pieces(path) if path.endswith(".model") else ByteLevel(path, plain=False)
        self.apart = by_units(path)
        self.known = Lately(kept)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(ids) // 4 for ids in self.coder.ids(texts)]

    def __call__(self, texts: list[str], table: dict[str, int]) -> list[int]:
        alone = range(len(texts)) if not self.apart else [i for i, t in enumerate(texts) if any(a in t for a in self.coder.added)]
        answers = dict(zip(alone, self.whole([texts[i] for i in alone]), strict=True))
        missed: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if i not in answers:
                parts = units(text)
                found = list(map(table.get, parts))
                if None in found:
                    missed[i] = [p for p, n in zip(parts, found, strict=True) if n is None]
                    answers[i] = sum(n for n in found if n is not None)
                else:
                    answers[i] = sum(found)
        self.known.provide({p for parts in missed.values() for p in parts}, self.whole)
        for i, parts in missed.items():
            answers[i] += sum(map(self.known.__getitem__, parts))
        return [answers[i] for i in range(len(texts))]


FREQUENT = "unit string, found long"


def _most_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found.update(u for u in units(text) if len(u) <= LONGEST)
        if len(found) > 16 * TABLE:
            found = Counter(dict(found.most_common(8 * TABLE)))
    top = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:TABLE]
    yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["unit", "found"])


def frequent(documents: DataFrame, path: str, sample: int = SAMPLE) -> dict[str, int]:
    """Tokens of the most frequent units of about ``sample`` documents, drawn by chance."""
    share = min(1.0, sample / max(1, documents.count()))
    chosen = documents.where((F.rand(12) < share) & F.col("text").isNotNull()).select("text")
    lists = chosen.repartition(COUNTERS).mapInArrow(_most_frequent, FREQUENT).collect()
    total: Counter[str] = Counter()
    for row in lists:
        total[row.unit] += row.found
    chosen = [u for u, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:TABLE]]
    return dict(zip(chosen, Counting(path).whole(chosen), strict=True))


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = LIMIT, sample: int = SAMPLE) -> DataFrame:
    """``documents`` and _n_bytes (UTF-8), _n_tokens, _over_limit (more than ``limit`` tokens)."""
    spark = documents.sparkSession
    small_batches(spark)
    documents = documents.drop("_n_bytes", "_n_tokens", "_over_limit")
    table = spark.sparkContext.broadcast(frequent(documents.select("text"), tokenizer, sample) if by_units(tokenizer) else {})
    rows, names = plain(documents)
    text = names["text"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = lasting(f"token counts {tokenizer}", lambda: Counting(tokenizer))
        for batch in batches:
            n = count([t or "" for t in batch.column(text).to_pylist()], table.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "n_tokens"])

    out = rows.mapInArrow(counted, T.StructType([*rows.schema.fields]).add("n_tokens", "long"))
    return out.select(
        *[F.col(new).alias(old) for old, new in names.items()], F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_n_bytes"),
        F.col("n_tokens").alias("_n_tokens"), (F.col("n_tokens") > limit).alias("_over_limit"))
