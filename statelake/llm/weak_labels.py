"""Quality classifier from weak labels.

1. Heuristic labellers vote on every document: good, bad, or no opinion.
2. Expectation-maximisation over the counts of vote patterns (at most three to the
   power of the labellers, however many documents) estimates each labeller's accuracy
   and the share of good documents, without any true label.
3. The posterior of a document's pattern is its soft label. A logistic scorer over
   hashed words and character classes learns from a bounded sample of documents.
4. The scorer answers for every document; below ``CUT`` a document is rejected.

Defined results: a text that is null or has no word has score 0 and is rejected; repeated
rows and rows without ``doc_id`` are scored like others; an empty table gives an empty
result; other columns are passed on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, bounded_sample, small_batches

#: Documents that the scorer is trained on (about so many, never over twice), taken by the hash of their text.
SAMPLE = 6000
BUCKETS = 1 << 14
CUT = 0.5
EPOCHS = 8
# Words added to a text's number of words: a few words alone say little.
DAMPING = 20
# Numeric inputs beside the hashed words.
SHARES = ("upper", "symbols", "marks", "digits", "bars", "repeats", "same_lines", "next_same", "same_words")
# Words of the windows over which different words are counted: their share falls with length.
WINDOW = 200
BAD, ABSTAIN, GOOD = -1, 0, 1
UPPER, SYMBOLS, MARKS, DIGITS, BARS = (re.compile(p) for p in (r"[^\W\d_a-zß-öø-ÿ]", r"[#*$%&<>{}\\^~=]", r"[!?]", r"\d", r"\|"))


def fresh_words(words: list[str]) -> float:
    """Mean share of different words over the consecutive windows of the whole text; the last one ends with it and is full too."""
    n = len(words)
    if n <= WINDOW:
        return len(set(words)) / max(1, n)
    starts = [*range(0, n - WINDOW, WINDOW), n - WINDOW]
    return sum(len(set(words[at:at + WINDOW])) for at in starts) / (WINDOW * len(starts))


def shares(text: str, words: list[str]) -> list[float]:
    """Measures of a text between 0 and 1, over the whole text."""
    n = max(1, len(words))
    chars = max(1, sum(map(len, words)))
    upper = sum(map(str.isupper, text))
    lines = [x for x in text.split("\n") if x.strip()]
    triples = list(zip(words, words[1:], words[2:], strict=False))
    follow = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        upper / chars, min(1.0, len(SYMBOLS.findall(text)) / n), min(1.0, len(MARKS.findall(text)) / n), len(DIGITS.findall(text)) / chars,
        min(1.0, len(BARS.findall(text)) / n), 1 - len(set(triples)) / len(triples) if triples else 0.0, 1 - len(set(lines)) / max(1, len(lines)), follow / n,
        1 - fresh_words(words) if words else 0.0,
    ]


#: Detectors of one kind of junk each: the share from which they say bad, else they abstain.
DETECTORS = {"upper": 0.35, "symbols": 0.15, "marks": 0.35, "digits": 0.3, "bars": 0.15, "repeats": 0.5, "same_lines": 0.7, "next_same": 0.2}
LABELLERS = len(DETECTORS) + 4


def votes(text: str) -> list[int]:
    """What each labeller says; they overlap and may all be wrong.

    A detector that finds nothing has no opinion: junk of one kind looks clean to the
    detectors of all others. Four labellers look at the words' form instead.
    """
    words = text.split()
    if not words:
        return [BAD] * LABELLERS
    measured = dict(zip(SHARES, shares(text, words), strict=True))
    n = len(words)
    plain = sum(w.strip(".,;:!?'\"()").isalpha() for w in words) / n
    stops = sum(len(w) <= 4 and w.isalpha() for w in words) / n
    prose = sum(w[-1] in ".," for w in words) / n
    return [
        *[BAD if measured[name] >= least else ABSTAIN for name, least in DETECTORS.items()],
        BAD if plain < 0.7 else GOOD if plain > 0.97 and measured["upper"] < 0.2 else ABSTAIN,
        BAD if stops < 0.12 and n >= 20 else ABSTAIN,
        BAD if measured["same_words"] > 0.75 and n >= 20 else ABSTAIN,
        GOOD if 0.02 <= prose <= 0.4 and plain > 0.95 and measured["repeats"] < 0.2 else ABSTAIN,
    ]


def accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and per labeller and class (bad, good) the probability of each vote (bad, none, good).

    ``patterns`` is (patterns by labellers). The start says that labellers are right more often than not.
    """
    prior = 0.7
    table = np.tile(np.array([[0.3, 0.6, 0.1], [0.02, 0.6, 0.38]]), (patterns.shape[1], 1, 1))
    onehot = np.stack([patterns == v for v in (BAD, ABSTAIN, GOOD)], 2).astype(float)
    for _ in range(rounds):
        good = posterior(patterns, prior, table)
        w = np.stack([(1 - good) * counts, good * counts])
        total = np.einsum("cp,plv->lcv", w, onehot)
        # One vote of each kind is added, so that nothing is impossible.
        new = (total + 1) / (total + 1).sum(2, keepdims=True)
        done = np.abs(new - table).max() < 1e-9
        table, prior = new, float((w[1].sum() + 1) / (w.sum() + 2))
        if done:
            break
    return prior, table


def posterior(patterns: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    log = np.log(table)[np.arange(patterns.shape[1]), :, :]
    score = np.array([np.log(1 - prior), np.log(prior)]) + np.stack(
        [log[np.arange(patterns.shape[1]), c, patterns + 1].sum(1) for c in (0, 1)], 1)
    return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))


def bucket(word: str) -> int:
    """Hash bucket of a word's shape and ending: new words fall to known buckets."""
    w = word.lower()
    return zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS


class Scorer:
    """Logistic model: mean weight of the words' buckets, weights of the shares, and a bias."""

    def __init__(self, weights: np.ndarray, numeric: np.ndarray, bias: float):
        self.weights, self.numeric, self.bias = weights, numeric, bias

    def words(self) -> Memo:
        return Memo(lambda w: float(self.weights[bucket(w)]), 200_000)

    def __call__(self, text: str | None, memo: Memo) -> float:
        words = (text or "").split()
        if not words:
            return 0.0
        z = self.bias + sum(map(memo.__getitem__, words)) / (len(words) + DAMPING) + float(np.dot(self.numeric, shares(text, words)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS) -> Scorer:
    """Stochastic gradient steps with per-weight rates over soft labels, in a fixed order."""
    rows = []
    for text in texts:
        words = text.split()
        ids, n = np.unique([bucket(w) for w in words], return_counts=True)
        rows.append((ids, n / (len(words) + DAMPING), np.array(shares(text, words))))
    weights, numeric = np.zeros(BUCKETS), np.zeros(len(SHARES))
    # Fixed at the share of good ones, which is then the answer where a text says little.
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_n = np.full(BUCKETS, 1e-6), np.full(len(SHARES), 1e-6)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            ids, x, s = rows[i]
            z = bias + weights[ids] @ x + numeric @ s
            g = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels[i]
            gw, gn = g * x + 1e-6 * weights[ids], g * s
            seen_w[ids] += gw * gw
            seen_n += gn * gn
            weights[ids] -= 0.2 * gw / np.sqrt(seen_w[ids])
            numeric -= 0.5 * gn / np.sqrt(seen_n)
    return Scorer(weights, numeric, bias)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[int, ...], int] = {}
        for text in batch.column("text").to_pylist():
            v = tuple(votes(text or ""))
            found[v] = found.get(v, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([list(v) for v in found], pa.list_(pa.int32())), pa.array(list(found.values()), pa.int64())], names=["pattern", "n"])


def learn(documents: DataFrame, sample: int = SAMPLE) -> Scorer | None:
    """Accuracies from all documents, the scorer from a sample of ``sample``."""
    small_batches(documents.sparkSession)
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_vote, "pattern array<int>, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return None
    patterns, counts = np.array([r["pattern"] for r in counted]), np.array([r["n"] for r in counted], float)
    order = np.lexsort(patterns.T)
    prior, table = accuracies(patterns[order], counts[order])
    chosen = [t for t in bounded_sample(texts, "text", int(counts.sum()), sample) if t.split()]
    if not chosen:
        return None
    labels = posterior(np.array([votes(t) for t in chosen]), prior, table)
    return train(chosen, labels)


def scored(documents: DataFrame, scorer: Scorer | None) -> DataFrame:
    """``documents`` and _score (probability of good)."""
    documents = documents.drop("_score", "_kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = scorer.words() if scorer else None
        for batch in batches:
            score = [scorer(t, memo) if scorer else 0.0 for t in batch.column("text").to_pylist()]
            yield batch.append_column("_score", pa.array(score, pa.float64()))

    schema = documents.select("*", F.lit(0.0).alias("_score")).schema
    return documents.mapInArrow(run, schema)


def classify(documents: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """``documents`` with _score and _kept; input columns of these names are replaced."""
    return scored(documents, learn(documents, sample)).withColumn("_kept", F.col("_score") >= cut)
