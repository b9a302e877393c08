"""Language identification by rank-order profiles of character n-grams.

Every language has a profile: its ``top`` most frequent n-grams (one to three
letters, words padded by a space), counted over all training texts. A text's own
most frequent n-grams are compared to each profile by the out-of-place distance:
the sum over them of the difference between both ranks, ``top`` where the profile lacks one.

Defined results: ``und`` with score 0 where the text is null or has no letter, or no
language can be learned; rank ties go to the smaller n-gram, equal distances to the
smaller language; rows with a null ``doc_id`` count as not held out (their remainder
is unknown, so they are not learned from either); repeated rows are answered alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_of

NONE = "und"
# Different words that a worker keeps the n-grams of, words that are counted and words that are cut at once.
WORDS, TOGETHER, PART = 200_000, 200_000, 50_000
LETTERS = re.compile(r"[^\W\d_]+").findall


def grams(word: str) -> list[str]:
    """n-grams of a padded word."""
    padded = f" {word} "
    return list(word) + [padded[i:i + n] for n in (2, 3) for i in range(len(padded) - n + 1)]


def cut(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``grams`` of words, one word's after the other's, and how many each has.

    An n-gram is a number: three code points of 21 bits, raised by one, 0 behind a short
    n-gram's end. Numbers are in the order of the strings.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer(f" {'  '.join(words)} ".encode("utf-32-le"), "<u4").astype(np.int64) + 1 if words else np.zeros(0, np.int64)
    ends = np.cumsum(sizes + 2)
    inside = np.ones((len(code), 3), bool)
    inside[ends - 1] = False
    inside[ends - 2, 2] = False
    inside[ends - sizes - 2, 0] = False
    found = np.empty((len(code), 3), np.int64)
    found[:, 0] = code << 42
    found[:, 1] = found[:, 0]
    found[:-1, 1] |= code[1:] << 21
    found[:, 2] = found[:, 1]
    found[:-2, 2] |= code[2:]
    return found[inside], 3 * sizes + 1


def spelled(numbers: np.ndarray) -> list[str]:
    """The strings of n-grams."""
    codes = np.stack([numbers >> 42, numbers >> 21 & 0x1FFFFF, numbers & 0x1FFFFF], 1)
    return np.maximum(codes - 1, 0).astype("<u4").view("<U3").ravel().tolist()


def numbered(names: list[str]) -> np.ndarray:
    """The numbers of n-grams."""
    codes = np.array(names, "<U3").view("<u4").reshape(-1, 3).astype(np.int64)
    codes += codes > 0
    return codes[:, 0] << 42 | codes[:, 1] << 21 | codes[:, 2]


def letters(text: str) -> list[str]:
    return LETTERS(text.lower())


COUNTED = "lang string, gram string, n long"


def _count(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Per task: n-gram counts by language, handed on whenever many have gathered."""
    words: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in words.items():
            known = iter(counts)
            while part := list(islice(known, PART)):
                gram, sizes = cut(part)
                found, which = np.unique(gram, return_inverse=True)
                often = np.repeat(np.fromiter(map(counts.__getitem__, part), float), sizes)
                n = np.bincount(which, often).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(spelled(found), pa.string()), pa.array(n)], names=["lang", "gram", "n"])
        words.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(letters(text))
        if sum(map(len, words.values())) > most:
            yield from flush()
    yield from flush()


def learn(labelled: DataFrame, top: int = 400) -> dict[str, list[str]]:
    """Profile of each language over all rows of ``labelled`` (lang, text).

    What reaches the driver is ``top`` n-grams for each language.
    """
    counts = labelled.mapInArrow(lambda b: _count(b, 200_000), COUNTED).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= top)
    found: dict[str, list[tuple[int, str]]] = {}
    for r in ranked.select("lang", "gram", "rank").collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: [g for _, g in sorted(rows)] for lang, rows in sorted(found.items())}


class Numbers(dict):
    """Numbers of words, in the order they are met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Ranker:
    def __init__(self, profiles: dict[str, list[str]], top: int):
        self.langs = list(profiles)
        self.top = top
        self.known = np.unique(numbered([g for p in profiles.values() for g in p]))
        # rank in each profile by n-gram; unknown n-grams share the last column.
        self.ranks = np.full((len(self.langs), len(self.known) + 1), -1, np.int64)
        for row, p in enumerate(profiles.values()):
            self.ranks[row, np.searchsorted(self.known, numbered(p))] = np.arange(len(p))
        self._forget()

    def _forget(self) -> None:
        """Start anew: no words, no n-grams."""
        # n-grams met so far and their columns in ``ranks``; the same n-grams sorted, and where they were met.
        self.met = self.columns = self.sorted = self.at = np.zeros(0, np.int64)
        # Words met so far; the n-grams of word w are ``flat[starts[w]:starts[w + 1]]``.
        self.words = Numbers()
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _known(self) -> None:
        """Take in the n-grams of new words."""
        new = islice(self.words, len(self.starts) - 1, None)
        while part := list(islice(new, PART)):
            gram, sizes = cut(part)
            found, which = np.unique(gram, return_inverse=True)
            at = np.searchsorted(self.sorted, found)
            there = at < len(self.sorted)
            there[there] = self.sorted[at[there]] == found[there]
            ids = np.empty(len(found), np.int64)
            ids[there] = self.at[at[there]]
            ids[~there] = len(self.met) + np.arange(len(found) - there.sum())
            self._meet(found[~there], at[~there], ids[~there])
            self.flat = np.concatenate([self.flat, ids[which].astype(np.int32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _meet(self, fresh: np.ndarray, at: np.ndarray, ids: np.ndarray) -> None:
        """New n-grams, sorted, with their places among the sorted ones."""
        self.met = np.concatenate([self.met, fresh])
        self.sorted, self.at = np.insert(self.sorted, at, fresh), np.insert(self.at, at, ids)
        column = np.searchsorted(self.known, fresh)
        named = np.append(self.known, -1)[column] == fresh
        self.columns = np.concatenate([self.columns, np.where(named, column, -1)])

    def many(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        out: list[tuple[str, float]] = []
        held: list[list[str]] = []
        count = 0
        for text in texts:
            held.append(letters(text or ""))
            count += len(held[-1])
            if count >= TOGETHER:
                out += self._ranked(held)
                held, count = [], 0
        return [*out, *self._ranked(held)]

    def _ranked(self, held: list[list[str]]) -> Iterator[tuple[str, float]]:
        """Answers to texts given as words, all of whose n-grams are counted at once."""
        if len(self.words) > WORDS:
            self._forget()
        word = np.fromiter(map(self.words.__getitem__, chain.from_iterable(held)), np.int64)
        self._known()
        span = max(1, len(self.words))
        text = np.repeat(np.arange(len(held)), [len(w) for w in held])
        found, often = np.unique(text * span + word, return_counts=True)
        text, word = found // span, found % span
        sizes = self.starts[word + 1] - self.starts[word]
        ends = np.cumsum(sizes)
        gram = self.flat[np.repeat(self.starts[word] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        often = np.repeat(often.astype(float), sizes)
        bounds = np.concatenate([[0], ends])[np.searchsorted(text, np.arange(len(held) + 1))]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if low == high or not self.langs:
                yield NONE, 0.0
                continue
            total = np.bincount(gram[low:high], often[low:high])
            there = np.flatnonzero(total)
            yield self._nearest(there, total[there].astype(np.int64))

    def _nearest(self, there: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if len(there) > self.top:
            least = np.partition(counts, len(counts) - self.top)[len(counts) - self.top]
            there, counts = there[counts >= least], counts[counts >= least]
        there = there[np.lexsort((self.met[there], -counts))][:self.top]
        ranks = self.ranks[:, self.columns[there]]
        away = np.where(ranks >= 0, np.abs(ranks - np.arange(len(there))), self.top).sum(1)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.top * len(there))

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.many([text])[0]


ANSWER = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(documents: DataFrame, profiles: dict[str, list[str]], top: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; reads doc_id (passed on), held_out and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, top)
        for batch in batches:
            found = ranker.many(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return documents.select("doc_id", "held_out", "text").mapInArrow(run, ANSWER)


def languages(documents: DataFrame, top: int = 400, folds: int = 5) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) is no multiple of ``folds``; answer all."""
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of(documents).alias("text"), "lang",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0).alias("fold"))
    profiles = learn(rows.where("NOT fold AND lang IS NOT NULL").select("lang", "text"), top)
    return identify(rows.withColumn("held_out", F.coalesce("fold", F.lit(False))), profiles, top)
