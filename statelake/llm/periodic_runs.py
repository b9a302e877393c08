"""Periodic runs of words: seeds by k-grams of the least guaranteed overlap, extended along diagonals.

A run with smallest period q has at least ``multiple`` q words, so it overlaps itself moved
by q in ``(multiple - 1) q`` words or more. Periods are taken in classes [2^j, 2^(j+1)): every
run of a class overlaps itself in ``(multiple - 1) 2^j`` words at least (the first classes in
more, as a run has ``shortest`` words), so grams of that length k find it. Two occurrences
of a k-gram in one document, with a lag of the class, are a seed.

Only next-door occurrences need pairing: k >= q - 1, so a third occurrence between two at lag q
would give the k-gram two periods that sum to q, hence (Fine and Wilf) a common one that
divides q, and q would not be the smallest. Seeds of a class are therefore fewer than the
document's words, however often a gram repeats, and no list of occurrences meets itself.

A seed whose left neighbour on its diagonal is a seed too, or that lies below what the
table of its lag says is covered, belongs to a run already extended. The others are extended
to both sides by comparing words. Grams are named exactly, by pairs of names of shorter
ones, and only where the shorter ones occur twice, so prose leaves the index at once.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null or empty text has no words, no runs
and an empty collapsed text; repeated rows are each answered; every other column is passed
on, those called _n_words, _runs or _collapsed are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import first_of_runs, plain, small_batches

MULTIPLE = 4
SHORTEST = 6
# Texts are worked on together until they hold so many words.
TOGETHER = 200_000

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
RUN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Codes(dict):
    """Numbers of words, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _names(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal numbers for equal pairs, and how often each pair is there."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.cumsum(new) - 1
    out = np.empty(len(order), np.int64)
    out[order] = number
    return out, np.bincount(number, minlength=int(number[-1]) + 1 if len(order) else 0)


class Grams:
    """Names of the grams that stand at two or more places of their document."""

    def __init__(self, codes: np.ndarray, document: np.ndarray):
        names, count = _names(document, codes)
        self.known = {1: self._kept(np.arange(len(codes)), names, count)}

    @staticmethod
    def _kept(places: np.ndarray, names: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        again = count[names] > 1 if len(names) else np.zeros(0, bool)
        return places[again], names[again]

    def __call__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in order and the names of their k-grams. A name holds its document, so no gram leaves it."""
        if k not in self.known:
            half = (k + 1) // 2
            # Two halves that meet, or overlap in one word, hold what the gram holds.
            places, names = self(half)
            at = np.searchsorted(places, places + (k - half))
            at[at == len(places)] = 0
            both = places[at] == places + (k - half) if len(places) else np.zeros(0, bool)
            found, count = _names(names[both], names[at[both]])
            self.known[k] = self._kept(places[both], found, count)
        return self.known[k]


def classes(longest: int, multiple: int, shortest: int) -> Iterator[tuple[int, int, int]]:
    """(least period, greatest period, k) of every class that a text of ``longest`` words can hold."""
    low = 1
    while multiple * low <= longest:
        high = 2 * low - 1
        yield low, high, min(max((multiple - 1) * q, shortest - q) for q in range(low, max(low, min(high, shortest)) + 1))
        low *= 2


def runs_of(codes: np.ndarray, bounds: np.ndarray, multiple: int = MULTIPLE, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """(start, length, smallest period) of each document's runs, by start and period.

    ``bounds`` are the documents' first places and the end of the last.
    """
    if multiple < 3:
        raise ValueError("k-grams of a class are shorter than its periods below three periods")
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    sizes = np.diff(bounds)
    if not len(sizes) or sizes.max() < shortest:
        return found
    document = np.repeat(np.arange(len(sizes)), sizes)
    grams = Grams(codes, document)
    for low, high, k in classes(int(sizes.max()), multiple, shortest):
        places, names = grams(k)
        if not len(places):
            continue
        order = np.argsort(names, kind="stable")
        places, names = places[order], names[order]
        lag = places[1:] - places[:-1]
        seed = (names[1:] == names[:-1]) & (lag >= low) & (lag <= high)
        lag, start = lag[seed], places[:-1][seed]
        order = np.lexsort((start, lag))
        lag, start = lag[order], start[order]
        if not len(lag):
            continue
        heads = np.flatnonzero(np.concatenate([[True], (lag[1:] != lag[:-1]) | (start[1:] != start[:-1] + 1)]))
        # A run's overlap is seeds side by side; fewer of them cannot be one.
        overlap = np.diff(np.append(heads, len(lag))) + k - 1
        enough = overlap + lag[heads] >= np.maximum(multiple * lag[heads], shortest)
        covered: dict[int, int] = {}
        for q, at in zip(lag[heads[enough]].tolist(), start[heads[enough]].tolist(), strict=True):
            if at < covered.get(q, 0):
                continue
            d = int(document[at])
            first, end = _extend(codes, at, q, int(bounds[d]), int(bounds[d + 1]))
            covered[q] = end - q
            if end - first >= max(multiple * q, shortest):
                found[d].append((first - int(bounds[d]), end - first, q))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def _extend(codes: np.ndarray, at: int, q: int, low: int, high: int) -> tuple[int, int]:
    """First word and end of the stretch around ``at`` whose words q apart are identical, within [low, high)."""
    first, step = at, 16
    while first > low:
        to = max(low, first - step)
        other = np.flatnonzero(codes[to:first] != codes[to + q:first + q])
        if len(other):
            first = to + int(other[-1]) + 1
            break
        first, step = to, 2 * step
    last, step = at, 16
    while last + q < high:
        to = min(high - q, last + step)
        other = np.flatnonzero(codes[last:to] != codes[last + q:to + q])
        if len(other):
            last += int(other[0])
            break
        last, step = to, 2 * step
    return first, last + q


def _collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, q in runs:
            change[start + q] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def _found(batches: Iterator[pa.RecordBatch], column: str, multiple: int, shortest: int) -> Iterator[pa.RecordBatch]:
    def answer(held: pa.RecordBatch, split: list[list[bytes]]) -> pa.RecordBatch:
        codes = Codes()
        numbers = np.fromiter(map(codes.__getitem__, chain.from_iterable(split)), np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(words) for words in split])]).astype(np.int64)
        runs = runs_of(numbers, bounds, multiple, shortest)
        arrays = [
            pa.array([len(words) for words in split], pa.int64()),
            pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], RUN_ARROW),
            pa.array([_collapse(words, r) for words, r in zip(split, runs, strict=True)], pa.binary()).cast(pa.string()),
        ]
        kept = [n for n in held.schema.names if n != column]
        return pa.RecordBatch.from_arrays([*[held.column(n) for n in kept], *arrays], names=[*kept, "_n_words", "_runs", "_collapsed"])

    for batch in batches:
        # bytes.split() cuts at exactly the contract's white space.
        split: list[list[bytes]] = []
        count = first = 0
        for text in batch.column(column).cast(pa.binary()).to_pylist():
            split.append((text or b"").split())
            count += len(split[-1])
            if count >= TOGETHER:
                yield answer(batch.slice(first, len(split)), split)
                first += len(split)
                split, count = [], 0
        if split:
            yield answer(batch.slice(first, len(split)), split)


def periodic_runs(documents: DataFrame, multiple: int = MULTIPLE, shortest: int = SHORTEST, text: Column | None = None) -> DataFrame:
    """``documents`` and _n_words, _runs (start, length, period of every run, by start and period),
    _collapsed (the words left when each run keeps one period); ``text`` stands in for its text column."""
    small_batches(documents.sparkSession)
    text = F.col("text") if text is None else text
    documents = documents.drop("_n_words", "_runs", "_collapsed")
    rows, names = plain(documents)
    column = f"c{len(names)}"
    rows = documents.select("*", text.cast("string")).toDF(*rows.columns, column)
    schema = T.StructType([f for f in rows.schema if f.name != column]).add("_n_words", "long").add("_runs", RUNS).add("_collapsed", "string")
    out = rows.mapInArrow(lambda b: _found(b, column, multiple, shortest), schema)
    return out.select(*[F.col(new).alias(old) for old, new in names.items()], "_n_words", "_runs", "_collapsed")


def looped(text: Column, doc_id: Column) -> Column:
    """The words of the tenth of all documents whose checksum ends in 0, with a periodic tail; other texts as they are.

    With h the checksum of the decimal doc_id, g = h div 10 and n words, the tail begins at
    a = g mod n and repeats its first 1 + (n - a) div (3 + g mod 8) words. A null doc_id has no checksum.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(h / 10)

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))) + 1
        return F.transform(w, lambda word, i: F.when(i < a, word).otherwise(F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int"))))

    repeated = F.array_join(F.transform(F.array(words), tail)[0], " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(r"[^\x20\x09-\x0D]"), repeated).otherwise(text)


def digest(rows: DataFrame) -> DataFrame:
    """Counts, the run of greatest exact exponent, and checksums of runs and collapsed text."""
    best = F.aggregate(
        F.slice("_runs", 2, F.greatest(F.size("_runs") - 1, F.lit(0))), F.element_at("_runs", 1),
        lambda kept, run: F.when(run["length"] * kept["period"] > kept["length"] * run["period"], run).otherwise(kept))
    text = F.array_join(F.transform("_runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    rows = rows.select("doc_id", "_runs", "_collapsed", F.when(F.size("_runs") > 0, best).alias("best"), text.alias("runs_text"))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("_runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2("runs_text", 256).alias("runs_sha256"), F.sha2("_collapsed", 256).alias("collapsed_sha256"))
