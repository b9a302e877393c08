"""Fuzzy line de-duplication by MinHash over character shingles.

1. Each task computes the signatures of the lines it sees first and deals their band
   values, packed, to ranges. A range's owner keeps band values that two or more
   different lines share; of bands with the same lines one is kept.
2. Candidates' texts are fetched; a bitmap of fixed size keeps other lines from being shuffled.
3. Candidates of a band are verified by their Jaccard similarity and joined to
   components (``linking``, ``components``: union-find inside tasks, star rounds across).
   The line that occurs most often is a band's first hub, as its variants are closer to it
   than to one another. Sizes and sketches, which bound the similarity from above, settle
   most unlike pairs before their texts are fetched; a pair is met in one of its bands only.
4. Of each component one line stays: the first by document and place. Where lines occur is
   written once as keys; only lines that occur twice or have a link meet again.

A signature is made by one-permutation hashing: a shingle's hash tells its bin, a bin keeps
its least hash, an empty bin takes the one of the first filled bin in an order of its own.

Defined results: similarity ignores case and runs of white space; null text is empty; lines without a word are never removed; rows of the
same ``doc_id`` and text are the same document and keep the same lines; a null ``doc_id``
comes after every other; other columns are passed on; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_of_runs, partitions, plain, small_batches, text_key, text_of, written
from .linking import families
from .prefix_join import FLUSH, STORED_BITS, from_six, joined, mixed, range_bits, shared_values, six_bytes

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 16, 6
PASSES, BINS = 3, 32
HUBS = 2
BITMAP_BITS = 24
CHUNK = 1 << 16
SKETCH = [f"s{i}" for i in range(8)]
SKETCH_BITS = 64 * len(SKETCH)
MULTIPLIERS = mixed(np.arange(1, PASSES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# The order in which an empty bin asks the others.
DONORS = np.argsort(mixed(np.arange(1, BINS * BINS + 1, dtype=np.uint64)).reshape(BINS, BINS), axis=1)


SPACES = " \t\n\x0b\x0c\r"


def normal(line: str) -> str:
    line = line.lower()
    # The only printable white space is the plain space.
    if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " ":
        return line
    return " ".join(line.split())


def shingles(line: str) -> set[str]:
    """Character shingles; of a shorter line, the line itself."""
    s = normal(line)
    return {s[i:i + WIDTH] for i in range(len(s) - WIDTH + 1)} if len(s) >= WIDTH else {s}


def hashed(lines: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First line, hashes of all shingles, and their number for each line, of chunks of the lines."""
    at = 0
    while at < len(lines):
        part, size, to = [], 0, at
        while to < len(lines) and (size == 0 or size < CHUNK):
            part.append(normal(lines[to]).ljust(WIDTH, "\0"))
            size += len(part[-1])
            to += 1
        counts = np.array([len(p) for p in part])
        code = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = code[:len(code) - WIDTH + 1].copy()
        for i in range(1, WIDTH):
            h *= np.uint64(0x100000001B3)
            h += code[i:len(code) - WIDTH + 1 + i]
        # The last WIDTH - 1 places of a line start no shingle of its own.
        own = np.ones(len(code), bool)
        own[(np.cumsum(counts)[:, None] - np.arange(1, WIDTH)).ravel()] = False
        yield at, mixed(h[own[:len(h)]]), counts - WIDTH + 1
        at = to


def filled(low: np.ndarray) -> np.ndarray:
    """``low`` (lines by bins) with a filled bin's value in every empty one."""
    out = low.copy()
    line, place = np.nonzero(low == EMPTY)
    for turn in range(BINS):
        if not len(line):
            break
        value = low[line, DONORS[place, turn]]
        found = value != EMPTY
        out[line[found], place[found]] = value[found]
        line, place = line[~found], place[~found]
    return out


def bands(lines: list[str]) -> np.ndarray:
    """Band values of each line (lines by bands), minima over all its shingles."""
    out = np.empty((len(lines), BANDS), np.uint64)
    for at, h, counts in hashed(lines):
        first = np.repeat(np.arange(len(counts)) * BINS, counts)
        value, place = np.empty_like(h), np.empty_like(first)
        signature = []
        for multiplier in MULTIPLIERS:
            np.multiply(h, multiplier, out=value)
            low = np.full(len(counts) * BINS, EMPTY)
            np.right_shift(value.view(np.int64), 32, out=place)
            place &= BINS - 1
            place += first
            np.minimum.at(low, place, value)
            signature.append(filled(low.reshape(-1, BINS)))
        rows = np.concatenate(signature, axis=1).reshape(-1, BANDS, ROWS)
        value = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(counts), 1))
        for row in range(ROWS):
            value = mixed(value ^ rows[:, :, row]) + np.uint64(row)
        out[at:at + len(counts)] = mixed(value)
    return out


def sketches(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of different shingles of each line, and SKETCH_BITS bits: whether an odd number of them falls there.

    What two lines share falls out of the difference of their bits, so that it never has more
    bits than the lines have shingles apart.
    """
    sizes, bits = np.empty(len(lines), np.int32), np.empty((len(lines), len(SKETCH)), np.int64)
    for at, h, counts in hashed(lines):
        # A chunk has fewer than 2 ** 17 lines, as each counts WIDTH characters at least.
        line = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        found = np.sort((line << np.uint64(47)) | (h >> np.uint64(17)))
        found = found[first_of_runs(found)]
        line = (found >> np.uint64(47)).astype(np.int64)
        odd = np.bincount(line * SKETCH_BITS + (found & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=len(counts) * SKETCH_BITS) & 1
        sizes[at:at + len(counts)] = np.bincount(line, minlength=len(counts))
        bits[at:at + len(counts)] = np.packbits(odd.astype(bool)).view(np.int64).reshape(-1, len(SKETCH))
    return sizes, bits


TRAITS = "n int, " + ", ".join(f"{s} long" for s in SKETCH)


def _with_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, bits = sketches(batch.column("line").to_pylist())
        arrays = [batch.column("key"), batch.column("line"), pa.array(sizes), *map(pa.array, bits.T.copy())]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "line", "n", *SKETCH])


def may_link(x: str, y: str, percent: int) -> Column:
    """False only where two lines are less similar than ``percent``: by their sizes, or as they
    have more shingles apart than (100 - percent) / (100 + percent) of both together."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    apart = reduce(add, [F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in SKETCH])
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & ((100 + percent) * apart <= (100 - percent) * (nx + ny))


DEALT = "range int, keys binary, values binary"
DEALT_ARROW = pa.schema([("range", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


def _worded(batch: pa.RecordBatch) -> tuple[list[int], list[int], list[bytes], np.ndarray]:
    """Row, place, bytes and key (64 bits of the SHA-256) of every line with a word."""
    rows, places, lines = [], [], []
    for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        for place, line in enumerate(text.split(b"\n")):
            if line.strip(SPACES.encode()):
                rows.append(row)
                places.append(place)
                lines.append(line)
    return rows, places, lines, np.frombuffer(b"".join([sha256(x).digest()[:8] for x in lines]), "<i8")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, places, _, keys = _worded(batch)
        row = pa.array(rows, pa.int64())
        arrays = [batch.column("doc_id").take(row), batch.column("text_key").take(row), pa.array(places, pa.int32()), pa.array(keys)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "place", "key"])


def _fresh(batches: Iterator[pa.RecordBatch], marks: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Keys and lines that the task has not passed on yet; with ``marks``, of those marked there."""
    seen: set[int] = set()
    for batch in batches:
        _, _, lines, keys = _worded(batch)
        wanted = np.arange(len(keys))
        if marks is not None:
            place = keys & ((1 << BITMAP_BITS) - 1)
            wanted = np.flatnonzero((marks[place >> 6] >> (place & 63)) & 1)
        fresh = []
        for i, k in zip(wanted.tolist(), keys[wanted].tolist(), strict=True):
            if k not in seen:
                seen.add(k)
                fresh.append(i)
        if fresh:
            yield keys[fresh], [lines[i].decode("utf-8", "replace") for i in fresh]


def _deal(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Band values of the lines that a task sees first, by range."""
    shift = np.uint64(64 - STORED_BITS - bits)
    keys: list[np.ndarray] = []
    found: list[np.ndarray] = []
    total = 0

    def flush() -> pa.RecordBatch:
        value = np.concatenate(found)
        key = np.repeat(np.concatenate(keys), BANDS)
        part = (value >> np.uint64(STORED_BITS)).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        value, key, part = value[order], key[order], part[order]
        bounds = np.append(first_of_runs(part), len(part))
        rows = [(int(part[lo]), key[lo:hi].tobytes(), six_bytes(value[lo:hi])) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(DEALT_ARROW)], schema=DEALT_ARROW)

    for key, lines in _fresh(batches):
        keys.append(key)
        found.append(bands(lines).ravel() >> shift)
        total += len(found[-1])
        if total > FLUSH:
            yield flush()
            keys, found, total = [], [], 0
    if total:
        yield flush()


def _shared(table: pa.Table, bits: int) -> pa.Table:
    part = table.column("range")[0].as_py()
    value = from_six(b"".join(table.column("values").to_pylist())) | np.uint64(part << STORED_BITS)
    key, value, _ = shared_values(joined(table.column("keys"), np.int64), value)
    return pa.table([pa.array(value.view(np.int64)), pa.array(key)], names=["feature", "gid"])


def bitmap(keys: DataFrame) -> np.ndarray:
    """2 ** BITMAP_BITS bits, set at every key's place: 2 MB however many keys there are."""
    place = F.pmod("gid", F.lit(1 << BITMAP_BITS))
    words = keys.select((F.shiftright(place, 6)).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(gid, {1 << BITMAP_BITS}L) & 63 AS INT))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def shingle_sets(lines: list[str]) -> Iterator[np.ndarray]:
    """Sorted hashes of the different shingles of each line."""
    for _, h, counts in hashed(lines):
        for part in np.split(h, np.cumsum(counts)[:-1]):
            part = np.sort(part)
            yield part[first_of_runs(part)]


class Sets(dict):
    """Shingle sets of the last lines; once they hold a million characters, only of those asked for."""

    chars = 0

    def provide(self, lines: set[str]) -> None:
        if self.chars > 1_000_000:
            kept = {line: self[line] for line in lines & self.keys()}
            self.clear()
            self.update(kept)
            self.chars = sum(map(len, kept))
        new = list(lines - self.keys())
        self.update(zip(new, shingle_sets(new), strict=True))
        self.chars += sum(map(len, new))


def _alike(x: str, y: str, sets: Sets, percent: int) -> bool:
    a, b = sets[x], sets[y]
    if len(a) == 1 or len(b) == 1:
        # A line shorter than a shingle is filled up before it is hashed.
        a, b = shingles(x), shingles(y)
        both = len(a & b)
    else:
        together = np.sort(np.concatenate((a, b)))
        both = int(np.count_nonzero(together[1:] == together[:-1]))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    sets = Sets()
    for batch in batches:
        x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        sets.provide({*x, *y})
        kept = batch.filter(pa.array([_alike(p, q, sets, percent) for p, q in zip(x, y, strict=True)], pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])


def _different(lists: DataFrame) -> DataFrame:
    """One of all lists with the same entries."""
    sets = lists.groupBy("feature").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("gid")).alias("u"), F.bit_xor(F.xxhash64("gid", F.lit(1))).alias("v"))
    return lists.join(sets.groupBy("n", "u", "v").agg(F.min("feature").alias("feature")).select("feature"), "feature")


def removed_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, gone (places of the lines that go): one row for each document that loses any."""
    spark = documents.sparkSession
    small_batches(spark)
    bits = range_bits(partitions(spark))
    texts = documents.select(text_of(documents).alias("text"))
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text_of(documents)).alias("text_key"), text_of(documents).alias("text"))
    places = written(keyed.mapInArrow(_places, "doc_id long, text_key long, place int, key long"), "places")
    dealt = texts.mapInArrow(lambda b: _deal(b, bits), DEALT)
    shared = written(dealt.groupBy("range").applyInArrow(lambda t: _shared(t, bits), "feature long, gid long"), "bands")
    counted = written(
        places.groupBy("key").agg(F.count("*").alias("times")).join(shared.select("gid").distinct(), F.col("key") == F.col("gid"), "left")
        .where("times > 1 OR gid IS NOT NULL"), "counts")
    nodes = counted.where("gid IS NOT NULL").select("gid")
    lists = written(_different(shared).join(counted.select("gid", (-F.col("times")).alias("weight")), "gid"), "lists")

    marks = spark.sparkContext.broadcast(bitmap(nodes))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, lines in _fresh(batches, marks.value):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(lines, pa.string())], names=["key", "line"])

    found = written(
        texts.mapInArrow(marked, "key long, line string")
        .join(nodes.withColumnRenamed("gid", "key"), "key").dropDuplicates(["key"])
        .mapInArrow(_with_sketches, f"key long, line string, {TRAITS}"), "lines")
    traits = found.select(F.col("key").alias("gid"), "n", *SKETCH)

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = found.select(F.col("key").alias("a"), F.col("line").alias("x")), found.select(F.col("key").alias("b"), F.col("line").alias("y"))
        x, y = traits.withColumnRenamed("gid", "a").alias("x"), traits.withColumnRenamed("gid", "b").alias("y")
        pairs = pairs.join(x, "a").join(y, "b").where(may_link("x", "y", percent)).select("a", "b")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(lambda t: _verify(t, percent), "a long, b long")

    def met_here(x: str, y: str) -> Column:
        """Of the bands that two lines share, only the least pairs them."""
        return may_link(x, y, percent) & (F.array_min(F.array_intersect(f"{x}.features", f"{y}.features")) == F.col(f"{x}.feature"))

    features = lists.groupBy("gid").agg(F.collect_set("feature").alias("features"))
    labels = families(lists, nodes.withColumn("node", F.col("gid")), met_here, verified, traits.join(features, "gid"), HUBS)

    wanted = counted.join(labels, F.col("key") == F.col("node"), "left").where("times > 1 OR component IS NOT NULL")
    wanted = wanted.select("key", F.coalesce("component", "key").alias("label"))
    met = written(places.join(wanted, "key").drop("key"), "met")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "place")
    gone = met.join(met.groupBy("label").agg(F.min(rank).alias("stays")), "label").where(rank != F.col("stays"))
    return gone.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("gone"))


def _rebuild(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The lines that stay in ``column``; n_lines is counted before."""
    for batch in batches:
        texts, counts = [], []
        for text, gone in zip(batch.column(column).to_pylist(), batch.column("gone").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            counts.append(sum(1 for line in lines if line.strip(SPACES)))
            if gone:
                gone = set(gone)
                text = "\n".join(line for i, line in enumerate(lines) if i not in gone)
            texts.append(text)
        for name, array in ((column, pa.array(texts, pa.string())), ("n_lines", pa.array(counts, pa.int32()))):
            at = batch.schema.get_field_index(name)
            batch = batch.set_column(at, batch.schema.field(at), array)
        yield batch


def dedup_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``documents`` with the lines that stay in ``text``, and _n_lines, _n_removed (lines with a word).

    Input columns named like these two are replaced.
    """
    documents = documents.drop("_n_lines", "_n_removed")
    gone = removed_lines(documents.select("doc_id", "text"), percent).withColumnRenamed("doc_id", "gone_doc")
    rows, names = plain(documents)
    doc, text = names["doc_id"], names["text"]
    rows = rows.withColumn("key", text_key(F.coalesce(text, F.lit(""))))
    found = rows.join(gone, rows[doc].cast("long").eqNullSafe(F.col("gone_doc")) & (F.col("key") == F.col("text_key")), "left")
    out = found.select(*names.values(), "gone", F.lit(0).alias("n_lines"))
    rebuilt = out.mapInArrow(lambda b: _rebuild(b, text), out.schema)
    return rebuilt.select(
        *[F.col(new).alias(old) for old, new in names.items()], F.col("n_lines").alias("_n_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("_n_removed"))
