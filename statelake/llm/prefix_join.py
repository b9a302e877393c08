"""Similarity self-join on word shingles: grouped prefix join, reported as components.

1. Each task hashes its texts to shingle sets and deals the shingles, packed in
   binary columns, to ranges of the hash. Whoever owns a range knows how many
   different texts hold each shingle; shingles of one text only are dropped.
2. Per text, the shingles are ordered by that frequency, rarest first. Two texts
   that reach the threshold share one of the first n - ceil(t*n) + 1. Shingles of
   one text fill that prefix first, so most texts have no candidates at all.
3. Texts of the same size, prefix and number of own shingles are one group. Lists
   of groups by prefix shingle are filtered by size and by position, then expanded
   and verified member by member (module ``linking``).

A shingle is identified by the top 48 + log2(ranges) bits of a 64-bit hash, a text
by 64 bits of its SHA-256.

Defined results: null or blank text has an empty set and is its own component; rows
with a null ``doc_id`` are returned, and give way to any other id of their component;
rows repeated as a whole are returned as often; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, first_of_runs, first_seen, lasting, partitions, plain, small_batches, text_key, written
from .linking import families

STORED_BITS = 48
FLUSH = 400_000
MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

PACKED = "range int, keys binary, counts binary, values binary"
PACKED_ARROW = pa.schema([("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("values", pa.binary())])


def mixed(h: np.ndarray) -> np.ndarray:
    out = h >> np.uint64(30)
    out ^= h
    out *= MIX1
    part = out >> np.uint64(27)
    out ^= part
    out *= MIX2
    np.right_shift(out, np.uint64(31), out=part)
    out ^= part
    return out


def word_hashes(most: int = 100_000) -> Memo:
    return Memo(lambda w: xxhash.xxh64_intdigest(w), most)


def shingle_hashes(text: str, width: int, words: Memo) -> np.ndarray:
    """Distinct hashes of the text's shingles; with fewer words, of the whole sequence."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = len(h)
    if n == 0:
        return h
    span = min(n, width)
    out = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        out = (out + h[i:n - span + 1 + i]) * STEP
        out ^= out >> np.uint64(29)
    return np.unique(mixed(out))


def range_bits(n: int) -> int:
    return max(6, min(16, int(np.ceil(np.log2(max(1, n))))))


def home_bits(bits: int) -> int:
    """Homes of texts are a quarter of the ranges: what is shared is a fraction of all, and
    every range sends one row to every home."""
    return max(4, bits - 2)


def six_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = first_of_runs(owner)
    return starts, np.diff(np.append(starts, len(owner)))


def _deal(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Shingles by hash range; set sizes by text key in the ranges that follow."""
    words = lasting("words", word_hashes)
    shift = np.uint64(64 - STORED_BITS - bits)
    keys: list[int] = []
    sets: list[np.ndarray] = []
    total = 0

    def flush() -> pa.RecordBatch:
        owner, sizes = np.array(keys, np.int64), np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        who = np.repeat(np.arange(len(owner)), sizes)
        part = (values >> np.uint64(STORED_BITS)).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        values, who, part = values[order], who[order], part[order]
        rows = []
        bounds = np.append(first_of_runs(part), len(part))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            starts, counts = _runs(who[lo:hi])
            rows.append((int(part[lo]), owner[who[lo:hi][starts]].tobytes(), counts.astype(np.uint32).tobytes(), six_bytes(values[lo:hi])))
        home = owner & ((1 << home_bits(bits)) - 1)
        order = np.argsort(home, kind="stable")
        bounds = np.append(first_of_runs(home[order]), len(order))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[lo:hi]
            rows.append(((1 << bits) + int(home[at[0]]), owner[at].tobytes(), sizes[at].astype(np.uint32).tobytes(), b""))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PACKED_ARROW, strict=True)], schema=PACKED_ARROW)

    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = np.unique(shingle_hashes(text, width, words) >> shift)
            keys.append(key)
            sets.append(found)
            total += len(found) + 10
            if total > FLUSH:
                yield flush()
                keys, sets, total = [], [], 0
    if keys:
        yield flush()


FOUND = "home int, keys binary, counts binary, values binary, freqs binary"
FOUND_ARROW = pa.schema([("home", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("values", pa.binary()), ("freqs", pa.binary())])


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in column.to_pylist()] or [np.zeros(0, kind)])


def shared_values(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, value, number of keys) of all values that two keys hold."""
    order = np.argsort(values)
    keys, values = keys[order], values[order]
    starts = first_of_runs(values)
    counts = np.diff(np.append(starts, len(values)))
    some = np.repeat(counts > 1, counts)
    keys, values = keys[some], values[some]
    order = np.lexsort((keys, values))
    keys, values = keys[order], values[order]
    if len(keys):
        once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (values[1:] != values[:-1])])
        keys, values = keys[once], values[once]
    starts = first_of_runs(values)
    counts = np.diff(np.append(starts, len(values)))
    freq = np.repeat(counts, counts)
    some = freq > 1
    return keys[some], values[some], freq[some]


def _count(table: pa.Table, bits: int) -> pa.Table:
    """One range: how many texts hold each shingle; shared ones go home to their text."""
    part = table.column("range")[0].as_py()
    owner, counts = joined(table.column("keys"), np.int64), joined(table.column("counts"), np.uint32)
    if part >= 1 << bits:
        return pa.table([pa.array([part - (1 << bits)], pa.int32()), pa.array([owner.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary())], schema=FOUND_ARROW)
    values = from_six(b"".join(table.column("values").to_pylist())) | np.uint64(part << STORED_BITS)
    keys, values, freq = shared_values(np.repeat(owner, counts), values)
    home = (keys & ((1 << home_bits(bits)) - 1)).astype(np.uint16)
    order = np.lexsort((keys, home))
    keys, values, freq, home = keys[order], values[order], freq[order], home[order]
    bounds = np.append(first_of_runs(home), len(home))
    rows = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        starts, runs = _runs(keys[lo:hi])
        rows.append((int(home[lo]), keys[lo:hi][starts].tobytes(), runs.astype(np.uint32).tobytes(), values[lo:hi].tobytes(), np.minimum(freq[lo:hi], 2**32 - 1).astype(np.uint32).tobytes()))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FOUND_ARROW, strict=True)] if rows else [pa.array([], f.type) for f in FOUND_ARROW], schema=FOUND_ARROW)


PROFILE = "key long, n int, own int, prefix array<long>, shared array<long>"
PROFILE_ARROW = pa.schema([("key", pa.int64()), ("n", pa.int32()), ("own", pa.int32()), ("prefix", pa.list_(pa.int64())), ("shared", pa.list_(pa.int64()))])


def _profile(table: pa.Table, percent: int) -> pa.Table:
    """Size, shingles of its own, matchable prefix and shared shingles of each text of one home."""
    sizes: dict[int, int] = {}
    keys, values, freqs = [], [], []
    for k, c, v, f in zip(*[table.column(x).to_pylist() for x in ("keys", "counts", "values", "freqs")], strict=True):
        owner, counts = np.frombuffer(k, np.int64), np.frombuffer(c, np.uint32)
        if v:
            keys.append(np.repeat(owner, counts))
            values.append(np.frombuffer(v, np.int64))
            freqs.append(np.frombuffer(f, np.uint32))
        else:
            sizes.update(zip(owner.tolist(), counts.tolist(), strict=True))
    key, value, freq = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, values, freqs))
    order = np.lexsort((value, freq, key))
    key, value = key[order], value[order]
    starts, runs = _runs(key)
    who, n, own, prefix, shared = [], [], [], [], []
    for at, count in zip(starts.tolist(), runs.tolist(), strict=True):
        k = int(key[at])
        size = sizes.pop(k)
        most = size - -(-percent * size // 100) + 1
        alone = size - count
        some = alone < most
        who.append(k)
        n.append(size)
        own.append(alone)
        prefix.append(value[at:at + most - alone].tolist() if some else [])
        shared.append(value[at:at + count].tolist() if some else [])
    for k, size in sizes.items():
        who.append(k)
        n.append(size)
        own.append(size)
        prefix.append([])
        shared.append([])
    return pa.table([pa.array(who, pa.int64()), pa.array(n, pa.int32()), pa.array(own, pa.int32()), pa.array(prefix, pa.list_(pa.int64())), pa.array(shared, pa.list_(pa.int64()))], schema=PROFILE_ARROW)


def profiles(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """One row for each key of ``texts`` (key, text)."""
    bits = range_bits(2 * partitions(texts.sparkSession))
    dealt = texts.mapInArrow(lambda b: _deal(b, width, bits), PACKED)
    found = dealt.groupBy("range").applyInArrow(lambda t: _count(t, bits), FOUND)
    return found.groupBy("home").applyInArrow(lambda t: _profile(t, percent), PROFILE)


def _by_text(keyed: DataFrame, width: int, percent: int) -> DataFrame:
    """key, n_shingles, label, first (the smallest document of the text); ``keyed`` has doc_id, text, key."""
    small_batches(keyed.sparkSession)
    profile = written(profiles(first_seen(keyed.select("key", "text")), width, percent), "prefixes")
    candidates = profile.where(F.size("prefix") > 0)

    def may_link(x: str, y: str) -> Column:
        nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
        rest = F.least(nx - F.col(f"{x}.place"), ny - F.col(f"{y}.place"))
        return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (100 * rest >= percent * (nx + ny - rest))

    def verified(pairs: DataFrame) -> DataFrame:
        a = candidates.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
        b = candidates.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        return (
            pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .withColumn("both", both).where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
        )

    grouped = candidates.withColumn("gid", F.xxhash64("n", "own", "prefix"))
    groups = grouped.select("gid", "n", "own", "prefix").distinct()
    lists = groups.select("gid", "n", F.col("own").alias("weight"), F.posexplode("prefix").alias("at", "feature")).withColumn("place", F.col("weight") + F.col("at"))
    labels = families(lists.select("feature", "gid", "weight", "n", "place"), grouped.select("gid", F.col("key").alias("node")), may_link, verified)

    # A text's copies share its key; a text without links is its own component.
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("first"))
    return (
        first.join(labels, first["key"] == labels["node"], "left").select("key", "first", F.coalesce("component", "key").alias("label"))
        .join(profile.select("key", F.col("n").cast("long").alias("n_shingles")), "key")
    )


def _keyed(documents: DataFrame, doc: str, text: str) -> DataFrame:
    return documents.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("key", text_key(F.col("text")))


def shingle_components(documents: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of ``documents``.

    Texts link when 100 * shared shingles >= percent * all shingles of both. A component
    is named by its smallest document.
    """
    keyed = _keyed(documents, "doc_id", "text")
    texts = _by_text(keyed, width, percent)
    names = texts.groupBy("label").agg(F.min("first").alias("component_id"))
    return (
        keyed.select("doc_id", "key").join(texts.join(names, "label").select("key", "n_shingles", "component_id"), "key")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``documents`` whose document is the smallest of its component, or has no word."""
    rows, names = plain(documents)
    doc, text = names["doc_id"], names["text"]
    texts = _by_text(_keyed(rows, doc, text), width, percent)
    place = F.struct(F.col("first").isNull().alias("none"), "first", "key")
    stays = texts.where("n_shingles > 0").groupBy("label").agg(F.min(place).alias("stays")).select("stays.first", "stays.key", F.lit(False).alias("blank"))
    blank = texts.where("n_shingles = 0").select("first", "key", F.lit(True).alias("blank"))
    keyed = rows.withColumn("key", text_key(F.coalesce(text, F.lit(""))))
    return (
        keyed.join(stays.union(blank), "key").where(F.col("blank") | F.col(doc).cast("long").eqNullSafe(F.col("first")))
        .select(*[F.col(new).alias(old) for old, new in names.items()])
    )
