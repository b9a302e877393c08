"""Removal of repeated byte strings: column-wise construction over anchored contexts.

A string of ``length`` bytes repeats where it also starts earlier in the corpus.
One Burrows-Wheeler transform of the whole corpus, extended by one symbol per
document and round, would need as many rounds over all data as the longest
document has bytes. Here the corpus is first cut into small collections that can
be built apart from each other, and each is built column-wise:

1. Every string of ``length`` bytes holds the smallest hash of its ``GRAM``-byte
   substrings, its anchor; equal strings have equal anchors at equal places. Anchors
   are dealt to ranges of their hash in packed columns; anchors that occur once are dropped.
2. An anchor's occurrences, with all bytes that a string around it may cover, are one
   collection of short aligned documents. Its order and common prefixes are built by
   inserting one symbol of each per round: a stable pass by symbol keeps them sorted by
   what has been inserted so far, and the start of the common part with the neighbour
   above is carried along. Neighbours that share the last ``length`` symbols hold the
   same string; all but the earliest are repeats. Collections are read one after the
   other from the sorted files of Spark's shuffle.
3. The repeats of a document are merged and cut out.

Copies of a whole text are found by its SHA-256: of a text of at least ``length``
bytes nothing stays but in its first document.

Defined results: null text is empty; rows of the same ``doc_id`` and text are the same
document; a null ``doc_id`` comes after every other; of different texts under one
``doc_id`` either comes first, always the same; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_of_runs, first_seen, partitions, plain, small_batches, text_key, whole_groups, written
from .prefix_join import FLUSH, STORED_BITS, from_six, home_bits, joined, mixed, range_bits, six_bytes

GRAM = 32
LAST = np.iinfo(np.int64).max
BLOCK = 1 << 18
FAR = np.int16(32767)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on (the last GRAM - 1 places are left out)."""
    h, power, width = data.astype(np.uint64) + np.uint64(1), np.uint64(0x100000001B3), 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * power + h[width:]
            power, width = power * power, 2 * width
    return mixed(h)


def slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """best over values[i:i + width] for each i."""
    span, out = 1, values
    while 2 * span <= width:
        out = best(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return best(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of all strings of ``length`` bytes that end in their text.

    ``data`` holds texts one after the other, ``ends`` the end of each.
    """
    reach = length - GRAM + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(data) | np.uint64(1)
    low = slide(h, reach, np.minimum)
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    last = np.repeat(ends, sizes)[:len(low)]
    low = np.where(np.arange(len(low)) + length <= last, low, np.uint64(0))
    pad = np.zeros(reach - 1, np.uint64)
    high = slide(np.concatenate([pad, low, pad]), reach, np.maximum)
    places = np.flatnonzero(h == high)
    return places, h[places]


DEALT = "range int, keys binary, counts binary, values binary, places binary"
DEALT_ARROW = pa.schema([("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("values", pa.binary()), ("places", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _packed(part: np.ndarray, key: np.ndarray, value: np.ndarray, place: np.ndarray, pack) -> list[tuple]:
    """One row for each part; key runs are stored once."""
    order = np.argsort(part, kind="stable")
    part, key, value, place = part[order], key[order], value[order], place[order]
    bounds = np.append(first_of_runs(part), len(part))
    rows = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        starts = first_of_runs(key[lo:hi])
        counts = np.diff(np.append(starts, hi - lo))
        rows.append((int(part[lo]), key[lo:hi][starts].tobytes(), counts.astype(np.uint32).tobytes(), pack(value[lo:hi]), place[lo:hi].astype(np.uint32).tobytes()))
    return rows


def _deal(batches: Iterator[pa.RecordBatch], length: int, bits: int) -> Iterator[pa.RecordBatch]:
    shift = np.uint64(64 - STORED_BITS - bits)
    held: list[tuple] = []
    total = 0

    def flush() -> pa.RecordBatch:
        key, value, place = (np.concatenate(x) for x in zip(*held, strict=True))
        return _rows(_packed((value >> np.uint64(STORED_BITS)).astype(np.uint16), key, value, place, six_bytes), DEALT_ARROW)

    for batch in batches:
        keys = batch.column("key").to_numpy()
        texts = [(k, t.encode("utf-8", "surrogatepass")) for k, t in zip(keys.tolist(), batch.column("text").to_pylist(), strict=True)]
        texts = [(k, t) for k, t in texts if len(t) >= length]
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (size == 0 or size + len(texts[to][1]) <= BLOCK):
                size += len(texts[to][1])
                to += 1
            block = texts[at:to]
            at = to
            ends = np.cumsum([len(t) for _, t in block])
            places, values = anchors(np.frombuffer(b"".join(t for _, t in block), np.uint8), ends, length)
            who = np.searchsorted(ends, places, "right")
            starts = np.concatenate([[0], ends[:-1]])
            held.append((np.array([k for k, _ in block], np.int64)[who], values >> shift, places - starts[who]))
            total += len(places)
            if total > FLUSH:
                yield flush()
                held, total = [], 0
    if total:
        yield flush()


def _again(table: pa.Table, bits: int) -> pa.Table:
    """One range: the anchors that occur twice or more, by the home of their text."""
    part = table.column("range")[0].as_py()
    key = np.repeat(joined(table.column("keys"), np.int64), joined(table.column("counts"), np.uint32))
    value = from_six(b"".join(table.column("values").to_pylist())) | np.uint64(part << STORED_BITS)
    place = joined(table.column("places"), np.uint32)
    order = np.argsort(value)
    counts = np.diff(np.append(first_of_runs(value[order]), len(value)))
    order = order[np.repeat(counts > 1, counts)]
    order = order[np.lexsort((place[order], key[order], value[order]))]
    key, value, place = key[order], value[order], place[order]
    if len(key):
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (value[1:] != value[:-1]) | (place[1:] != place[:-1])])
        key, value, place = key[once], value[once], place[once]
        counts = np.diff(np.append(first_of_runs(value), len(value)))
        some = np.repeat(counts > 1, counts)
        key, value, place = key[some], value[some], place[some]
    home = (key & ((1 << home_bits(bits)) - 1)).astype(np.uint16)
    order = np.lexsort((place, key))
    rows = _packed(home[order], key[order], value[order], place[order], lambda v: v.tobytes())
    return pa.Table.from_batches([_rows(rows, DEALT_ARROW)])


HELD = "key long, values binary, places binary"
HELD_ARROW = pa.schema([("key", pa.int64()), ("values", pa.binary()), ("places", pa.binary())])


def _by_text(table: pa.Table) -> pa.Table:
    key = np.repeat(joined(table.column("keys"), np.int64), joined(table.column("counts"), np.uint32))
    value, place = joined(table.column("values"), np.int64), joined(table.column("places"), np.uint32)
    order = np.lexsort((place, key))
    key, value, place = key[order], value[order], place[order]
    bounds = np.append(first_of_runs(key), len(key))
    rows = [(int(key[lo]), value[lo:hi].tobytes(), place[lo:hi].tobytes()) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.Table.from_batches([_rows(rows, HELD_ARROW)])


CONTEXT = "anchor long, first long, key long, place int, low int, high int, context binary"
CONTEXT_ARROW = pa.schema([("anchor", pa.int64()), ("first", pa.int64()), ("key", pa.int64()), ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("context", pa.binary())])


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Occurrences with the bytes around them; 0xFF, which no text holds, stands for what lies outside.

    Of equal contexts that a task has at hand only the earliest goes on: all strings of the
    others repeat. These are handed on as spans (low is -1, high the span's end, the anchor any
    number), merged within their document, so that a hot passage leaves each task once.
    """
    side, wide = length - GRAM, 2 * length - GRAM
    held: dict[bytes, tuple] = {}
    spans: dict[int, list[tuple[int, int]]] = {}
    count = 0

    def flush() -> pa.RecordBatch:
        rows = [(*row, context) for context, row in held.items()]
        for key, found in spans.items():
            found.sort()
            lo, hi = found[0]
            for x, y in [*found[1:], (LAST, LAST)]:
                if x > hi:
                    rows.append((key, LAST, key, lo, -1, hi, b""))
                    lo = x
                hi = max(hi, y)
        return _rows(rows, CONTEXT_ARROW)

    for batch in batches:
        for first, key, data, values, places in zip(*[batch.column(x).to_pylist() for x in ("first", "key", "content", "values", "places")], strict=True):
            first, size = LAST if first is None else first, len(data)
            padded = b"\xff" * side + data + b"\xff" * side
            for value, place in zip(np.frombuffer(values, np.int64).tolist(), np.frombuffer(places, np.uint32).tolist(), strict=True):
                row = (value, first, key, place, max(0, side - place), min(side, size - place - GRAM))
                context = padded[place:place + wide]
                known = held.get(context)
                if known is None:
                    held[context] = row
                    continue
                if row[1:4] < known[1:4]:
                    held[context], row = row, known
                spans.setdefault(row[2], []).append((row[3] - side + row[4], row[3] - side + row[5] + length))
            count += len(values) // 8
            if count > 40_000:
                yield flush()
                held.clear()
                spans.clear()
                count = 0
    if count:
        yield flush()


def repeated(columns: np.ndarray, groups: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the repeats of each row, -1 where it has none.

    ``columns`` is symbols by rows; rows are ordered by group and, within it, by
    precedence. One symbol of each row is inserted per round.
    """
    wide, n = columns.shape
    heads = first_of_runs(groups)
    place_group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
    order = np.arange(n)
    # since[i]: where the common part of the rows at i - 1 and i starts.
    since = np.zeros(n, np.int16)
    since[heads] = FAR
    begin, end = np.full(n, -1, np.int16), np.full(n, -1, np.int16)
    same_group = place_group[1:] == place_group[:-1]
    for k in range(wide):
        symbol = columns[k][order]
        differ = (symbol[1:] != symbol[:-1]) & same_group
        if differ.any():
            mixed_groups = np.zeros(len(heads), bool)
            mixed_groups[place_group[1:][differ]] = True
            at = np.flatnonzero(mixed_groups[place_group])
            group, s, old = place_group[at], symbol[at], since[at]
            code = group * 256 + s
            turn = np.argsort(code, kind="stable")
            sorted_code = code[turn]
            new = np.empty(len(at), np.int16)
            new[0] = FAR
            joins = np.flatnonzero(sorted_code[1:] == sorted_code[:-1]) + 1
            breaks = np.flatnonzero(sorted_code[1:] != sorted_code[:-1]) + 1
            sorted_group = group[turn]
            new[breaks] = np.where(sorted_group[breaks] == sorted_group[breaks - 1], k + 1, FAR)
            before, here = turn[joins - 1], turn[joins]
            near = here == before + 1
            new[joins[near]] = old[here[near]]
            if not near.all():
                pairs = np.stack([before[~near] + 1, here[~near] + 1], 1).ravel()
                new[joins[~near]] = np.maximum.reduceat(np.append(old, np.int16(0)), pairs)[::2]
            order[at] = order[at][turn]
            since[at] = new
        if k + 1 >= length:
            start = k + 1 - length
            classes = np.flatnonzero(since > start)
            sizes = np.diff(np.append(classes, n))
            if (sizes > 1).any():
                least = np.minimum.reduceat(order, classes)
                later = order[order != np.repeat(least, sizes)]
                later = later[(low[later] <= start) & (start <= high[later])]
                begin[later] = np.where(begin[later] < 0, start, begin[later])
                end[later] = start
    return begin, end


SPAN = "key long, lo long, hi long"
SPAN_ARROW = pa.schema([("key", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def _spans(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    side = length - GRAM
    for table in whole_groups(batches, "anchor", 20_000):
        ready = table.filter(pc.less(table.column("low"), 0))
        if ready.num_rows:
            yield pa.RecordBatch.from_arrays(
                [ready.column("key").combine_chunks(), ready.column("place").cast(pa.int64()).combine_chunks(), ready.column("high").cast(pa.int64()).combine_chunks()], schema=SPAN_ARROW)
        table = table.filter(pc.greater_equal(table.column("low"), 0))
        n = table.num_rows
        if not n:
            continue
        anchor, first, key, place = (table.column(x).to_numpy() for x in ("anchor", "first", "key", "place"))
        order = np.lexsort((place, key, first, anchor))
        data = np.frombuffer(b"".join(table.column("context").to_pylist()), np.uint8).reshape(n, side + length)
        columns = np.ascontiguousarray(data[order].T)
        begin, end = repeated(columns, anchor[order], table.column("low").to_numpy()[order], table.column("high").to_numpy()[order], length)
        some = begin >= 0
        base = place[order][some].astype(np.int64) - side
        yield pa.RecordBatch.from_arrays([pa.array(key[order][some]), pa.array(base + begin[some]), pa.array(base + end[some] + length)], schema=SPAN_ARROW)


CUT = "key long, n_removed long, n_spans long, kept_sha256 string, kept binary"
CUT_ARROW = pa.schema([("key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, data, spans in zip(*[batch.column(x).to_pylist() for x in ("key", "content", "spans")], strict=True):
            at, kept, removed, runs = 0, [], 0, 0
            stop = -1
            for span in spans:  # sorted by start
                lo, hi = span["lo"], span["hi"]
                if lo > stop:
                    runs += 1
                    kept.append(data[at:lo])
                    removed += hi - lo
                    stop = at = hi
                elif hi > stop:
                    removed += hi - stop
                    stop = at = hi
            kept.append(data[at:])
            rest = b"".join(kept)
            rows.append((key, removed, runs, hashlib.sha256(rest).hexdigest(), rest if texts else None))
        if rows:
            yield _rows(rows, CUT_ARROW)


def _repeats(sources: DataFrame, length: int, texts: bool) -> DataFrame:
    """Cuts of every text with repeats, by text key, with what remains if ``texts`` asks for it.

    ``sources`` has key, doc_id and text.
    """
    spark = sources.sparkSession
    bits = range_bits(partitions(spark))
    long_enough = sources.where(F.octet_length("text") >= length).select("key", "text")
    dealt = first_seen(long_enough).mapInArrow(lambda b: _deal(b, length, bits), DEALT)
    again = dealt.groupBy("range").applyInArrow(lambda t: _again(t, bits), DEALT)
    held = written(again.groupBy("range").applyInArrow(_by_text, HELD), "anchors")

    candidates = written(
        first_seen(long_enough).withColumn("content", F.col("text").cast("binary")).drop("text")
        .join(held, "key").join(_firsts(sources), "key").dropDuplicates(["key"]), "repeats")
    contexts = candidates.mapInArrow(lambda b: _contexts(b, length), CONTEXT)
    spans = (
        contexts.repartition(partitions(spark), "anchor").sortWithinPartitions("anchor")
        .mapInArrow(lambda b: _spans(b, length), SPAN)
        .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    )
    return written(candidates.select("key", "content").join(spans, "key").mapInArrow(lambda b: _cut(b, texts), CUT), "cuts")


def _firsts(sources: DataFrame) -> DataFrame:
    return sources.groupBy("key").agg(F.min("doc_id").alias("first"))


def _is_copy(size: Column, doc: Column, length: int) -> Column:
    """Not the first document of its text, and long enough to be a repeat."""
    return (size >= length) & F.col("first").isNotNull() & ~doc.eqNullSafe(F.col("first"))


def _sources(documents: DataFrame, doc: str, text: str) -> DataFrame:
    return documents.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("key", text_key(F.col("text")))


def cut_repeats(documents: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of ``documents``."""
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} or more")
    small_batches(documents.sparkSession)
    sources = _sources(documents, "doc_id", "text")
    cuts = _repeats(sources, length, texts=False).drop("kept")
    copy = _is_copy(F.col("n_bytes"), F.col("doc_id"), length)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return sources.select("key", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")).join(_firsts(sources), "key").join(cuts, "key", "left").select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame, length: int = 100) -> DataFrame:
    """``documents`` with the remaining bytes as ``text`` and their number removed as _n_removed.

    A character cut in half becomes U+FFFD. An input column named _n_removed is replaced.
    """
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} or more")
    small_batches(documents.sparkSession)
    rows, names = plain(documents.drop("_n_removed"))
    doc, text = names["doc_id"], names["text"]
    sources = _sources(rows, doc, text)
    cuts = _repeats(sources, length, texts=True).select("key", "n_removed", "kept")
    rows = rows.withColumn("key", text_key(F.coalesce(text, F.lit(""))))
    size = F.octet_length(F.coalesce(text, F.lit(""))).cast("long")
    copy = _is_copy(size, F.col(doc).cast("long"), length)
    kept = F.when(copy, F.lit("")).otherwise(F.coalesce(F.make_valid_utf8(F.col("kept").cast("string")), F.col(text)))
    return rows.join(_firsts(sources).join(cuts, "key", "left"), "key").select(
        *[(kept if old == "text" else F.col(new)).alias(old) for old, new in names.items()],
        F.when(copy, size).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("_n_removed"))
