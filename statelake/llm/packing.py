"""Best-fit packing of token sequences by exact-complement hashing.

Only lengths matter for the plan, and there are at most ``size`` of them: the plan
is made from one count per length, however many pieces there are. From the longest
length down, the gap that a length leaves is filled exactly, by one length, a pair
or a triple whose sum is the gap, as often as the counts allow; what no combination
completes goes by best fit. A plan is a list of patterns (lengths, times), and every
step uses up one length, so it has a few thousand entries at most.

Pieces are then numbered within their length, in parallel over slices of the
document ids, and a piece's number names its pattern, sequence and place.

Defined results: null text is empty and is packed as the closing id alone; repeated
rows are packed as often; rows with a null ``doc_id`` are packed too; an empty table
gives an empty result.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Lately, Memo, lasting, small_batches, text_of, written
from .units import WHITE

SIZE = 2048
END = 0
MARKS = string.punctuation
SLICES = 64
# Bytes of text that are looked up together.
TOGETHER = 4 << 20

# White space as the tokenizer's pattern has it, and the empty end of a text.
BLANK = {"", *re.findall(f"[{WHITE}]", "".join(map(chr, range(0x3001))))}
cut_units = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())])


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    Texts are cut into units that are tokenized apart from each other: the tokenizer's pattern
    cuts before all white space that follows another character, so a unit is white space and
    the characters up to the next. A unit that begins with neither stands for itself after a
    space; a text that begins with none is read after a line feed, whose one id is taken off.
    """

    def __init__(self, path: str, most_units: int = 600_000):
        from tokenizers import Tokenizer

        # Spark runs one task for each core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # The literals of these tokens have their own ids and cut a text wherever they stand.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Texts that are not words with one space or one line feed between them.
        white = f"[{WHITE}]"
        self.odd = "|".join([r"\A\z", rf"\A{white}", rf"{white}\z", white * 2, f"[{WHITE.translate({10: None, 32: None})}]", *map(re.escape, self.added)])
        self.known = Lately(most_units)
        # A token's text has one character for each of its bytes.
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        self.marks = Memo(lambda run: self.whole([run])[0])

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, texts: list[str]) -> list[bytes]:
        """Ids of parts that begin, and do not end, with white space: one call for all, cut where
        the tokens' bytes fill a part."""
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        bounds = np.cumsum(pc.binary_length(pa.array(texts, pa.string())).to_numpy())
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), bounds) + 1
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]

    @staticmethod
    def units(text: str) -> list[str]:
        """The units of a text, or of a line feed and the text if it does not begin with white space."""
        if text and text[0] not in BLANK:
            text = "\n" + text
        return [u[1:] if u[0] == " " and u[1:2] not in BLANK else u for u in cut_units(text)]

    @staticmethod
    def bare(unit: str) -> str:
        """A unit without the marks that follow its last letter; the tokenizer's pattern cuts there."""
        bare = unit.rstrip(MARKS)
        return bare if bare[-1:].isalpha() else unit

    def _new(self, units: list[str]) -> list[bytes]:
        bares = [self.bare(u) for u in units]
        made: dict[str, bytes] = {}
        alone, words = [], []
        for b in set(bares):
            ids = self.known.get(b) or self.known.before.get(b)
            if ids is not None:
                made[b] = ids
            elif b[-1] in BLANK:
                alone.append(b)
            else:
                words.append(b)
        made.update(zip(alone, self.whole(alone), strict=True))
        if words:
            made.update(zip(words, self.words([b if b[0] in BLANK else " " + b for b in words]), strict=True))
        return [made[b] + self.marks[u[len(b):]] if len(b) < len(u) else made[b] for u, b in zip(units, bares, strict=True)]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        return self.encoded(pa.array(texts, pa.large_string()))

    def encoded(self, texts: pa.LargeStringArray) -> Iterator[bytes]:
        is_odd = pc.match_substring_regex(texts, self.odd)
        odd = texts.filter(is_odd).to_pylist()
        apart = [i for i, t in enumerate(odd) if any(a in t for a in self.added)]
        whole = dict(zip(apart, self.whole([odd[i] for i in apart]), strict=True))
        split = [[] if i in whole else self.units(t) for i, t in enumerate(odd)]

        # The other texts are cut at their spaces, column-wise.
        text = pa.large_string()
        lines = pc.replace_substring(texts.filter(pc.invert(is_odd)), "\n", " \n")
        lines = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n", text), lines, pa.scalar("", text)), " ")
        places = lines.flatten().dictionary_encode()
        different = places.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.known.provide({*different, *chain.from_iterable(split)}, self._new)
        found = pa.array(map(self.known.__getitem__, different), pa.large_binary()).take(places.indices)
        _, offsets, data = found.buffers()
        bounds = np.frombuffer(offsets, np.int64)[lines.offsets.to_numpy()].tolist() if len(lines) else [0]
        straight = zip(bounds[:-1], bounds[1:], strict=True)

        at = 0
        for odd_one in is_odd.to_pylist():
            if odd_one:
                ids = whole[at] if at in whole else b"".join(map(self.known.__getitem__, split[at]))
                headed = at not in whole and odd[at][:1] not in BLANK
                at += 1
                yield ids[4:] if headed else ids
            else:
                lo, hi = next(straight)
                yield data[lo + 4:hi].to_pybytes()


def cut(ids: bytes, size: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of each piece; the first piece of a long document takes the odd rest."""
    n = len(ids) // 4
    bounds = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
    return [(lo, hi - lo, zlib.crc32(ids[4 * lo:4 * hi])) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]


def _together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until they have so many bytes (the last may be smaller)."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.nbytes
        if count >= size:
            yield pa.concat_batches(held)
            held, count = [], 0
    if held:
        yield pa.concat_batches(held)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    encode, close = lasting(f"encoder {path}", lambda: Encoder(path)), np.array([END], "<u4").tobytes()
    wide = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string())])
    for batch in _together((b.cast(wide) for b in batches), TOGETHER):
        rows = [
            (doc, i, *part)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode.encoded(batch.column("text")), strict=True)
            for i, part in enumerate(cut(ids + close, size))
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECE_ARROW, strict=True)], schema=PIECE_ARROW)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their number of sequences; together they use up ``counts``."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...]) -> None:
        times = min(int(left[x]) // lengths.count(x) for x in set(lengths))
        for x in lengths:
            left[x] -= times
        patterns.append((lengths, times))

    def there(*lengths: int) -> bool:
        return all(x > 0 and left[x] >= lengths.count(x) for x in set(lengths))

    def complement(first: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths with the sum ``gap``, the largest lengths first."""
        if gap == 0:
            return ()
        if there(first, gap):
            return (gap,)
        stock = np.flatnonzero(left[:gap + 1])
        stock = stock[stock > 0]
        pairs = stock[(stock >= gap - stock) & (left[gap - stock] > 0) & (gap > stock)]
        for a in pairs[::-1]:
            if there(first, int(a), int(gap - a)):
                return (int(a), int(gap - a))
        for a in stock[::-1]:
            rest = gap - int(a)
            if rest < 2 or 3 * int(a) < gap:
                continue
            b = stock[(stock <= a) & (stock >= rest - stock) & (stock < rest)]
            b = b[left[rest - b] > 0]
            for x in b[::-1]:
                if there(first, int(a), int(x), rest - int(x)):
                    return (int(a), int(x), rest - int(x))
        return None

    for length in range(size, 0, -1):
        while left[length]:
            found = complement(length, size - length)
            if found is None:
                # Best fit: the largest length that fits, again and again, then an exact rest if there is one.
                lengths, gap = [length], size - length
                while gap:
                    left_now = left[:gap + 1].copy()
                    for x in lengths:
                        if x <= gap:
                            left_now[x] -= 1
                    fits = np.flatnonzero(left_now[1:] > 0)
                    if not len(fits):
                        break
                    lengths.append(int(fits[-1]) + 1)
                    gap -= lengths[-1]
                found = tuple(lengths[1:])
            use((length, *found))
    return patterns


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first number of each slot, first sequence of its pattern, offset in the sequence."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            found.setdefault(x, []).append((used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        sequence += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for x, rows in found.items()}


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(documents: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece."""
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(documents).alias("text"))
    pieces = written(rows.mapInArrow(lambda b: _pieces(b, tokenizer, size), PIECE), "pieces")
    pieces = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SLICES)).cast("int"))

    # At most ``size`` lengths times SLICES rows.
    per_slice = pieces.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_slice.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {r["length"]: r["n"] for r in per_slice.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(counts, size))

    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (
        pieces.withColumn("number", F.row_number().over(within) - 1)
        .join(bases.select("length", "slice", "base"), ["length", "slice"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("number")).alias("number"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                starts, firsts, offsets = table[x]
                slot = np.searchsorted(starts, number[at], "right") - 1
                sequence[at] = firsts[slot] + number[at] - starts[slot]
                offset[at] = offsets[slot]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(length.astype(np.int64)), batch.column("ids_crc32"), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(place, PLACED)
