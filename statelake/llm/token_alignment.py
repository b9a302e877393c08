"""Alignment of two tokenizations of each text, and how often their tokens are linked in the corpus.

1. Both encoders work on units (``units``) that neither joins, so a worker keeps what it has
   met; texts where units could touch are encoded whole.
2. The tokens of many texts lie on one line of bytes. All of A and B are sorted by start
   (lexsort), the running maximum of their ends is accumulated, and where a start reaches it
   a group begins. Inside the groups every overlap of an A with a B token is a link.
3. Links are kept as numbers into the pairs of their block, some texts that a task has
   aligned together; a block also holds in how many of its documents each pair is linked.
   Blocks are written once: a document is encoded and aligned only there.
4. Blocks' numbers are summed to corpus-wide counts, and the counts of a block's own pairs
   come back to it. What is exchanged is a row for each pair of a block, not for each link,
   so a pair that every document holds costs a row a block; no count table is broadcast.

Defined results: null and empty texts, and texts whose tokens do not spell the space and the
text byte by byte, have no tokens: zeros and an empty groups_sha256; every row is a document
of its own, repeated ones too; a null ``doc_id`` stays null; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Lately, lasting, small_batches, written
from .units import ByteLevel, Pieces, units

# A block ends with the text that brings its links to so many.
BLOCK = 2_000_000
# Units of a part of a long text, and bytes of A ids that are aligned at once.
PART = 100_000
LINE = 1 << 20
KEPT = 300_000


class Aligner:
    """Ids of texts in both vocabularies, and their links."""

    def __init__(self, bytes_path: str, pieces_path: str, kept: int = KEPT):
        self.a, self.b = ByteLevel(bytes_path, plain=True), Pieces(pieces_path)
        self.a_bytes, self.b_bytes = self.a.token_bytes(), self.b.token_bytes()
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes))
        self.known = Lately(kept)
        digits = len(str(max(len(self.a_bytes), len(self.b_bytes))))
        # An id's digits and the mark behind it: more of its side, other side, next group.
        self.shown = {
            mark: np.array([f"{i}{mark}".encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))], f"S{digits + 1}").view(np.uint8).reshape(-1, digits + 1)
            for mark in ",|;"
        }

    def spelled(self, tokens: list[bytes], ids: bytes) -> bytes:
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _new(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Ids on both sides and whether both spell the unit."""
        found = zip(parts, self.a.ids(parts), self.b.unit_ids(parts), strict=True)
        return [(a, b, self.spelled(self.a_bytes, a) == p.encode() == self.spelled(self.b_bytes, b)) for p, a, b in found]

    def encode(self, texts: list[str]) -> list[list[tuple[bytes, bytes]]]:
        """Ids on both sides, a long text's in parts that end between units; none for texts that they do not spell."""
        split = [units(" " + t) if t and not self.b.joined(" " + t) else None for t in texts]
        self.known.provide({u for parts in split if parts for u in parts}, self._new)
        apart = [i for i, parts in enumerate(split) if parts is None and texts[i]]
        whole = [texts[i] for i in apart]
        given = {i: [ids] for i, *ids in zip(apart, self.a.ids([" " + t for t in whole]), self.b.ids(whole), strict=True)}
        out = []
        for i, (text, parts) in enumerate(zip(texts, split, strict=True)):
            spells = False
            if parts is not None:
                a, b, right = zip(*map(self.known.__getitem__, parts), strict=True)
                given[i] = [(b"".join(a[at:at + PART]), b"".join(b[at:at + PART])) for at in range(0, len(parts), PART)]
                spells = all(right)
            found = given.get(i, [])
            if found and not spells:
                a, b = (self.spelled(tokens, b"".join(ids[side] for ids in found)) for side, tokens in enumerate((self.a_bytes, self.b_bytes)))
                spells = a == (" " + text).encode() == b
            out.append(found if spells else [])
        return out

    def __call__(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links, groups_sha256) of each text, and the A and B ids of all links, text by text."""
        encoded = self.encode(texts)
        sums, shas = np.zeros((len(texts), 4), np.int64), [hashlib.sha256() for _ in texts]
        links: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
        line: list[tuple[int, bytes, bytes]] = []
        size = 0

        def aligned() -> None:
            numbers, shown, *found = self.line([(a, b) for _, a, b in line])
            links.append(tuple(found))
            for (i, *_), row, text in zip(line, numbers, shown, strict=True):
                # The mark between groups is hashed once it is known that another one follows.
                shas[i].update(b";" + text if sums[i, 0] else text)
                sums[i] += row

        for i, parts in enumerate(encoded):
            for a, b in parts:
                line.append((i, a, b))
                size += len(a)
                if size >= LINE:
                    aligned()
                    line, size = [], 0
        if line:
            aligned()
        rows = [(*row, sha.hexdigest() if row[0] else "") for row, sha in zip(sums.tolist(), shas, strict=True)]
        return rows, *(np.concatenate(side) for side in zip(*links, strict=True))

    def line(self, encoded: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of parts of texts, laid on one line: (n_a, n_b, n_groups, n_links) and the groups' text of each, A and B ids of all links."""
        n_a, n_b = (np.array([len(ids[side]) // 4 for ids in encoded], np.int64) for side in (0, 1))
        a, b = (np.frombuffer(b"".join(ids[side] for ids in encoded), "<u4").astype(np.int64) for side in (0, 1))
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_start, b_start = a_end - self.a_sizes[a], b_end - self.b_sizes[b]

        # Groups: a token that starts where all before it have ended begins one.
        side = np.repeat(np.array([0, 1], np.int8), [len(a), len(b)])
        start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
        order = np.lexsort((side, start))
        reach = np.maximum.accumulate(end[order])
        begins = np.ones(len(order), bool)
        begins[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(begins) - 1
        group_a, group_b = group[:len(a)], group[len(a):]

        # Links: of the B tokens, those from the first that ends behind an A token's start to the last that starts before its end.
        first, beyond = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        each = beyond - first
        link_a = np.repeat(a, each)
        link_b = b[np.repeat(first - (np.cumsum(each) - each), each) + np.arange(len(link_a))]

        ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
        n_links = np.diff(np.concatenate([[0], np.cumsum(each)])[ends_a], prepend=0)
        # Every group has an A token.
        n_groups = np.diff(np.concatenate([[0], group_a + 1])[ends_a], prepend=0)
        shown, to = self._shown(a, b, group_a, group_b, ends_a, ends_b)
        texts = [shown[lo:hi - 1] for lo, hi in zip([0, *to.tolist()[:-1]], to.tolist(), strict=True)]
        return np.column_stack([n_a, n_b, n_groups, n_links]), texts, link_a, link_b

    def _shown(self, a, b, group_a, group_b, ends_a, ends_b) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` of all, and where each one's text ends."""
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
        order = np.lexsort((np.repeat(np.array([0, 1], np.int8), [len(a), len(b)]), np.concatenate([group_a, group_b])))
        cells = np.concatenate([
            np.where(last_a[:, None], self.shown["|"][a], self.shown[","][a]), np.where(last_b[:, None], self.shown[";"][b], self.shown[","][b])])[order]
        used = cells != 0
        to = np.concatenate([[0], np.cumsum(used.sum(1))])[ends_a + ends_b]
        return cells[used].tobytes(), to


BLOCKS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs array<long>, documents array<int>"
BLOCKS_ARROW = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("documents", pa.list_(pa.int32()))])


def pressed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte planes apart, compressed."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpressed(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(4, count).T.copy().view("<u4").ravel()


def _block(block: int, rows: list[tuple], pairs: np.ndarray) -> pa.RecordBatch:
    """Rows of a block: of each document its links, as numbers of pairs; the pairs, from the most frequent, are on the first row."""
    known, which, often = np.unique(pairs, return_inverse=True, return_counts=True)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(known))
    which = rank[which]
    known = known[np.argsort(rank)]
    sizes = np.array([r[4] for r in rows], np.int64)
    held = np.unique(np.repeat(np.arange(len(rows)), sizes) * max(1, len(known)) + which)
    documents = np.bincount(held % max(1, len(known)), minlength=len(known)).astype(np.int32)
    ends = np.cumsum(sizes)
    links = [pressed(which[e - n:e]) if n else b"" for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    first = [(known, documents)] + [(None, None)] * (len(rows) - 1)
    columns = [[block] * len(rows), *zip(*rows, strict=True), links, *zip(*first, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCKS_ARROW, strict=True)], schema=BLOCKS_ARROW)


def _blocks(batches: Iterator[pa.RecordBatch], bytes_path: str, pieces_path: str, most: int) -> Iterator[pa.RecordBatch]:
    align = lasting(f"aligner {bytes_path} {pieces_path}", lambda: Aligner(bytes_path, pieces_path))
    base = TaskContext.get().partitionId() << 32
    rows: list[tuple] = []
    pairs: list[np.ndarray] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        answers, a, b = align([t or "" for t in batch.column("text").to_pylist()])
        rows += [(doc, *answer) for doc, answer in zip(batch.column("doc_id").to_pylist(), answers, strict=True)]
        pairs.append(a << 32 | b)
        held += len(a)
        if held >= most:
            yield _block(base, rows, np.concatenate(pairs))
            rows, pairs, held, base = [], [], 0, base + 1
    if rows:
        yield _block(base, rows, np.concatenate(pairs))


ANSWER = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _summed(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of a block's documents."""
    # The documents' numbers follow the list of pairs; the counts come in any order.
    known = next((p for p in documents.column("pairs").to_pylist() if p is not None), [])
    known = np.array(known, np.int64)
    order = np.argsort(counts.column("pair").to_numpy())
    at = order[np.searchsorted(counts.column("pair").to_numpy(), known, sorter=order)] if len(known) else np.zeros(0, np.int64)
    total, best = counts.column("total").to_numpy()[at], counts.column("is_best").to_numpy()[at]
    n_best, count_sum = [], []
    for links, n in zip(documents.column("links").to_pylist(), documents.column("n_links").to_pylist(), strict=True):
        which = unpressed(links, n) if n else np.zeros(0, np.int64)
        n_best.append(int(best[which].sum()))
        count_sum.append(int(total[which].sum()))
    kept = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column(
        "groups_sha256", documents.column("groups_sha256"))


def aligned_blocks(documents: DataFrame, bytes_path: str, pieces_path: str, block: int = BLOCK) -> DataFrame:
    """Aligned documents by blocks, written to the shared folder."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(lambda b: _blocks(b, bytes_path, pieces_path, block), BLOCKS), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id in the high, B id in the low 32 bits), total documents that hold it linked, is_best of its A id."""
    counts = (
        blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "documents")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.documents").alias("total")).withColumn("a", F.shiftright("pair", 32))
    )
    # An A id has at most as many pairs as B has entries.
    best = counts.groupBy("a").agg(F.max("total").alias("best"))
    return counts.join(best, "a").select("pair", "total", (F.col("total") == F.col("best")).alias("is_best"))


def alignment(documents: DataFrame, bytes_path: str, pieces_path: str, block: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    blocks = aligned_blocks(documents, bytes_path, pieces_path, block)
    wanted = blocks.where("pairs IS NOT NULL").select(F.col("block").alias("wanted_by"), F.explode("pairs").alias("pair"))
    counted = wanted.join(pair_counts(blocks), "pair").select("wanted_by", "pair", "total", "is_best")
    return blocks.drop("documents").groupBy("block").cogroup(counted.groupBy("wanted_by")).applyInArrow(_summed, ANSWER)
