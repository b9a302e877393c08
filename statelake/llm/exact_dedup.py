"""Exact de-duplication by Grace hashing.

Rows are first grouped inside their scan task, so that a text held by a third of
all rows leaves each task once. What remains is dealt by hash (the first level of
partitioning, done by Spark's shuffle), and each task goes on: while its rows do
not fit the memory given, they are dealt to spill files by further hash bits,
until a bucket fits an open-addressing table that compares complete contents.

Defined results: null text counts as empty; null ``doc_id`` comes after every
other; of rows tied at the smallest ``doc_id`` exactly one is kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, partitions, small_batches, text_of, written

FAN_OUT_BITS = 4
MEMORY_BYTES = 64 << 20
ROW_BYTES = 200


class OpenTable:
    """Open addressing with linear probing; equal means equal hash and equal content."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.members: list[list] = []

    def add(self, code: int, content: bytes, member) -> bool:
        """True if the content is new."""
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == code and self.contents[entry] == content:
                self.members[entry].append(member)
                return False
            at = (at + 1) & mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(code)
        self.contents.append(content)
        self.members.append([member])
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, code in enumerate(self.hashes):
            at = code & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def grace_groups(rows: Iterable[tuple], memory: int = MEMORY_BYTES, level: int = 0, folder: str | None = None) -> Iterator[OpenTable]:
    """Tables that together hold every (hash, content, member) row, equal contents in one entry.

    Spill files live in the task's temporary folder and go when the task ends.
    """
    table, held = OpenTable(), 0
    rows = iter(rows)
    # Hashes have 64 bits: beyond the last level rows share all of them and stay together.
    last = (level + 1) * FAN_OUT_BITS > 48
    for code, content, member in rows:
        held += ROW_BYTES + (len(content) if table.add(code, content, member) else 0)
        if held > memory and not last:
            break
    else:
        yield table
        return
    own = tempfile.mkdtemp(prefix="grace-", dir=folder)
    try:
        files = [open(f"{own}/{i}", "wb") for i in range(1 << FAN_OUT_BITS)]  # noqa: SIM115
        shift, mask = 60 - level * FAN_OUT_BITS, (1 << FAN_OUT_BITS) - 1

        def spill(code: int, content: bytes, member) -> None:
            pickle.dump((code, content, member), files[(code >> shift) & mask], pickle.HIGHEST_PROTOCOL)

        for entry, code in enumerate(table.hashes):
            for member in table.members[entry]:
                spill(code, table.contents[entry], member)
        del table
        for row in rows:
            spill(*row)
        for f in files:
            f.close()
        for f in files:
            yield from grace_groups(_records(f.name), memory, level + 1, own)
    finally:
        shutil.rmtree(own, ignore_errors=True)


def _records(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _code(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "little")


LOCAL = "doc_id long, sha binary, part int, turn int, leads boolean, content binary, copies long"
FINAL = "sha binary, part int, turn int, keep_id long, group_size long, stays boolean"


def _local(batches: Iterator[pa.RecordBatch], memory: int) -> Iterator[pa.RecordBatch]:
    """Group the task's rows; the leading row of a content carries it and the number of copies."""
    part = TaskContext.get().partitionId()

    def rows():
        for batch in batches:
            yield from ((_code(sha), text, (doc, sha)) for doc, text, sha in zip(
                batch.column("doc_id").to_pylist(), batch.column("content").to_pylist(), batch.column("sha").to_pylist(), strict=True))

    for table in grace_groups(rows(), memory):
        turns: dict[bytes, list[bytes]] = {}
        for content, members in zip(table.contents, table.members, strict=True):
            turns.setdefault(members[0][1], []).append(content)
        out: list[tuple] = []
        size = 0
        for content, members in zip(table.contents, table.members, strict=True):
            sha = members[0][1]
            turn = 0 if len(turns[sha]) == 1 else sorted(turns[sha]).index(content)
            ids = sorted((m[0] for m in members), key=lambda d: (d is None, d or 0))
            for i, doc in enumerate(ids):
                out.append((doc, sha, part, turn, i == 0, None if i else content, None if i else len(ids)))
            size += len(content) + 100 * len(ids)
            if size > 8 << 20:
                yield _batch(out, LOCAL_ARROW)
                out, size = [], 0
        if out:
            yield _batch(out, LOCAL_ARROW)


def _final(batches: Iterator[pa.RecordBatch], memory: int) -> Iterator[pa.RecordBatch]:
    """Group the leading rows of all tasks by content."""

    def rows():
        for batch in batches:
            c = [batch.column(x).to_pylist() for x in ("doc_id", "sha", "part", "turn", "content", "copies")]
            yield from ((_code(sha), content, (doc is None, doc or 0, part, turn, sha, copies)) for doc, sha, part, turn, content, copies in zip(*c, strict=True))

    for table in grace_groups(rows(), memory):
        out: list[tuple] = []
        for members in table.members:
            members.sort(key=lambda m: m[:4])
            keep = None if members[0][0] else members[0][1]
            size = sum(m[5] for m in members)
            out += [(m[4], m[2], m[3], keep, size, i == 0) for i, m in enumerate(members)]
            if len(out) > 50_000:
                yield _batch(out, FINAL_ARROW)
                out = []
        if out:
            yield _batch(out, FINAL_ARROW)


LOCAL_ARROW = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("part", pa.int32()), ("turn", pa.int32()), ("leads", pa.bool_()), ("content", pa.binary()), ("copies", pa.int64())])
FINAL_ARROW = pa.schema([("sha", pa.binary()), ("part", pa.int32()), ("turn", pa.int32()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("stays", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def exact_dedup(documents: DataFrame, memory: int = MEMORY_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``documents``."""
    spark = documents.sparkSession
    small_batches(spark)
    normal = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_replace(text_of(documents), SPACE, " ").alias("t"))
    rows = normal.select("doc_id", F.col("t").cast("binary").alias("content"), F.unhex(F.sha2("t", 256)).alias("sha"))
    local = written(rows.mapInArrow(lambda b: _local(b, memory), LOCAL), "exact")
    leading = local.where("leads").repartition(partitions(spark), "sha")
    groups = leading.select("doc_id", "sha", "part", "turn", "content", "copies").mapInArrow(lambda b: _final(b, memory), FINAL)
    return (
        local.select("doc_id", "sha", "part", "turn", "leads")
        .join(groups, ["sha", "part", "turn"])
        .select("doc_id", "keep_id", "group_size", (F.col("leads") & F.col("stays")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    )
