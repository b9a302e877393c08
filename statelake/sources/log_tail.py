"""Growing log files as a streaming source: every complete line once, from the byte where the last batch ended.

Offsets are a byte per file, always behind a newline, so a last line that is still being
written waits for a later batch. A batch's stretch of a file is cut into chunks; a chunk has
the lines that begin in it. A task reads many small chunks, so that the number of tasks
follows neither the chunks nor the files. Line numbers need the lines before the stretch, which
``LOG_PROGRESS`` keeps per file with the bytes they end at, for the last batch and the one
before it: a batch that is run again finds the state it started from.
"""

from __future__ import annotations

import fnmatch
import io
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.window import Window

from statelake.tables import TableSpec

from .event_log import FILE_PATTERN

# The source travels to executors by value: a cluster need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "log_tail"
CHUNK_BYTES = 64 << 20
# A batch is shared out among so many tasks, unless a task would have less than the least or more than a chunk of the usual size.
TASKS = 256
TASK_BYTES = 4 << 20
# Bytes of whole lines that become one Arrow batch.
BLOCK = 2 << 20
# So many chunks' offsets go to every executor (some 20 MB), and the lines stay where they were read; beyond, both are dealt by chunk.
FEW_CHUNKS = 200_000
# Bytes read at once when the end of a file is searched for its last newline.
BACK = 1 << 16

TAIL = "source_file string, began long, chunk long, nth long, ended long, line string"
TAIL_ARROW = pa.schema([
    ("source_file", pa.string()), ("began", pa.int64()), ("chunk", pa.int64()), ("nth", pa.int64()), ("ended", pa.int64()), ("line", pa.string())])

LOG_PROGRESS = TableSpec(
    "log_progress", "source_file text, began exact, lines_before exact, reached exact, lines exact", ("source_file",), partitioned=False)


@dataclass
class Span:
    """Chunks of a file, side by side: its lines that begin in [low, high); the batch's stretch of the file is [began, end)."""

    name: str
    began: int
    low: int
    high: int
    end: int


@dataclass
class Share(InputPartition):
    """What one task reads."""

    spans: list[Span]


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The store that holds a folder, and the folder's path there."""
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


class TailReader(DataSourceStreamReader):
    def __init__(self, folder: str, pattern: str, chunk_bytes: int):
        self.folder, self.pattern, self.chunk_bytes = folder, pattern, chunk_bytes
        self.known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, root = opened(self.folder)
        found = {}
        for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.is_file and fnmatch.fnmatch(info.base_name, self.pattern):
                if self.known.get(info.base_name, (None, 0))[0] != info.size:
                    self.known[info.base_name] = (info.size, complete(store, info.path, info.size))
                if end := self.known[info.base_name][1]:
                    found[info.base_name] = end
        return found

    def partitions(self, start: dict, end: dict) -> list[Share]:
        step = self.chunk_bytes
        grown = [(name, start.get(name, 0), to) for name, to in sorted(end.items()) if start.get(name, 0) < to]
        most = max(step, min(CHUNK_BYTES, max(TASK_BYTES, sum(to - began for _, began, to in grown) // TASKS)))
        shares, room = [], 0
        for name, began, to in grown:
            low = began
            while low < to:
                if room <= 0:
                    shares.append(Share([]))
                    room = most
                high = min(to, low + -(-room // step) * step)
                shares[-1].spans.append(Span(name, began, low, high, to))
                room -= high - low
                low = high
        return shares

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        store, root = opened(self.folder)
        for span in partition.spans:
            with store.open_input_file(f"{root}/{span.name}") as raw:
                yield from _read(io.BufferedReader(raw, 1 << 20), span, self.chunk_bytes)


def _read(file: io.BufferedReader, span: Span, step: int) -> Iterator[pa.RecordBatch]:
    at = span.low
    if at > span.began:
        # The line around the border belongs to the chunk before.
        file.seek(at - 1)
        at = at - 1 + len(file.readline())
    else:
        file.seek(at)
    # The last line's chunk, and the lines of that chunk so far.
    last, so_far = -1, 0
    while at < span.high:
        block = file.read(min(BLOCK, span.high - at))
        if not block.endswith(b"\n"):
            block += file.readline(span.end - at - len(block))
        if not block.endswith(b"\n"):
            raise EOFError(f"{span.name} has lost bytes it had: it ends at {at + len(block)}, before {span.end}")
        lines = block[:-1].split(b"\n")
        text = pa.array(lines, pa.binary())
        ended = at + np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)
        began = np.concatenate(([at], ended[:-1]))
        chunk = span.low + (began - span.low) // step * step
        place = np.arange(len(lines)) - np.searchsorted(chunk, chunk)
        nth = np.where(chunk == last, place + so_far, place)
        last, so_far, at = chunk[-1], nth[-1] + 1, int(ended[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(span.name, len(lines)), pa.repeat(pa.scalar(span.began, pa.int64()), len(lines)), pa.array(chunk), pa.array(nth), pa.array(ended), _text(text)],
            schema=TAIL_ARROW)


def _text(lines: pa.Array) -> pa.Array:
    try:
        return lines.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are not UTF-8
        return pa.array([line.decode("utf-8", "replace") for line in lines.to_pylist()], pa.string())


def complete(store: fs.FileSystem, path: str, size: int) -> int:
    """Bytes of a file up to its last newline."""
    with store.open_input_file(path) as file:
        high = size
        while high > 0:
            low = max(0, high - BACK)
            at = file.read_at(high - low, low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            high = low
    return 0


class LogTail(DataSource):
    """``spark.readStream.format("log_tail").load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return TAIL

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"].rstrip("/"), self.options.get("pattern", FILE_PATTERN), int(self.options.get("chunkBytes", CHUNK_BYTES)))


def tail_source(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The complete lines of all log files of a folder as a stream; a folder may appear later."""
    spark.dataSource.register(LogTail)
    return spark.readStream.format(FORMAT).option("chunkBytes", chunk_bytes).load(folder)


def lines_before(progress: DataFrame) -> tuple[DataFrame, Column]:
    """Progress under names of its own, and the lines before a stretch that begins at ``began``."""
    known = progress.select(*[F.col(c).alias(f"_p_{c}") for c in LOG_PROGRESS.columns])
    count = (
        F.when(F.col("began") == 0, F.lit(0)).when(F.col("began") == F.col("_p_reached"), F.col("_p_lines"))
        .when(F.col("began") == F.col("_p_began"), F.col("_p_lines_before"))
        .otherwise(F.raise_error(F.concat(F.lit("no line count for "), "source_file", F.lit(" from byte "), F.col("began").cast("string"))))
    )
    return known, count.cast("long")


def stretches(batch: DataFrame, progress: DataFrame) -> DataFrame:
    """(source_file, chunk, offset) and the batch's new progress: one row per chunk of a batch."""
    chunks = batch.groupBy("source_file", "began", "chunk").agg(F.count(F.lit(1)).alias("_n"), F.max("ended").alias("_ended"))
    known, count = lines_before(progress)
    # A row per chunk: short windows.
    whole = Window.partitionBy("source_file")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.join(known, F.col("source_file") == F.col("_p_source_file"), "left").withColumn("lines_before", count)
    return placed.select(
        "source_file", "began", "chunk", "lines_before", F.max("_ended").over(whole).alias("reached"),
        (F.col("lines_before") + F.sum("_n").over(whole)).alias("lines"),
        (F.col("lines_before") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("offset"))


def numbered(batch: DataFrame, placed: DataFrame) -> DataFrame:
    """(source_file, seq, line) with the line's index in its file; ``placed``, best persisted, is counted first."""
    offsets = placed.select("source_file", "chunk", "offset")
    if placed.count() <= FEW_CHUNKS:
        offsets = F.broadcast(offsets)
    return batch.join(offsets, ["source_file", "chunk"]).select("source_file", (F.col("offset") + F.col("nth")).cast("int").alias("seq"), "line")
