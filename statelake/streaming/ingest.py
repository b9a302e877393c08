"""Micro-batches into stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statelake.sources.event_log import event_rows, log_source, number_lines, score_rows, split_lines
from statelake.sources.log_tail import CHUNK_BYTES, LOG_PROGRESS, numbered, stretches, tail_source
from statelake.sources.store import Lake
from statelake.tables import BOT_EVENTS, BOT_SCORES, TableSpec


def keyed_merge(lake: Lake, spec: TableSpec, order: Column, source: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. Of rows with equal keys in a micro-batch the greatest by
    ``order`` stays, which should leave no ties between different rows. A micro-batch that is
    replayed after a failure is known by ``source`` and its number and left out."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # a merge reads its batch more than once
        try:
            lake.upsert(spec, batch, order, (source, batch_id))
        finally:
            batch.unpersist()

    return merge


def start_merge(stream: DataFrame, lake: Lake, spec: TableSpec, checkpoint: str, order: Column) -> StreamingQuery:
    """Merges everything that is available now, in bounded micro-batches."""
    return (
        stream.writeStream.foreachBatch(keyed_merge(lake, spec, order, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _store_lines(lines: DataFrame, lake: Lake, rejected: str, source: tuple[str, int]) -> None:
    """Numbered lines to the score and event tables, unreadable ones to a side folder."""
    split = _needed(split_lines(lines)).persist()
    place = F.struct("source_file", "seq")
    try:
        lake.upsert(BOT_SCORES, score_rows(split), place, source)
        lake.upsert(BOT_EVENTS, event_rows(split), place, source)
        bad = split.where(~F.col("ok")).select("source_file", "seq", "line")
        bad.write.mode("overwrite").json(f"{rejected}/batch={source[1]}")
    finally:
        split.unpersist()


def _needed(split: DataFrame) -> DataFrame:
    """Split lines without what no later step reads: the text of good lines, the fields of scores and of unreadable lines."""
    is_event = F.col("ok") & (F.col("event.type") != "scores")
    return split.withColumn("line", F.when(~F.col("ok"), F.col("line"))).withColumn("fields", F.when(is_event, F.col("fields")))


def ingest_logs(spark: SparkSession, folder: str, lake: Lake, rejected: str, checkpoint: str) -> StreamingQuery:
    """Sealed log files to the score and event tables, unreadable lines to a side folder.

    The file source reads a path once: files that still grow are for ``ingest_growing_logs``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        _store_lines(number_lines(batch), lake, rejected, (checkpoint, batch_id))

    return (
        log_source(spark.readStream.option("maxFilesPerTrigger", 1000), folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_growing_logs(
    spark: SparkSession, folder: str, lake: Lake, rejected: str, checkpoint: str, chunk_bytes: int = CHUNK_BYTES
) -> StreamingQuery:
    """What log files have grown by since the last run; a line that is not finished waits for its end.

    Line numbers go on where the table of progress says the file was left. That table is
    written last, so a batch that failed half-way is run again from the same numbers.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        placed = stretches(batch, lake.scan(LOG_PROGRESS)).persist()  # read for the numbers and, thrice, for the progress
        try:
            _store_lines(numbered(batch, placed), lake, rejected, (checkpoint, batch_id))
            progress = placed.select(*LOG_PROGRESS.columns).distinct()
            lake.upsert(LOG_PROGRESS, progress, F.col("reached"), (checkpoint, batch_id))
        finally:
            placed.unpersist()
            batch.unpersist()

    return (
        tail_source(spark, folder, chunk_bytes)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_in_bucket(
    stream: DataFrame, keys: Sequence[str], seconds: int, lateness: str = "1 hour", ts: str = "ts", tie: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and cadence bucket, the newest sample's; update mode.

    Of samples of one instant the one with the greatest ``tie`` columns stays, by default the
    greatest of all values. State is dropped once a bucket is later than the watermark.
    """
    values = [c for c in stream.columns if c not in keys and c != ts]
    order = F.struct(ts, *(values if tie is None else tie))
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(F.window(ts, f"{seconds} seconds"), *keys)
        .agg(F.max_by(F.struct(*values), order).alias("_last"))
        .select(F.col("window.start").alias(ts), *keys, "_last.*")
    )
