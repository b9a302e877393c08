"""Gaps and islands: runs of rows at or above a threshold, with hole tolerance.

The input is a clock-sampled panel: one row per entity and cadence bucket, so an
entity's series is bounded by the time span, not by the table. All thresholds
share one shuffle and one sort; the closing aggregate reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def threshold_runs(
    panel: DataFrame,
    keys: Sequence[str],
    level: Column,
    thresholds: Sequence[float],
    max_hole_seconds: int,
    ts: str = "ts",
) -> DataFrame:
    """Rows inside a run, with ``threshold`` and ``run_id`` per (keys, threshold).

    A run ends when the level falls below the threshold or is unknown, or when
    the next sample is more than ``max_hole_seconds`` away.
    """
    by_time = Window.partitionBy(*keys).orderBy("_t")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = panel.withColumn("_t", F.unix_micros(ts)).withColumn("_level", level)
    near = (F.col("_t") - F.lag("_t").over(by_time)) <= F.lit(max_hole_seconds * 1_000_000)
    df = df.withColumn("_near", F.coalesce(near, F.lit(False)))

    runs = []
    for i, threshold in enumerate(thresholds):
        inside = F.coalesce(F.col("_level") >= F.lit(threshold), F.lit(False))
        df = df.withColumn(f"_in{i}", inside)
        continues = F.col("_near") & F.coalesce(F.lag(f"_in{i}").over(by_time), F.lit(False))
        df = df.withColumn(f"_new{i}", (F.col(f"_in{i}") & ~continues).cast("int"))
    for i, threshold in enumerate(thresholds):
        df = df.withColumn(f"_run{i}", F.sum(f"_new{i}").over(so_far))
        runs.append(
            F.when(
                F.col(f"_in{i}"),
                F.struct(F.lit(float(threshold)).alias("threshold"), F.col(f"_run{i}").alias("run_id")),
            )
        )
    return df.select(*panel.columns, F.inline(F.array_compact(F.array(*runs))))
