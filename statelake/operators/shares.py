"""Share of a group, change of share, top-k share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statelake.functions import double, share_pct


def share_within(df: DataFrame, group: Sequence[str], amount: str, out: str) -> DataFrame:
    """Percentage of the group's total. Groups are small by construction
    (the markets of one vault at one instant)."""
    whole = F.sum(amount).over(Window.partitionBy(*group))
    return df.withColumn(out, share_pct(amount, whole))


def with_previous(df: DataFrame, keys: Sequence[str], columns: dict[str, str], ts: str = "ts") -> DataFrame:
    """Adds the value each column had at the series' previous row (column -> output name)."""
    series = Window.partitionBy(*keys).orderBy(ts)
    return df.withColumns({out: F.lag(c).over(series) for c, out in columns.items()})


def top_k_sum(df: DataFrame, group: Sequence[str], amount: str, k: int, out: str) -> DataFrame:
    """Sum of the group's k largest amounts, NULL amounts ignored.

    The rank filter runs before the shuffle too, so a hot group sends at most k
    rows per map task.
    """
    largest = Window.partitionBy(*group).orderBy(F.col("_amount").desc())
    return (
        df.select(*group, double(amount).alias("_amount"))
        .where(F.col("_amount").isNotNull())
        .withColumn("_place", F.row_number().over(largest))
        .where(F.col("_place") <= k)
        .groupBy(*group)
        .agg(F.sum("_amount").alias(out))
    )
