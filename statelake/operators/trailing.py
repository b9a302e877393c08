"""Conditional aggregates over windows that end at an anchor instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, ts: str = "ts") -> Column:
    """The table's newest instant as a scalar subquery (one value, no join).

    On a day-partitioned table only the newest day is read.
    """
    if "date" in df.columns:
        df = df.where(F.col("date") == df.select(F.max("date")).scalar())
    return df.select(F.max(ts)).scalar()


def since(df: DataFrame, start: Column, ts: str = "ts") -> DataFrame:
    """Rows from ``start`` on; a day-partitioned table skips earlier days."""
    recent = df.where(F.col(ts) >= start)
    return recent.where(F.col("date") >= F.to_date(start)) if "date" in df.columns else recent


def ago(anchor: Column, **span: int) -> Column:
    """``anchor`` minus days/hours."""
    return anchor - F.make_dt_interval(F.lit(span.get("days", 0)), F.lit(span.get("hours", 0)))


def sum_where(value: Column, condition: Column) -> Column:
    """Conditional sum, 0 when nothing qualifies."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def avg_where(value: Column, condition: Column) -> Column:
    """Conditional mean, NULL when nothing qualifies."""
    return F.avg(F.when(condition, value))


def indicator(condition: Column) -> Column:
    """1.0 when the condition holds, 0.0 when it does not or is unknown."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))
