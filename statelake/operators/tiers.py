"""Leader spread and tiered benchmark inside a group of peers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_leader_spread(df: DataFrame, name: str, value: str, eligible: Column, group: Sequence[str]) -> DataFrame:
    """``df`` with the value minus the best eligible peer's as ``name``; NULL when no peer is eligible.

    The leaders are an aggregate, combined before the shuffle and joined back: a row a group
    against all rows, so neither a hot group nor few groups put many rows into one task.
    """
    keys = {f"_g{i}": c for i, c in enumerate(group)}
    leaders = df.where(eligible).groupBy(*[F.col(c).alias(k) for k, c in keys.items()]).agg(F.max(value).alias("_leader"))
    same = F.lit(True)
    for k, c in keys.items():
        same = same & F.col(c).eqNullSafe(F.col(k))
    return df.join(leaders, same, "left").select(*df.columns, (F.col(value) - F.col("_leader")).alias(name))


def tier(value: Column, member: Column) -> tuple[Column, Column, Column]:
    """Mean, best and size of a tier, as aggregates."""
    inside = F.when(member, value)
    return F.avg(inside), F.max(inside), F.count(F.when(member, F.lit(1)))
