"""Keyed de-duplication with a defined winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Column, last: bool = True) -> DataFrame:
    """One row per key: the greatest (or smallest) by ``order``.

    An aggregate, so copies of a hot key collapse on the map side first.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    pick = F.max_by if last else F.min_by
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), order).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )
