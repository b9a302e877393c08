"""Newest rows per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_rows(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Every row carrying its key's newest ``ts`` (ties kept).

    The rank filter is applied before the shuffle as well (window group limit),
    so each map task sends only its own newest rows per key.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last())
    return df.withColumn("_rank", F.rank().over(newest_first)).where("_rank = 1").drop("_rank")


def latest_value(value: Column | str, ts: Column | str = "ts") -> Column:
    """Aggregate: the newest *known* value (rows with a NULL value do not count)."""
    v = F.col(value) if isinstance(value, str) else value
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.max_by(v, F.when(v.isNotNull(), t))


def latest_per_group(per_snapshot: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """One row per key out of per-(key, ts) aggregates: the newest snapshot's."""
    rest = [c for c in per_snapshot.columns if c not in keys]
    return (
        per_snapshot.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(ts)).alias("_row"))
        .select(*keys, "_row.*")
    )


def instants(tables: Mapping[str, DataFrame], name: str) -> tuple[DataFrame, list[str]] | None:
    """The newest instants of a table, and their days, where it is a stored one that names them."""
    return getattr(tables, "newest", {}).get(name)


def at_newest(df: DataFrame, newest: tuple[DataFrame, list[str]] | None, keys: Sequence[str]) -> DataFrame:
    """Rows of each key's newest instant where a stored table names these instants, otherwise all rows.

    ``newest`` has (entity ..., ts) with ``keys`` among the entity's columns, and the days that
    hold them: other days are not read.
    """
    if newest is None:
        return df
    known, days = newest
    instants = known.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max("ts").alias("_newest"))
    same = F.col("ts") == F.col("_newest")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.where(F.col("date").isin([date.fromisoformat(d) for d in days])).join(instants, same, "left_semi")
