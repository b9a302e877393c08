"""Which entities to follow, which source to trust, what to repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a primary price below this confidence is replaced by the secondary.
LOW_CONFIDENCE = 0.8

ENTITY = ["chain_id", "market_id"]


def tracked_set(allocated: DataFrame, extras: DataFrame, universe: DataFrame, floor_usd: float) -> DataFrame:
    """Markets held by a vault, listed by hand, or at least ``floor_usd`` large.

    ``universe`` has (chain_id, market_id, supply_usd); an unknown supply counts as 0.
    """
    big = universe.where(F.coalesce("supply_usd", F.lit(0.0)) >= F.lit(floor_usd))
    return (
        allocated.select(*ENTITY).unionByName(extras.select(*ENTITY)).unionByName(big.select(*ENTITY)).distinct()
    )


def above_floor(tracked: DataFrame, universe: DataFrame, floor_usd: float) -> DataFrame:
    """Tracked markets at or above the floor; one whose supply was never seen passes.

    Seen but NULL counts as 0, as in :func:`tracked_set`.
    """
    if floor_usd <= 0:
        return tracked
    known = universe.select(*ENTITY, F.coalesce("supply_usd", F.lit(0.0)).alias("_usd"))
    joined = tracked.join(known, ENTITY, "left")
    return joined.where(F.col("_usd").isNull() | (F.col("_usd") >= F.lit(floor_usd))).drop("_usd")


def tracked_tokens(markets: DataFrame) -> DataFrame:
    """Distinct (chain_id, token_address) the tracked markets touch."""
    both = F.explode(F.array("loan_token", "collateral_token")).alias("token_address")
    return markets.select("chain_id", both).where("token_address is not null and token_address <> ''").distinct()


def with_fallback(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """Primary rows where they can be trusted, secondary rows elsewhere.

    A weak or missing primary is replaced when the secondary has the key, and
    kept when it does not.
    """
    strong = F.coalesce(F.col("confidence"), F.lit(0.0)) >= F.lit(LOW_CONFIDENCE)
    trusted = primary.where(strong).select(*keys)
    usable = secondary.join(trusted, keys, "left_anti")
    kept = primary.join(usable.select(*keys), keys, "left_anti")
    return kept.unionByName(usable)


def not_covered(tracked: DataFrame, returned: DataFrame) -> DataFrame:
    """Tracked entities for which no state came back."""
    return tracked.join(returned.select(*ENTITY).distinct(), ENTITY, "left_anti")


def heal_candidates(history: DataFrame, as_of: Column, lookback_hours: int) -> DataFrame:
    """The part of a re-supplied history that a repair may fill from."""
    start = F.floor(F.unix_seconds(as_of)) - F.lit(lookback_hours * 3600)
    return history.where((F.col("ts") >= F.timestamp_seconds(start)) & (F.col("ts") <= as_of))
