"""Episodes: contiguous runs above a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.functions import double, micros, whole_minutes
from statelake.operators import threshold_runs

from .market_views import MARKET, Tables, v_oracle_price_check

# Thresholds and the longest hole inside an episode, in seconds.
UTILIZATION_THRESHOLDS = [0.92, 0.95]
DEVIATION_THRESHOLDS = [0.02, 0.05]
MAX_HOLE_SECONDS = 7200


def _episodes(runs: DataFrame, keys: list[str], *aggs) -> DataFrame:
    return (
        runs.groupBy(*keys, "threshold", "run_id")
        .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), *aggs)
        .withColumn("duration_min", whole_minutes("start_ts", "end_ts"))
        .drop("run_id")
    )


def utilization_spells(
    state: DataFrame, thresholds=UTILIZATION_THRESHOLDS, max_hole_seconds: int = MAX_HOLE_SECONDS
) -> DataFrame:
    panel = state.select(
        "ts", *MARKET, F.col("utilization").alias("u"),
        double(F.col("total_supply_assets") - F.col("total_borrow_assets")).alias("_free"),
    )
    runs = threshold_runs(panel, MARKET, F.col("u"), thresholds, max_hole_seconds)
    spells = _episodes(runs, MARKET, F.max("u").alias("peak_u"), F.min("_free").alias("min_available_liquidity"))
    return spells.select(
        *MARKET, "threshold", "start_ts", "end_ts", "duration_min", "peak_u", "min_available_liquidity"
    )


def v_util_spells(t: Tables) -> DataFrame:
    """Spells of utilization at or above 0.92 and 0.95."""
    return utilization_spells(t["market_state"])


def deviation_spells(
    check: DataFrame, thresholds=DEVIATION_THRESHOLDS, max_hole_seconds: int = MAX_HOLE_SECONDS
) -> DataFrame:
    panel = check.where("deviation is not null").select("ts", *MARKET, "deviation")
    runs = threshold_runs(panel, MARKET, F.abs("deviation"), thresholds, max_hole_seconds)
    size = F.abs("deviation")
    # Of two equally large deviations the earlier one is reported.
    signed = F.max_by("deviation", F.struct(size, -micros("ts")))
    spells = _episodes(runs, MARKET, F.max(size).alias("peak_abs_deviation"), signed.alias("peak_deviation"))
    return spells.select(
        *MARKET, "threshold", "start_ts", "end_ts", "duration_min", "peak_abs_deviation", "peak_deviation"
    )


def v_depeg_spells(t: Tables) -> DataFrame:
    """Spells of oracle deviation of at least 2 % and 5 %."""
    return deviation_spells(v_oracle_price_check(t))
