"""Interest-rate curve and compounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .amounts import wad

# Seconds per year, utilization knee, slope factor above and below it.
SECONDS_PER_YEAR = 31_536_000
KNEE = 0.9
STEEPNESS = 4.0


def apy_at_target(rate_wad: Column | str) -> Column:
    """Continuous compounding of a per-second 18-digit fixed-point rate."""
    return F.exp(wad(rate_wad) * F.lit(SECONDS_PER_YEAR)) - F.lit(1.0)


def borrow_rate(u: Column, target: Column) -> Column:
    """Kinked curve: target/4 when idle, target at the knee, 4x target when full."""
    floor_rate, cap_rate = target / STEEPNESS, target * STEEPNESS
    above = target + (cap_rate - target) * (u - KNEE) / (1.0 - KNEE)
    below = floor_rate + (target - floor_rate) * u / KNEE
    return (
        F.when(u >= 1.0, cap_rate)
        .when(u >= KNEE, above)
        .when(u > 0.0, below)
        .otherwise(floor_rate)
    )


def compound_three_terms(rate_per_second: Column) -> Column:
    """x + x^2/2 + x^3/6 for one year's simple rate x."""
    x = rate_per_second * F.lit(SECONDS_PER_YEAR)
    return x + x * x / 2.0 + x * x * x / 6.0
