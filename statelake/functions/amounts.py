"""Exact integers to human units.

Every product or quotient is taken on doubles: Spark's decimal division would
otherwise round to six digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double(c: Column | str) -> Column:
    return _col(c).cast("double")


def human(amount: Column | str, decimals: Column | str) -> Column:
    """Base units divided by 10^decimals; NULL when either is unknown."""
    return double(amount) / F.pow(F.lit(10.0), _col(decimals))


def wad(c: Column | str) -> Column:
    """18-digit fixed point to a plain number."""
    return double(c) / F.lit(1e18)


def text_price(raw: Column | str, loan_decimals: Column | str, collateral_decimals: Column | str) -> Column:
    """Oracle price text (may exceed 38 digits) to loan units per collateral unit."""
    exponent = F.lit(36) + _col(loan_decimals) - _col(collateral_decimals)
    return _col(raw).try_cast("double") / F.pow(F.lit(10.0), exponent)


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole on doubles, NULL for an empty whole."""
    return F.lit(100.0) * double(part) / F.nullif(double(whole), F.lit(0.0))
