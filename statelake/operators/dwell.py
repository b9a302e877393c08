"""Two-threshold hysteresis and dwell tests on clock-sampled panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

HOUR_US = 3_600_000_000


def trailing_hours(keys: Sequence[str], hours: float, order: str = "_t") -> WindowSpec:
    """Rows of the entity in the closed trailing interval; ``order`` is in microseconds."""
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(-int(hours * HOUR_US), 0)


def none_within(happened: Column, keys: Sequence[str], hours: float, order: str = "_t") -> Column:
    """True when ``happened`` was true on no row of the closed trailing interval.

    Only the newest time it happened matters, which is a running maximum: the work is
    linear in the rows however long the interval. Unknown counts as not happened.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    newest = F.max(F.when(happened, F.col(order))).over(so_far)
    return F.coalesce(newest < F.col(order) - F.lit(int(hours * HOUR_US)), F.lit(True))


def seen_within(present: Column, keys: Sequence[str], hours: float, min_age_hours: float = 0, order: str = "_t") -> Column:
    """True when some row with ``present`` is at most ``hours`` and at least ``min_age_hours`` old."""
    old_enough = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -int(min_age_hours * HOUR_US))
    newest = F.max(F.when(present, F.col(order))).over(old_enough)
    return F.coalesce(newest >= F.col(order) - F.lit(int(hours * HOUR_US)), F.lit(False))


def throughout(condition: Column, keys: Sequence[str], hours: float, min_span_hours: float, order: str = "_t") -> Column:
    """True when ``condition`` held on every row of the last ``hours`` and these span long enough.

    An unknown condition counts as not holding; the span guards against data holes.
    """
    held = none_within(~F.coalesce(condition, F.lit(False)), keys, hours, order)
    return held & seen_within(F.lit(True), keys, hours, min_span_hours, order)


def latch(event: Column, keys: Sequence[str], order: str = "_t") -> Column:
    """State set by the last non-NULL event: 1 enters, 0 leaves; starts outside."""
    history = (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.coalesce(F.last(event, ignorenulls=True).over(history), F.lit(0)) == 1
