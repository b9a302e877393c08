"""Log returns and rolling annualised volatility on an hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from .dwell import HOUR_US

# Fixed value: hours per year.
HOURS_PER_YEAR = 8760
# Values are counted in units of 10 ** -12, exactly: sums of 38 digits hold a billion squares of values up to 50.
UNITS = 10**12


def log_return(price: str, keys: Sequence[str], ts: str = "ts") -> Column:
    previous = F.lag(price).over(Window.partitionBy(*keys).orderBy(ts))
    return F.ln(F.col(price) / previous)


def _moments(value: str, frame: WindowSpec) -> Column:
    """Number, sum and sum of squares of the values of a frame, as exact integers."""
    x = F.col(value)
    zero = F.lit(0).cast("decimal(38,0)")
    return F.struct(
        F.count(x).over(frame).cast("decimal(38,0)").alias("n"),
        F.coalesce(F.sum(x).over(frame).cast("decimal(38,0)"), zero).alias("s"),
        F.coalesce(F.sum((x * x).cast("decimal(38,0)")).over(frame), zero).alias("q"),
    )


def rolling_volatility(df: DataFrame, value: str, keys: Sequence[str], days: dict[str, int], ts: str = "ts") -> DataFrame:
    """Sample deviation over trailing calendar days (holes do not stretch the
    look-back), annualised. ``days`` maps an output name to a window length.

    A window's moments are those of all rows so far less those of the rows before it. Both
    are running sums, each row enters them once, so the cost does not depend on the window's
    length; they are exact integers, so the difference loses nothing.
    """
    by_time = Window.partitionBy(*keys).orderBy("_t")
    scaled = F.round(F.col(value) * UNITS).cast("decimal(18,0)")
    out = df.withColumn("_t", F.unix_micros(ts)).withColumn("_x", scaled)
    out = out.withColumn("_all", _moments("_x", by_time.rangeBetween(Window.unboundedPreceding, 0)))
    for name, n in days.items():
        out = out.withColumn("_old", _moments("_x", by_time.rangeBetween(Window.unboundedPreceding, -24 * n * HOUR_US - 1)))
        count, total, squares = (F.col("_all")[m] - F.col("_old")[m] for m in "nsq")
        spread = (count * squares).cast("decimal(38,0)") - (total * total).cast("decimal(38,0)")
        count = count.cast("double")
        variance = spread.cast("double") / (count * (count - 1.0)) / float(UNITS) ** 2
        out = out.withColumn(name, F.when(count > 1, F.sqrt(variance) * F.sqrt(F.lit(float(HOURS_PER_YEAR)))))
    return out.drop("_t", "_x", "_all", "_old")
