"""Which time buckets of an entity hold a sample, as bitmaps that can be merged.

A bitmap covers SPAN buckets of a fixed grid (3.7 years of hours), one bit each. Coverage is one
aggregate of the samples; coverages of batches merge by OR, so a table's is kept up
with every merge and holes are found without reading its samples again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: bits of one of Spark's bitmaps.
SPAN = 32_768


def coverage(df: DataFrame, entity: Sequence[str], bucket_seconds: int) -> DataFrame:
    """(entity, span, bits, first_ts, last_ts): a row for each entity and span of buckets."""
    bucket = F.floor(F.unix_seconds("ts") / F.lit(bucket_seconds))
    rows = df.where("ts IS NOT NULL").select(*entity, "ts", F.floor(bucket / SPAN).alias("span"), F.pmod(bucket, F.lit(SPAN)).alias("_bit"))
    return rows.groupBy(*entity, "span").agg(
        F.bitmap_construct_agg("_bit").alias("bits"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def merged(one: DataFrame, other: DataFrame, entity: Sequence[str]) -> DataFrame:
    """The coverage of both."""
    return one.unionByName(other).groupBy(*entity, "span").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def gaps(cover: DataFrame, entity: Sequence[str], bucket_seconds: int) -> DataFrame:
    """(entity, first_ts, last_ts, expected, actual) of entities with fewer buckets than their first and last sample span."""
    bucket = lambda c: F.floor(F.unix_seconds(c) / F.lit(bucket_seconds))
    found = cover.groupBy(*entity).agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum(F.bitmap_count("bits")).alias("actual"))
    return found.withColumn("expected", bucket("last_ts") - bucket("first_ts") + 1).where("expected > actual").select(
        *entity, "first_ts", "last_ts", "expected", "actual")


def holes(cover: DataFrame, entity: Sequence[str], bucket_seconds: int) -> DataFrame:
    """(entity, ts) of every bucket without a sample between an entity's first and last: the zero bits.

    Bytes of eight samples are passed over before any bit is looked at.
    """
    ends = cover.groupBy(*[F.col(c).alias(f"_e_{c}") for c in entity]).agg(
        *[F.floor(F.unix_seconds(f(c)) / F.lit(bucket_seconds)).alias(n) for f, c, n in ((F.min, "first_ts", "_low"), (F.max, "last_ts", "_high"))],
        F.min("span").alias("_from"), F.max("span").alias("_to"))
    same = F.lit(True)
    for c in entity:
        same = same & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    # A span without any sample has no row of its own.
    spans = ends.withColumn("span", F.explode(F.sequence("_from", "_to")))
    bits = cover.select(*entity, F.col("span").alias("_s"), F.hex("bits").alias("_hex"))
    rows = spans.join(bits, same & (F.col("span") == F.col("_s")), "left")
    places = F.sequence(F.lit(0), F.lit(SPAN // 8 - 1))
    text = F.coalesce("_hex", F.lit("00" * (SPAN // 8)))
    low_byte, high_byte = (F.col(c) - F.col("span") * SPAN for c in ("_low", "_high"))
    wanted = F.filter(places, lambda i: (i >= F.floor(low_byte / 8)) & (i <= F.floor(high_byte / 8)) & (F.substr(text, i * 2 + 1, F.lit(2)) != "FF"))
    byte = rows.select(*[F.col(f"_e_{c}").alias(c) for c in entity], F.col("span").alias("_span"), "_low", "_high", text.alias("_bytes"), F.explode(wanted).alias("_byte"))
    value = F.conv(F.substr("_bytes", F.col("_byte") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    bit = byte.select(*entity, "_span", "_low", "_high", "_byte", value.alias("_value"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit"))
    bucket = F.col("_span") * SPAN + F.col("_byte") * 8 + F.col("_bit")
    empty = F.getbit(F.col("_value"), F.col("_bit")) == 0
    return bit.where(empty & (bucket > F.col("_low")) & (bucket < F.col("_high"))).select(*entity, F.timestamp_seconds(bucket * bucket_seconds).alias("ts"))
