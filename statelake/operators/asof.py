"""As-of left join: for every left row the newest right row at or before it.

Plan. Both sides are tagged and unioned, and a running "last right row seen"
answers every left row, so no left/right pairs are formed. The ordered scan is
cut into groups small enough for one task:

* time is cut into chunks; each (key, chunk) with left rows starts from an *opening*
  row that carries the newest right value of any earlier chunk. Openings are found on
  the groups alone, one row per (key, chunk) of either side, so there are never more of
  them than groups of the left side;
* a (key, chunk) with left rows that holds more than ``max_rows`` rows of both sides is split
  in time: its rows are counted per bin of a fine grid, and bins are joined, in order, to parts
  of about ``max_rows`` rows. Every part has an opening of its own, taken from the bins before
  it, so no row of either side is repeated. Without such groups the adaptive planner
  drops the count;
* only where a single bin has more than ``max_rows`` left rows (copies of one instant, say)
  its part's left rows are dealt by a hash of their content, and the part's right rows and
  opening are repeated for each share.

The right side is a clock-sampled series (one row per key and instant), which bounds the
right rows of a bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DAY = 86_400
MAX_ROWS = 4_000_000
# Bins of a chunk that is split.
BINS = 256


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[Column | str, Column | str]],
    take: dict[str, str],
    left_ts: str = "ts",
    right_ts: str = "ts",
    tie_break: Sequence[str] = (),
    chunk_seconds: int = DAY,
    max_rows: int | None = MAX_ROWS,
    identity: Sequence[str] = (),
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Left columns plus ``take`` (right column -> output name).

    ``keys`` pairs a left expression with a right expression. A left row with a
    NULL key part, or older than every right row, gets NULLs. Among right rows
    of one instant the greatest ``tie_break`` columns win. ``max_rows=None``
    leaves groups whole, for left sides that are known to be small. ``identity`` names
    the left columns that tell rows apart; hashing these instead of whole rows
    leaves the others free to be pruned. ``sizes_from`` gives the same rows from a cheaper
    plan (before a previous lookup, say); group sizes are counted there.
    """
    width = chunk_seconds * 1_000_000
    names = [f"_asof_k{i}" for i in range(len(keys))]
    group = [*names, "_asof_chunk"]
    chunk_of = F.floor(F.col("_asof_t") / F.lit(width))

    def as_col(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    samples = (
        right.select(
            *[as_col(rc).alias(n) for n, (_, rc) in zip(names, keys)],
            F.unix_micros(right_ts).alias("_asof_t"),
            # Source names: several lookups into one table then share its exchanges.
            F.struct(*take).alias("_asof_v"),
            F.struct(F.lit(0).alias("_asof_tie"), *[F.col(c) for c in tie_break]).alias("_asof_rank"),
        )
        .dropna(subset=[*names, "_asof_t"])
        .withColumn("_asof_chunk", chunk_of)
    )
    def keyed(df: DataFrame) -> DataFrame:
        return df.select(
            "*", *[as_col(lc).alias(n) for n, (lc, _) in zip(names, keys)], F.unix_micros(left_ts).alias("_asof_t"),
        ).withColumn("_asof_chunk", chunk_of)

    rows = keyed(left).withColumn("_asof_left", F.lit(1))
    counted = keyed(left if sizes_from is None else sizes_from)
    sizes = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_asof_n"))
    newest = F.max_by("_asof_v", F.struct("_asof_t", "_asof_rank")).alias("_asof_v")
    last_of = samples.groupBy(*group).agg(newest, F.count(F.lit(1)).alias("_asof_m"))
    earlier = Window.partitionBy(*names).orderBy("_asof_chunk").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        sizes.unionByName(last_of, allowMissingColumns=True)
        .groupBy(*group).agg(F.max("_asof_n").alias("_asof_n"), F.max("_asof_m").alias("_asof_m"), F.first("_asof_v", ignorenulls=True).alias("_asof_v"))
        .withColumn("_asof_v", F.last("_asof_v", ignorenulls=True).over(earlier))
        .where("_asof_n is not null")
    )
    openings = groups.select(*group, "_asof_v", (F.col("_asof_chunk") * F.lit(width) - 1).alias("_asof_t"), F.lit(True).alias("_asof_opens"))
    tagged = rows.unionByName(samples, allowMissingColumns=True).unionByName(openings, allowMissingColumns=True)
    if max_rows is not None:
        large = groups.where(F.col("_asof_n") + F.coalesce("_asof_m", F.lit(0)) > max_rows)
        cuts = part_cuts(counted, samples, large, group, width, max_rows)
        tagged = _placed(_joined(tagged, _few(cuts, max_rows), group), tagged.columns, list(identity) or left.columns, width)
        group = [*group, "_asof_part", "_asof_share"]

    scan = (
        Window.partitionBy(*group)
        .orderBy("_asof_t", F.col("_asof_left").asc_nulls_first(), F.col("_asof_rank").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        tagged.withColumn("_asof_hit", F.last("_asof_v", ignorenulls=True).over(scan))
        .where(F.col("_asof_left") == 1)
        .select(*left.columns, *[F.col("_asof_hit")[src].alias(out) for src, out in take.items()])
    )


def bin_of(width: int) -> Column:
    """The bin of a row in its chunk; a later row is never in an earlier bin."""
    return F.floor((F.col("_asof_t") - F.col("_asof_chunk") * F.lit(width)) * F.lit(BINS) / F.lit(width)).cast("int")


def split_bins(left: DataFrame, right: DataFrame, large: DataFrame, group: list[str], width: int, max_rows: int) -> DataFrame:
    """Bins of the ``large`` groups: the part a bin belongs to and whether it is the part's first, into how many
    shares the part's left rows are dealt, the bin's first instant, and the newest right value before it."""
    rows = left.select(*group, "_asof_t", F.lit(1).alias("_asof_left")).unionByName(right.select(*group, "_asof_t", "_asof_v", "_asof_rank"), allowMissingColumns=True)
    rows = _joined(rows, _few(large.select(*group, F.col("_asof_v").alias("_opening")), max_rows), group, "inner").withColumn("_asof_bin", bin_of(width))
    bins = rows.groupBy(*group, "_asof_bin").agg(
        F.count(F.lit(1)).alias("_n"), F.count("_asof_left").alias("_n_left"), F.min("_asof_t").alias("_asof_first"), F.first("_opening").alias("_opening"),
        F.max_by("_asof_v", F.when(F.col("_asof_left").isNull(), F.struct("_asof_t", "_asof_rank"))).alias("_last"))
    # At most BINS rows a group.
    by_bin = Window.partitionBy(*group).orderBy("_asof_bin")
    earlier, parts = by_bin.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*group, "_asof_part")
    return (
        bins.withColumn("_asof_v", F.coalesce(F.last("_last", ignorenulls=True).over(earlier), "_opening"))
        .withColumn("_asof_part", F.floor(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) / F.lit(max_rows)).cast("int"))
        .withColumn("_asof_is_first", ~F.col("_asof_part").eqNullSafe(F.lag("_asof_part").over(by_bin)))
        .withColumn("_asof_shares", F.greatest(F.lit(1), F.max(F.ceil(F.col("_n_left") / F.lit(max_rows)).cast("int")).over(parts)))
    )


def part_cuts(left: DataFrame, right: DataFrame, large: DataFrame, group: list[str], width: int, max_rows: int) -> DataFrame:
    """(group, _asof_cuts): the first bin of each part of a large group, in order, with the part's opening."""
    cut = F.struct(
        F.col("_asof_bin").alias("bin"), F.col("_asof_part").alias("part"), F.col("_asof_shares").alias("shares"), (F.col("_asof_first") - 1).alias("t"),
        F.col("_asof_v").alias("v"))
    firsts = split_bins(left, right, large, group, width, max_rows).where("_asof_is_first")
    # Ordered by bin alone: values need not be comparable.
    in_order = lambda a, b: F.when(a["bin"] < b["bin"], -1).when(a["bin"] > b["bin"], 1).otherwise(0)
    return firsts.groupBy(*group).agg(F.array_sort(F.collect_list(cut), in_order).alias("_asof_cuts"))


def _placed(tagged: DataFrame, columns: list[str], content: list[str], width: int) -> DataFrame:
    """Rows of large groups in their parts and shares, the opening of such a group in all of them; others in part 0."""
    place = lambda part, share, t, v: F.struct(part.alias("_asof_part"), share.alias("_asof_share"), t.alias("_asof_t"), v.alias("_asof_v"))
    cuts, t, v = F.col("_asof_cuts"), F.col("_asof_t"), F.col("_asof_v")
    # A row is in the last part that begins at or before its bin.
    own = F.element_at(F.filter(cuts, lambda c: c["bin"] <= bin_of(width)), -1)
    shares = lambda c: F.sequence(F.lit(0), c["shares"] - 1)
    everywhere = F.flatten(F.transform(cuts, lambda c: F.transform(shares(c), lambda s: place(c["part"], s, c["t"], F.coalesce(c["v"], v)))))
    places = (
        F.when(cuts.isNull(), F.array(place(F.lit(0), F.lit(0), t, v)))
        .when(F.col("_asof_left") == 1, F.array(place(own["part"], F.pmod(F.xxhash64(*content), own["shares"]).cast("int"), t, v)))
        .when(F.col("_asof_opens"), everywhere)
        .otherwise(F.transform(shares(own), lambda s: place(own["part"], s, t, v)))
    )
    return tagged.select(*[c for c in columns if c not in ("_asof_t", "_asof_v")], F.inline(places))


def _few(df: DataFrame, max_rows: int) -> DataFrame:
    """What has a row, or a cut, for each ``max_rows`` rows of input at most: of 10 ** 12 rows and a limit of four
    million, 250,000 groups and twice as many cuts. It is broadcast, so that the rows themselves stay where they
    are; only a limit of under a million rows, as in tests, leaves the choice to the planner."""
    return F.broadcast(df) if max_rows >= 1_000_000 else df


def _same(keys: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def _joined(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal (or both NULL) keys."""
    probe = other.select(*[F.col(c).alias(f"_j{c}") if c in keys else F.col(c) for c in other.columns])
    return df.join(probe, _same(keys, "_j"), how).drop(*[f"_j{c}" for c in keys])
