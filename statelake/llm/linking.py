"""From candidate lists to components without all pairs of a list.

A list gathers entries that share one feature (a prefix token, a band). First every
entry is verified against a few hubs of its largest list, in two rounds, which is linear
in the list and joins a large family of near copies; in the second round a component
stands for all its members, as far as a few rounds have found it. Then exactly the pairs of a list that are still in
different components are verified, so no link between components is missed; pairs
inside a component can't change the result and are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected, partly_connected, prepare

HUBS = 4


def _chosen(entries: DataFrame, keys: list[str], seed: int, count: int) -> DataFrame:
    """For each entry, the hubs of its largest list: its lightest entry and some by hash."""
    orders = [F.col("weight").cast("long") if seed + s == 0 else F.xxhash64("gid", F.lit(seed + s)) for s in range(count)]
    hubs = entries.groupBy("feature").agg(
        F.count("*").alias("entries"), F.array(*[F.min(F.struct(o.alias("o"), *keys)) for o in orders]).alias("hubs"))
    best = F.max(F.struct("entries", F.transform("hubs", lambda h: F.struct(*[h[k].alias(k) for k in keys])).alias("hubs")))
    found = entries.join(hubs, "feature").groupBy(*keys).agg(best.alias("best")).select(*keys, F.explode("best.hubs").alias("hub"))
    return found.select(*keys, *[F.col("hub")[k].alias(f"hub_{k}") for k in keys])


def families(lists: DataFrame, members: DataFrame, may_link: Callable, verified: Callable[[DataFrame], DataFrame],
             traits: DataFrame | None = None, hubs: int = HUBS) -> DataFrame:
    """(node, component) of all nodes with a link.

    ``lists``    feature, gid, weight, and the columns ``may_link`` reads; one row for each feature of a group
    ``members``  gid, node; a group's members share all its lists
    ``may_link`` Column over the aliases ``x`` and ``y`` of two list rows; false only where no member can link
    ``verified`` keeps those (a, b) pairs that link
    ``traits``   gid and more columns that ``may_link`` reads
    ``hubs``     hubs of a list in each of the two rounds
    """
    prepare(lists.sparkSession)
    faces = members.groupBy("gid").agg(F.min("node").alias("face"))
    stars = (
        members.join(_chosen(lists, ["gid"], 0, hubs), "gid").join(faces.select(F.col("gid").alias("hub_gid"), "face"), "hub_gid")
        .where("node != face").select(F.least("face", "node").alias("a"), F.greatest("face", "node").alias("b")).distinct()
    )
    links = verified(stars).select("a", "b").checkpoint()

    def placed_by(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members with their component, and the lists that hold more than one, by group and component."""
        labels = partly_connected(links).withColumnRenamed("component", "label")
        placed = members.join(labels, "node", "left").select("gid", "node", F.coalesce("label", "node").alias("label")).checkpoint()
        entries = lists.join(placed.select("gid", "label").distinct(), "gid")
        mixed = entries.groupBy("feature").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("feature")
        return placed, entries.join(mixed, "feature")

    placed, entries = placed_by(links)
    faces = placed.groupBy("gid", "label").agg(F.min("node").alias("face"))
    again = (
        _chosen(entries, ["gid", "label"], hubs, hubs).where("label != hub_label")
        .join(faces.withColumnRenamed("face", "a"), ["gid", "label"])
        .join(faces.select(F.col("gid").alias("hub_gid"), F.col("label").alias("hub_label"), F.col("face").alias("b")), ["hub_gid", "hub_label"])
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    links = links.union(verified(again).select("a", "b")).checkpoint()

    placed, entries = placed_by(links)
    if traits is not None:
        entries = entries.join(traits, "gid")
    pairs = (
        entries.alias("x").join(entries.alias("y"), (F.col("x.feature") == F.col("y.feature")) & (F.col("x.label") < F.col("y.label")) & may_link("x", "y"))
        .select(F.col("x.gid").alias("gx"), F.col("x.label").alias("lx"), F.col("y.gid").alias("gy"), F.col("y.label").alias("ly")).distinct()
    )
    left = placed.select(F.col("gid").alias("gx"), F.col("label").alias("lx"), F.col("node").alias("a"))
    right = placed.select(F.col("gid").alias("gy"), F.col("label").alias("ly"), F.col("node").alias("b"))
    rest = verified(pairs.join(left, ["gx", "lx"]).join(right, ["gy", "ly"]).select("a", "b")).select("a", "b")
    return connected(links.union(rest))
