"""Connected components of an edge table, by alternating large-star and small-star rounds.

Rounds need only grouped minima and joins, so no component is ever held by a task.
Edges are first reduced inside each task by union-find, which turns whatever a
task holds into a forest; a component spread over all tasks takes a few rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.session import shared_dir


def local_forest(edges: DataFrame) -> DataFrame:
    """Union-find inside each task: (child, smallest node reachable there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        for at in range(0, len(nodes), 100_000):
            part = [x for x in nodes[at:at + 100_000] if find(x) != x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def connected(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    ``edges`` has columns a, b (long). Loops and repeated edges are allowed, nulls are dropped.
    """
    edges = _forest(edges)
    before = _sum_of(edges)
    for _ in range(most_rounds):
        edges = _stars(edges)
        after = _sum_of(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def partly_connected(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """(node, component) after so many rounds: nodes of one component are connected, but not all that are connected need have one."""
    edges = _forest(edges)
    for _ in range(rounds):
        edges = _stars(edges)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b"))
    return nodes.groupBy("node").agg(F.min("component").alias("component"))


def _forest(edges: DataFrame) -> DataFrame:
    prepare(edges.sparkSession)
    return local_forest(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")).distinct().checkpoint()


def _stars(edges: DataFrame) -> DataFrame:
    """One round over edges (larger node, smaller node)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    # Large star: every larger neighbour hangs onto the smallest one.
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    # Small star: the smaller neighbours, and the node itself, hang onto the smallest.
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    return (
        large.join(small, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        .where("a != b").distinct().checkpoint()
    )


def _sum_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def prepare(spark: SparkSession) -> None:
    """Checkpoints go to the folder the cluster names; a private one is made only in tests."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
