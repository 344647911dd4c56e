"""Connected components of an edge list, as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges(a, b)``.

    Every round points the larger neighbours of a node at its smallest one, then does the
    same with the smaller neighbours, until the edges are stars. The edges never become
    more than twice as many, chains halve in each round, and every round is written to
    the shared folder, so lost executors cost one round at most. The smallest neighbours
    are written too before edges are joined with them: an edge of a hub then meets one row
    of a stored table, and the hub's partition can be split, which a join with an aggregate
    can't. Nothing but a count and a checksum reaches the driver. Rows with a null end are
    no edges.
    """
    stars = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-edges",
    )
    seen = _mark(stars)
    while seen[0]:
        stars = written(_large(stars, name), f"{name}-large")
        stars = written(_small(stars, name), f"{name}-stars")
        now = _mark(stars)
        if now == seen:
            break
        seen = now
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.hash("u", "v"), F.lit(1 << 20)))).first()
    return tuple(row)


def _large(edges: DataFrame, name: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{name}-least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame, name: str) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()
