"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    ).select("col.a", "col.b")


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: `node`, `root`. `edges`: `a`, `b` (long).

    Large-star and small-star steps in turn, until no edge changes. A step needs each
    node's smallest neighbour, which tasks pre-aggregate, and joins it to the node's edges,
    which a node with very many edges doesn't keep in one task. Every round is written to
    the shared folder; the driver sees a count and a sum of hashes.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    current = written(edges.distinct(), "edges")
    state = None
    while True:
        found = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state or not found[0]:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = tuple(found)
        # Large star: each node's larger neighbours go to its smallest one (or itself).
        ways = _both_ways(current)
        least = ways.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            ways.where(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("m").alias("a"), "b")
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        # Small star: each node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(least, "b")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                        F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                    )
                )
            )
            .select("col.a", "col.b")
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        current = written(small, "edges")
