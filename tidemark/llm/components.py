"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import remove_folder, scratch_folder


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link and is no root; a root is the smallest node of its component.

    ``links`` has two long columns ``a`` and ``b``; directions, repeats, loops and nulls do not matter. The
    alternating star method: each round points every node at its smallest neighbour, first from the larger
    side, then from the smaller. A round is two joins on the node; only two sums come to the driver. Rounds
    are tables in the shared folder, and an earlier one goes when its successor is written.
    """
    spark = links.sparkSession
    links = links.filter(F.col("a") != F.col("b"))
    at, folder = _write(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(most_rounds):
        both = at.union(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large, large_folder = _write(_star(both, F.col("b") > F.col("a")))
        # After the large star every link leads from a node to a smaller one.
        small, small_folder = _write(_star(large, F.lit(True)))
        for old in (folder, large_folder):
            remove_folder(spark, old)
        at, folder = small, small_folder
        now = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == now:
            return at.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _star(links: DataFrame, wanted: Column) -> DataFrame:
    """Link each node, and its wanted neighbours, to the least node around it."""
    least = links.groupBy("a").agg(F.min("b").alias("_m")).select(
        F.col("a").alias("_a"), F.least("a", "_m").alias("_m")
    )
    moved = links.join(least, F.col("a") == F.col("_a")).filter(wanted).select("b", "_m")
    ends = moved.union(least.select("_a", "_m")).toDF("a", "b").filter(F.col("a") != F.col("b"))
    return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _write(frame: DataFrame) -> tuple[DataFrame, str]:
    folder = scratch_folder(frame.sparkSession, "links")
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder), folder
