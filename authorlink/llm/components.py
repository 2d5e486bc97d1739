"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authorlink.llm import common


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of every node that has a link to another; the root is the least node reachable.

    Each round ties the greater neighbours of every node to its least one (large
    star), then all lesser neighbours to the least (small star), until nothing
    changes: O(log² n) rounds. Minima are summed up in each task before the
    shuffle, the joins are plain ones that can be split at hot nodes, and each
    round's links are written, so that lost executors cost one round at most.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = common.written(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = common.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
