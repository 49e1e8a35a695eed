"""Connected components of a graph in a DataFrame.

Alternating large and small stars: each round every node's neighbours are
re-tied to the smallest node it knows, by an aggregation and a join. Nothing
but two numbers a round reaches the driver, and no neighbourhood is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v), root being the smallest
    node of its component. Nodes may be of any type that Spark can order."""
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    before, now = None, _state(edges)
    while before != now and now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = stored(large, "edges")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(down.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        edges = stored(small, "edges")
        before, now = now, _state(edges)
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
