"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Each round is two joins with a partial minimum before the shuffle, written
    to the shared folder; a node with very many edges is split by the skew join.
    """
    e = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: the larger neighbours of a node go to its smallest neighbour (or itself)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        e = written(small.where("u <> v").distinct(), "small-star")
        # done when every node hangs on one root: larger ends meet one edge and are nobody's smaller end
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("leaf")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("leaf")))
        ends = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.count(F.lit(1)).alias("n"))
        if ends.where("leaf > 1 OR (leaf = 1 AND n > 1)").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
