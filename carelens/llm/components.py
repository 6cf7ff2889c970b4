"""Connected components of a table of links, as shuffles over narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import stored

#: Rounds after which something must be wrong: they grow with the logarithm of the
#: longest chain.
MOST_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in a link; the component is its least node.

    Large-star and small-star rounds: each node's greater neighbours are linked to
    the least node it knows, then its other lesser neighbours are, until no link
    changes. A round sends each link a few times, whatever a node's degree: the
    least neighbour is an aggregate with a map-side part, and links are joined to
    it, so Spark splits a node of very many links. Every round is written to the
    shared folder, which keeps plans short and survives lost executors."""
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both["u"] == least["w"]).where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        lesser = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(lesser, large["u"] == lesser["w"])
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(
            lesser.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()
        edges = stored(small, "links")
        # a star forest stays as it is; equal counts and sums of hashes tell
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
