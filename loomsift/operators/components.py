"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.session import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 40) -> DataFrame:
    """``node``, ``component`` (its smallest node) for each node of the undirected edges; ids are bigint.

    Loops and repeated or null ends are allowed; an empty graph gives no rows. Each round is two
    joins by node. A hub with very many neighbours is never gathered: its neighbours only meet
    its minimum. Lineage is cut by a checkpoint each round; ``most`` rounds without an end are an
    error (they suffice for paths of some 2**40 nodes).
    """
    links = checkpointed(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    for _ in range(most):
        if _are_stars(links):
            break
        # large star: each node links its larger neighbours to the smallest of all its neighbours and itself
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node links its smaller neighbours and itself to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        links = checkpointed(small)
    else:
        raise RuntimeError(f"no end after {most} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether each node has one link to a smaller one, which has none itself: then all is done."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(links.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR (out = 1 AND into = 1)").isEmpty()
