"""Connected components of a large edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest among the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge; root is the smallest node of its component.

    ``edges`` has long columns u and v. Large-star and small-star steps alternate until every node hangs on its
    root; each round is written to the shared folder, so the lineage stays short and lost executors cost little.
    Edges keep linear in the nodes: each step gives at most as many as it took.
    """
    now = stage(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        now = stage(_small_star(_large_star(now)).distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    # a root is never a u of a finished star
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
