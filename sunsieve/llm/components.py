"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.sources.shared import landed


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, move to the least of them."""
    down = edges.where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, label): each linked node with the least node of its component.

    `links` has two long columns, a and b; nulls and loops link nothing. Every round is written to
    the shared folder; nothing of the graph comes to the driver but a count and a sum. A hub's
    links are aggregated before they are shuffled and joined in parts, so no task needs them all.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges, seen = landed(edges.distinct(), "links"), None
    for _ in range(rounds):
        edges = landed(_small_star(_large_star(edges)).where("u <> v").distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
