"""Connected components of a link table, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the node's smallest neighbour."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(lowest, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Point a node's smaller neighbours, and itself, at the smallest of them."""
    lowest = links.groupBy("a").agg(F.min("b").alias("m"))
    others = (links.join(lowest, "a").where("b <> m")
              .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return others.union(lowest.toDF("a", "b")).distinct()


def _signature(links: DataFrame) -> tuple:
    """Number of links and the sum of their hashes: equal only when nothing changed."""
    return tuple(links.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node it reaches.

    ``links`` has two bigint columns. Each round replaces links by links to a smaller
    node, in two joins on one node; it ends when a round changes nothing, after about
    the square of the logarithm of the longest chain. Rounds are written to the shared
    work folder, so no lineage grows and the driver sees two numbers per round. A node
    with very many links is a skewed join key that adaptive execution splits.

    Self links, repeated links and nulls are dropped. A root is its own node in the
    result. No links: no rows.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = stored(links.where("a > b").distinct(), "links")
    before = _signature(links)
    while before[0]:
        links = stored(_small_star(_large_star(links)), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    nodes = links.toDF("node", "root")
    roots = nodes.select("root").distinct().select(F.col("root").alias("node"), "root")
    return nodes.union(roots)
