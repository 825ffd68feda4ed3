"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm.store import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for the nodes of undirected edges; a component is its smallest node.

    Alternating large and small stars: every node's larger neighbours are hung below
    its smallest one, then its smaller neighbours, until each component is one star.
    Both steps are a partial minimum and a join per node, so a node with very many
    edges is never gathered in one place. The edge table is written to the shared
    folder after each round; two sums tell on the driver whether it still changes.
    """
    pairs = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u is not null and v is not null and u <> v").distinct(),
        "edges",
    )
    before = None
    while True:
        seen = pairs.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == before:
            break
        before = tuple(seen)
        pairs = materialize(_small_star(_large_star(pairs)), "edges")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest of its neighbours and itself."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours, and itself, to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()
