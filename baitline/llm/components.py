"""Connected components of a link table by alternating large-star and small-star steps, in joins and aggregates only.

Every step hooks nodes to the smallest node they can see; the rounds needed grow with the logarithm of the longest
path. Minima are pre-aggregated before they are shuffled, and the joins read their exchanges directly, so Spark can split
a node with very many links; each round's
links are written to the shared folder, so neither lineage nor a lost executor matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.llm.common import checkpointed, joined_anew


def _state(edges: DataFrame) -> tuple:
    """Equal for equal link tables."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links(a, b): component is the smallest node reachable. Loops are ignored."""
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = joined_anew(both, least, "a", "n").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = joined_anew(large, least, "a", "n").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = checkpointed(small.select("e.a", "e.b").where("a <> b").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point within {most_rounds} rounds")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
