"""Connected components by alternating star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from carelake.session import materialize


def _hang(directed: DataFrame, only_above: bool) -> DataFrame:
    """Tie every neighbour `b` of a node `a` to the smallest one of them and the node.

    The smallest neighbour is a `min` per node, reduced before the shuffle, and joined
    back, so a node with very many neighbours is never gathered in one place.
    `only_above` moves the neighbours above the node; else the node moves with them.
    """
    smallest = directed.groupBy("a").agg(F.min("b").alias("low")).select(
        "a", F.least("a", "low").alias("low")
    )
    moved = directed.filter(F.col("b") > F.col("a")) if only_above else directed
    tied = moved.join(smallest, "a").select(F.col("b").alias("left"), F.col("low").alias("right"))
    if not only_above:
        tied = tied.unionByName(smallest.select(F.col("a").alias("left"), F.col("low").alias("right")))
    return tied.filter(F.col("left") > F.col("right")).distinct()


def _kept(edges: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The edges written to the shared folder, and their fingerprint, taken by the write."""
    code = F.xxhash64("left", "right")
    seen = Observation()
    watched = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(code.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(code).alias("xor"),
    )
    return materialize(watched, "components"), seen.get


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """`id` and `component`, the smallest id it is connected to, for all ids of `edges`.

    `edges` has the columns `left` and `right`. Rounds grow with the logarithm of the
    number of nodes. Each round is written to the shared folder, which cuts the
    lineage; the driver receives three numbers per round.
    """
    current = edges.filter(F.col("left") != F.col("right")).select(
        F.greatest("left", "right").alias("left"), F.least("left", "right").alias("right")
    ).distinct()
    current, before = _kept(current)
    for _ in range(max_rounds):
        down = current.select(F.col("left").alias("a"), F.col("right").alias("b"))
        up = current.select(F.col("right").alias("a"), F.col("left").alias("b"))
        large = _hang(down.unionByName(up), only_above=True)
        small = _hang(large.select(F.col("left").alias("a"), F.col("right").alias("b")), only_above=False)
        current, after = _kept(small)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"connected_components: not settled after {max_rounds} rounds")
    stars = current.select(F.col("left").alias("id"), F.col("right").alias("component"))
    centres = stars.select(F.col("component").alias("id"), "component").distinct()
    return stars.unionByName(centres)
