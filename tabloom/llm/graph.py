"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.workspace import scratch, stage

# Links, a megabyte or two, that one task takes without a shuffle.
FEW = 1 << 17


def _dealt(rows: DataFrame, few: bool) -> DataFrame:
    return rows.coalesce(1) if few else rows


def _stars(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    """One step of large-star or small-star: neighbours of a node move to its least neighbour."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
    if large:
        both = both.union(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
    both = _dealt(both, few)
    # Stars with very many leaves are summed before the shuffle and split by the join.
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    least = least.withColumn("least", F.least("least", "node"))
    moved = both.join(least, "node")
    if large:
        moved = moved.filter(F.col("near") > F.col("node")).select("near", "least")
    else:
        moved = moved.select("near", "least").union(least.select("node", "least"))
    return (
        _dealt(moved, few)
        .select(F.col("near").alias("a"), F.col("least").alias("b"))
        .filter("a > b")
        .distinct()
    )


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``: the least node it is linked to.

    Large-star and small-star steps alternate until every edge points to its component. Each
    round is written to the shared folder, so that lost executors cost one round at most; the
    number of rounds follows the logarithm of the longest path. Graphs of up to ``FEW`` edges are
    not dealt out, as a round of them is less work than its shuffles.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    with scratch() as kept:
        now = stage(
            edges.select(high.alias("a"), low.alias("b")).filter("a > b").distinct(), "links"
        )
        digest, few = None, False
        for _ in range(rounds):
            # Two tables of distinct edges are the same if their sizes and sums of hashes are.
            found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).head()
            few = found[0] <= FEW
            if found == digest or not found[0]:
                break
            moved = _stars(_stars(_dealt(now, few), True, few), False, few)
            digest, now = found, stage(moved, "links")
        nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        ends = nodes.union(now.select("b", "b").distinct())
        return kept(_dealt(ends, few).distinct(), "reached")
