"""Connected components of an edge table by alternating star operations.

Every round is joins, minima and a distinct of edges; a node with many edges is joined and pre-aggregated,
never gathered. The edges of each round are a written table, so a lost executor repeats tasks and not rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpulse.staging import discarded, written


def _round(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b; connects each node's larger, then its smaller neighbours to its minimum."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.filter(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    ).distinct()
    below = large.groupBy("a").agg(F.min("b").alias("m"))
    rest = large.join(below, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionAll(below.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint); root is the smallest node that is reachable.

    Loops, repeated and reversed edges change nothing; edges with a null end are no edges; no edges give no rows.
    """
    now = written(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        if not state[0]:
            break
        before, now = now, written(_round(now), "edges")
        discarded(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
