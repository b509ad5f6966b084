"""Connected components by alternating large-star and small-star steps.

Each step sends every node's neighbours to the smallest of them, so chains shorten by
a constant factor and no task holds a component. A node with very many neighbours is
aggregated to a minimum with a map-side step, and joined, where adaptive execution
splits its side if it is much larger than the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.staging import staged


def _toward_least(edges: DataFrame, *, small: bool) -> DataFrame:
    """One step: edges (u, v) -> edges from larger to smaller nodes."""
    low, high = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    down = edges.select(high, low)
    if small:
        near = down
    else:
        near = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("least")).select(
        "u", F.least("u", "least").alias("least")
    )
    met = near.join(least, "u")
    if small:
        moved = met.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            met.select("u", F.col("least").alias("v"))
        )
    else:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.where("u <> v").distinct()


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) -> (node, component), the component being its smallest node.

    Nodes without an edge do not occur. Written once.
    """
    now = staged(edges.select("u", "v").where("u <> v"), "edges")
    seen = _fingerprint(now)
    while seen[0]:
        now = staged(_toward_least(_toward_least(now, small=False), small=True), "edges")
        found = _fingerprint(now)
        if found == seen:
            break
        seen = found
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return staged(stars.union(roots).distinct(), "components")
