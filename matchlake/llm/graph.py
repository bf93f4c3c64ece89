"""Connected components of a link table that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Smallest node reachable by links, per linked node, as (node, component).

    ``links`` holds two long columns ``a`` and ``b`` in any direction. Large-star and small-star
    steps alternate until the table no longer changes: every step replaces links by links to
    smaller nodes, so the number of steps is about the logarithm of a component's size and the
    table never grows. Each step is written; nothing is collected but a count and a checksum.
    """
    edges = scratch.put(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u > v")
        .distinct(),
        "edges-0",
    )
    seen, step = _signature(edges), 0
    while seen[0]:
        step += 1
        edges = scratch.put(_small_star(_large_star(edges)), f"edges-{step}")
        scratch.drop(f"edges-{step - 1}")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u > v").distinct()
