"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.sources.staging import Staging


def _distinct_links(df: DataFrame) -> DataFrame:
    return df.filter("u > v").distinct()


def _large_star(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    around = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = around.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    low = staging.keep(low, f"{name}_low")  # a table of its own: Spark may then split a node with many links
    moved = around.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return staging.keep(_distinct_links(moved), name)


def _small_star(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    low = staging.keep(links.groupBy("u").agg(F.min("v").alias("low")), f"{name}_low")
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return staging.keep(_distinct_links(moved.union(low.select("u", F.col("low").alias("v")))), name)


def connected_components(links: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node of `links`; component is the smallest node reachable.

    `links` has two columns of comparable type: both ends of each link, in either order,
    repeats allowed. Nodes without a link (or linked only to themselves) and links with a null
    end are not in the result. Every round is two aggregations with map-side minima and two joins whose
    large keys Spark may split; a round at least contracts all stars, so the number of rounds
    grows with the logarithm of the longest chain. Each round is written to the run folder,
    which cuts lineage and survives lost executors; nothing but one summary row is collected.
    """
    a, b = links.columns
    current = staging.keep(
        _distinct_links(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).dropna()), "links_0"
    )
    summary, turn = None, 0
    while True:
        turn += 1
        current = _large_star(current, staging, f"large_{turn}")
        current = _small_star(current, staging, f"small_{turn}")
        # Equal sums over a set of links that only ever moves downwards: nothing moved.
        now = tuple(
            current.agg(
                F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
            ).first()
        )
        if now == summary:
            break
        summary = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
