"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang every neighbour on the smallest one; the large star moves larger neighbours only, the small star smaller ones."""
    if large:
        around = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``node, component``: the smallest node that each linked node can reach.

    Every round writes its links to the shared folder, so a lost executor never replays
    earlier rounds; the driver sees three numbers a round. Rounds grow with the logarithm of
    the number of nodes. Repeated links, links in both directions and links to oneself are
    allowed; nodes without links are not returned.
    """
    current = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    before = _state(current)
    while before[0]:
        current = stage(_stars(_stars(current, large=True).distinct(), large=False).distinct(), "links")
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
