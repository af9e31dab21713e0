"""Threat feeds -> one indicator table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.ip import is_public_ip
from tidewatch.plans.joins import Lookup

SNAPSHOT_TTL = dt.timedelta(hours=24)


def latest_valid_snapshot(
    snapshots: DataFrame, now: Column, ttl: dt.timedelta = SNAPSHOT_TTL
) -> DataFrame:
    """Rows of each feed's newest snapshot, if it is younger than ``ttl``.

    ``snapshots(feed, kind, fetched_at, value)``. An expired feed is left out, not reused.
    """
    newest = snapshots.groupBy("feed").agg(F.max("fetched_at").alias("fetched_at"))
    valid = newest.where(now.cast("timestamp") - F.col("fetched_at").cast("timestamp") < F.lit(ttl))
    return Lookup(valid, "feed-snapshots").join(
        snapshots, ["feed", "fetched_at"], "left_semi", spread_by="value"
    )


def build_indicators(feeds: DataFrame, last_updated: Column | None = None) -> DataFrame:
    """``feeds(feed, kind, value)`` -> (kind, value, sources, source_count, last_updated).

    Addresses keep the sorted list of feeds that carry them and must be public; the other
    kinds are plain sets. A value has at most as many sources as there are feeds.
    """
    usable = feeds.where((F.col("kind") != "ip") | is_public_ip(F.col("value")))
    by_feed = F.when(F.col("kind") == "ip", F.col("feed"))
    return (
        usable.groupBy("kind", "value")
        .agg(F.array_sort(F.collect_set(by_feed)).alias("_sources"))
        .select(
            "kind", "value",
            F.when(F.col("kind") == "ip", F.col("_sources")).alias("sources"),
            F.when(F.col("kind") == "ip", F.size("_sources")).alias("source_count"),
            (F.current_timestamp() if last_updated is None else last_updated.cast("timestamp"))
            .alias("last_updated"),
        )
    )


def indicator_counts(indicators: DataFrame) -> DataFrame:
    """Indicators per kind, and their total as kind ``all``."""
    return indicators.rollup("kind").agg(F.count("*").alias("indicators")).select(
        F.coalesce("kind", F.lit("all")).alias("kind"), "indicators"
    )


def feed_union(*feeds: DataFrame) -> DataFrame:
    """Distinct (kind, value) over several feeds."""
    combined = feeds[0].select("kind", "value")
    for feed in feeds[1:]:
        combined = combined.unionByName(feed.select("kind", "value"))
    return combined.distinct()
