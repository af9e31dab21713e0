"""Extracted indicators x indicator table -> hits, and hits -> one object per event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.joins import Lookup

STATUS = "blocklisted"


def indicator_lookup(indicators: DataFrame) -> Lookup:
    """The indicators, worked out and written once; ``seen`` has the time of their last update."""
    spans = [c for c in ("valid_from", "valid_to") if c in indicators.columns]
    table = indicators.select("kind", "value", "sources", "source_count", "last_updated", *spans)
    lookup = Lookup(table, "indicators", last_updated=F.max("last_updated"))
    lookup.table = lookup.table.drop("last_updated")
    return lookup


def match_indicators(
    iocs: DataFrame, indicators: DataFrame | Lookup, id_col: str = "event_id", time_col: str | None = None
) -> DataFrame:
    """Exact, case-sensitive matches of all four kinds in one join on (kind, value).

    A value that sits in a large share of all events is the normal case here (a scanner, a
    public resolver), so the join splits it; see ``Lookup.join``. With ``time_col`` the
    indicators are an ``indicator_history``, and an event meets those valid at its time; an
    event without a time, or before the first version, meets none.
    """
    lookup = indicators if isinstance(indicators, Lookup) else indicator_lookup(indicators)
    valid = None
    if time_col is not None:
        at = F.col(f"l.{time_col}").cast("timestamp")
        valid = (at >= F.col("r.valid_from")) & (F.col("r.valid_to").isNull() | (at < F.col("r.valid_to")))
    return lookup.join(iocs, ["kind", "value"], "inner", spread_by=id_col, extra=valid)


def ioc_matches_column():
    """The ``ioc_matches`` object from grouped hits; kinds without hits are left out."""

    def in_order(kind: str, value):
        hits = F.array_sort(F.collect_list(
            F.when(F.col("kind") == kind, F.struct(F.col("ord").alias("ord"), value.alias("hit")))
        ))
        return F.when(F.size(hits) > 0, F.transform(hits, lambda h: h.hit))

    address = F.struct(
        F.col("value").alias("ip"), F.col("source_count").alias("source_count"),
        F.col("sources").alias("sources"), F.lit(STATUS).alias("status"),
    )
    return F.struct(
        in_order("domain", F.col("value")).alias("malicious_domains"),
        in_order("hash", F.col("value")).alias("malicious_hashes"),
        in_order("ip", address).alias("malicious_ips"),
        in_order("url", F.col("value")).alias("malicious_urls"),
    )


def regroup_hits(hits: DataFrame, id_col: str = "event_id") -> DataFrame:
    """One ``ioc_matches`` object per event with hits.

    A group holds the distinct indicators of one event, never more than its own text does.
    """
    return hits.groupBy(id_col).agg(ioc_matches_column().alias("ioc_matches"))
