"""End-to-end jobs: normalise, hunt, match, count, locate and assemble."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.rules import (
    BEHAVIOR_THRESHOLD, BEHAVIOR_WINDOW_MINUTES, DEFAULT_PACK, RulePack,
)
from tidewatch.functions.text import TextView, rfc3339
from tidewatch.operators.behavior import behavior
from tidewatch.operators.geo import geolocate
from tidewatch.operators.hunt import hunt
from tidewatch.operators.indicators import SNAPSHOT_TTL, build_indicators, latest_valid_snapshot
from tidewatch.operators.iocs import ioc_array
from tidewatch.operators.match import indicator_lookup, ioc_matches_column, match_indicators
from tidewatch.operators.normalize_firewall import accepted, classify_lines, firewall_text, rejected
from tidewatch.operators.normalize_packets import normalize_packets, packet_text
from tidewatch.operators.reports import stage_metrics
from tidewatch.operators.siem import format_siem_syslog
from tidewatch.schema import ENRICHMENT_FIELD, ENRICHMENT_TYPE, GEO_PLACE
from tidewatch.session import remove, stage, staged_paths


@dataclass(frozen=True)
class Settings:
    """What an enrichment run looks for."""

    pack: RulePack = DEFAULT_PACK
    threshold: int = BEHAVIOR_THRESHOLD
    window_minutes: int = BEHAVIOR_WINDOW_MINUTES
    enrich: bool = True
    # The time that behaviour counts follow; by default an event's own, and else that of its arrival.
    time_col: str | None = None

    def time(self, *columns: str) -> Column:
        return F.coalesce(*[F.col(c).cast("timestamp") for c in ([self.time_col] if self.time_col else columns)])


DEFAULTS = Settings()


def detect(events: DataFrame, view: TextView, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """The part of the enrichment that needs only the event itself, in projections."""
    # The text is a column before it is searched: inside an expression over arrays it would be put together at each use.
    read = events.select("*", view.lines.alias("_text"))
    found = read.select("*", ioc_array(F.col("_text")).alias("_iocs"))
    return hunt(found, replace(view, lines=F.col("_text")), pack).drop("_text")


def assemble(
    detected: DataFrame,
    indicators: DataFrame,
    geo: DataFrame | None,
    time: str | Column,
    settings: Settings = DEFAULTS,
    flags: DataFrame | None = None,
) -> DataFrame:
    """Join all findings to the events and attach ``forwarder_enrichment``.

    ``detected`` should be a staged table: each detector reads only its few columns of it.
    Hits, counts and places are narrow rows; they are stacked, grouped by event once and
    joined once, so the wide events are moved a single time. ``flags`` replaces the
    behaviour counts where they were computed elsewhere (streams). Where ``indicators`` are an
    ``indicator_history``, as for a replay, an event meets the version valid at its time.
    """
    lookup = indicator_lookup(indicators)
    timed = detected.withColumn("_at", F.col(time) if isinstance(time, str) else time)
    as_of = "_at" if "valid_from" in indicators.columns else None
    hits = match_indicators(timed.select("event_id", *([as_of] if as_of else []), F.inline("_iocs")), lookup, time_col=as_of)
    if flags is None:
        flags = behavior(timed, "_at", threshold=settings.threshold, window_minutes=settings.window_minutes)
    findings = hits.select("event_id", "kind", "ord", "value", "sources", "source_count").unionByName(
        flags.select("event_id", F.concat(F.lit("high_frequency_"), "kind").alias("kind"), "count"),
        allowMissingColumns=True,
    )
    if geo is not None:
        findings = findings.unionByName(
            geolocate(detected, geo).select("event_id", F.col("side").alias("kind"), "place"),
            allowMissingColumns=True,
        )
    else:
        findings = findings.withColumn("place", F.lit(None).cast(GEO_PLACE))

    def one(kind: str, column: str) -> Column:
        return F.any_value(F.when(F.col("kind") == kind, F.col(column)), True)

    grouped = findings.groupBy("event_id").agg(
        ioc_matches_column().alias("ioc"),
        *[one(f"high_frequency_{k}", "count").alias(f"n_{k}") for k in ("ip", "logid", "user")],
        *[one(side, "place").alias(f"place_{side}") for side in ("dst", "src")],
    )

    def often(kind: str) -> Column:
        return F.when(
            F.col(f"n_{kind}").isNotNull(),
            F.struct(F.col(f"n_{kind}").alias("count"),
                     F.lit(settings.window_minutes).alias("time_window_minutes")),
        ).alias(f"high_frequency_{kind}")

    def any_of(columns: list[str]) -> Column:
        result = F.lit(False)
        for column in columns:
            result = result | F.col(column).isNotNull()
        return result

    shaped = grouped.select(
        "event_id",
        F.when(any_of(["n_ip", "n_logid", "n_user"]),
               F.struct(often("ip"), often("logid"), often("user"))).alias("_anomalies"),
        F.when(any_of(["place_dst", "place_src"]),
               F.struct(F.col("place_dst").alias("dst"), F.col("place_src").alias("src"))).alias("_geo"),
        F.when(any_of([f"ioc.{name}" for name in (
            "malicious_domains", "malicious_hashes", "malicious_ips", "malicious_urls")]),
            F.col("ioc")).alias("_matches"),
    )
    stamp = rfc3339(F.lit(lookup.seen["last_updated"] or dt.datetime.now(dt.timezone.utc)))
    return (
        detected.drop("_iocs").join(shaped, "event_id", "left")
        .withColumn(
            ENRICHMENT_FIELD,
            F.when(
                any_of(["_anomalies", "_geo", "_matches", "threat_hunting"]),
                F.struct(
                    F.col("_anomalies").alias("behavioral_anomalies"), F.col("_geo").alias("geoip"),
                    stamp.alias("intel_last_updated"), F.col("_matches").alias("ioc_matches"),
                    F.col("threat_hunting"),
                ),
            ),
        )
        .drop("_anomalies", "_geo", "_matches", "threat_hunting")
    )


def enrich(
    events: DataFrame,
    view: TextView,
    indicators: DataFrame,
    geo: DataFrame | None,
    time: str | Column,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Attach ``forwarder_enrichment`` to any event table with an ``event_id``."""
    if not settings.enrich:
        return events
    return assemble(stage(detect(events, view, settings.pack), "detected"), indicators, geo, time, settings)


@dataclass(frozen=True)
class FirewallRun:
    """Results of ``enrich_firewall``, all read from one staged pass over the lines.

    ``paths`` are the staged tables; ``close``, or the end of a ``with`` block, removes them
    once the results are written.
    """

    events: DataFrame
    rejects: DataFrame
    settings: Settings
    paths: tuple[str, ...] = ()

    def close(self) -> None:
        for path in self.paths:
            remove(self.events.sparkSession, path)

    def __enter__(self) -> FirewallRun:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def siem_lines(self) -> DataFrame:
        return format_siem_syslog(self.events)

    def metrics(self) -> DataFrame:
        good = self.events.select(F.col(ENRICHMENT_FIELD).isNotNull().alias("found"))
        rows = good.select(F.lit(None).cast("string").alias("reason"), "found").unionByName(
            self.rejects.select("reason", F.lit(False).alias("found"))
        )
        return stage_metrics(rows.withColumn(ENRICHMENT_FIELD, F.when(F.col("found"), F.lit(True))))


def enrich_firewall(
    lines: DataFrame, indicators: DataFrame, geo: DataFrame | None = None, settings: Settings = DEFAULTS
) -> FirewallRun:
    """Raw lines -> enriched events and rejects.

    The lines are read, parsed and searched once, into a staged table; rejects and events
    are two filters on it.
    """
    classified = classify_lines(lines)
    with staged_paths() as paths:
        if settings.enrich:
            staged = stage(detect(classified, firewall_text(), settings.pack), "firewall")
            events = assemble(accepted(staged), indicators, geo, settings.time("event_ts", "ingest_ts"), settings)
        else:
            staged = stage(classified, "firewall")
            events = accepted(staged).withColumn(ENRICHMENT_FIELD, F.lit(None).cast(ENRICHMENT_TYPE))
    return FirewallRun(events, rejected(staged), settings, tuple(paths))


def enrich_packets(
    packets: DataFrame, indicators: DataFrame, geo: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Packet JSON -> enriched flow events. Behaviour counts follow the packet's own time."""
    flows = normalize_packets(packets)
    return enrich(flows, packet_text(), indicators, geo, settings.time("event_ts"), settings)


def refresh_indicators(
    snapshots: DataFrame, now: Column, ttl: dt.timedelta = SNAPSHOT_TTL
) -> DataFrame:
    """Feed snapshots -> indicator table, from the feeds that are still fresh at ``now``."""
    return build_indicators(latest_valid_snapshot(snapshots, now, ttl), last_updated=now)
