"""Every registered query with its SQL twin."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import samples as S
from checks import twins as T
from tidewatch.functions.ip import is_public_ip
from tidewatch.functions.rules import RulePack
from tidewatch.functions.text import TextView, flat_view
from tidewatch.operators import alerts, reports, routing
from tidewatch.operators.behavior import (
    activity_epochs, behavior, behavior_keys, key_counts, merge_counts, running_counts, sliding_counts,
)
from tidewatch.operators.filters import has_anomaly, has_enrichment, has_ioc, has_rule
from tidewatch.operators.geo import geolocate, rejected_ranges
from tidewatch.operators.hunt import hunt, keyword_rows, pattern_rows, rule_rows
from tidewatch.operators.indicators import build_indicators, feed_union, indicator_counts, latest_valid_snapshot
from tidewatch.operators.iocs import extract_iocs
from tidewatch.operators.match import match_indicators, regroup_hits
from tidewatch.operators.normalize_firewall import firewall_text, normalize_firewall
from tidewatch.operators.normalize_packets import normalize_packets, packet_text
from tidewatch.plans.enrich import FirewallRun, Settings, enrich_firewall, enrich_packets, refresh_indicators
from tidewatch.schema import TRAFFIC_POSITIONS
from tidewatch.session import configure, stage_path
from tidewatch.sources import readers, sinks, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}
THRESHOLD = T.THRESHOLD


def query(name: str, twin: str | None = None):
    """Register a query, and its SQL twin if there is one."""

    def add(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[name] = run
        if twin is not None:
            TWINS[name] = twin
        return run

    return add


def stamp(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


# Shared inputs ---------------------------------------------------------------


def spread(rows: DataFrame) -> DataFrame:
    """For stored samples: the given tables are single files of one row group, which only one task can read."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def shared_out(rows: DataFrame) -> DataFrame:
    """Rows of a table whose few files would leave most cores idle, dealt out; a table of many files is read as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else spread(rows)


def documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TextView]:
    rows = shared_out(S.table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("event_id"), "lang", "source", "text")
    return rows, flat_view({c: c for c in ("lang", "source", "text")})


def pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TextView]:
    rows = shared_out(S.table(spark, sf_dir, "pages")).select(F.col("page_id").alias("event_id"), "url", "html")
    return rows, flat_view({c: c for c in ("url", "html")})


def long_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TextView]:
    """All documents, some hundred to a line of a megabyte without a line end."""
    text = F.struct("doc_id", F.translate("text", "\n", " ").alias("text"))
    rows = S.table(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 500").alias("event_id")).agg(
        F.array_sort(F.collect_list(text)).alias("all")
    )
    return rows.select("event_id", F.array_join("all.text", " ").alias("text")), flat_view({"text": "text"})


def conversations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TextView]:
    rows = shared_out(S.table(spark, sf_dir, "conversations")).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("event_id"), "role", "text"
    )
    return rows, flat_view({c: c for c in ("role", "text")})


_stores: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], deal: bool = True) -> DataFrame:
    """A table written by the first query of a session that needs it; with ``deal``, dealt out before."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stores:
        path = stage_path(spark, name)
        (spread(make()) if deal else make()).write.parquet(path)
        _stores[key] = path
    return spark.read.parquet(_stores[key])


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The firewall lines as they lie in the landing zone: (event_id, ingest_ts, raw)."""
    return stored(spark, sf_dir, "raw-lines", lambda: S.firewall_lines(spark, sf_dir), deal=False)


def firewall(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TextView]:
    return normalize_firewall(raw_lines(spark, sf_dir))[0], firewall_text()


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.clean_feed(stored(spark, sf_dir, "feed-lines", lambda: S.feed_lines(spark, sf_dir)))


UPDATED = "2024-02-01 00:00:00"


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_indicators(feeds(spark, sf_dir), last_updated=F.lit(UPDATED))


def firewall_run(spark: SparkSession, sf_dir: str) -> FirewallRun:
    return enrich_firewall(
        raw_lines(spark, sf_dir), indicators(spark, sf_dir), S.geo_ranges(spark, sf_dir),
        Settings(threshold=THRESHOLD, time_col="ingest_ts"),
    )


def event_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched events as a written table, as reports and alerts find them.

    They come from a join, in as many parts as it has, so these wide rows aren't moved again.
    """
    return stored(spark, sf_dir, "event-store", lambda: firewall_run(spark, sf_dir).events, deal=False)


# Indicators: extraction, feeds, matching ---------------------------------------

_SOURCES = {"documents": (documents, T.DOC_TEXT, "doc"), "pages": (pages, T.PAGE_TEXT, "page"),
            "long": (long_lines, T.LONG_TEXT, "long"), "firewall": (firewall, T.FW_SPLIT, "fw"), "conversations": (conversations, T.CONV_TEXT, "conv")}


def _per_source(name: str, source, ctes: str, prefix: str) -> None:
    @query(f"ioc_extract_{name}", f"WITH {ctes}, {T.iocs(prefix + '_text')} SELECT id AS event_id, kind, value, ord FROM iocs")
    def _extract(spark, sf_dir):
        rows, view = source(spark, sf_dir)
        return extract_iocs(rows, view.lines)

    @query(f"match_{name}", f"WITH {ctes}, {T.iocs(prefix + '_text')}, {T.INDICATORS}, {T.HITS} "
                            "SELECT id AS event_id, kind, ord, value, sources, source_count FROM hits")
    def _match(spark, sf_dir):
        rows, view = source(spark, sf_dir)
        hits = match_indicators(extract_iocs(rows, view.lines), indicators(spark, sf_dir))
        return hits.select("event_id", "kind", "ord", "value", F.array_join("sources", ",").alias("sources"), "source_count")

    @query(f"hunt_patterns_{name}", f"WITH {ctes}, {T.scan(prefix + '_leaves')} SELECT id AS event_id, pattern, field_path, sample FROM scan")
    def _patterns(spark, sf_dir):
        return pattern_rows(hunt(*source(spark, sf_dir)))

    @query(f"hunt_rules_{name}", f"WITH {ctes}, {T.fired(prefix + '_text')} SELECT id AS event_id, CAST(row_number() OVER "
                                 "(PARTITION BY id ORDER BY ord) - 1 AS INTEGER) AS ord, rule, pattern FROM fired")
    def _rules(spark, sf_dir):
        return rule_rows(hunt(*source(spark, sf_dir)))

    @query(f"hunt_keywords_{name}", f"WITH {ctes}, {T.keywords(prefix + '_text')} SELECT id AS event_id, suspicious_process, critical_asset_access "
                                    "FROM words WHERE suspicious_process IS NOT NULL OR critical_asset_access IS NOT NULL")
    def _keywords(spark, sf_dir):
        return keyword_rows(hunt(*source(spark, sf_dir)))


for _name, _spec in _SOURCES.items():
    _per_source(_name, *_spec)


@query("feed_values", f"WITH {T.FEED_LINES} SELECT feed, kind, value FROM feed_values")
def _feed_values(spark, sf_dir):
    return feeds(spark, sf_dir)


@query("feed_union", f"WITH {T.FEED_LINES} SELECT DISTINCT kind, value FROM feed_values")
def _feed_union(spark, sf_dir):
    rows = feeds(spark, sf_dir)
    return feed_union(rows.where("feed = 'addresses-a'"), rows.where("feed = 'addresses-b'"), rows.where("kind <> 'ip'"))


_SNAPSHOTS = f"""snapshots AS (
  SELECT 'feed-' || event_type AS feed, 'ip' AS kind, date_trunc('day', ts) AS fetched_at, {T.DST} AS value
  FROM events WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-20'),
newest AS (SELECT feed, max(fetched_at) AS fetched_at FROM snapshots GROUP BY feed)"""


def _snapshots(spark, sf_dir):
    """Fetches of every event's day, but one feed was fetched for the last time on the 19th; its later rows belong there."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    last = F.when(F.col("event_type") == "view", F.least(day, F.lit("2024-01-19").cast("timestamp"))).otherwise(day)
    return S.table(spark, sf_dir, "events").select(
        F.concat(F.lit("feed-"), "event_type").alias("feed"), F.lit("ip").alias("kind"), last.alias("fetched_at"), S.destination_address().alias("value"),
    )


@query("feed_snapshots", f"WITH {_SNAPSHOTS} SELECT feed, kind, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, value FROM snapshots "
                         "SEMI JOIN newest USING (feed, fetched_at) WHERE TIMESTAMP '2024-01-30 23:59:59' - fetched_at < INTERVAL 24 HOUR")
def _feed_snapshots(spark, sf_dir):
    rows = latest_valid_snapshot(_snapshots(spark, sf_dir), F.lit("2024-01-30 23:59:59"))
    return rows.select("feed", "kind", stamp("fetched_at").alias("fetched_at"), "value")


@query("indicator_refresh", f"""WITH {_SNAPSHOTS}, fresh AS (SELECT DISTINCT feed, value FROM snapshots SEMI JOIN newest USING (feed, fetched_at)
  WHERE TIMESTAMP '2024-01-30 23:59:59' - fetched_at < INTERVAL 24 HOUR)
  SELECT 'ip' AS kind, value, string_agg(feed, ',' ORDER BY feed) AS sources, CAST(count(*) AS INTEGER) AS source_count,
    '2024-01-30 23:59:59' AS last_updated FROM fresh GROUP BY value""")
def _indicator_refresh(spark, sf_dir):
    rows = refresh_indicators(_snapshots(spark, sf_dir), F.lit("2024-01-30 23:59:59"))
    return rows.select("kind", "value", F.array_join("sources", ",").alias("sources"), "source_count", stamp("last_updated").alias("last_updated"))


@query("indicator_build", f"WITH {T.INDICATORS} SELECT kind, value, sources, source_count FROM indicators")
def _indicator_build(spark, sf_dir):
    return indicators(spark, sf_dir).select("kind", "value", F.array_join("sources", ",").alias("sources"), "source_count")


@query("indicator_counts", f"WITH {T.INDICATORS} SELECT coalesce(kind, 'all') AS kind, count(*) AS indicators FROM indicators GROUP BY ROLLUP (kind)")
def _indicator_counts(spark, sf_dir):
    return indicator_counts(indicators(spark, sf_dir))


@query("regroup_hits", f"""WITH {T.PAGE_TEXT}, {T.iocs('page_text')}, {T.INDICATORS}, {T.HITS}
  SELECT id AS event_id, string_agg(value, ' ' ORDER BY ord) FILTER (kind = 'domain') AS domains,
    string_agg(value, ' ' ORDER BY ord) FILTER (kind = 'url') AS urls,
    string_agg(value, ' ' ORDER BY ord) FILTER (kind = 'ip') AS ips FROM hits GROUP BY id""")
def _regroup_hits(spark, sf_dir):
    rows, view = pages(spark, sf_dir)
    grouped = regroup_hits(match_indicators(extract_iocs(rows, view.lines), indicators(spark, sf_dir)))
    return grouped.select(
        "event_id", F.array_join("ioc_matches.malicious_domains", " ").alias("domains"),
        F.array_join("ioc_matches.malicious_urls", " ").alias("urls"),
        F.array_join(F.transform("ioc_matches.malicious_ips", lambda m: m.ip), " ").alias("ips"),
    )


_ADDRESSES = f"""addresses AS (SELECT event_id, event_type,
  {T.pick([8, 10, 127, 169, 172, 192, 198, 203, 224, 255, 0, 100], 'event_id % 12')} || '.' ||
  {T.pick([0, 16, 31, 32, 51, 64, 168, 254], '(event_id // 12) % 8')} || '.' ||
  {T.pick([0, 2, 100, 113], '(event_id // 96) % 4')} || '.' || (user_id % 300) AS quad FROM events),
shaped AS (SELECT event_id, CASE event_type WHEN 'click' THEN quad || '/24' WHEN 'signup' THEN '0' || quad ELSE quad END AS address FROM addresses)"""


@query("public_ip", f"WITH {_ADDRESSES} SELECT event_id, address, {T.public_v4('address')} AS public FROM shaped")
def _public_ip(spark, sf_dir):
    return S.addresses(spark, sf_dir).select("event_id", "address", is_public_ip(F.col("address")).alias("public"))


_V6 = f"""SELECT event_id, {T.pick(["fe80::", "febf:1::", "fec0::", "fc00::", "fdff::", "ff02::", "2001:db8::", "2001:db9::",
  "2a04:4e42:3b::", "::ffff:8.8.", "2001:DB8:1:2:3:4:5:", "::"], 'event_id % 12')} || CASE event_id % 12
  WHEN 9 THEN (event_id % 250) || '.' || (user_id % 250) WHEN 11 THEN 'abcd:' || lower(hex(event_id % 65536))
  ELSE lower(hex(event_id % 65536)) END AS address,
  (event_id % 12) IN (2, 7, 8, 9, 11) AS public FROM events"""


@query("public_ip_v6", _V6)
def _public_ip_v6(spark, sf_dir):
    return S.v6_addresses(spark, sf_dir).select("event_id", "address", is_public_ip(F.col("address")).alias("public"))


# Normalisation -------------------------------------------------------------------

_FW_COLUMNS = ["event_id", "type", "source_address", "destination_address", "application", "action", "device_name", "rule_name",
               "source_user", "threat_name", "source_zone", "destination_zone", "bytes", "log_number", "source_port",
               "destination_port", "session_id"]


@query("normalize_firewall", f"WITH {T.FW_EVENTS} SELECT {', '.join(_FW_COLUMNS)} FROM fw_events")
def _normalize_firewall(spark, sf_dir):
    return firewall(spark, sf_dir)[0].select(*_FW_COLUMNS)


@query("firewall_field_values", f"WITH {T.FW_SPLIT} SELECT event_id, name, value FROM fw_values WHERE is_text")
def _firewall_field_values(spark, sf_dir):
    rows, view = firewall(spark, sf_dir)
    return rows.select("event_id", F.inline(view.leaves)).select("event_id", F.col("path").alias("name"), "value")


@query("unparsed_fields", f"WITH {T.FW_SPLIT} SELECT event_id, name, value FROM fw_values WHERE is_text AND num <> 's'")
def _unparsed_fields(spark, sf_dir):
    return firewall(spark, sf_dir)[0].select("event_id", F.explode("unparsed").alias("name", "value"))


@query("reject_firewall", f"""WITH {T.FW_SPLIT} SELECT event_id, raw, 'Palo Alto line has ' || len(f) || ' CSV fields, needs 31' AS reason
  FROM fw_split WHERE len(f) < 31""")
def _reject_firewall(spark, sf_dir):
    return normalize_firewall(raw_lines(spark, sf_dir))[1].select("event_id", "raw", "reason")


_PACKETS = f"""usable AS (SELECT * FROM events WHERE event_id % 50 NOT IN (0, 1, 4, 5)),
flows AS (SELECT event_id, ts,
  CASE WHEN event_id % 50 = 3 THEN '2a00:1450::' || lower(hex(event_id % 4096)) ELSE {T.SRC} END AS source_address,
  CASE WHEN event_id % 50 = 3 THEN 'fe80::1' ELSE {T.DST} END AS destination_address,
  CASE WHEN event_id % 50 = 3 THEN 6 ELSE 4 END AS ip_version,
  CAST(CASE WHEN event_id % 3 = 2 THEN 0 ELSE 1024 + event_id % 50000 END AS INTEGER) AS source_port,
  CASE WHEN event_id % 3 = 2 OR event_id % 50 = 2 THEN 0 ELSE {T.pick(S.PORTS, 'user_id % 20')} END AS destination_port,
  (['TCP', 'UDP', 'OTHER'])[event_id % 3 + 1] AS ip_protocol,
  CAST(floor(value * 10) AS BIGINT) AS bytes, epoch_us(ts) // 1000 AS timestamp_ms,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time_utc,
  CASE WHEN event_id % 3 = 0 THEN 'eth:ip:tcp:telnet' ELSE 'eth:ip:udp' END AS protocols,
  CASE WHEN event_type = 'error' THEN (['/index.html', '/a/../../etc/passwd', '/q?id=1'' or 1=1'])[event_id % 3 + 1] END AS uri,
  CASE WHEN event_type = 'error' THEN (['curl/8.1', 'Mozilla'])[event_id % 2 + 1] END AS agent,
  CAST(CASE WHEN event_id % 3 < 2 THEN 1024 + event_id % 50000 END AS VARCHAR) AS sport_text,
  CASE WHEN event_id % 3 < 2 THEN CASE WHEN event_id % 50 = 2 THEN '99999' ELSE CAST({T.pick(S.PORTS, 'user_id % 20')} AS VARCHAR) END END AS dport_text
  FROM usable)"""
_LAYER = "CASE event_id % 3 WHEN 0 THEN 'tcp' ELSE 'udp' END"
_PACKET_LEAVES = f"""{_PACKETS},
pk_values AS (
  SELECT event_id AS id, 'destination_address' AS path, destination_address AS value FROM flows
  UNION ALL SELECT event_id, 'frame.frame_frame_len', CAST(bytes AS VARCHAR) FROM flows
  UNION ALL SELECT event_id, 'frame.frame_frame_protocols', protocols FROM flows
  UNION ALL SELECT event_id, 'frame.frame_frame_time_utc', time_utc FROM flows
  UNION ALL SELECT event_id, 'http.uri[0]', uri FROM flows
  UNION ALL SELECT event_id, 'http.uri[1].agent', agent FROM flows
  UNION ALL SELECT event_id, CASE ip_version WHEN 4 THEN 'ip.ip_ip_dst' ELSE 'ipv6.ipv6_ipv6_dst' END, destination_address FROM flows
  UNION ALL SELECT event_id, CASE ip_version WHEN 4 THEN 'ip.ip_ip_src' ELSE 'ipv6.ipv6_ipv6_src' END, source_address FROM flows
  UNION ALL SELECT event_id, 'ip_protocol', ip_protocol FROM flows
  UNION ALL SELECT event_id, 'log_type', 'tshark' FROM flows
  UNION ALL SELECT event_id, 'protocols', protocols FROM flows
  UNION ALL SELECT event_id, 'source_address', source_address FROM flows
  UNION ALL SELECT event_id, {_LAYER} || '.' || {_LAYER} || '_' || {_LAYER} || '_dstport', dport_text FROM flows
  UNION ALL SELECT event_id, {_LAYER} || '.' || {_LAYER} || '_' || {_LAYER} || '_srcport', sport_text FROM flows
  UNION ALL SELECT event_id, 'time_utc', time_utc FROM flows),
pk_leaves AS (SELECT id, path, value, row_number() OVER (PARTITION BY id ORDER BY replace(path, '.', ' ')) - 1 AS ord
  FROM pk_values WHERE value IS NOT NULL),
pk_text AS (SELECT id, string_agg(value, chr(10) ORDER BY ord) AS lines, string_agg(value, ' ' ORDER BY ord) AS joined
  FROM pk_leaves GROUP BY id)"""
_FLOW_COLUMNS = ["event_id", "source_address", "destination_address", "ip_version", "source_port", "destination_port", "ip_protocol",
                 "bytes", "timestamp_ms", "time_utc", "protocols"]


def packets(spark, sf_dir):
    lines = stored(spark, sf_dir, "packet-lines", lambda: S.packet_lines(spark, sf_dir), deal=False)
    return readers.parse_packets(lines)[0]


@query("normalize_packets", f"WITH {_PACKETS} SELECT {', '.join(_FLOW_COLUMNS)} FROM flows")
def _normalize_packets(spark, sf_dir):
    return normalize_packets(packets(spark, sf_dir)).select(
        *[F.col(c).cast("int").alias(c) if c == "ip_version" else F.col(c) for c in _FLOW_COLUMNS]
    )


@query("packet_leaves", f"WITH {_PACKET_LEAVES} SELECT id AS event_id, CAST(ord AS INTEGER) AS ord, path, value FROM pk_leaves")
def _packet_leaves(spark, sf_dir):
    return normalize_packets(packets(spark, sf_dir)).select("event_id", F.inline(packet_text().leaves))


@query("packet_strings", f"WITH {_PACKET_LEAVES} SELECT id AS event_id, lines FROM pk_text")
def _packet_strings(spark, sf_dir):
    return normalize_packets(packets(spark, sf_dir)).select("event_id", packet_text().lines.alias("lines"))


@query("reject_packets", "SELECT event_id, '{\"timestamp\": broken' AS raw FROM events WHERE event_id % 50 = 5")
def _reject_packets(spark, sf_dir):
    return readers.parse_packets(S.packet_lines(spark, sf_dir))[1]


@query("packet_metrics", """SELECT CAST(sum((event_id % 50 NOT IN (4, 5))::INT) AS BIGINT) AS parsed,
  CAST(sum((event_id % 50 NOT IN (0, 1, 4, 5))::INT) AS BIGINT) AS normalized, CAST(sum((event_id % 50 IN (0, 1))::INT) AS BIGINT) AS skipped,
  CAST(sum((event_id % 50 = 5)::INT) AS BIGINT) AS rejected FROM events""")
def _packet_metrics(spark, sf_dir):
    good, bad = readers.parse_packets(stored(spark, sf_dir, "packet-lines", lambda: S.packet_lines(spark, sf_dir), deal=False))
    return reports.packet_metrics(good, normalize_packets(good), bad)


@query("enrich_packets", f"""WITH {_PACKET_LEAVES}, {T.iocs('pk_text')}, {T.INDICATORS}, {T.HITS}, {T.scan('pk_leaves')},
  {T.fired('pk_text')}, {T.keywords('pk_text')}, {T.epochs('flows')},
  n AS (SELECT f.event_id, count(*) OVER (PARTITION BY source_address, epoch ORDER BY f.timestamp_ms, f.event_id ROWS UNBOUNDED PRECEDING) AS n
    FROM flows f JOIN epoch_of e USING (event_id))
  SELECT f.event_id, (SELECT string_agg(value, ' ' ORDER BY ord) FROM hits h WHERE h.id = f.event_id AND kind = 'ip') AS ips,
    (SELECT string_agg(rule, ' ' ORDER BY ord) FROM fired r WHERE r.id = f.event_id) AS rules,
    (SELECT string_agg(field_path || '=' || pattern, ' ' ORDER BY ord, pattern) FROM scan s WHERE s.id = f.event_id) AS patterns,
    suspicious_process, critical_asset_access, CASE WHEN n > {THRESHOLD} THEN n END AS ip_count
  FROM flows f JOIN words w ON w.id = f.event_id JOIN n USING (event_id)""")
def _enrich_packets(spark, sf_dir):
    rows = enrich_packets(packets(spark, sf_dir), indicators(spark, sf_dir), None, Settings(threshold=THRESHOLD))
    return rows.select("event_id", *_findings())


def _findings() -> list[Column]:
    e = F.col("forwarder_enrichment")
    hunting = e.threat_hunting

    def joined(array: Column, item) -> Column:
        return F.array_join(F.transform(array, item), " ")

    return [
        joined(e.ioc_matches.malicious_ips, lambda m: m.ip).alias("ips"),
        joined(hunting.correlation_rules, lambda r: r.rule).alias("rules"),
        joined(hunting.suspicious_patterns, lambda p: F.concat(p.field_path, F.lit("="), p.pattern)).alias("patterns"),
        hunting.suspicious_process.alias("suspicious_process"),
        hunting.critical_asset_access.alias("critical_asset_access"),
        e.behavioral_anomalies.high_frequency_ip["count"].alias("ip_count"),
    ]


# Behaviour -------------------------------------------------------------------------


def keyed(spark, sf_dir):
    return behavior_keys(S.generic_events(spark, sf_dir), "ts")


@query("behavior_keys", f"WITH {T.KEYED} SELECT event_id, kind, key FROM keyed")
def _behavior_keys(spark, sf_dir):
    return keyed(spark, sf_dir).select("event_id", "kind", "key")


@query("activity_epochs", f"WITH {T.epochs('events')} SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, "
                          "epoch_us(epoch) AS epoch_us FROM epoch_of GROUP BY ALL")
def _activity_epochs(spark, sf_dir):
    return activity_epochs(S.table(spark, sf_dir, "events"), "ts").select(
        stamp("minute").alias("minute"), F.unix_micros("epoch").alias("epoch_us")
    )


@query("running_counts", f"WITH {T.COUNTS} SELECT event_id, kind, key, epoch_us(epoch) AS epoch_us, count FROM counts")
def _running_counts(spark, sf_dir):
    events = S.generic_events(spark, sf_dir)
    return running_counts(behavior_keys(events, "ts"), activity_epochs(events, "ts")).select(
        "event_id", "kind", "key", F.unix_micros("epoch").alias("epoch_us"), "count"
    )


def _flag_query(kind: str, threshold: int) -> None:
    @query(f"flag_{kind}", f"WITH {T.COUNTS} SELECT event_id, key, count FROM counts WHERE kind = '{kind}' AND count > {threshold}")
    def _flag(spark, sf_dir):
        rows = behavior(S.generic_events(spark, sf_dir), "ts", threshold=threshold)
        return rows.where(F.col("kind") == kind).select("event_id", "key", "count")


for _kind, _threshold in (("ip", 2), ("user", 5), ("logid", 1)):
    _flag_query(_kind, _threshold)


@query("sliding_counts", f"""WITH {T.KEYED} SELECT DISTINCT kind, key, epoch_us(ts) AS ts_us, count(*) OVER
  (PARTITION BY kind, key ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS in_window FROM keyed""")
def _sliding_counts(spark, sf_dir):
    return sliding_counts(keyed(spark, sf_dir), 24 * 60).select("kind", "key", F.unix_micros("ts").alias("ts_us"), "in_window")


@query("sliding_anomalies", f"""WITH {T.KEYED}, s AS (SELECT kind, key, event_id, count(*) OVER
  (PARTITION BY kind, key ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS n FROM keyed)
  SELECT kind, count(*) AS events FROM s WHERE n > 1 GROUP BY kind""")
def _sliding_anomalies(spark, sf_dir):
    return sliding_counts(keyed(spark, sf_dir), 5).where("in_window > 1").groupBy("kind").agg(F.sum("events").alias("events"))


@query("merge_counts", f"WITH {T.KEYED} SELECT kind, key, count(*) AS count FROM keyed GROUP BY kind, key")
def _merge_counts(spark, sf_dir):
    rows = keyed(spark, sf_dir)
    return merge_counts(*[key_counts(rows.where(f"day(ts) {test}")) for test in ("< 10", "between 10 and 20", "> 20")])


# Location --------------------------------------------------------------------------


@query("geo_join", f"""WITH sides AS (SELECT event_id, 'src' AS side, {T.SRC} AS address FROM events UNION ALL
  SELECT event_id, 'dst', {T.DST} FROM events), {T.located('sides')} SELECT * FROM located""")
def _geo_join(spark, sf_dir):
    events = S.table(spark, sf_dir, "events").select(
        "event_id", S.source_address().alias("source_address"), S.destination_address().alias("destination_address")
    )
    return geolocate(events, S.geo_ranges(spark, sf_dir)).select(
        "event_id", "side", "place.country_code", "place.country_name", "place.city", "place.location.lat", "place.location.lon"
    )


# End to end -------------------------------------------------------------------------

_RULES = "(SELECT string_agg(rule, ' ' ORDER BY ord) FROM fired r WHERE r.id = f.event_id)"


@query("enrich_firewall", f"""WITH {T.ENRICHED} SELECT event_id, (SELECT string_agg(value, ' ' ORDER BY ord) FROM hits h
    WHERE h.id = f.event_id AND kind = 'ip') AS ips, {_RULES} AS rules,
    (SELECT string_agg(field_path || '=' || pattern, ' ' ORDER BY ord, pattern) FROM scan s WHERE s.id = f.event_id) AS patterns,
    suspicious_process, critical_asset_access, ip_count, src_country, dst_country, has_enrichment FROM found f""")
def _enrich_firewall(spark, sf_dir):
    e = F.col("forwarder_enrichment")
    return firewall_run(spark, sf_dir).events.select(
        "event_id", *_findings(), e.geoip.src.country_name.alias("src_country"),
        e.geoip.dst.country_name.alias("dst_country"), has_enrichment().alias("has_enrichment"),
    )


_SECONDS = "fw_seconds AS (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM fw_events)"


@query("enrich_by_event_time", f"""WITH {T.FW_EVENTS}, {_SECONDS}, {T.epochs('fw_seconds')},
  counted AS (SELECT f.event_id, f.source_address, f.ts, count(*) OVER (PARTITION BY source_address, epoch ORDER BY f.ts
    RANGE UNBOUNDED PRECEDING) AS n FROM fw_seconds f JOIN epoch_of e USING (event_id))
  SELECT source_address, epoch_us(ts) AS us, max(n) AS ip_count FROM counted WHERE n > {THRESHOLD} GROUP BY ALL""")
def _enrich_by_event_time(spark, sf_dir):
    """Lines read back from files all arrive at once; their counts follow the time in the line."""
    path = stage_path(spark, "landing")
    raw_lines(spark, sf_dir).select(F.col("raw").alias("value")).write.text(path)
    run = enrich_firewall(readers.read_log_lines(spark, path), indicators(spark, sf_dir), settings=Settings(threshold=THRESHOLD))
    often = F.col("forwarder_enrichment.behavioral_anomalies.high_frequency_ip.count")
    return run.events.where(often.isNotNull()).groupBy("source_address", F.unix_micros("event_ts").alias("us")).agg(F.max(often).alias("ip_count"))


@query("enrich_off", f"WITH {T.FW_EVENTS} SELECT event_id, source_address, false AS has_enrichment FROM fw_events")
def _enrich_off(spark, sf_dir):
    run = enrich_firewall(raw_lines(spark, sf_dir), indicators(spark, sf_dir), settings=Settings(enrich=False))
    return run.events.select("event_id", "source_address", has_enrichment().alias("has_enrichment"))


@query("enrichment_flags", f"WITH {T.ENRICHED} SELECT event_id, has_enrichment, has_ioc, has_anomaly, has_rule FROM found")
def _enrichment_flags(spark, sf_dir):
    return event_store(spark, sf_dir).select(
        "event_id", has_enrichment().alias("has_enrichment"), has_ioc().alias("has_ioc"),
        has_anomaly().alias("has_anomaly"), has_rule().alias("has_rule"),
    )


@query("stage_metrics", f"""WITH {T.ENRICHED} SELECT (SELECT count(*) FROM fw_raw) AS received, count(*) AS parsed,
  (SELECT count(*) FROM fw_split WHERE len(f) < 31) AS rejected, count(*) FILTER (has_enrichment) AS enriched,
  count(*) AS to_store, count(*) FILTER (has_enrichment) AS to_siem FROM found""")
def _stage_metrics(spark, sf_dir):
    return firewall_run(spark, sf_dir).metrics()


_LEAD = {"device_name": "device_name", "serial_number": "serial_number", "generated_time": "generated_time", "source_address": "src_ip",
         "destination_address": "dst_ip", "source_port": "src_port", "destination_port": "dst_port", "action": "action", "application": "application"}
_SIEM = f"""quoted AS (SELECT event_id, name, CASE WHEN contains(value, ' ') OR contains(value, '"')
    THEN '"' || replace(value, '"', '\\"') || '"' ELSE value END AS value FROM fw_values),
ranked AS (SELECT event_id, CASE name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LEAD.items())} ELSE name END || '=' || value AS pair, name,
    CASE name {" ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(_LEAD))} ELSE 100 END AS rank FROM quoted WHERE name NOT IN ('@timestamp', 'log_source')),
siem AS (SELECT event_id, '<134>PaloAlto: ' || string_agg(pair, ' ' ORDER BY rank, name)
    || ' enrich_intel_last_updated=2024-02-01T00:00:00+00:00' AS line FROM ranked SEMI JOIN (SELECT * FROM found WHERE has_enrichment) USING (event_id) GROUP BY event_id)"""


@query("siem_lines", f"WITH {T.ENRICHED}, {_SIEM} SELECT event_id, line FROM siem")
def _siem_lines(spark, sf_dir):
    return firewall_run(spark, sf_dir).siem_lines()


@query("siem_output", f"WITH {T.ENRICHED}, {_SIEM} SELECT line FROM siem")
def _siem_output(spark, sf_dir):
    path = stage_path(spark, "siem")
    sinks.write_siem_syslog(event_store(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("json_output", f"""WITH {T.FW_SPLIT} SELECT '{{' || string_agg(CAST(to_json(name) AS VARCHAR) || ':' || CASE WHEN is_text
    THEN CAST(to_json(value) AS VARCHAR) ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END, ',' ORDER BY name) || '}}' AS json
  FROM fw_values GROUP BY event_id""")
def _json_output(spark, sf_dir):
    path = stage_path(spark, "events-json")
    run = enrich_firewall(raw_lines(spark, sf_dir), indicators(spark, sf_dir), settings=Settings(enrich=False))
    sinks.write_events_json(run.events, path)
    return spark.read.text(path).select(F.col("value").alias("json"))


@query("json_output_enriched", f"WITH {T.ENRICHED} SELECT session_id, CAST(n_rules AS INTEGER) AS n_rules, ip_count, src_country FROM found")
def _json_output_enriched(spark, sf_dir):
    """Findings as they stand in the JSON of the enriched events."""
    path = stage_path(spark, "enriched-json")
    sinks.write_events_json(event_store(spark, sf_dir), path)
    v, found = spark.read.text(path).select(F.parse_json("value").alias("v")), "$.forwarder_enrichment"
    rules = F.try_variant_get("v", f"{found}.threat_hunting.correlation_rules", "array<variant>")
    return v.select(
        F.try_variant_get("v", "$.session_id", "bigint").alias("session_id"), F.coalesce(F.size(rules), F.lit(0)).alias("n_rules"),
        F.try_variant_get("v", f"{found}.behavioral_anomalies.high_frequency_ip.count", "bigint").alias("ip_count"),
        F.try_variant_get("v", f"{found}.geoip.src.country_name", "string").alias("src_country"),
    )


@query("json_output_packets", f"""WITH {_PACKET_LEAVES}, {T.fired('pk_text')} SELECT source_address, destination_address, CAST(bytes AS VARCHAR) AS frame_len,
  (SELECT CAST(count(*) AS INTEGER) FROM fired r WHERE r.id = f.event_id) AS n_rules FROM flows f""")
def _json_output_packets(spark, sf_dir):
    path = stage_path(spark, "packets-json")
    sinks.write_events_json(enrich_packets(packets(spark, sf_dir), indicators(spark, sf_dir), None, Settings(threshold=THRESHOLD)), path)
    v = spark.read.text(path).select(F.parse_json("value").alias("v"))
    rules = F.try_variant_get("v", "$.forwarder_enrichment.threat_hunting.correlation_rules", "array<variant>")
    return v.select(
        *[F.try_variant_get("v", f"$.{name}", "string").alias(name) for name in ("source_address", "destination_address")],
        F.try_variant_get("v", "$.frame.frame_frame_len", "string").alias("frame_len"), F.coalesce(F.size(rules), F.lit(0)).alias("n_rules"),
    )


_OWN_PATTERN, _OWN_RULE = r"(?i)th[ae]\w+ing", r"(?i)(whre|andnd)"


@query("rule_pack_own", f"""WITH {T.DOC_TEXT} SELECT id AS event_id, 'pattern' AS what, path || ' ' || left(value, 100) AS value FROM doc_leaves
  WHERE regexp_matches(value, {T.q(_OWN_PATTERN)}) UNION ALL SELECT id, 'rule', 'own' FROM doc_text WHERE regexp_matches(joined, {T.q(_OWN_RULE)})
  UNION ALL SELECT id, 'process', 'ststion' FROM doc_text WHERE contains(lower(joined), 'ststion')""")
def _rule_pack_own(spark, sf_dir):
    """A user's own pattern, rule and word in place of the published ones."""
    pack = RulePack(patterns={"mine": _OWN_PATTERN}, processes=("ststion",), assets=(), rules={"own": _OWN_RULE}).validate(spark)
    hunted = hunt(*documents(spark, sf_dir), pack)
    found = [
        pattern_rows(hunted).select("event_id", F.lit("pattern").alias("what"), F.concat("field_path", F.lit(" "), "sample").alias("value")),
        rule_rows(hunted).select("event_id", F.lit("rule").alias("what"), F.col("rule").alias("value")),
        keyword_rows(hunted).select("event_id", F.lit("process").alias("what"), F.col("suspicious_process").alias("value")),
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("firewall_floats", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 1500.0::DOUBLE WHEN 1 THEN -2.25 WHEN 2 THEN 0.0 WHEN 4 THEN 0.5 END AS time,
  CASE WHEN event_id % 5 = 3 THEN 'abc' END AS kept FROM events""")
def _firewall_floats(spark, sf_dir):
    """Lines long enough to reach a float field, with numbers, a special value and a text in it."""
    at = TRAFFIC_POSITIONS["high_resolution_timestamp"]
    fixed = {0: "1", 1: "2024/01/02 03:04:05", 3: "TRAFFIC", 6: "2024/01/02 03:04:05"}
    number = S.pick(["1.5e3", "-2.25", "nan", "abc", "0.5"], F.col("event_id") % 5)
    raw = F.concat_ws(",", *[number if i == at else F.lit(fixed.get(i, "")) for i in range(at + 2)])
    events = normalize_firewall(S.table(spark, sf_dir, "events").select("event_id", raw.alias("raw")))[0]
    name = "high_resolution_timestamp"
    return events.select("event_id", F.col(name).alias("time"), F.try_element_at("unparsed", F.lit(name)).alias("kept"))


@query("read_log_lines", f"WITH {T.FW_RAW} SELECT raw FROM fw_raw")
def _read_log_lines(spark, sf_dir):
    path = stage_path(spark, "lines")
    raw = raw_lines(spark, sf_dir).select(F.concat(F.lit("\t"), "raw", F.lit(" \n   ")).alias("value"))
    raw.write.text(path)
    return readers.read_log_lines(spark, path).select("raw")


@query("read_packets", f"WITH {_PACKETS} SELECT count(*) FILTER (event_id % 50 NOT IN (4, 5)) AS packets FROM events")
def _read_packets(spark, sf_dir):
    path = stage_path(spark, "packets")
    S.packet_lines(spark, sf_dir).select(F.col("raw").alias("value")).write.text(path)
    return readers.read_packets(spark, path)[0].agg(F.count("*").alias("packets"))


@query("read_feeds", f"WITH {T.FEED_LINES} SELECT feed, kind, value FROM feed_values")
def _read_feeds(spark, sf_dir):
    path = stage_path(spark, "feeds")
    S.feed_lines(spark, sf_dir).select("feed", F.col("line").alias("value")).write.partitionBy("feed").text(path)
    kinds = {"addresses-a": "ip", "addresses-b": "ip", "urls": "url", "hosts": "domain", "digests": "hash"}
    return readers.read_feeds(spark, [{"feed": f, "kind": k, "path": f"{path}/feed={f}"} for f, k in kinds.items()])


def _read_json(name: str, reader, log_type: str) -> None:
    @query(name, f"SELECT event_id, event_type, '{log_type}' AS log_type FROM events")
    def _run(spark, sf_dir):
        path = stage_path(spark, name)
        S.table(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "event_type", "ts")).alias("value")).write.text(path)
        good, _ = reader(spark, path)
        return good.select(
            F.try_variant_get("event", "$.event_id", "bigint").alias("event_id"),
            F.try_variant_get("event", "$.event_type", "string").alias("event_type"), "log_type",
        )


_read_json("read_alerts", readers.read_alerts, "wazuh_alert")
_read_json("read_events_json", readers.read_events_json, "prodepa_json")


# Routing ------------------------------------------------------------------------------

_INDEX = """CASE log_type WHEN 'wazuh_alert' THEN 'wazuh-alerts-' WHEN 'prodepa_json' THEN 'prodepa-logs-' WHEN 'fortigate_raw' THEN 'fortigate-raw-'
  WHEN 'tshark' THEN 'prodepa-logs-' ELSE 'unclassified-logs-' END || strftime(at_ts, '%Y.%m.%d')"""


@query("route_events", f"WITH {T.COLLECTED} SELECT event_id, log_type, epoch_us(at_ts) AS at_us, {_INDEX} AS index_name FROM dated")
def _route_events(spark, sf_dir):
    return routing.route(S.collected_logs(spark, sf_dir)).select(
        "event_id", "log_type", F.unix_micros("at_timestamp").alias("at_us"), "index_name"
    )


@query("route_daily", f"""WITH {T.COLLECTED} SELECT event_id, log_type, {_INDEX} AS index_name,
  CASE WHEN log_type = 'fortigate_raw' THEN 'fw ' || (event_id % 7) END AS devname FROM dated""")
def _route_daily(spark, sf_dir):
    path = stage_path(spark, "routed")
    sinks.write_routed(routing.route(S.collected_logs(spark, sf_dir)), path)
    return spark.read.parquet(path).select("event_id", "log_type", "index_name", F.try_element_at("kv", F.lit("devname")).alias("devname"))


@query("route_json", f"""WITH {T.COLLECTED} SELECT event_id, log_type, {_INDEX} AS index_name, epoch_us(at_ts) AS at_us,
  CASE WHEN log_type = 'fortigate_raw' THEN 'fw ' || (event_id % 7) END AS devname,
  CASE WHEN log_type = 'fortigate_raw' THEN '134' END AS syslog_pri FROM dated""")
def _route_json(spark, sf_dir):
    """JSON documents with what the collector has added to each."""
    path = stage_path(spark, "routed-json")
    logs = S.collected_logs(spark, sf_dir)
    sinks.write_routed(routing.route(logs.withColumn("event", F.parse_json(F.to_json(F.struct("event_id", "message", "timestamp"))))), path)
    rows = spark.read.text(path).withColumn("v", F.parse_json("value"))
    part = lambda key, kind: F.try_variant_get("v", f"$['{key}']", kind)
    return rows.select(
        part("event_id", "bigint").alias("event_id"), part("log_type", "string").alias("log_type"), "index_name",
        F.unix_micros(part("@timestamp", "string").cast("timestamp")).alias("at_us"), part("devname", "string").alias("devname"),
        part("syslog_pri", "string").alias("syslog_pri"),
    )


@query("kv_logs", f"""WITH {T.COLLECTED} SELECT event_id, '134' AS syslog_pri, 'fw ' || (event_id % 7) AS devname, {T.SRC} AS srcip,
  'close' AS action, CAST(user_id AS VARCHAR) AS user FROM collected WHERE event_type = 'signup'""")
def _kv_logs(spark, sf_dir):
    rows = routing.normalize_kv_logs(S.collected_logs(spark, sf_dir)).where("kv is not null")
    return rows.select("event_id", "syslog_pri", *[F.element_at("kv", k).alias(k) for k in ("devname", "srcip", "action", "user")])


@query("tagged_alerts", "SELECT event_id, 'wazuh_alert' AS log_type, 'wazuh-alerts-' || strftime(ts, '%Y.%m.%d') AS index_name FROM events")
def _tagged_alerts(spark, sf_dir):
    rows = S.collected_logs(spark, sf_dir).select("event_id", "at_timestamp")
    return routing.route(routing.tag_log_type(rows, routing.ALERT_TYPE)).select("event_id", "log_type", "index_name")


# Reports -------------------------------------------------------------------------------


@query("stored_report", f"""WITH {T.FW_EVENTS} SELECT source_address, count(*) AS count FROM fw_events
  WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-12' AND source_address IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def _stored_report(spark, sf_dir):
    """A report on one week of a store by days opens only that week's folders."""
    path = stage_path(spark, "store-by-day")
    sinks.write_event_store(event_store(spark, sf_dir), path)
    week = store.read_event_store(spark, path, dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 12))
    return reports.top_source_ips(week)


@query("read_geo", f"""WITH sides AS (SELECT event_id, 'src' AS side, {T.SRC} AS address FROM events UNION ALL
  SELECT event_id, 'dst', {T.DST} FROM events), {T.located('sides')} SELECT event_id, side, country_name, lat, lon FROM located""")
def _read_geo(spark, sf_dir):
    """The range table through a CSV file."""
    path = stage_path(spark, "geo") + ".csv"
    S.geo_ranges(spark, sf_dir).write.option("header", True).csv(path)
    events = S.table(spark, sf_dir, "events").select(
        "event_id", S.source_address().alias("source_address"), S.destination_address().alias("destination_address")
    )
    return geolocate(events, readers.read_geo(spark, path)).select("event_id", "side", "place.country_name", "place.location.lat", "place.location.lon")


@query("geo_packets", f"""WITH {_PACKETS}, sides AS (SELECT event_id, 'src' AS side, source_address AS address FROM flows WHERE ip_version = 4 UNION ALL
  SELECT event_id, 'dst', destination_address FROM flows WHERE ip_version = 4), {T.located('sides')}
  SELECT event_id, side, country_name, lat, lon FROM located UNION ALL
  SELECT event_id, 'src', coalesce(country_name, 'Unknown'), CASE WHEN lat IS NULL OR lon IS NULL THEN 0.0 ELSE lat END,
    CASE WHEN lat IS NULL OR lon IS NULL THEN 0.0 ELSE lon END FROM flows, geo WHERE ip_version = 6 AND ip_lo = '2a00::'""")
def _geo_packets(spark, sf_dir):
    """Flows of both families; link-local addresses have no place."""
    flows = normalize_packets(packets(spark, sf_dir))
    return geolocate(flows, S.geo_ranges(spark, sf_dir)).select("event_id", "side", "place.country_name", "place.location.lat", "place.location.lon")


@query("geo_rejects", "SELECT 'an end is no address' AS reason, count(*) AS ranges FROM supplier WHERE s_suppkey % 3 = 0 "
                      "UNION ALL SELECT 'ends of two families', count(*) FROM supplier WHERE s_suppkey % 3 = 1")
def _geo_rejects(spark, sf_dir):
    """Ranges with one end that is no address, or of another family; every third one is right."""
    n = F.col("s_suppkey") % 250
    rows = S.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("10.0.0."), n.cast("string")).alias("ip_lo"),
        F.when(F.col("s_suppkey") % 3 == 0, "none").when(F.col("s_suppkey") % 3 == 1, "2001::1").otherwise("10.0.1.0").alias("ip_hi"),
    )
    return rejected_ranges(rows).groupBy("reason").agg(F.count("*").alias("ranges"))


_HOUR = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')"
_SPINE = f"""hours AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM found GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM hours)"""


def _top(col: str, k: int, where: str = "true", name: str | None = None) -> str:
    return (f"SELECT {col} AS {name or col}, count(*) AS count FROM found WHERE {col} IS NOT NULL AND {where} "
            f"GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {k}")


@query("events_over_time", f"WITH {T.ENRICHED}, {_SPINE} SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(n, 0) AS count FROM spine LEFT JOIN hours USING (h)")
def _events_over_time(spark, sf_dir):
    return reports.events_over_time(event_store(spark, sf_dir)).select(stamp("bucket").alias("bucket"), "count")


@query("action_distribution", f"""WITH {T.ENRICHED}, c AS (SELECT action, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, action) AS r
  FROM found WHERE action IS NOT NULL GROUP BY action) SELECT CASE WHEN r <= 10 THEN action ELSE 'Other' END AS action, CAST(sum(n) AS BIGINT) AS count, r > 10 AS is_other FROM c GROUP BY 1, 3""")
def _action_distribution(spark, sf_dir):
    return reports.action_distribution(event_store(spark, sf_dir))


@query("top_source_ips", f"WITH {T.ENRICHED} {_top('source_address', 15)}")
def _top_source_ips(spark, sf_dir):
    return reports.top_source_ips(event_store(spark, sf_dir))


@query("top_applications", f"WITH {T.ENRICHED} {_top('application', 15)}")
def _top_applications(spark, sf_dir):
    return reports.top_applications(event_store(spark, sf_dir))


@query("top_destination_ports", f"WITH {T.ENRICHED} {_top('destination_port', 15)}")
def _top_destination_ports(spark, sf_dir):
    return reports.top_destination_ports(event_store(spark, sf_dir))


@query("threat_hits_over_time", f"WITH {T.ENRICHED} SELECT {_HOUR} AS bucket, count(*) AS count FROM found WHERE has_ioc GROUP BY 1")
def _threat_hits_over_time(spark, sf_dir):
    return reports.threat_hits_over_time(event_store(spark, sf_dir)).select(stamp("bucket").alias("bucket"), "count")


@query("top_blocklisted_sources", f"WITH {T.ENRICHED} {_top('source_address', 20, 'has_ioc')}")
def _top_blocklisted_sources(spark, sf_dir):
    return reports.top_blocklisted_sources(event_store(spark, sf_dir))


@query("anomalies_over_time", f"WITH {T.ENRICHED} SELECT {_HOUR} AS bucket, count(*) AS count FROM found WHERE has_anomaly GROUP BY 1")
def _anomalies_over_time(spark, sf_dir):
    return reports.anomalies_over_time(event_store(spark, sf_dir)).select(stamp("bucket").alias("bucket"), "count")


@query("rules_fired", f"WITH {T.ENRICHED} SELECT rule, count(DISTINCT id) AS count FROM fired GROUP BY rule ORDER BY 2 DESC, 1 LIMIT 20")
def _rules_fired(spark, sf_dir):
    return reports.rules_fired(event_store(spark, sf_dir))


@query("source_countries", f"WITH {T.ENRICHED} {_top('src_country', 20, name='country_name')}")
def _source_countries(spark, sf_dir):
    return reports.source_countries(event_store(spark, sf_dir))


@query("overview_report", f"""WITH {T.ENRICHED}, {_SPINE}, c AS (SELECT action, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, action) AS r
    FROM found WHERE action IS NOT NULL GROUP BY action)
  SELECT 'events_over_time' AS report, strftime(h, '%Y-%m-%d %H:%M:%S') AS value, coalesce(n, 0) AS count FROM spine LEFT JOIN hours USING (h)
  UNION ALL SELECT 'action_distribution', CASE WHEN r <= 10 THEN action ELSE 'Other' END, CAST(sum(n) AS BIGINT) FROM c GROUP BY 2
  UNION ALL SELECT 'top_source_ips', * FROM ({_top('source_address', 15)})
  UNION ALL SELECT 'top_applications', * FROM ({_top('application', 15)})
  UNION ALL SELECT 'top_destination_ports', * FROM ({_top('CAST(destination_port AS VARCHAR)', 15, name='p')})""")
def _overview_report(spark, sf_dir):
    return reports.overview_report(event_store(spark, sf_dir))


@query("threat_report", f"""WITH {T.ENRICHED}
  SELECT 'threat_hits_over_time' AS report, {_HOUR} AS value, count(*) AS count FROM found WHERE has_ioc GROUP BY ALL
  UNION ALL SELECT 'anomalies_over_time', {_HOUR}, count(*) FROM found WHERE has_anomaly GROUP BY ALL
  UNION ALL SELECT 'top_blocklisted_sources', * FROM ({_top('source_address', 20, 'has_ioc')})
  UNION ALL SELECT 'rules_fired', * FROM (SELECT rule, count(*) FROM fired GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)
  UNION ALL SELECT 'source_countries', * FROM ({_top('src_country', 20, name='c')})
  UNION ALL SELECT 'top_applications', * FROM ({_top('application', 15)})""")
def _threat_report(spark, sf_dir):
    return reports.threat_report(event_store(spark, sf_dir))


@query("top_terms", "SELECT lang AS value, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def _top_terms(spark, sf_dir):
    return reports.top_terms(S.table(spark, sf_dir, "documents"), "lang", 3)


# Alerts ---------------------------------------------------------------------------------


def _alert_queries(rule: alerts.AlertRule, flag: str) -> None:
    step = rule.every_minutes * 60
    run = f"(epoch_us(ts) // {step * 1000000} + 1) * {step}"
    hits = f"hits_of AS (SELECT event_id, ts, {run} AS run FROM found WHERE {flag})"

    @query(f"alert_{rule.field}", f"""WITH {T.ENRICHED}, {hits},
      runs AS (SELECT run, count(*) AS new_hits FROM hits_of GROUP BY run)
      SELECT run AS run_s, new_hits, (SELECT count(*) FROM hits_of h WHERE epoch_us(h.ts) >= (r.run - 300) * 1000000
        AND epoch_us(h.ts) < r.run * 1000000) AS window_hits FROM runs r""")
    def _runs(spark, sf_dir):
        return alerts.alert_runs(event_store(spark, sf_dir), rule).select(
            F.unix_seconds("run_ts").alias("run_s"), "new_hits", "window_hits"
        )

    @query(f"alert_hits_{rule.field}", f"""WITH {T.ENRICHED}, {hits} SELECT event_id, run AS run_s,
      CAST(row_number() OVER (PARTITION BY run ORDER BY ts DESC, event_id) AS INTEGER) AS hit FROM hits_of
      QUALIFY hit <= 100""")
    def _hits(spark, sf_dir):
        return alerts.reported_hits(event_store(spark, sf_dir), rule).select(
            "event_id", F.unix_seconds("run_ts").alias("run_s"), "hit"
        )


for _rule, _flag_name in ((alerts.IOC_ALERT, "has_ioc"), (alerts.ANOMALY_ALERT, "has_anomaly"), (alerts.RULE_ALERT, "has_rule")):
    _alert_queries(_rule, _flag_name)
