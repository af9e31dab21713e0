"""Collector steps: type tags, key=value logs, event dates and daily index names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Log types and the prefix of the daily index each is written to. Packet
# events are enriched JSON events too, so they share the index of those.
# ---------------------------------------------------------------------------
ALERT_TYPE = "wazuh_alert"
JSON_TYPE = "prodepa_json"
KEY_VALUE_TYPE = "fortigate_raw"
INDEX_PREFIXES = {
    "wazuh_alert": "wazuh-alerts-",
    "prodepa_json": "prodepa-logs-",
    "fortigate_raw": "fortigate-raw-",
    "tshark": "prodepa-logs-",
}
OTHER_PREFIX = "unclassified-logs-"
# ---------------------------------------------------------------------------


def tag_log_type(events: DataFrame, log_type: str) -> DataFrame:
    return events.withColumn("log_type", F.lit(log_type))


def kv_pairs(text: Column) -> Column:
    """``a=1 b="x y"`` -> map; blanks inside quotes belong to the value, the last key wins."""
    whole = F.regexp_extract_all(text, F.lit(r'(?:^|(?<= ))([^\s=]+=(?:"[^"]*"|[^ ]*))'), 1)
    pairs = F.transform(whole, lambda p: F.struct(
        F.substring_index(p, "=", 1).alias("key"),
        F.regexp_replace(F.substr(p, F.instr(p, F.lit("=")) + 1), r'^"([^"]*)"$', "$1").alias("value"),
    ))
    keys = F.array_distinct(F.transform(pairs, lambda p: p.key))
    last = F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p.key == k), -1).value)
    return F.map_from_arrays(keys, last)


def normalize_kv_logs(events: DataFrame, message: str = "message") -> DataFrame:
    """Split ``<pri>key=value …`` messages into ``syslog_pri`` and a ``kv`` map.

    Rows of other types, and messages without that header, keep both columns null.
    """
    header = r"(?s)<([1-9][0-9]*)>(.*)"
    fits = (F.col("log_type") == KEY_VALUE_TYPE) & F.col(message).rlike(header)
    return events.withColumn(
        "syslog_pri", F.when(fits, F.regexp_extract(message, header, 1))
    ).withColumn("kv", F.when(fits, kv_pairs(F.regexp_extract(message, header, 2))))


def apply_event_date(events: DataFrame, timestamp: str = "timestamp", target: str = "at_timestamp") -> DataFrame:
    """An ISO 8601 ``timestamp`` replaces the target time; anything else leaves it as it is."""
    iso = F.when(F.col(timestamp).rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(timestamp))
    return events.withColumn(target, F.coalesce(iso, F.col(target).cast("timestamp")))


def index_name(log_type: Column, at: Column) -> Column:
    prefix = F.lit(OTHER_PREFIX)
    for name, value in INDEX_PREFIXES.items():
        prefix = F.when(log_type == name, F.lit(value)).otherwise(prefix)
    return F.concat(prefix, F.date_format(at, "yyyy.MM.dd"))


def route(events: DataFrame, at: str = "at_timestamp") -> DataFrame:
    """Key=value split, event date, then the daily index every row is written to."""
    if "message" in events.columns:
        events = normalize_kv_logs(events)
    if "timestamp" in events.columns:
        events = apply_event_date(events, target=at)
    return events.withColumn("index_name", index_name(F.col("log_type"), F.col(at)))
