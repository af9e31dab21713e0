"""Registered queries against their SQL twins on the smallest sample."""

import pytest

import __spark_entry__ as entry
from checks.catalog import QUERIES, TWINS
from checks.run import compare

SMALL = "/root/testdata/sf0.001"
PICKED = [
    "normalize_firewall", "reject_firewall", "firewall_field_values", "match_firewall", "match_pages", "hunt_patterns_documents",
    "hunt_rules_firewall", "packet_leaves", "enrich_packets", "enrich_firewall", "running_counts", "activity_epochs", "sliding_counts",
    "geo_join", "siem_lines", "json_output", "route_daily", "threat_report", "overview_report", "alert_rule", "public_ip_v6", "read_feeds",
    "indicator_refresh", "packet_metrics", "ioc_extract_long", "hunt_patterns_long", "enrich_by_event_time", "route_json", "stored_report", "geo_rejects",
    "sliding_anomalies", "line_ids", "match_as_of", "stream_flags", "stream_sliding", "stream_hits", "stream_late", "rollup_overview", "stream_store",
]


@pytest.mark.parametrize("name", PICKED)
def test_query_equals_its_twin(spark, name):
    assert compare(spark, SMALL, name).startswith("ok")


def test_contract(spark):
    assert QUERIES.keys() <= entry.queries().keys() and TWINS.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
    assert set(TWINS) == set(QUERIES)
    first = entry.entry(spark)
    assert first.columns == ["source_address", "count"] and first.count() > 0
