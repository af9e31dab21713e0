"""Time the headline queries and print one JSON line.

``enrich_firewall`` is the whole job from raw lines to enriched events; the reports and
alerts then read the written event table, as dashboards do. Every query is run to the end
with all its columns. Writing the sample lines is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "normalize_firewall", "ioc_extract_firewall", "match_firewall", "hunt_patterns_firewall",
    "running_counts", "sliding_counts", "geo_join", "indicator_build", "enrich_firewall", "siem_output",
    "normalize_packets", "enrich_packets", "hunt_rules_documents", "ioc_extract_documents", "route_daily",
    "events_over_time", "action_distribution", "top_source_ips", "top_applications", "top_destination_ports",
    "threat_hits_over_time", "top_blocklisted_sources", "anomalies_over_time", "rules_fired", "source_countries",
    "overview_report", "threat_report", "alert_ioc", "alert_rule",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from checks import catalog

    catalog.configure(spark)
    catalog.raw_lines(spark, sf_dir)
    catalog.packets(spark, sf_dir)
    catalog.feeds(spark, sf_dir)
    catalog.event_store(spark, sf_dir)
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    slope = {}
    smaller = sf_dir.replace("sf0.1", "sf0.01")
    if smaller != sf_dir and os.path.isdir(smaller):
        # The same job, compiled by now, on all events and on a tenth: what it takes besides its rows, and for each row.
        again = {}
        for folder in (smaller, sf_dir):
            start = time.time()
            catalog.QUERIES["enrich_firewall"](spark, folder).write.format("noop").mode("overwrite").save()
            again[folder] = time.time() - start
        fewer = spark.read.parquet(f"{smaller}/events.parquet").count()
        slope = {
            "enrich_again_sec": round(again[sf_dir], 3), "enrich_small_sec": round(again[smaller], 3),
            "enrich_ms_per_event": round(1000 * (again[sf_dir] - again[smaller]) / (events - fewer), 4),
        }
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "events": events,
        "enrich_events_per_sec": round(events / seconds["enrich_firewall"]), "spark": spark.version,
    } | slope))
    spark.stop()


if __name__ == "__main__":
    main()
