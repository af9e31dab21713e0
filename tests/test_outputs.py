"""Routing, reports, alerts, sources and sinks."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidewatch.operators import alerts, reports, routing
from tidewatch.plans.enrich import enrich_firewall
from tidewatch.schema import ENRICHMENT_FIELD, ENRICHMENT_TYPE
from tidewatch.operators.match import match_indicators
from tidewatch.session import setting
from tidewatch.sources import readers, sinks, store
from tidewatch.sources.sinks import write_event_store
from tidewatch.sources.snapshots import expire_snapshots, indicator_history, newest_version, publish_snapshot, read_snapshot

import pytest


def test_routing(spark, tmp_path):
    rows = [(1, "wazuh_alert", "2030-02-03T04:05:06Z", ""), (2, "prodepa_json", "not a date", ""), (3, "tshark", None, ""), (4, "other", "2030-02-03T04:05:06.5+02:00", ""),
            (5, "fortigate_raw", None, '<13>a=1 b="x y" c= a=2 d="" junk e=f=g'), (6, "fortigate_raw", None, "no header"), (7, None, None, "")]
    frame = spark.createDataFrame(rows, "event_id int, log_type string, timestamp string, message string").withColumn("at_timestamp", F.lit("2030-01-01 00:00:00").cast("timestamp"))
    got = {r.event_id: r for r in routing.route(frame).collect()}
    assert got[1].index_name == "wazuh-alerts-2030.02.03" and got[2].index_name == "prodepa-logs-2030.01.01" and got[3].index_name == "prodepa-logs-2030.01.01"
    assert got[4].index_name == "unclassified-logs-2030.02.03" and got[4].at_timestamp == dt.datetime(2030, 2, 3, 2, 5, 6, 500000)
    assert got[5].index_name == "fortigate-raw-2030.01.01" and got[5].syslog_pri == "13" and got[5].kv == {"a": "2", "b": "x y", "c": "", "d": "", "e": "f=g"}
    assert got[6].kv is None and got[7].index_name == "unclassified-logs-2030.01.01"
    sinks.write_routed(routing.route(frame).drop("kv"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("index_name = 'prodepa-logs-2030.01.01'").count() == 2


def test_lines_and_json_sources(spark, tmp_path):
    (tmp_path / "l.txt").write_bytes(b"  one \r\n\n\xff two\n \t \n")
    rows = readers.read_log_lines(spark, str(tmp_path / "l.txt")).collect()
    assert [r.raw for r in rows] == ["one", "� two"] and len({r.event_id for r in rows}) == 2
    (tmp_path / "j.txt").write_text('{"message":"m","timestamp":"2030-01-02T00:00:00Z","n":1}\n{bad\n')
    (tmp_path / "l2.txt").write_text("one\n")
    again = readers.read_log_lines(spark, str(tmp_path / "l.txt")).collect()
    other = readers.read_log_lines(spark, str(tmp_path / "l2.txt"), options={"encoding": "UTF-8"}).collect()
    assert {r.event_id for r in again} == {r.event_id for r in rows} and other[0].event_id not in {r.event_id for r in rows}
    good, bad = readers.read_alerts(spark, str(tmp_path / "j.txt"))
    assert good.first()["log_type"] == "wazuh_alert" and [r.raw for r in bad.collect()] == ["{bad"]
    routed = routing.route(readers.json_columns(good))
    assert routed.first()["index_name"] == "wazuh-alerts-2030.01.02"
    sinks.write_routed(routed, str(tmp_path / "out"))
    written = json.loads(spark.read.text(str(tmp_path / "out")).first()["value"])
    assert written == {"message": "m", "timestamp": "2030-01-02T00:00:00Z", "n": 1, "log_type": "wazuh_alert", "@timestamp": "2030-01-02T00:00:00+00:00"}
    good, _ = readers.read_events_json(spark, str(tmp_path / "j.txt"))
    assert good.first()["log_type"] == "prodepa_json"


def enriched(spark, rows):
    """rows: (second, source, action, port, ioc, anomaly, rules)"""
    data = [(i, dt.datetime(2030, 1, 1) + dt.timedelta(seconds=r[0]), *r[1:]) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(data, "event_id int, ingest_ts timestamp, source_address string, action string, destination_port bigint, ioc boolean, anomaly boolean, rules array<string>")
    return frame.withColumn("application", F.col("action")).withColumn(ENRICHMENT_FIELD, F.expr(f"""if(ioc or anomaly or rules is not null, cast(named_struct(
      'behavioral_anomalies', if(anomaly, named_struct('high_frequency_ip', named_struct('count', 11L, 'time_window_minutes', 5), 'l', null, 'u', null), null),
      'geoip', null, 'intel_last_updated', 'now',
      'ioc_matches', if(ioc, named_struct('d', null, 'h', null, 'i', null, 'u', array('x')), null),
      'threat_hunting', if(rules is not null, named_struct('r', transform(rules, r -> named_struct('pattern', 'p', 'rule', r)), 'a', null, 's', null, 'p', null), null))
      as {ENRICHMENT_TYPE}), null)"""))


ROWS = ([(i * 600, f"s{i % 30:02d}", f"a{i % 12:02d}" if i % 5 else None, i % 40, i % 3 == 0, i % 4 == 0, ["r1", "r1", "r2"] if i % 2 else None) for i in range(120)]
        + [(200_000, "s00", "Other", None, False, False, None)])


def test_reports(spark):
    frame = enriched(spark, ROWS)
    ports = reports.top_destination_ports(frame).collect()
    assert [(r.destination_port, r["count"]) for r in ports] == [(p, 3) for p in range(15)]
    top = {(r.action, r.is_other): r["count"] for r in reports.action_distribution(frame).collect()}
    assert len(top) == 11 and sum(top.values()) == 97 and top["a00", False] == 8 and top["Other", True] == 17
    timeline = reports.events_over_time(frame).collect()
    assert len(timeline) == 56 and sum(r["count"] for r in timeline) == 121 and sum(r["count"] == 0 for r in timeline) == 35
    hits = reports.threat_hits_over_time(frame).collect()
    assert len(hits) == 20 and sum(r["count"] for r in hits) == 40
    assert {r.rule: r["count"] for r in reports.rules_fired(frame).collect()} == {"r1": 60, "r2": 60}
    assert reports.source_countries(frame).count() == 0
    overview = {(r.report, r.value): r["count"] for r in reports.overview_report(frame).collect()}
    assert overview["action_distribution", "Other"] == 17 and overview["top_source_ips", "s00"] == 5
    assert sum(1 for name, _ in overview if name == "events_over_time") == 56
    threats = {(r.report, r.value): r["count"] for r in reports.threat_report(frame).collect()}
    assert threats["rules_fired", "r2"] == 60 and threats["anomalies_over_time", "2030-01-01 00:00:00"] == 2
    assert sum(n for (name, _), n in threats.items() if name == "top_blocklisted_sources") == 40
    empty = reports.events_over_time(frame.where("false"))
    assert empty.count() == 0


def test_topic_records_are_named_by_their_offset(spark):
    records = spark.createDataFrame([("t", 0, i, f"line {i % 2}".encode()) for i in range(4)], "topic string, partition int, offset long, value binary").withColumn("timestamp", F.current_timestamp())
    lines = readers.with_event_ids(readers.clean_lines(readers.topic_columns(records)))
    assert len({r.event_id for r in lines.collect()}) == 4 and {r.event_id for r in lines.collect()} == {r.event_id for r in lines.repartition(3).collect()}


def test_a_far_off_time_does_not_break_the_timeline(spark):
    rows = spark.sql("select timestamp'2030-01-01 00:10:00' as ingest_ts union all select timestamp'2230-01-01 00:10:00'")
    assert reports.events_over_time(rows).agg(F.count("*"), F.sum("count")).first()[:] == ((dt.date(2230, 1, 1) - dt.date(2030, 1, 1)).days * 24 + 1, 2)


def test_staged_tables_of_a_run_are_removed(spark):
    lines = spark.createDataFrame([(1, "no log")], "event_id bigint, raw string")
    indicators = spark.createDataFrame([], "kind string, value string, sources array<string>, source_count int, last_updated timestamp")
    with enrich_firewall(lines, indicators) as run:
        assert run.rejects.count() == 1 and all(os.path.isdir(p.removeprefix("file:")) for p in run.paths) and len(run.paths) > 2
    assert not any(os.path.isdir(p.removeprefix("file:")) for p in run.paths)


def test_alerts(spark):
    frame = enriched(spark, [(t, "s", "a", 1, True, False, ["r"]) for t in (0, 59, 60, 61, 299, 301, 900)])
    runs = {r.run_ts.minute: (r.new_hits, r.window_hits) for r in alerts.alert_runs(frame, alerts.IOC_ALERT).collect()}
    assert runs == {1: (2, 2), 2: (2, 4), 5: (1, 5), 6: (1, 4), 16: (1, 1)}
    runs = {r.run_ts.minute: (r.new_hits, r.window_hits) for r in alerts.alert_runs(frame, alerts.RULE_ALERT).collect()}
    assert runs == {2: (4, 4), 6: (2, 4), 16: (1, 1)}
    assert alerts.alert_runs(frame, alerts.ANOMALY_ALERT).count() == 0
    assert alerts.alert_hits(frame, alerts.IOC_ALERT).count() == 7
    many = enriched(spark, [(i % 50, "s", "a", 1, True, False, None) for i in range(250)])
    listed = alerts.reported_hits(many, alerts.IOC_ALERT).collect()
    assert len(listed) == 100 and min(r.ingest_ts.second for r in listed) == 30


def test_indicator_versions(spark, tmp_path):
    root = str(tmp_path / "intel")
    assert newest_version(spark, root) is None
    with pytest.raises(RuntimeError, match="no indicators"):
        read_snapshot(spark, root)
    for n in (1, 2):
        publish_snapshot(spark.range(n), root)
    assert read_snapshot(spark, root).count() == 2


def test_versions_expire_and_history_keeps_runs(spark, tmp_path):
    root = str(tmp_path / "intel")
    table = spark.createDataFrame(
        [("ip", v, ["a"], 1, dt.datetime(2030, 1, 1)) for v in "xyz"], "kind string, value string, sources array<string>, source_count int, last_updated timestamp")
    days = [dt.datetime(2030, 1, d) for d in (1, 2, 3, 4)]
    for at, kept in zip(days, ("xyz", "xy", "xz", "xz")):
        publish_snapshot(table.where(F.col("value").isin(list(kept))), root, at)
    def spans():
        return sorted((r.value, r.valid_from.day, r.valid_to and r.valid_to.day) for r in indicator_history(spark, root).collect())

    assert spans() == [("x", 1, None), ("y", 1, 3), ("z", 1, 2), ("z", 3, None)]
    met = spark.createDataFrame([(i, "ip", v, at) for i, (v, at) in enumerate([
        ("x", dt.datetime(2029, 12, 31)), ("y", dt.datetime(2030, 1, 2, 5)), ("y", dt.datetime(2030, 1, 3)), ("z", dt.datetime(2030, 1, 2)), ("z", dt.datetime(2031, 1, 1)), ("z", None)])],
        "event_id long, kind string, value string, ts timestamp")
    assert sorted(r.event_id for r in match_indicators(met, indicator_history(spark, root), time_col="ts").collect()) == [1, 4]
    assert expire_snapshots(spark, root, dt.datetime(2030, 1, 3, 1)) == 2
    assert spans() == [("x", 3, None), ("z", 3, None)] and len(os.listdir(f"{root}/versions")) - sum(n.startswith((".", "_")) for n in os.listdir(f"{root}/versions")) == 2
    assert expire_snapshots(spark, root, dt.datetime(2040, 1, 1)) == 0 and read_snapshot(spark, root).count() == 2


def test_line_ids_do_not_depend_on_blocks(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("".join(f"line {i % 7} of {name}\n" + ("\n" if i % 5 == 0 else "") for i in range(3000)))
    ids = []
    for size in ("4k", "16k", "128m"):
        with setting(spark, "spark.sql.files.maxPartitionBytes", size), setting(spark, "spark.sql.files.openCostInBytes", "1k"):
            rows = readers.read_log_lines(spark, str(tmp_path)).select("event_id", "raw", "src_file").collect()
        ids.append(sorted(map(tuple, rows)))
    assert ids[0] == ids[1] == ids[2] and len({r[0] for r in ids[0]}) == 6000
    one = [r[1] for r in ids[0] if r[2].endswith("a.txt")]
    assert one == [f"line {i % 7} of a" for i in range(3000)]


def test_blocks_of_lines_are_no_task_each(spark, tmp_path, monkeypatch):
    """Ids of lines are the same however many blocks a task takes."""
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(20_000)))
    monkeypatch.setattr(readers, "TASKS_A_CORE", 1)
    with setting(spark, "spark.sql.files.maxPartitionBytes", "4k"), setting(spark, "spark.sql.files.openCostInBytes", "1k"):
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 16
        rows = readers.read_log_lines(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        got = {int(r.event_id[16:], 16): r.raw for r in rows.collect()}
    assert got == {i: f"line {i}" for i in range(20_000)}


def test_packed_store_reads_like_its_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(4000).select(F.col("id").alias("event_id"), (F.timestamp_seconds(F.lit(1_900_000_000) + F.col("id") * 60)).alias("ingest_ts"))
    rows = rows.withColumn("ingest_ts", F.when(F.col("event_id") != 17, F.col("ingest_ts")))

    def held(*span):
        return sorted(r.event_id for r in store.read_event_store(spark, path, *span).collect())

    for n in range(5):
        write_event_store(rows.where(F.col("event_id") % 5 == n), f"{path}/batch={n}", mode="overwrite")
    assert store.compact_event_store(spark, path) == 4 and held() == list(range(4000))
    # The last batch is written again, then others follow; an old one that comes back is not read twice.
    write_event_store(rows.where(F.col("event_id") % 5 == 4), f"{path}/batch=4", mode="overwrite")
    write_event_store(rows.where("event_id = 5"), f"{path}/batch=5", mode="overwrite")
    assert store.compact_event_store(spark, path) == 1 and held() == sorted([*range(4000), 5])
    assert not [n for n in os.listdir(path) if n in ("batch=0", "batch=3")]
    files = [r.file for r in store._manifest(spark, path)[1].collect()]
    days = rows.select(F.to_date("ingest_ts")).distinct().count()
    assert len(files) == len(set(files)) == days
    start, end = dt.datetime(2030, 3, 18, 6), dt.datetime(2030, 3, 19, 1)
    assert held(start, end) == sorted(r.event_id for r in rows.where((F.col("ingest_ts") >= F.lit(start)) & (F.col("ingest_ts") < F.lit(end))).collect())
    assert held(dt.datetime(2040, 1, 1)) == [] and store.compact_event_store(spark, path) == 0
