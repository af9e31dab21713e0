"""Streams against the batch jobs."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidewatch.operators import alerts, reports
from tidewatch.operators.behavior import activity_epochs, behavior, behavior_keys, running_counts
from tidewatch.plans.enrich import Settings, enrich_firewall
from tidewatch.session import work_dir
from tidewatch.sources import readers, sinks, store
from tidewatch.sources.snapshots import publish_snapshot
from tidewatch.streaming.counts import STATE_STORE, ShardCounter, batch_epochs, stream_behavior, with_epoch
from tidewatch.streaming.streams import EnrichStream, StreamPaths, stream_alert_runs, stream_enrich, stream_enrich_packets, stream_flags

from tests.test_behavior_geo import events
from tests.test_detect import indicator_table
from tests.test_normalize import IP, common, packet
from tests.test_outputs import enriched

import pytest


def drain(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def staged(spark):
    """Names of the tables that streams have staged and not removed."""
    folder = f"{work_dir(spark).removeprefix('file:')}/staged"
    return {n for n in (os.listdir(folder) if os.path.isdir(folder) else []) if n.startswith("stream")}


def test_stream_feeds_alerts_and_reports_through_the_store(spark, tmp_path):
    source, intel, kept = tmp_path / "in", str(tmp_path / "intel"), str(tmp_path / "store")
    source.mkdir()
    publish_snapshot(indicator_table(spark), intel)
    lines = readers.read_log_lines(spark, str(source), streaming=True, options={"maxFilesPerTrigger": "1"})
    where = StreamPaths(**{**vars(paths(str(tmp_path / "out"))), "store": kept})
    for name, count in (("a.txt", 3), ("b.txt", 2)):
        (source / name).write_text("\n".join([common(p8="9.9.9.9")] * count) + "\n")
    drain(stream_enrich(lines, intel, where, trigger={"availableNow": True}))
    stored = store.read_event_store(spark, kept)
    assert stored.count() == 5 and stored.select("event_id").distinct().count() == 5
    assert [(r.source_address, r["count"]) for r in reports.top_blocklisted_sources(stored).collect()][0][1] == 5
    raw = spark.read.parquet(kept)
    source_stream = spark.readStream.schema(raw.schema).parquet(kept)
    # Two marks far later close the windows of the events.
    late = raw.limit(1).withColumn("ingest_ts", F.col("ingest_ts") + F.expr("interval 1 day")).drop("batch", "day")
    runs = alerts.IOC_ALERT
    query = stream_alert_runs(source_stream, runs, "ingest_ts").writeStream.format("memory").queryName("stored_runs").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "alerts")).start()
    try:
        query.processAllAvailable()
        sinks.write_event_store(late, f"{kept}/batch=90")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table("stored_runs").agg(F.sum("new_hits")).first()[0] == 5


def paths(root):
    return StreamPaths(events=f"{root}/events", state=f"{root}/state", checkpoint=f"{root}/checkpoint", rejects=f"{root}/rejects", siem=f"{root}/siem")


def test_enrichment_stream(spark, tmp_path):
    source, intel, out = tmp_path / "in", str(tmp_path / "intel"), str(tmp_path / "out")
    source.mkdir()
    lines = readers.read_log_lines(spark, str(source), streaming=True)
    with pytest.raises(RuntimeError, match="before the stream starts"):
        stream_enrich(lines, intel, paths(out))
    publish_snapshot(indicator_table(spark).where("kind <> 'ip'"), intel)
    before = staged(spark)

    def feed(name, count):
        (source / name).write_text("\n".join([common(p8="9.9.9.9", p14="web")] * count + ["not a log"]) + "\n")
        drain(stream_enrich(lines, intel, paths(out), settings=Settings(threshold=10), trigger={"availableNow": True}))

    feed("a.txt", 8)
    publish_snapshot(indicator_table(spark), intel)
    feed("b.txt", 5)
    assert staged(spark) == before
    rows = [json.loads(r.value) for r in spark.read.text(f"{out}/events").collect()]
    assert len(rows) == 13
    hits = [r for r in rows if "ioc_matches" in r.get("forwarder_enrichment", {})]
    assert len(hits) == 5 and hits[0]["forwarder_enrichment"]["ioc_matches"]["malicious_ips"][0]["ip"] == "9.9.9.9"
    counts = sorted(r["forwarder_enrichment"]["behavioral_anomalies"]["high_frequency_ip"]["count"] for r in rows
                    if "behavioral_anomalies" in r.get("forwarder_enrichment", {}))
    assert counts == [11, 12, 13]
    assert spark.read.parquet(f"{out}/rejects").count() == 2 and spark.read.text(f"{out}/siem").count() == 5


def test_packet_stream(spark, tmp_path):
    source, intel, out = tmp_path / "in", str(tmp_path / "intel"), str(tmp_path / "out")
    source.mkdir()
    publish_snapshot(indicator_table(spark), intel)
    (source / "a.txt").write_text('{"index":{}}\n' + packet(ip=IP) + "\n{broken\n")
    drain(stream_enrich_packets(readers.read_log_lines(spark, str(source), streaming=True), intel, paths(out), trigger={"availableNow": True}))
    rows = [json.loads(r.value) for r in spark.read.text(f"{out}/events").collect()]
    assert [r["forwarder_enrichment"]["ioc_matches"]["malicious_ips"][0]["ip"] for r in rows] == ["8.8.4.4"]
    assert spark.read.parquet(f"{out}/rejects").count() == 1


ROWS = [(s, "hot" if i % 3 else "cold", "u", None) for i, s in enumerate([*range(0, 60, 3), *range(500, 520), *range(860, 900, 2), 1259, 1619, 1700, 2100])]


def test_counts_go_on_over_twenty_batches_and_a_restart(spark, tmp_path):
    source, intel, out = tmp_path / "in", str(tmp_path / "intel"), str(tmp_path / "out")
    source.mkdir()
    publish_snapshot(indicator_table(spark).where("kind = 'ip'"), intel)
    settings = Settings(threshold=4, time_col="event_ts")
    times = [s for i in range(20) for s in (i * 100, i * 100 + 1, *([i * 100 + 50] * (i % 4)))]
    times = [t + (1000 if t >= 700 else 0) + (5000 if t >= 1500 else 0) for t in times]
    lines, parts = [], {}
    for n, t in enumerate(times):
        at = (dt.datetime(2030, 1, 1) + dt.timedelta(seconds=t)).strftime("%Y/%m/%d %H:%M:%S")
        lines.append(common(p6=at, p7="10.0.0.1" if n % 3 else f"10.0.0.{n % 7}", p14=f"line{n}"))
        parts.setdefault(n * 20 // len(times), []).append(lines[-1])

    def feed(numbers):
        for i in numbers:
            (source / f"{i:02d}.txt").write_text("\n".join(parts[i]) + "\n")
            os.utime(source / f"{i:02d}.txt", (1_800_000_000 + i, 1_800_000_000 + i))
        reader = readers.read_log_lines(spark, str(source), streaming=True, options={"maxFilesPerTrigger": "1"})
        drain(stream_enrich(reader, intel, where, settings=settings, trigger={"availableNow": True}))

    where = StreamPaths(events=f"{out}/events", state=f"{out}/state", checkpoint=f"{out}/checkpoint")
    feed(range(9))
    feed(range(9, 20))
    (tmp_path / "all.txt").write_text("\n".join(lines) + "\n")
    with enrich_firewall(readers.read_log_lines(spark, str(tmp_path / "all.txt")), indicator_table(spark), settings=settings) as run:
        want = sorted(json.dumps(r["forwarder_enrichment"]["behavioral_anomalies"], sort_keys=True) + r["source_zone"] for r in
                      (json.loads(r.value) for r in run.events.select(sinks.event_json(run.events).alias("value")).collect()) if "behavioral_anomalies" in r.get("forwarder_enrichment", {}))
    got = [json.loads(r.value) for r in spark.read.text(f"{out}/events").collect()]
    assert len(got) == len(times)
    assert sorted(json.dumps(r["forwarder_enrichment"]["behavioral_anomalies"], sort_keys=True) + r["source_zone"] for r in got if "behavioral_anomalies" in r.get("forwarder_enrichment", {})) == want
    assert len(want) > 20 and not os.listdir(f"{out}/state/taking")


@pytest.mark.parametrize("size", [3, 25])
def test_epochs_go_on_from_the_clock(spark, size):
    frame = events(spark, ROWS)
    whole = {r.event_id: r.epoch for r in running_counts(behavior_keys(frame, "ts"), activity_epochs(frame, "ts")).select("event_id", F.unix_micros("epoch").alias("epoch")).collect()}
    clock, got = None, {}
    for lo in range(0, len(ROWS), size):
        part = frame.where(F.col("event_id").between(lo, lo + size - 1))
        epochs, clock = batch_epochs(part, "ts", 5, clock)
        got.update({r.event_id: r.epoch for r in with_epoch(part, "ts", epochs).collect()})
    assert got == whole and len(set(whole.values())) > 2
    assert batch_epochs(frame.limit(0), "ts", 5, clock) == (None, clock)


def test_sharded_counts_need_their_state_store(spark, tmp_path):
    kept = spark.conf.get(STATE_STORE[0])
    spark.conf.set(STATE_STORE[0], "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(RuntimeError, match="RocksDB"):
            stream_behavior(stream_of(spark, tmp_path, events(spark, ROWS)), "ts")
    finally:
        spark.conf.set(STATE_STORE[0], kept)


def stream_of(spark, tmp_path, frame, files=1):
    path = str(tmp_path / "in")
    for i in range(files):
        frame.where(F.col("event_id") % files == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frame.schema).parquet(path)


def test_sharded_counts(spark, tmp_path):
    spark.conf.set(*STATE_STORE)
    frame = events(spark, ROWS)
    want = sorted((r.event_id, r.kind, r["count"]) for r in behavior(frame, "ts", threshold=4).select("event_id", "kind", "count").collect())
    for shards in (1, 3):
        flags = stream_behavior(stream_of(spark, tmp_path / str(shards), frame), "ts", shards=shards, threshold=4)
        drain(flags.writeStream.format("memory").queryName(f"flags{shards}").outputMode("append")
              .option("checkpointLocation", str(tmp_path / f"c{shards}")).start())
        got = sorted((r.event_id, r.kind, r["count"]) for r in spark.table(f"flags{shards}").collect())
        if shards == 1:
            assert got == want
        else:
            assert 0 < len(got) < len(want)


def test_flags_across_all_events_need_no_shard(spark, tmp_path, monkeypatch):
    """No task gets a worker's events whole, and counts go on from batch to batch."""
    monkeypatch.setattr(ShardCounter, "handleInputRows", None)
    frame, path = events(spark, ROWS), str(tmp_path / "in")
    want = sorted((r.event_id, r.kind, r["count"]) for r in behavior(frame, "ts", threshold=4).collect())
    where = StreamPaths(events=str(tmp_path / "flags"), state=str(tmp_path / "state"), checkpoint=str(tmp_path / "c"))
    half = len(ROWS) // 2
    for part in (frame.where(F.col("event_id") < half), frame.where(F.col("event_id") >= half)):
        part.repartition(3).write.mode("append").parquet(path)
        lines = spark.readStream.schema(frame.schema).parquet(path)
        stream_flags(lines, where, "ts", Settings(threshold=4), {"availableNow": True}).awaitTermination()
    flags = spark.read.option("recursiveFileLookup", "true").parquet(where.events)
    assert sorted((r.event_id, r.kind, r["count"]) for r in flags.collect()) == want and len(want) > 3
    assert len({r.batch for r in spark.read.parquet(where.events).select("batch").collect()}) == 2


def test_a_failed_stream_raises_though_it_has_ended():
    class Ended:
        isActive = False

        def exception(self):
            return ValueError("failed")

        def stop(self):
            pass

    with pytest.raises(ValueError, match="failed"):
        EnrichStream(Ended(), Ended()).awaitTermination()


def test_a_silent_shard_is_cleared(spark, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    first = events(spark, [(i, f"s{i % 40}", "u", None) for i in range(200)])
    first.coalesce(1).write.parquet(path)
    flags = stream_behavior(spark.readStream.schema(first.schema).parquet(path), "ts", shard=F.hash("user"), shards=64, threshold=4)
    query = flags.writeStream.format("memory").queryName("silent").outputMode("append").option("checkpointLocation", checkpoint).start()

    def keys():
        return spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint).count()

    try:
        query.processAllAvailable()
        assert keys() == 41
        # Hours later: the watermark passes the end of the first shard's silence, and its timer clears it.
        events(spark, [(9000, "late", "other", None)]).coalesce(1).write.mode("append").parquet(path)
        query.processAllAvailable()
        events(spark, [(9001, "late", "other", None)]).coalesce(1).write.mode("append").parquet(path)
        query.processAllAvailable()
    finally:
        query.stop()
    assert keys() == 2 and spark.table("silent").where("kind = 'user'").count() == 196


@pytest.mark.parametrize("rule", [alerts.IOC_ALERT, alerts.RULE_ALERT])
def test_alert_stream(spark, tmp_path, rule):
    rows = [(t, "s", "a", 1, True, False, ["r"]) for t in (0, 59, 60, 61, 299, 301, 900)]
    frame = enriched(spark, rows)
    last = enriched(spark, [(100_000, "s", "a", 1, True, False, ["r"])])
    source = stream_of(spark, tmp_path, frame)
    query = stream_alert_runs(source, rule, "ingest_ts").writeStream.format("memory").queryName(f"runs_{rule.field}").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "c")).start()
    try:
        query.processAllAvailable()
        last.write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted(tuple(r) for r in spark.table(f"runs_{rule.field}").collect())
    assert got == sorted(tuple(r) for r in alerts.alert_runs(frame, rule).collect())


def test_parts_of_a_stream_are_many_files_and_one_batch_each(spark, tmp_path, monkeypatch):
    from checks import streams

    assert streams.files_of_parts([5, 10**9], 8) == 1 and streams.files_of_parts([10**9], 8) == 8
    monkeypatch.setattr(streams, "PART_ROWS", 20)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(60 * cores).selectExpr("id", "int(id % 3) as n")
    stream, path = streams.as_stream(rows.where(f"n < 2 or id < {2 * cores}"), "parts", 3, F.col("n"))
    assert len(spark.read.parquet(path).inputFiles()) > 2 * cores
    batches = []
    stream.writeStream.foreachBatch(lambda batch, _: batches.append(sorted(map(tuple, batch.groupBy("n").count().collect())))).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [[n for n, _ in batch] for batch in batches] == [[0], [1], [2]]
    assert [batch[0][1] for batch in batches[:2]] == [20 * cores] * 2
