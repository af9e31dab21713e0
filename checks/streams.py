"""Registered queries of streams, line ids, indicator versions and the store: run to their end over the given tables, output read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import samples as S
from checks import twins as T
from checks.catalog import TWINS, event_store, indicators, keyed, query, raw_lines
from tidewatch.operators import alerts, reports, rollups
from tidewatch.operators.filters import has_ioc, has_rule
from tidewatch.operators.match import match_indicators
from tidewatch.plans.enrich import Settings
from tidewatch.session import setting, stage, stage_path
from tidewatch.sources import readers, sinks, snapshots, store
from tidewatch.streaming import windows
from tidewatch.streaming.streams import StreamPaths, stream_alert_runs, stream_enrich, stream_flags

NOW = {"availableNow": True}


def as_stream(rows: DataFrame, name: str, parts: int = 1, by=None) -> tuple[DataFrame, str]:
    """A table as a stream of files, and their folder; with ``by``, part ``n`` has the rows of that number and is a batch older than the next.

    Every part but the last has the same number of files, so that a batch is a part: one file if one of
    them has few rows, and else as many as the cluster runs tasks, so that all of them write and read it.
    """
    spark = rows.sparkSession
    path = stage_path(spark, name)
    if by is None:
        rows.write.parquet(path)
        return spark.readStream.schema(rows.schema).parquet(path), path
    sizes = dict(rows.groupBy(by.alias("part")).count().collect())
    files = files_of_parts([sizes.get(n, 0) for n in range(parts - 1)], spark.sparkContext.defaultParallelism)
    for n in range(parts):
        rows.where(by == n).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path), path


#: Rows of a part from which it is dealt over several files: far more than are needed for none of them to be empty.
PART_ROWS = 10_000


def files_of_parts(sizes: list[int], cores: int) -> int:
    return cores if min(sizes, default=0) >= PART_ROWS * cores else 1


def output_of(stream: DataFrame, name: str) -> DataFrame:
    """What a stream has written when it has read all its input."""
    spark = stream.sparkSession
    path = stage_path(spark, name)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", stage_path(spark, f"{name}-checkpoint"))
    writer.trigger(**NOW).start(path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("line_ids", f"WITH {T.FW_RAW} SELECT raw FROM fw_raw")
def _line_ids(spark, sf_dir):
    """Lines that have the same id however their files are cut and packed."""
    path = stage_path(spark, "id-lines")
    raw_lines(spark, sf_dir).select("raw").write.text(path)
    read = []
    for size in ("64k", "128m"):
        with setting(spark, "spark.sql.files.maxPartitionBytes", size):
            read.append(stage(readers.read_log_lines(spark, path).select("event_id", "raw"), "line-ids"))
    return read[0].join(read[1], ["event_id", "raw"]).select("raw")


_VERSIONS = ((0, dt.datetime(2024, 1, 5)), (1, dt.datetime(2024, 1, 12, 7, 30)), (2, dt.datetime(2024, 1, 20)))


@query("match_as_of", f"""WITH {T.INDICATORS}, versions(k, since) AS (VALUES {', '.join(f"({k}, TIMESTAMP '{at}')" for k, at in _VERSIONS)}),
  met AS (SELECT event_id, ts, {T.DST} AS value FROM events), dated AS (SELECT m.*, v.k FROM met m ASOF JOIN versions v ON m.ts >= v.since)
  SELECT event_id, value, source_count FROM dated JOIN indicators USING (value) WHERE kind = 'ip' AND length(value) % 3 <> k""")
def _match_as_of(spark, sf_dir):
    """Events of a month against the indicator version that was valid at their time."""
    root = stage_path(spark, "versions")
    table = stage(indicators(spark, sf_dir), "version-indicators")
    for k, at in _VERSIONS:
        snapshots.publish_snapshot(table.where(F.length("value") % 3 != k), root, at)
    iocs = S.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("at"), F.lit("ip").alias("kind"), S.destination_address().alias("value")
    )
    return match_indicators(iocs, snapshots.indicator_history(spark, root), time_col="at").select("event_id", "value", "source_count")


@query("stream_flags", f"WITH {T.COUNTS} SELECT event_id, kind, key, count FROM counts WHERE count > 2")
def _stream_flags(spark, sf_dir):
    """Behaviour counts across all events of a stream, in keyed state by key."""
    events, _ = as_stream(S.generic_events(spark, sf_dir), "stream-events")
    root = stage_path(spark, "stream-flags")
    where = StreamPaths(events=f"{root}/flags", state=f"{root}/state", checkpoint=f"{root}/checkpoint")
    stream_flags(events, where, "ts", Settings(threshold=2), NOW).awaitTermination()
    flags = spark.read.option("recursiveFileLookup", "true").schema("event_id bigint, kind string, key string, count bigint")
    return flags.parquet(where.events)


@query("stream_enriched", f"""WITH {T.ENRICHED} SELECT source_address, count(*) AS events, count(*) FILTER (has_ioc) AS hits, count(*) FILTER (has_rule) AS rules
  FROM found GROUP BY ALL""")
def _stream_enriched(spark, sf_dir):
    """Raw lines through the enrichment stream, its store read back."""
    path, root = stage_path(spark, "landing"), stage_path(spark, "stream-enriched")
    raw_lines(spark, sf_dir).select("raw").write.text(path)
    snapshots.publish_snapshot(indicators(spark, sf_dir), f"{root}/intel")
    where = StreamPaths(events=f"{root}/events", state=f"{root}/state", checkpoint=f"{root}/checkpoint", rejects=f"{root}/rejects", siem=f"{root}/siem", store=f"{root}/store")
    stream_enrich(readers.read_log_lines(spark, path, streaming=True), f"{root}/intel", where, S.geo_ranges(spark, sf_dir), trigger=NOW).awaitTermination()
    rows = store.read_event_store(spark, where.store)
    return rows.groupBy("source_address").agg(F.count("*").alias("events"), F.count_if(has_ioc()).alias("hits"), F.count_if(has_rule()).alias("rules"))


@query("stream_sliding", f"""WITH {T.KEYED}, s AS (SELECT kind, key, date_trunc('second', ts) AS ts FROM keyed)
  SELECT DISTINCT kind, key, epoch_us(ts) AS ts_us, count(*) OVER (PARTITION BY kind, key ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS in_window FROM s""")
def _stream_sliding(spark, sf_dir):
    rows, _ = as_stream(keyed(spark, sf_dir), "stream-keyed")
    return output_of(windows.stream_sliding_counts(rows, 5), "stream-sliding").select("kind", "key", F.unix_micros("ts").alias("ts_us"), "in_window")


_FAR = "interval 400 days"


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events that raise an alert, as a stream, and one far later that closes all their windows."""
    found = F.struct("forwarder_enrichment.ioc_matches").alias("forwarder_enrichment")
    rows = event_store(spark, sf_dir).where(alerts.IOC_ALERT.matches()).select("event_id", "ingest_ts", found)
    last = rows.limit(1).withColumn("ingest_ts", F.col("ingest_ts") + F.expr(_FAR))
    both = rows.withColumn("n", F.lit(0)).unionByName(last.withColumn("n", F.lit(1)))
    return as_stream(both, "stream-marked", 2, F.col("n"))[0]


@query("stream_hits", TWINS["alert_hits_ioc"])
def _stream_hits(spark, sf_dir):
    """The newest hits of every run, kept in a heap and given out by a timer."""
    found = output_of(windows.stream_reported_hits(_marked(spark, sf_dir), alerts.IOC_ALERT, "ingest_ts"), "stream-hits")
    return found.where("run_ts < '2025-01-01'").select("event_id", F.unix_seconds("run_ts").alias("run_s"), "hit")


@query("stream_alerts", TWINS["alert_ioc"])
def _stream_alerts(spark, sf_dir):
    found = output_of(stream_alert_runs(_marked(spark, sf_dir), alerts.IOC_ALERT, "ingest_ts"), "stream-alerts")
    return found.where("run_ts < '2025-01-01'").select(F.unix_seconds("run_ts").alias("run_s"), "new_hits", "window_hits")


@query("stream_late", """WITH n AS (SELECT event_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN event_id % 2 ELSE 2 END AS file FROM events)
  SELECT event_id, coalesce(ts < (SELECT max(ts) FROM n AS o WHERE o.file < n.file) - INTERVAL 7 DAY, false) AS late FROM n""")
def _stream_late(spark, sf_dir):
    """Rows in time and rows behind the watermark are all rows of a stream."""
    rows = S.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    part = F.when(F.col("ts") < "2024-01-15", F.col("event_id") % 2).otherwise(2)
    stream, _ = as_stream(rows, "stream-late", 3, part)
    root = stage_path(spark, "split-late")
    windows.split_late(stream, "ts", 7 * 86_400, f"{root}/on_time", f"{root}/late", f"{root}/state", f"{root}/checkpoint", NOW).awaitTermination()
    on_time = spark.read.option("recursiveFileLookup", "true").schema(rows.schema).parquet(f"{root}/on_time")
    late = spark.read.schema(rows.schema).parquet(f"{root}/late")
    return on_time.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))


@query("rollup_overview", TWINS["overview_report"])
def _rollup_overview(spark, sf_dir):
    """The overview from daily partial counts; no event is read for it."""
    path = stage_path(spark, "rollups")
    rollups.refresh_rollups(event_store(spark, sf_dir), path)
    rollups.refresh_rollups(event_store(spark, sf_dir), path, [dt.date(2024, 1, 7), dt.date(2024, 1, 8)])
    return rollups.rollup_report(spark, path, "overview")


@query("rollup_threats", TWINS["threat_report"])
def _rollup_threats(spark, sf_dir):
    path = stage_path(spark, "rollups")
    rollups.refresh_rollups(event_store(spark, sf_dir), path)
    return rollups.rollup_report(spark, path, "threat")


@query("stream_store", TWINS["stored_report"])
def _stream_store(spark, sf_dir):
    """A store of micro-batches, packed into files by day, and one that came later."""
    path, events = stage_path(spark, "batch-store"), event_store(spark, sf_dir)
    for n in range(4):
        sinks.write_event_store(events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == n), f"{path}/batch={n}")
        if n in (1, 3):
            store.compact_event_store(spark, path)
    return reports.top_source_ips(store.read_event_store(spark, path, dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 12)))
