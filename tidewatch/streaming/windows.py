"""Streams by event time: late rows, the newest hits of a run, and counts of the last minutes."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewatch.operators.alerts import MAX_HITS, AlertRule, run_time
from tidewatch.session import exists, file_system, publish, remove
from tidewatch.streaming.counts import need_state_store

# Late rows ----------------------------------------------------------------------------------

_SEEN = "newest_us bigint"


def split_late(
    events: DataFrame, time_col: str, delay_seconds: int, on_time: str, late: str, state: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the rows of a stream to ``on_time``, and those behind the watermark to ``late``: together they are all rows.

    The watermark is Spark's own: the newest time of all earlier micro-batches less the delay.
    Streams with that watermark over ``on_time`` lose no row, as its files come in the same
    order. Rows without a time are late. A batch is published whole and once, also when it
    is repeated.
    """
    spark = events.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        before = _newest(spark, state, batch_id - 1)
        at = F.unix_micros(F.col(time_col).cast("timestamp"))
        behind = at.isNull() if before is None else at.isNull() | (at < before - delay_seconds * 1_000_000)
        written = f"{state}/written/{batch_id}"
        if not exists(spark, f"{written}/_SUCCESS") and not exists(spark, f"{on_time}/{batch_id:012d}"):
            batch.where(behind).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
            newest = batch.agg(F.max(at)).first()[0]
            newest = before if newest is None else newest if before is None else max(before, newest)
            rows = spark.createDataFrame([(newest,)], _SEEN)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{state}/newest/{batch_id}")
            batch.where(~behind).write.mode("overwrite").parquet(written)
        publish(spark, written, f"{on_time}/{batch_id:012d}")
        remove(spark, f"{state}/newest/{batch_id - 2}")

    system, folder = file_system(spark, on_time)
    system.mkdirs(folder)
    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def _newest(spark: SparkSession, state: str, batch_id: int) -> int | None:
    path = f"{state}/newest/{batch_id}"
    return spark.read.schema(_SEEN).parquet(path).first()[0] if batch_id >= 0 and exists(spark, path) else None


def read_on_time(spark: SparkSession, schema, on_time: str) -> DataFrame:
    """The rows in time as a stream."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(on_time)


# The newest hits of a run -------------------------------------------------------------------


def _newest_of_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The newest ``size`` rows of each run in this task."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(map(len, held)) > 64 * size:
            held = [_cut(pa.concat_tables(held), size)]
    if held:
        yield from _cut(pa.concat_tables(held), size).to_batches()


def _cut(table: pa.Table, size: int) -> pa.Table:
    table = table.sort_by([("run_us", "ascending"), ("us", "descending"), ("event_id", "ascending")])
    runs = table["run_us"].to_numpy()
    place, kept = {}, []
    for i, run in enumerate(runs.tolist()):
        place[run] = place.get(run, 0) + 1
        if place[run] <= size:
            kept.append(i)
    return table.take(pa.array(kept, pa.int64()))


class NewestHits(StatefulProcessor):
    """The newest hits of one run, a heap of bounded size, given out when the watermark passes the run."""

    def __init__(self, size: int, row: str):
        self.size, self.row = size, row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hits = handle.getListState("hits", self.row)

    def handleInputRows(self, key, rows, timerValues):
        held = list(self.hits.get()) if self.hits.exists() else []
        new = [(r["us"], r["event_id"]) for r in rows]
        best = heapq.nsmallest(self.size, [*map(tuple, held), *new], key=lambda h: (-h[0], h[1]))
        if not held:
            self.handle.registerTimer(key[0] // 1000)
        self.hits.put(best)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for place, (us, event_id) in enumerate(sorted(map(tuple, self.hits.get()), key=lambda h: (-h[0], h[1])), 1):
            yield Row(run_us=key[0], event_id=event_id, us=us, hit=place)
        self.hits.clear()

    def close(self) -> None:
        pass


def stream_reported_hits(events: DataFrame, rule: AlertRule, time_col: str, watermark: str = "10 minutes", size: int = MAX_HITS) -> DataFrame:
    """(run_ts, event_id, at, hit): the newest ``size`` new hits of every run, once its time is over.

    Each task cuts its own hits to ``size`` a run first, so a run with very many hits is a few
    rows of keyed state.
    """
    need_state_store(events.sparkSession)
    id_type = events.schema["event_id"].dataType.simpleString()
    at = F.col(time_col).cast("timestamp")
    hits = events.where(rule.matches() & at.isNotNull()).select(
        F.unix_micros(run_time(rule, time_col)).alias("run_us"), F.unix_micros(at).alias("us"), "event_id",
    )
    cut = hits.mapInArrow(lambda batches: _newest_of_runs(batches, size), f"run_us long, us long, event_id {id_type}")
    marked = cut.withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", watermark)
    found = marked.groupBy("run_us").transformWithState(
        statefulProcessor=NewestHits(size, f"us long, event_id {id_type}"), outputStructType=f"run_us long, event_id {id_type}, us long, hit int",
        outputMode="append", timeMode="EventTime",
    )
    return found.select(F.timestamp_micros("run_us").alias("run_ts"), "event_id", F.timestamp_micros("us").alias("at"), "hit")


# Counts of the last minutes -----------------------------------------------------------------


class RecentCounts(StatefulProcessor):
    """Events of one (kind, key) per time within the last minutes, forgotten by a timer."""

    def __init__(self, width_us: int):
        self.width = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getListState("ring", "us long, n long")

    def handleInputRows(self, key, rows, timerValues):
        counts: dict[int, int] = dict(map(tuple, self.ring.get())) if self.ring.exists() else {}
        new: dict[int, int] = {}
        for row in rows:
            new[row["us"]] = new.get(row["us"], 0) + row["n"]
        for us, n in new.items():
            counts[us] = counts.get(us, 0) + n
        times = sorted(counts)
        low, inside = 0, 0
        for us in times:
            inside += counts[us]
            while times[low] < us - self.width:
                inside -= counts[times[low]]
                low += 1
            if us in new:
                yield Row(kind=key[0], key=key[1], us=us, events=counts[us], in_window=inside)
        kept = [us for us in times if us >= times[-1] - self.width]
        self.ring.put([(us, counts[us]) for us in kept])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((times[-1] + self.width) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.ring.clear()
        return iter(())

    def close(self) -> None:
        pass


def _count_times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["kind", "key", "us"]).aggregate([([], "count_all")])
        yield from table.rename_columns(["kind", "key", "us", "n"]).to_batches()


def stream_sliding_counts(keyed: DataFrame, minutes: int, grain_seconds: int = 1, watermark: str = "10 minutes") -> DataFrame:
    """(kind, key, ts, events, in_window): per key and time, events of the last ``minutes``, both ends included.

    Times are cut to ``grain_seconds``, so a key's state is a ring of ``60 * minutes /
    grain_seconds`` counts at most, however busy it is; over times cut likewise the rows equal
    those of ``sliding_counts`` where events come in order, one batch holding all of a time. A
    key's ring goes when the watermark has left it behind.
    """
    need_state_store(keyed.sparkSession)
    grain = grain_seconds * 1_000_000
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = keyed.where(F.col("ts").isNotNull()).select("kind", "key", (us - F.pmod(us, F.lit(grain))).alias("us"))
    counted = cut.mapInArrow(_count_times, "kind string, key string, us long, n long").withColumn("ts", F.timestamp_micros("us"))
    found = counted.withWatermark("ts", watermark).groupBy("kind", "key").transformWithState(
        statefulProcessor=RecentCounts(minutes * 60_000_000), outputStructType="kind string, key string, us long, events long, in_window long",
        outputMode="append", timeMode="EventTime",
    )
    return found.select("kind", "key", F.timestamp_micros("us").alias("ts"), "events", "in_window")
