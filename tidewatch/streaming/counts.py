"""Behaviour counts of streams in keyed state: per key across all events, and per independent worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.rules import BEHAVIOR_THRESHOLD, BEHAVIOR_WINDOW_MINUTES
from tidewatch.operators.behavior import activity_epochs, epoch_counts, flagged, in_epochs, key_array
from tidewatch.plans.joins import Lookup
from tidewatch.session import RUNTIME_SETTINGS, stage

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = (_PROVIDER, RUNTIME_SETTINGS[_PROVIDER])
#: A key that has not been seen for so long loses its count, so that state is bounded by the keys of that time.
KEY_EXPIRY_DAYS = 30


def need_state_store(spark: SparkSession) -> None:
    if spark.conf.get(STATE_STORE[0], None) != STATE_STORE[1]:
        raise RuntimeError(f"set {STATE_STORE[0]} to {STATE_STORE[1]}")


# Epochs of a stream -----------------------------------------------------------------------

CLOCK = "last_us bigint, epoch_us bigint"


def batch_epochs(events: DataFrame, time_col: str, window_minutes: int, clock: tuple | None) -> tuple[DataFrame | int | None, tuple | None]:
    """The epoch of a micro-batch's events, going on from ``clock``, and the clock after it.

    ``clock`` is the newest time so far and the start of the running epoch. Batches come in
    order of time. A batch that spans less than a silence is in one epoch, and that is
    returned; for a longer one it is a table (minute, epoch). A batch without times has none and
    leaves the clock as it is.
    """
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    if last is None:
        return None, clock
    silence = (window_minutes + 1) * 60_000_000
    goes_on = clock is not None and first - clock[0] < silence
    newest = max(last, clock[0]) if goes_on else last
    if last - first < silence:
        running = clock[1] if goes_on else first
        return running, (newest, running)
    minutes = stage(activity_epochs(events, time_col, window_minutes), "stream-epochs")
    opening, running = minutes.agg(F.min(F.unix_micros("epoch")), F.max(F.unix_micros("epoch"))).first()
    epoch = F.unix_micros("epoch")
    if goes_on:
        epoch = F.when(epoch == opening, F.lit(clock[1])).otherwise(epoch)
        running = clock[1] if opening == running else running
    return minutes.select("minute", epoch.alias("epoch")), (newest, running)


def with_epoch(events: DataFrame, time_col: str, epochs: DataFrame | int | None) -> DataFrame:
    """``events`` plus the ``epoch`` that ``batch_epochs`` has found, null without a time."""
    at = F.col(time_col).cast("timestamp")
    if not isinstance(epochs, DataFrame):
        return events.withColumn("epoch", F.when(at.isNotNull(), F.lit(epochs)).cast("bigint"))
    untimed = events.where(at.isNull()).withColumn("epoch", F.lit(None).cast("bigint"))
    return in_epochs(events.where(at.isNotNull()), at, epochs).unionByName(untimed)


# Counts per key across all events -----------------------------------------------------------


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events per key and epoch in this task, and the files they come from."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keyed = pa.table({
            "kind": pc.struct_field(pc.list_flatten(table["keys"]), "kind"), "key": pc.struct_field(pc.list_flatten(table["keys"]), "key"),
            "epoch": table["epoch"].take(pc.list_parent_indices(table["keys"])),
        }).filter(pc.field("epoch").is_valid())
        counts = keyed.group_by(["kind", "key", "epoch"]).aggregate([([], "count_all")]).rename_columns(["kind", "key", "epoch", "n"])
        files = pc.unique(table["file"])
        none = pa.nulls(len(files))
        yield from counts.append_column("file", pa.nulls(len(counts), pa.string())).to_batches()
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.string()), none.cast(pa.string()), none.cast(pa.int64()), none.cast(pa.int64()), files.cast(pa.string())],
            names=["kind", "key", "epoch", "n", "file"],
        )


class EpochCounter(StatefulProcessor):
    """The count of one (kind, key) in the epoch it was last seen in."""

    def __init__(self, threshold: int, expiry_ms: int):
        self.threshold, self.expiry_ms = threshold, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "epoch long, n long", self.expiry_ms)

    def handleInputRows(self, key, rows, timerValues):
        # A few partial counts: one for each task and epoch that has the key.
        new: dict[int, int] = {}
        for row in rows:
            new[row["epoch"]] = new.get(row["epoch"], 0) + row["n"]
        epoch, n = self.count.get() if self.count.exists() else (None, 0)
        for at in sorted(new):
            before = n if at == epoch else 0
            epoch, n = at, before + new[at]
            if before and n > self.threshold:
                yield Row(kind=key[0], key=key[1], epoch=at, before=before, file=None)
        self.count.update((epoch, n))

    def close(self) -> None:
        pass


def carried_counts(events: DataFrame, threshold: int, expiry_days: int = KEY_EXPIRY_DAYS) -> DataFrame:
    """(kind, key, epoch, before, file) of each micro-batch of ``events(file, epoch, keys)``.

    ``before`` is what a key has from earlier batches of its epoch, for the keys that may pass
    the threshold; other rows name the files the batch comes from. Tasks count their own
    events first, so a busy key is a few rows of the keyed state, not its events.
    """
    need_state_store(events.sparkSession)
    parts = events.select("file", "epoch", "keys").mapInArrow(_partial_counts, "kind string, key string, epoch long, n long, file string")
    kind = "kind string, key string, epoch long, before long, file string"
    counted = parts.where("kind IS NOT NULL").groupBy("kind", "key").transformWithState(
        statefulProcessor=EpochCounter(threshold, expiry_days * 86_400_000), outputStructType=kind, outputMode="append", timeMode="ProcessingTime",
    )
    files = parts.where("file IS NOT NULL").select("kind", "key", "epoch", F.col("n").alias("before"), "file")
    return counted.unionByName(files)


def batch_flags(events: DataFrame, carried: DataFrame, time_col: str, threshold: int) -> DataFrame:
    """(event_id, kind, key, count) above the threshold, for a batch of ``events`` with their ``epoch``."""
    keyed = events.where("epoch IS NOT NULL").select("event_id", F.col(time_col).cast("timestamp").alias("ts"), "epoch", F.inline(key_array(events)))
    counts = Lookup(carried.select("kind", "key", "epoch", "before"), "stream-carried").join(
        epoch_counts(keyed), ["kind", "key", "epoch"], "left", spread_by="event_id"
    )
    counts = counts.withColumn("count", F.col("count") + F.coalesce("before", F.lit(0)))
    return flagged(counts, threshold).select("event_id", "kind", "key", "count")


# Counts of independent workers ----------------------------------------------------------------


class ShardCounter(StatefulProcessor):
    """Counts per key in one shard, cleared after silence in that shard.

    A batch's rows are counted as arrays: gaps cut them into spells, and a key's first spell goes
    on from its state. A timer clears a shard that stays silent, once the watermark says so.
    """

    def __init__(self, threshold: int, window_minutes: int):
        self.threshold, self.silence = threshold, (window_minutes + 1) * 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "kind string, key string", "n long")
        self.last = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows, ignore_index=True).sort_values(["us", "event_id"], kind="stable", ignore_index=True)
        us = batch["us"].to_numpy()
        newest = np.maximum.accumulate(np.concatenate([self.last.get() if self.last.exists() else us[:1], us]))
        spell = np.cumsum(us - newest[:-1] >= self.silence)
        keyed = batch.assign(spell=spell)[batch["kind"].notna()]
        groups = keyed.groupby(["spell", "kind", "key"], sort=False)
        sizes = groups.size()
        held = {name: self.counts.getValue(name[1:])[0] for name in sizes.index if name[0] == 0 and self.counts.containsKey(name[1:])}
        went_on = pd.Series(held, dtype="int64").reindex(sizes.index, fill_value=0) if held else 0 * sizes
        count = groups.cumcount().to_numpy() + 1 + went_on.to_numpy()[groups.ngroup().to_numpy()]
        if spell[-1]:
            self.counts.clear()
        for (at, *name), n in (sizes + went_on).items():
            if at == spell[-1]:
                self.counts.updateValue(tuple(name), (int(n),))
        self.last.update((int(newest[-1]),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(newest[-1] + self.silence) // 1000)
        over = keyed.assign(count=count)[count > self.threshold]
        if len(over):
            yield over[["event_id", "kind", "key", "count"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_behavior(
    events: DataFrame,
    time_col: str,
    shards: int | None = None,
    shard: Column | None = None,
    threshold: int = BEHAVIOR_THRESHOLD,
    window_minutes: int = BEHAVIOR_WINDOW_MINUTES,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Flags of a stream counted by independent workers, as (event_id, kind, key, count).

    Each shard counts the events it is given. Events go to shards by their id, so a busy
    source is shared by all of them, and a count is that of one worker; with one shard the
    flags equal those of ``behavior``. ``stream_enrich`` counts across all events instead.
    By default there are as many shards as the cluster runs tasks at once. Events later than the
    ``watermark`` are not counted; a shard's state goes when the watermark has passed the end
    of its silence.
    """
    spark = events.sparkSession
    need_state_store(spark)
    shards = shards or spark.sparkContext.defaultParallelism
    place = shard if shard is not None else F.xxhash64("event_id")
    id_type = events.schema["event_id"].dataType.simpleString()
    ts = F.col(time_col).cast("timestamp")
    keyed = events.select(
        "event_id", ts.alias("ts"), F.unix_micros(ts).alias("us"), F.pmod(place, F.lit(shards)).cast("bigint").alias("shard"),
        # An event without keys still ends a silence.
        F.inline_outer(key_array(events)),
    ).where("us IS NOT NULL")
    return keyed.withWatermark("ts", watermark).groupBy("shard").transformWithStateInPandas(
        statefulProcessor=ShardCounter(threshold, window_minutes),
        outputStructType=f"event_id {id_type}, kind string, key string, count bigint", outputMode="append", timeMode="EventTime",
    )
