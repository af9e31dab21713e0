"""Behaviour counts per source, user and rule id, with a reset after silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.rules import BEHAVIOR_THRESHOLD, BEHAVIOR_WINDOW_MINUTES
from tidewatch.plans.joins import Lookup
from tidewatch.session import stage

SOURCE_FIELDS = ("source_address", "srcip", "src")
HIGHEST_RULE_ID = 2**32 - 1
KINDS = ("ip", "user", "logid")


def key_array(events: DataFrame) -> Column:
    """array<struct<kind, key>>: what an event is counted under.

    The source is the first of ``source_address``, ``srcip``, ``src`` that is there; a rule
    id outside the unsigned 32-bit range is not counted.
    """
    have = set(events.columns)
    keys: dict[str, Column] = {}
    sources = [F.col(c).cast("string") for c in SOURCE_FIELDS if c in have]
    if sources:
        keys["ip"] = F.coalesce(*sources)
    if "user" in have:
        keys["user"] = F.col("user").cast("string")
    if "logid" in have:
        keys["logid"] = F.when(F.col("logid").between(0, HIGHEST_RULE_ID), F.col("logid").cast("string"))
    entries = F.array(*[
        F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys.items()
    ])
    return F.filter(entries, lambda entry: entry.key.isNotNull())


def behavior_keys(events: DataFrame, time_col: str, id_col: str = "event_id") -> DataFrame:
    """(id, ts, kind, key): one row for each key an event is counted under."""
    return events.select(
        F.col(id_col), F.col(time_col).cast("timestamp").alias("ts"), F.inline(key_array(events))
    )


def activity_epochs(
    events: DataFrame, time_col: str, window_minutes: int = BEHAVIOR_WINDOW_MINUTES
) -> DataFrame:
    """(minute, first_ts, epoch): the epoch every minute with events belongs to.

    An epoch starts where no event of any key came for more than ``window_minutes`` whole
    minutes, and is named by the time of its first event. Such a gap cannot lie inside a
    minute, so the events are first reduced to one row per minute; the neighbours are then
    found day by day, and only one row per day is ever ordered as a whole.
    """
    silence = (window_minutes + 1) * 60_000_000
    ts = F.col(time_col).cast("timestamp")
    minutes = (
        events.select(ts.alias("ts"))
        .groupBy(F.date_trunc("minute", "ts").alias("minute"))
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn("day", F.to_date("minute"))
    )
    in_day = Window.partitionBy("day").orderBy("minute")
    by_day = Window.orderBy("day")

    def starts(previous: Column) -> Column:
        gap = F.unix_micros("first_ts") - F.unix_micros(previous)
        return F.when(previous.isNull() | (gap >= silence), F.col("first_ts"))

    near = minutes.withColumn("before", F.lag("last_ts").over(in_day)).withColumn(
        "first_of_day", F.row_number().over(in_day) == 1
    )
    days = near.groupBy("day").agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.max(F.when(~F.col("first_of_day"), starts(F.col("before")))).alias("last_start"),
    )
    chained = days.withColumn("yesterday", F.lag("last_ts").over(by_day)).withColumn(
        "opening", starts(F.col("yesterday"))
    )
    carried = chained.select(
        "day", "yesterday",
        F.last(F.coalesce("last_start", "opening"), ignorenulls=True)
        .over(by_day.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
    )
    joined = near.join(carried, "day")
    start = starts(F.when(F.col("first_of_day"), F.col("yesterday")).otherwise(F.col("before")))
    return joined.withColumn("start", start).select(
        "minute", "first_ts",
        F.coalesce(
            F.last("start", ignorenulls=True).over(in_day), F.col("carried")
        ).alias("epoch"),
    )


def in_epochs(rows: DataFrame, ts: Column, epochs: DataFrame, spread_by: str = "event_id") -> DataFrame:
    """``rows`` with a time, plus the ``epoch`` their time belongs to."""
    return Lookup(epochs.select("minute", "epoch"), "epochs").join(
        rows.withColumn("minute", F.date_trunc("minute", ts)), ["minute"], "inner", spread_by=spread_by
    ).drop("minute")


def running_counts(keyed: DataFrame, epochs: DataFrame, id_col: str = "event_id") -> DataFrame:
    """(id, ts, kind, key, epoch, count): events so far in the epoch under the same key."""
    return epoch_counts(in_epochs(keyed, F.col("ts"), epochs, id_col), id_col)


def epoch_counts(with_epoch: DataFrame, id_col: str = "event_id") -> DataFrame:
    """``with_epoch(id, ts, kind, key, epoch)`` plus ``count``: events so far in the epoch under the same key.

    A single source may own a large share of all events, and steady traffic is one endless
    epoch, so a window over (key, epoch) would be one task's work. Instead the rows are
    range-partitioned by (kind, key, ts, id), which cuts a hot key into many slices; a row's
    count is its position in the slice plus the size of the key's earlier slices.
    """
    sliced = with_epoch.repartitionByRange("kind", "key", "ts", id_col).withColumn(
        "slice", F.spark_partition_id()
    )
    # The slice numbers depend on sampled range bounds, so they are written down once.
    slices = stage(sliced, "behavior-slices")
    group = ["kind", "key", "epoch"]
    earlier = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slices.groupBy("slice", *group).agg(F.count("*").alias("n"))
        .select("slice", *group, F.sum("n").over(earlier).alias("carried"))
        .where(F.col("carried").isNotNull())
    )
    # Ranges are contiguous: only the first group of a slice can continue from an earlier
    # one, so this side has fewer rows than there are slices.
    position = F.row_number().over(Window.partitionBy("slice", *group).orderBy("ts", id_col))
    return slices.join(F.broadcast(carried), ["slice", *group], "left").select(
        id_col, "ts", *group,
        (position + F.coalesce(F.col("carried"), F.lit(0))).cast("bigint").alias("count"),
    )


def flagged(counts: DataFrame, threshold: int = BEHAVIOR_THRESHOLD) -> DataFrame:
    """Rows whose key has been seen more than ``threshold`` times."""
    return counts.where(F.col("count") > threshold)


def behavior(
    events: DataFrame,
    time_col: str,
    id_col: str = "event_id",
    threshold: int = BEHAVIOR_THRESHOLD,
    window_minutes: int = BEHAVIOR_WINDOW_MINUTES,
) -> DataFrame:
    """(id, kind, key, count) for every event and key above the threshold."""
    counts = running_counts(
        behavior_keys(events, time_col, id_col), activity_epochs(events, time_col, window_minutes), id_col
    )
    return flagged(counts, threshold).select(id_col, "kind", "key", "count")


def key_counts(keyed: DataFrame) -> DataFrame:
    """(kind, key, count): how often each key occurs; a partial result for ``merge_counts``."""
    return keyed.groupBy("kind", "key").agg(F.count("*").alias("count"))


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Sum of disjoint partial counts per key."""
    combined = parts[0].select("kind", "key", "count")
    for part in parts[1:]:
        combined = combined.unionByName(part.select("kind", "key", "count"))
    return combined.groupBy("kind", "key").agg(F.sum("count").alias("count"))


def sliding_counts(keyed: DataFrame, minutes: int) -> DataFrame:
    """(kind, key, ts, events, in_window): per key and time, events of the last ``minutes``.

    Both ends are included. Equal times are counted together first. A window holds what the
    key has up to its time less what it has before its start, so each time is taken twice: with
    its events, and as a mark at the start. Running sums are made as in ``running_counts``:
    on ranges of (kind, key, time), which cut a busy key into many slices.
    """
    width = minutes * 60_000_000
    per_time = keyed.groupBy("kind", "key", "ts").agg(F.count("*").alias("events")).withColumn("us", F.unix_micros("ts"))
    # A mark comes before events of its time, as these belong to the window.
    twice = F.inline(F.array(
        F.struct(F.col("us").alias("at"), F.lit(True).alias("own"), F.col("events").alias("n")),
        F.struct((F.col("us") - width).alias("at"), F.lit(False).alias("own"), F.lit(0).cast("bigint").alias("n")),
    ))
    marked = per_time.select("kind", "key", "ts", "events", twice)
    slices = stage(
        marked.repartitionByRange("kind", "key", "at", "own").withColumn("slice", F.spark_partition_id()), "window-slices"
    )
    earlier = Window.partitionBy("kind", "key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first key of a slice goes on from earlier ones, so these are fewer rows than slices.
    carried = (
        slices.groupBy("slice", "kind", "key").agg(F.sum("n").alias("n"))
        .select("slice", "kind", "key", F.sum("n").over(earlier).alias("carried")).where(F.col("carried").isNotNull())
    )
    so_far = F.sum("n").over(Window.partitionBy("slice", "kind", "key").orderBy("at", "own").rowsBetween(Window.unboundedPreceding, 0))
    sums = slices.join(F.broadcast(carried), ["slice", "kind", "key"], "left").withColumn("upto", so_far + F.coalesce("carried", F.lit(0)))
    return sums.groupBy("kind", "key", "ts").agg(
        F.max(F.when(F.col("own"), F.col("events"))).alias("events"),
        (F.max(F.when(F.col("own"), F.col("upto"))) - F.max(F.when(~F.col("own"), F.col("upto")))).alias("in_window"),
    )
