"""Windowed alert rules over enriched events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators import filters
from tidewatch.operators.reports import TIME

LOOK_BACK_MINUTES = 5
MAX_HITS = 100


@dataclass(frozen=True)
class AlertRule:
    """A rule that runs every ``every_minutes`` over the last ``LOOK_BACK_MINUTES``."""

    name: str
    every_minutes: int
    field: str

    def matches(self) -> Column:
        return {"ioc": filters.has_ioc, "anomaly": filters.has_anomaly, "rule": filters.has_rule}[self.field]()


IOC_ALERT = AlertRule("threat_intel_hit", 1, "ioc")
ANOMALY_ALERT = AlertRule("behavioral_anomaly", 1, "anomaly")
RULE_ALERT = AlertRule("correlation_rule_fired", 2, "rule")
ALERTS = (IOC_ALERT, ANOMALY_ALERT, RULE_ALERT)


def run_time(rule: AlertRule, time_col: str = TIME) -> Column:
    """The first run whose window covers the event; later runs leave it out again."""
    return F.window(F.col(time_col).cast("timestamp"), f"{rule.every_minutes} minutes").end


def alert_hits(events: DataFrame, rule: AlertRule, time_col: str = TIME) -> DataFrame:
    """Matching events with the run that reports them, each exactly once."""
    return events.where(rule.matches()).withColumn("run_ts", run_time(rule, time_col))


def alert_runs(events: DataFrame, rule: AlertRule, time_col: str = TIME) -> DataFrame:
    """(run_ts, new_hits, window_hits) of every run that has new hits, and so fires.

    ``window_hits`` also counts what earlier runs in the same look-back reported. Counts per
    run are summed up first; the sums are then added to the runs they are visible in.
    """
    every = rule.every_minutes
    per_minute = (
        events.where(rule.matches())
        .groupBy(F.window(F.col(time_col).cast("timestamp"), "1 minute").end.alias("minute_end"))
        .agg(F.count("*").alias("n"))
    )
    # A run at time T sees the minutes that end in (T - look-back, T].
    runs = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(LOOK_BACK_MINUTES - 1)),
            lambda i: F.unix_seconds("minute_end") + i.cast("bigint") * 60,
        ),
        lambda t: t % (every * 60) == 0,
    )
    seen = per_minute.select("minute_end", "n", F.explode(runs).alias("run"))
    age = F.col("run") - F.unix_seconds("minute_end")
    return (
        seen.groupBy("run")
        .agg(
            F.sum(F.when(age < every * 60, F.col("n")).otherwise(0)).alias("new_hits"),
            F.sum("n").alias("window_hits"),
        )
        .where("new_hits > 0")
        .select(F.timestamp_seconds("run").alias("run_ts"), "new_hits", "window_hits")
    )


def reported_hits(
    events: DataFrame, rule: AlertRule, time_col: str = TIME, id_col: str = "event_id", size: int = MAX_HITS
) -> DataFrame:
    """The hits a run lists: its newest ``size`` new ones."""
    hits = alert_hits(events, rule, time_col)
    newest = Window.partitionBy("run_ts").orderBy(F.desc(time_col), F.asc(id_col))
    return hits.withColumn("hit", F.row_number().over(newest)).where(F.col("hit") <= size)
