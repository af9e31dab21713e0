"""The report queries of the security dashboards."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.filters import enrichment, has_anomaly, has_enrichment, has_ioc, has_rule
from tidewatch.session import stage

TIME = "ingest_ts"
OTHER = "Other"


def top_terms(events: DataFrame, col: str | Column, k: int, other: bool = False, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values, nulls left out; ties go to the smaller value.

    ``other`` adds one row that sums up all remaining values.
    """
    term = F.col(col) if isinstance(col, str) else col
    counts = events.select(term.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(
        F.count("*").alias("count")
    )
    order = [F.desc("count"), F.asc(name)]
    if not other:
        return counts.orderBy(*order).limit(k)
    top = counts.orderBy(*order).limit(k).withColumn("_top", F.lit(True))
    marked = counts.join(F.broadcast(top.select(name, "_top")), name, "left")
    label = F.when(F.col("_top"), F.col(name).cast("string")).otherwise(F.lit(OTHER))
    # The rest keeps its own row even if a top value is spelled like its label.
    return (
        marked.groupBy(label.alias(name), F.col("_top").isNull().alias("is_other"))
        .agg(F.sum("count").alias("count")).select(name, "count", "is_other")
    )


def histogram(events: DataFrame, bucket: str = "1 hour", time_col: str = TIME, empty: bool = False) -> DataFrame:
    """(bucket, count) by event time; ``empty`` also lists buckets without events.

    For a report on some time, give it the events of that time (``read_event_store``): the
    buckets go from the first event to the last.
    """
    start = F.window(F.col(time_col).cast("timestamp"), bucket).start
    counts = events.select(start.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("count"))
    return _with_empty(counts, bucket) if empty else counts


def _with_empty(counts: DataFrame, bucket: str) -> DataFrame:
    """Add the buckets between the first and the last that have no events.

    They are listed a thousand at a time: one far-off time is many rows, but not one huge array.
    """
    step = F.expr(f"interval {bucket}")
    ends = counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).where(F.col("lo").isNotNull())
    blocks = ends.select("hi", F.explode(F.sequence("lo", "hi", step * 1000)).alias("from"))
    last = F.least(F.col("hi"), F.col("from") + step * 999)
    spine = blocks.select(F.explode(F.sequence("from", last, step)).alias("bucket"))
    return spine.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")
    )


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def events_over_time(events: DataFrame, bucket: str = "1 hour", time_col: str = TIME) -> DataFrame:
    return histogram(events, bucket, time_col, empty=True)


def action_distribution(events: DataFrame, k: int = 10) -> DataFrame:
    return top_terms(events, "action", k, other=True, name="action")


def top_source_ips(events: DataFrame, k: int = 15) -> DataFrame:
    return top_terms(events, "source_address", k, name="source_address")


def top_applications(events: DataFrame, k: int = 15) -> DataFrame:
    return top_terms(events, "application", k, name="application")


def top_destination_ports(events: DataFrame, k: int = 15) -> DataFrame:
    return top_terms(events, "destination_port", k, name="destination_port")


def threat_hits_over_time(events: DataFrame, bucket: str = "1 hour", time_col: str = TIME) -> DataFrame:
    return histogram(events.where(has_ioc()), bucket, time_col)


def top_blocklisted_sources(events: DataFrame, k: int = 20) -> DataFrame:
    return top_terms(events.where(has_ioc()), "source_address", k, name="source_address")


def anomalies_over_time(events: DataFrame, bucket: str = "1 hour", time_col: str = TIME) -> DataFrame:
    return histogram(events.where(has_anomaly()), bucket, time_col)


def _fired_rules() -> Column:
    return F.array_distinct(
        F.transform(enrichment("threat_hunting.correlation_rules"), lambda r: r.rule)
    )


def rules_fired(events: DataFrame, k: int = 20) -> DataFrame:
    """An event counts once for each distinct rule it fired."""
    fired = events.where(has_rule()).select(F.explode(_fired_rules()).alias("rule"))
    return top_terms(fired, "rule", k, name="rule")


def source_countries(events: DataFrame, k: int = 20) -> DataFrame:
    return top_terms(events, enrichment("geoip.src.country_name"), k, name="country_name")


@dataclass(frozen=True)
class Board:
    """Reports that belong together: top lists by (values of an event, length), and time axes by (which events, with empty buckets)."""

    lists: Mapping[str, tuple[Column, int]]
    histograms: Mapping[str, tuple[Column, bool]]
    other: str | None = None


def board_entries(board: Board) -> Column:
    """The (report, value) rows of an event; ``_start`` is the start of its time bucket."""
    parts = [_entries(name, values) for name, (values, _) in board.lists.items()] + [
        F.when(keep, _entries(name, F.array(_stamp(F.col("_start"))))) for name, (keep, _) in board.histograms.items()
    ]
    nothing = F.array().cast("array<struct<report:string,value:string>>")
    return F.concat(*[F.coalesce(part, nothing) for part in parts])


def bucket_start(bucket: str, time_col: str) -> Column:
    return F.window(F.col(time_col).cast("timestamp"), bucket).start


def _report(events: DataFrame, board: Board, bucket: str, time_col: str) -> DataFrame:
    """Several reports in one pass: (report, value, count).

    Every event gives one small row per report it appears in. They are summed up before the
    only shuffle of event rows, and the sums, one row per distinct value, are staged; the
    lists and time axes are then made from those.
    """
    counts = (
        events.withColumn("_start", bucket_start(bucket, time_col)).select(F.inline(board_entries(board)))
        .where(F.col("value").isNotNull()).groupBy("report", "value").agg(F.count("*").alias("count"))
    )
    return finished_report(stage(counts, "report"), board, bucket)


def finished_report(counts: DataFrame, board: Board, bucket: str) -> DataFrame:
    """``counts(report, value, count)`` of all values to the board's lists and time axes."""
    lists, other = board.lists, board.other
    # One constant bound for all lists: Spark then cuts every partition to it before the shuffle.
    longest = max(k for _, k in lists.values())
    rank = F.row_number().over(Window.partitionBy("report").orderBy(F.desc("count"), F.asc("value")))
    limits = F.create_map(*[F.lit(x) for name, (_, k) in lists.items() for x in (name, k)])
    result = (
        counts.where(F.col("report").isin(list(lists))).withColumn("rank", rank)
        .where(F.col("rank") <= longest).where(F.col("rank") <= F.element_at(limits, F.col("report")))
        .select("report", "value", "count")
    )
    if other:
        shown = result.where(F.col("report") == other).select((-F.col("count")).alias("count"))
        rest = counts.where(F.col("report") == other).select("count").unionAll(shown).agg(
            F.sum("count").alias("count")
        ).where("count > 0")
        result = result.unionByName(rest.select(F.lit(other).alias("report"), F.lit(OTHER).alias("value"), "count"))
    for name, (_, with_empty) in board.histograms.items():
        mine = counts.where(F.col("report") == name)
        if with_empty:
            mine = _with_empty(mine.select(F.to_timestamp("value").alias("bucket"), "count"), bucket).select(
                F.lit(name).alias("report"), _stamp(F.col("bucket")).alias("value"), "count"
            )
        result = result.unionByName(mine)
    return result


def _entries(name: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("report"), v.alias("value")))


def _one(value: Column) -> Column:
    return F.array(value.cast("string"))


def overview_board() -> Board:
    """Traffic overview: volume over time, actions, top sources, applications and ports."""
    return Board(
        lists={
            "action_distribution": (_one(F.col("action")), 10),
            "top_source_ips": (_one(F.col("source_address")), 15),
            "top_applications": (_one(F.col("application")), 15),
            "top_destination_ports": (_one(F.col("destination_port")), 15),
        },
        histograms={"events_over_time": (F.lit(True), True)},
        other="action_distribution",
    )


def threat_board() -> Board:
    """Threats: indicator hits and anomalies over time, rules, sources, countries, applications."""
    return Board(
        lists={
            "top_blocklisted_sources": (F.when(has_ioc(), _one(F.col("source_address"))), 20),
            "rules_fired": (_fired_rules(), 20),
            "source_countries": (_one(enrichment("geoip.src.country_name")), 20),
            "top_applications": (_one(F.col("application")), 15),
        },
        histograms={
            "threat_hits_over_time": (has_ioc(), False),
            "anomalies_over_time": (has_anomaly(), False),
        },
    )


BOARDS = {"overview": overview_board, "threat": threat_board}


def overview_report(events: DataFrame, bucket: str = "1 hour", time_col: str = TIME) -> DataFrame:
    return _report(events, overview_board(), bucket, time_col)


def threat_report(events: DataFrame, bucket: str = "1 hour", time_col: str = TIME) -> DataFrame:
    return _report(events, threat_board(), bucket, time_col)


def stage_metrics(lines: DataFrame) -> DataFrame:
    """Counts per stage over classified and enriched lines, in one pass.

    Wants the columns ``reason`` and ``forwarder_enrichment``; every accepted event goes to
    the event store, and the enriched ones also to the SIEM.
    """
    good = F.col("reason").isNull()
    return lines.agg(
        F.count("*").alias("received"),
        F.count_if(good).alias("parsed"),
        F.count_if(~good).alias("rejected"),
        F.count_if(good & has_enrichment()).alias("enriched"),
        F.count_if(good).alias("to_store"),
        F.count_if(good & has_enrichment()).alias("to_siem"),
    )


def packet_metrics(packets: DataFrame, flows: DataFrame, rejects: DataFrame) -> DataFrame:
    """(parsed, normalized, skipped, rejected) of a packet run; skipped packets have no flow."""
    def tally(rows: DataFrame, parsed: int, normalized: int, rejected: int) -> DataFrame:
        return rows.agg(F.count("*").alias("n")).select(
            (F.col("n") * parsed).alias("parsed"), (F.col("n") * normalized).alias("normalized"),
            (F.col("n") * rejected).alias("rejected"),
        )

    stacked = tally(packets, 1, 0, 0).unionByName(tally(flows, 0, 1, 0)).unionByName(tally(rejects, 0, 0, 1))
    sums = stacked.agg(*[F.sum(c).alias(c) for c in ("parsed", "normalized", "rejected")])
    return sums.select("parsed", "normalized", (F.col("parsed") - F.col("normalized")).alias("skipped"), "rejected")
