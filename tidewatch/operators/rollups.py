"""Daily partial counts of the report boards, kept beside the event store and merged at report time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.reports import BOARDS, TIME, board_entries, bucket_start, finished_report
from tidewatch.session import exists, remove, stage

#: Buckets of the time axes; they must divide a day, as a rollup holds whole days.
BUCKET = "1 hour"


def day_counts(events: DataFrame, bucket: str = BUCKET, time_col: str = TIME) -> DataFrame:
    """(board, report, value, count, day): what each day adds to the reports. Sums of these are the counts of any days.

    All boards are counted in one pass over the events, with map-side aggregation; a value
    has one row a day however many events carry it.
    """
    boards = F.array(*[F.struct(F.lit(name).alias("board"), board_entries(make()).alias("entries")) for name, make in BOARDS.items()])
    at = F.col(time_col).cast("timestamp")
    rows = events.withColumn("_start", bucket_start(bucket, time_col)).select(F.to_date(at).alias("day"), F.inline(boards))
    return rows.select("day", "board", F.inline("entries")).where(F.col("value").isNotNull()).groupBy("day", "board", "report", "value").agg(
        F.count("*").alias("count")
    ).select("board", "report", "value", "count", "day")


def refresh_rollups(events: DataFrame, path: str, days: list[dt.date] | None = None, bucket: str = BUCKET, time_col: str = TIME) -> None:
    """Count the ``days`` of ``events`` anew (all of them by default) and replace these days' folders.

    Give it the events of those days, as ``read_event_store`` has them. A day that is refreshed
    and has no events any more loses its folder; other days stay as they are.
    """
    spark = events.sparkSession
    if days is not None:
        events = events.where(F.to_date(F.col(time_col).cast("timestamp")).isin(days))
        for day in days:
            if exists(spark, f"{path}/day={day}"):
                remove(spark, f"{path}/day={day}")
    counts = day_counts(events, bucket, time_col).hint("rebalance", "day")
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def rollup_report(spark: SparkSession, path: str, board: str, first: dt.date | None = None, last: dt.date | None = None, bucket: str = BUCKET) -> DataFrame:
    """(report, value, count) of a board over whole days, ``last`` included, from their rollups alone."""
    schema = "board string, report string, value string, count bigint, day date"
    rows = spark.read.schema(schema).parquet(path).where(F.col("board") == board)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last))
    counts = rows.groupBy("report", "value").agg(F.sum("count").alias("count"))
    return finished_report(stage(counts, "rollup-report"), BOARDS[board](), bucket)
