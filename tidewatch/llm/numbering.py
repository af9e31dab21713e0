"""Numbers within groups, running values within sequences and joins on uneven keys, with no group in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import stage

ROWS_PER_PART = 20_000
#: A key is heavy from this part of all rows on, so there are no more heavy keys than this.
MOST_HEAVY = 1_000


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str, total: int, copies: str | None = None,
             rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``rows`` plus ``name``: how many rows of the same ``by`` come before, gapless from 0.

    A group is cut into parts by a hash of its ``order`` columns, which should tell its rows
    apart; parts follow one another, and rows follow their order inside. A row with ``copies``
    stands for so many rows. ``total`` is the number of ``rows`` and sets the number of parts.
    """
    parts = max(1, math.ceil(total / rows_per_part))
    n = F.lit(1).cast("long") if copies is None else F.col(copies)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    group = [*by, "_part"]
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*group).agg(F.sum(n).alias("_n")).select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum(n).over(within), F.lit(0)))
    return placed.join(offsets, group).withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")


def sliced(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` in ranges of ``order``, written once with the number of the range as ``slice``: later slices hold later rows."""
    return stage(rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), name)


def join_uneven(left: DataFrame, right: DataFrame, on: list[str], copies: str, total: int, most_heavy: int = MOST_HEAVY) -> DataFrame:
    """Inner join where ``right`` knows in ``copies`` how many rows of ``left`` each of its keys meets, of ``total``.

    The rows of ``right`` that meet more than one in ``most_heavy`` of all are that few, and are
    broadcast; the others are joined by a shuffle in which no key has many rows.
    """
    most = max(1, total // most_heavy)
    heavy = F.broadcast(right.where(F.col(copies) > most))
    light = left.join(heavy.select(*on), on, "left_anti").join(right.where(F.col(copies) <= most), on)
    return left.join(heavy, on).unionByName(light)
