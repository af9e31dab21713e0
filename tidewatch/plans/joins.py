"""Joins against lookup tables whose keys may be used very unevenly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.session import stage

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64
# A key is heavy from so many rows on, and from its part of all rows on; so few keys are heavy.
HEAVY_ROWS = 100_000
MOST_HEAVY = 4_096
_ROW_OVERHEAD = 64


class Lookup:
    """A lookup table written once, with its measured in-memory size and what else is ``observed`` on the way."""

    def __init__(self, table: DataFrame, name: str, **observed: Column):
        seen = Observation()
        width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))
        measured = table.observe(
            seen, F.sum(F.coalesce(width, F.lit(0)) + _ROW_OVERHEAD).alias("bytes"),
            *[value.alias(key) for key, value in observed.items()],
        )
        self.table = stage(measured, name)
        self.seen = seen.get
        self.bytes = self.seen["bytes"] or 0

    def join(
        self,
        facts: DataFrame,
        on: list[str],
        how: str,
        spread_by: str,
        extra=None,
        limit: int = BROADCAST_BYTES,
        salts: int = SALTS,
        heavy_rows: int = HEAVY_ROWS,
    ) -> DataFrame:
        """Join ``facts`` to this table on equal ``on`` columns (and the ``extra`` condition).

        A table below ``limit`` bytes is broadcast, so the facts are not moved and hot keys
        do no harm. A larger one is joined by a shuffle. The facts' keys are counted for it,
        and only the heavy ones, a bounded number, are split into ``salts`` parts: a fact row
        goes to one part, chosen by its ``spread_by`` column, and a lookup row to all of them.
        Both ways give the same rows.
        """
        if self.bytes <= limit:
            return _join(facts, F.broadcast(self.table), on, how, extra)
        heavy = heavy_keys(facts, on, heavy_rows)
        no_key = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
        part = F.pmod(F.xxhash64(spread_by), F.lit(salts))
        salted = facts.join(heavy, on, "left").withColumn(
            "_salt", F.when(F.col("_heavy") | no_key, part).otherwise(F.lit(0).cast("bigint"))
        ).drop("_heavy")
        parts = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        copies = self.table.join(heavy, on, "left").withColumn(
            "_salt", F.explode(F.when(F.col("_heavy"), parts).otherwise(F.array(F.lit(0).cast("bigint"))))
        ).drop("_heavy")
        return _join(salted, copies, [*on, "_salt"], how, extra).drop("_salt")


def heavy_keys(facts: DataFrame, on: list[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``on`` and ``_heavy`` for the keys with many rows, to broadcast: no more than MOST_HEAVY keys can have that many."""
    counts = stage(facts.groupBy(*on).agg(F.count("*").alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    least = max(heavy_rows, total // MOST_HEAVY)
    return F.broadcast(counts.where(F.col("_rows") > least).select(*on, F.lit(True).alias("_heavy")))


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, extra) -> DataFrame:
    if extra is None:
        return left.join(right, on, how)
    left, right = left.alias("l"), right.alias("r")
    condition = extra
    for name in on:
        condition = condition & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    kept = [F.col(f"r.`{c}`") for c in right.columns if c not in on]
    return left.join(right, condition, how).select("l.*", *kept)
