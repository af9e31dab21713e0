"""Location of public addresses through a table of address ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.ip import ip_key, is_public_ip
from tidewatch.plans.joins import Lookup

SIDES = {"src": "source_address", "dst": "destination_address"}


def _shared_digits(lo: Column, hi: Column) -> Column:
    """How many leading hex digits two keys share."""
    return F.size(F.filter(
        F.sequence(F.lit(1), F.length(lo)), lambda n: F.left(lo, n) == F.left(hi, n)
    ))


def _keyed(geo: DataFrame) -> DataFrame:
    return geo.withColumn("lo", ip_key(F.col("ip_lo"))).withColumn("hi", ip_key(F.col("ip_hi")))


def rejected_ranges(geo: DataFrame) -> DataFrame:
    """The rows that ``prepare_geo`` can't use, each with its ``reason``."""
    return _keyed(geo).withColumn(
        "reason",
        F.when(F.col("lo").isNull() | F.col("hi").isNull(), "an end is no address")
        .when(F.length("lo") != F.length("hi"), "ends of two families")
        .when(F.col("lo") > F.col("hi"), "ends in the wrong order"),
    ).where("reason IS NOT NULL").drop("lo", "hi")


def prepare_geo(geo: DataFrame) -> DataFrame:
    """Range table -> (family, depth, bucket, lo, hi, place).

    A range is filed under the digits its ends share. Ranges that share exactly ``depth``
    digits each cross a boundary of the next digit, so a bucket holds at most 16 ranges of
    any disjoint set, and no range is ever copied. ``rejected_ranges`` lists the rows left out.
    """
    keyed = _keyed(geo)
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return (
        keyed.where((F.length("lo") == F.length("hi")) & (F.col("lo") <= F.col("hi")))
        .withColumn("depth", _shared_digits(F.col("lo"), F.col("hi")))
        .select(
            F.length("lo").alias("family"), "depth", F.left("lo", "depth").alias("bucket"), "lo", "hi",
            F.struct(
                F.coalesce("city", F.lit("Unknown")).alias("city"),
                F.coalesce("country_code", F.lit("XX")).alias("country_code"),
                F.coalesce("country_name", F.lit("Unknown")).alias("country_name"),
                F.struct(
                    F.when(placed, F.col("lat")).otherwise(F.lit(0.0)).alias("lat"),
                    F.when(placed, F.col("lon")).otherwise(F.lit(0.0)).alias("lon"),
                ).alias("location"),
            ).alias("place"),
        )
    )


def locate_addresses(addresses: DataFrame, geo: DataFrame) -> DataFrame:
    """``addresses(address)``, distinct -> (address, place) of the narrowest range around each.

    An equi-join on (family, depth, bucket): an address looks under those prefixes of its key
    whose depth the table has; there are 42 depths at most.
    """
    ranges = Lookup(prepare_geo(geo), "geo")
    depths: dict[int, list[int]] = {}
    for row in ranges.table.select("family", "depth").distinct().collect():
        depths.setdefault(row["family"], []).append(row["depth"])
    probed = F.array().cast("array<int>")
    for family, some in depths.items():
        probed = F.when(F.length("key") == family, F.array(*[F.lit(d) for d in sorted(some)])).otherwise(probed)
    keyed = addresses.where(is_public_ip(F.col("address"))).select(
        "address", ip_key(F.col("address")).alias("key")
    )
    probes = keyed.select(
        "address", "key", F.length("key").alias("family"),
        F.explode(probed).alias("depth"),
    ).withColumn("bucket", F.left("key", "depth"))
    around = F.col("l.key").between(F.col("r.lo"), F.col("r.hi"))
    hits = ranges.join(
        probes, ["family", "depth", "bucket"], "inner", spread_by="address", extra=around
    )
    # Of nested ranges the narrowest starts last and, at the same start, ends first.
    narrow = F.struct("lo", F.translate("hi", "0123456789abcdef", "fedcba9876543210"))
    return hits.groupBy("address").agg(F.max_by("place", narrow).alias("place"))


def geolocate(events: DataFrame, geo: DataFrame, id_col: str = "event_id") -> DataFrame:
    """(id, side, place): one row for each located side, ``src`` or ``dst``, of an event.

    Every address is located once, however many events carry it.
    """
    sides = events.select(
        id_col,
        F.inline(F.array(*[
            F.struct(F.lit(side).alias("side"), F.col(column).alias("address"))
            for side, column in SIDES.items()
        ])),
    ).where(F.col("address").isNotNull())
    places = locate_addresses(sides.select("address").distinct(), geo)
    return Lookup(places, "places").join(sides, ["address"], "inner", spread_by=id_col).select(
        id_col, "side", "place"
    )
