"""Behaviour counts against a plain replay, and location against a plain scan."""

import datetime as dt
import ipaddress
import random
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.operators.behavior import (
    activity_epochs, behavior, behavior_keys, key_counts, merge_counts, running_counts, sliding_counts,
)
from tidewatch.operators.geo import geolocate, locate_addresses

START = dt.datetime(2030, 1, 1, 23, 50)


def events(spark, rows):
    """rows: (seconds, source, user, logid)"""
    data = [(i, START + dt.timedelta(seconds=s), a, u, g) for i, (s, a, u, g) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, source_address string, user string, logid bigint")


def replay(rows, window=5):
    """One worker, one event at a time."""
    counts, last, flags = Counter(), None, {}
    for i, (s, a, u, g) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[0])):
        if last is not None and int((s - last) // 60) > window:
            counts.clear()
        last = s
        for kind, key in (("ip", a), ("user", u), ("logid", None if g is None or not 0 <= g < 2**32 else str(g))):
            if key is not None:
                counts[kind, key] += 1
                flags[i, kind] = counts[kind, key]
    return flags


def test_counts_equal_a_replay(spark):
    rng = random.Random(5)
    rows, at = [], 0.0
    for _ in range(3000):
        at += rng.choice([0, 0, 0.5, 3, 20, 359.9, 360, 361, 4000]) if rng.random() < 0.03 else rng.choice([0, 0.001, 1, 7])
        rows.append((at, "hot" if rng.random() < 0.5 else rng.choice("abc"), rng.choice(["u", None]), rng.choice([1, 2, 2**32, -1, None])))
    rng.shuffle(rows)
    frame = events(spark, rows)
    got = running_counts(behavior_keys(frame, "ts"), activity_epochs(frame, "ts")).collect()
    assert {(r.event_id, r.kind): r["count"] for r in got} == replay(rows)
    flags = {(r.event_id, r.kind): r["count"] for r in behavior(frame, "ts", threshold=10).collect()}
    assert flags == {k: n for k, n in replay(rows).items() if n > 10}


def test_a_hot_key_is_cut_into_slices(spark):
    """All events of one source at one time: the slices split it by event id."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(40_000).select(F.col("id").alias("event_id"), F.lit("2030-01-01 00:00:00").alias("ts"), F.lit("one").alias("src"))
        got = running_counts(behavior_keys(frame, "ts"), activity_epochs(frame, "ts"))
        row = got.agg(F.count_if(F.col("count") != F.col("event_id") + 1).alias("wrong"), F.count("*").alias("n")).first()
        assert (row.wrong, row.n) == (0, 40_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_reset_edges(spark):
    for gap, epochs in ((359.999999, 1), (360, 2)):
        frame = events(spark, [(0, "a", None, None), (gap, "a", None, None)])
        assert activity_epochs(frame, "ts").select("epoch").distinct().count() == epochs
    burst = [(i, "x", None, None) for i in range(11)]
    assert [(r.event_id, r.kind, r["count"]) for r in behavior(events(spark, burst), "ts").collect()] == [(10, "ip", 11)]
    assert behavior(events(spark, burst[:10]), "ts").count() == 0


def test_epochs_cross_days(spark):
    rows = [(i * 100, "a", None, None) for i in range(2000)] + [(2000 * 100 + 90_000, "a", None, None), (2000 * 100 + 300_000, "b", None, None)]
    got = activity_epochs(events(spark, rows), "ts").groupBy("epoch").agg(F.count("*").alias("n")).orderBy("epoch").collect()
    assert len(got) == 3 and got[0].epoch == START


def test_source_precedence(spark):
    frame = spark.createDataFrame([(1, "t", "1.1.1.1", "2.2.2.2", "3.3.3.3"), (2, "t", None, "2.2.2.2", "3.3.3.3"), (3, "t", None, None, "3.3.3.3"), (4, "t", None, None, None)],
                                  "event_id int, ts string, source_address string, srcip string, src string").withColumn("ts", F.lit("2030-01-01"))
    assert [(r.event_id, r.key) for r in behavior_keys(frame, "ts").orderBy("event_id").collect()] == [(1, "1.1.1.1"), (2, "2.2.2.2"), (3, "3.3.3.3")]


def test_merged_partials(spark):
    frame = behavior_keys(events(spark, [(0, "a", "u", 1)] * 11), "ts")
    parts = [key_counts(frame.where(f"event_id {t}")) for t in ("< 6", ">= 6")]
    assert {(r.kind, r.key): r["count"] for r in merge_counts(*parts).collect()} == {("ip", "a"): 11, ("user", "u"): 11, ("logid", "1"): 11}


def test_sliding_counts(spark):
    rng = random.Random(9)
    times = [rng.randrange(0, 4000) for _ in range(500)] + [300, 600, 900]
    frame = behavior_keys(events(spark, [(t, rng.choice("ab"), None, None) for t in times]), "ts")
    raw = [(r.key, r.ts) for r in frame.collect()]
    got = {(r.key, r.ts): (r.events, r.in_window) for r in sliding_counts(frame, 5).collect()}
    for key, ts in set(raw):
        inside = sum(1 for k, t in raw if k == key and ts - dt.timedelta(minutes=5) <= t <= ts)
        assert got[key, ts] == (raw.count((key, ts)), inside)
    assert len(got) == len(set(raw))


GEO = "ip_lo string, ip_hi string, country_code string, country_name string, city string, lat double, lon double"


def test_narrowest_range_wins(spark):
    rng = random.Random(2)
    blocks = [str(ipaddress.ip_network((rng.getrandbits(32), bits), strict=False)) for bits in (4, 8, 9, 12, 15, 16, 20, 23, 24, 28, 31, 32) for _ in range(12)]
    blocks += [str(ipaddress.ip_network(((0x2A00 << 112) | rng.getrandbits(100), bits), strict=False)) for bits in (16, 30, 48, 61, 64, 127) for _ in range(6)]
    nets = [ipaddress.ip_network(b) for b in dict.fromkeys(blocks)]
    geo = spark.createDataFrame([(str(n[0]), str(n[-1]), str(n), None, "C", 1.0, 2.0) for n in nets], GEO)
    probes = {str(n[0]) for n in nets} | {str(n[-1]) for n in nets} | {str(ipaddress.ip_address(rng.getrandbits(32))) for _ in range(500)}
    got = {r.address: r.place.country_code for r in locate_addresses(spark.createDataFrame([(p,) for p in probes], "address string"), geo).collect()}
    from tests.test_expressions import public

    for probe in probes:
        ip = ipaddress.ip_address(probe)
        around = [n for n in nets if n.version == ip.version and ip in n]
        want = str(max(around, key=lambda n: n.prefixlen)) if around and public(probe) else None
        assert got.get(probe) == want, probe


def test_only_public_sides_are_located(spark):
    geo = spark.createDataFrame([("0.0.0.0", "255.255.255.255", None, None, None, 3.0, None), ("9.0.0.5", "9.0.0.9", "AA", "A", "B", 1.0, 2.0)], GEO)
    frame = spark.createDataFrame([(1, "10.0.0.1", "9.0.0.7"), (2, "9.0.0.4", None), (3, "junk", "127.0.0.1")], "event_id int, source_address string, destination_address string")
    got = {(r.event_id, r.side): r.place.asDict(True) for r in geolocate(frame, geo).collect()}
    assert got == {(1, "dst"): {"city": "B", "country_code": "AA", "country_name": "A", "location": {"lat": 1.0, "lon": 2.0}},
                   (2, "src"): {"city": "Unknown", "country_code": "XX", "country_name": "Unknown", "location": {"lat": 0.0, "lon": 0.0}}}
