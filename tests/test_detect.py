"""Indicator extraction and matching, hunting, and the assembled enrichment."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewatch.functions.rules import DEFAULT_PACK, RulePack, any_word_pattern
from tidewatch.functions.text import flat_view
from tidewatch.operators.hunt import hunt, searched_words
from tidewatch.operators.indicators import build_indicators, feed_union, indicator_counts, latest_valid_snapshot
from tidewatch.operators.iocs import extract_iocs
from tidewatch.operators.match import match_indicators, regroup_hits
from tidewatch.plans.enrich import Settings, detect, enrich, enrich_firewall, enrich_packets
from tidewatch.plans.joins import Lookup, heavy_keys
from tidewatch.schema import ENRICHMENT_FIELD
from tidewatch.sources.readers import clean_feed, feed_id, parse_packets, read_feeds, read_geo

import pytest

from tests.test_normalize import IP, TAIL, common, packet


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id bigint, t string")


def found(spark, *values):
    rows = extract_iocs(texts(spark, *values), F.col("t")).orderBy("event_id", "kind", "ord").collect()
    result = {}
    for r in rows:
        result.setdefault((r.event_id, r.kind), []).append(r.value)
    return result


def test_extraction(spark):
    md5 = "0123456789abcdef" * 2
    got = found(
        spark, f"see http://Evil.example/path?q from 9.9.9.9 and 9.9.9.9 {md5} x{md5}", "299.1.1.1 1.2.3.4567 fe80::1234",
        "search.php a-b.example.co.uk -x.io www.site.test/a, ftp://f/ HTTP://U.example.", "2001:db8:1:2:3:4:5:6 ::ffff:1.2.3.4",
        "http://a\nb.c http://ab", md5.upper() + " " + "a" * 33 + " " + "b" * 40,
    )
    assert got[0, "url"] == ["http://Evil.example/path?q"] and got[0, "ip"] == ["9.9.9.9"] and got[0, "hash"] == [md5]
    assert got[0, "domain"] == ["Evil.example"]
    assert got[1, "ip"] == ["99.1.1.1", "1.2.3.45", "::1"]
    assert got[2, "domain"] == ["search.php", "a-b.example.co.uk", "x.io", "www.site.test", "U.example"]
    assert got[2, "url"] == ["www.site.test/a,", "ftp://f/", "HTTP://U.example."]
    assert got[3, "ip"] == ["2001:db8:1:2:3:4:5:6", "::ffff:1.2.3.4"]
    assert got[4, "url"] == ["http://ab"]
    assert got[5, "hash"] == [md5.upper(), "b" * 40]


def test_repeats_across_fields_are_reported_once(spark):
    rows = spark.createDataFrame([(1, "198.51.100.9", "again 198.51.100.9")], "event_id int, a string, b string")
    got = extract_iocs(rows, flat_view({"a": "a", "b": "b"}).lines).collect()
    assert [(r.kind, r.value, r.ord) for r in got] == [("ip", "198.51.100.9", 0)]


def test_any_address_is_extracted_once(spark):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.tuples(*[st.integers(0, 255)] * 4), min_size=20, max_size=60, unique=True))
    def check(addresses):
        values = [".".join(map(str, a)) for a in addresses]
        got = found(spark, *[f"{v}\nrepeated source {v}" for v in values])
        assert [got[i, "ip"] for i in range(len(values))] == [[v] for v in values]

    check()


FEED = [("f1", "ip", "# note"), ("f1", "ip", " 9.9.9.9 "), ("f1", "ip", "9.9.9.9"), ("f1", "ip", "10.0.0.1"), ("f1", "ip", "9.9.9.0/24"),
        ("f2", "ip", "9.9.9.9"), ("f2", "ip", "; x"), ("f2", "ip", "8.8.4.4"), ("f3", "domain", "evil.example"), ("f3", "domain", "b.example # why"), ("f4", "url", "http://evil.example/x"),
        ("f4", "url", "// c"), ("f5", "hash", "ab" * 16), ("f5", "hash", "")]


def indicator_table(spark):
    feeds = clean_feed(spark.createDataFrame(FEED, "feed string, kind string, line string"))
    return build_indicators(feeds, F.lit("2030-01-01 00:00:00"))


def test_feeds_and_indicators(spark, tmp_path):
    table = indicator_table(spark)
    rows = {(r.kind, r.value): r for r in table.collect()}
    assert set(rows) == {("ip", "9.9.9.9"), ("ip", "8.8.4.4"), ("domain", "evil.example"), ("domain", "b.example # why"), ("url", "http://evil.example/x"), ("hash", "ab" * 16)}
    assert rows["ip", "9.9.9.9"].sources == ["f1", "f2"] and rows["ip", "9.9.9.9"].source_count == 2
    assert rows["domain", "evil.example"].sources is None
    assert {r.kind: r.indicators for r in indicator_counts(table).collect()} == {"ip": 2, "domain": 2, "url": 1, "hash": 1, "all": 6}
    assert feed_union(table, table).count() == 6
    (tmp_path / "a.txt").write_text("#c\n 1.1.1.1\r\n\n1.1.1.1\n/x\n")
    (tmp_path / "b.txt").write_text("evil.example\n")
    read = read_feeds(spark, [{"feed": "a", "kind": "ip", "path": str(tmp_path / "a.txt")}, {"feed": "b", "kind": "domain", "path": str(tmp_path / "b.txt")}])
    assert sorted(map(tuple, read.collect())) == [("a", "ip", "1.1.1.1"), ("b", "domain", "evil.example")]
    with pytest.warns(UserWarning, match="left out"):
        assert read_feeds(spark, [{"feed": "x", "kind": "ip", "path": str(tmp_path / "none")}]).count() == 0
    assert len(spark.range(1).select(feed_id(F.lit("https://feed.example/list"))).first()[0]) == 64


def test_snapshots_expire_strictly(spark):
    rows = [("a", "ip", "2030-01-01 00:00:00", "old"), ("a", "ip", "2030-01-02 00:00:01", "new"), ("b", "ip", "2030-01-02 00:00:00", "edge")]
    frame = spark.createDataFrame(rows, "feed string, kind string, fetched_at string, value string").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    got = latest_valid_snapshot(frame, F.lit("2030-01-03 00:00:00")).collect()
    assert [r.value for r in got] == ["new"]


def test_matching_is_exact_and_regrouped(spark):
    events = texts(spark, "evil.example 9.9.9.9 8.8.4.4 EVIL.example", "http://evil.example/x.", "AB" * 16, "none")
    grouped = {r.event_id: r.ioc_matches for r in regroup_hits(match_indicators(extract_iocs(events, F.col("t")), indicator_table(spark))).collect()}
    assert sorted(grouped) == [0, 1]
    assert [(m.ip, m.status, m.sources, m.source_count) for m in grouped[0].malicious_ips] == [("9.9.9.9", "blocklisted", ["f1", "f2"], 2), ("8.8.4.4", "blocklisted", ["f2"], 1)]
    assert grouped[0].malicious_domains == ["evil.example"] and grouped[0].malicious_urls is None
    assert grouped[1].malicious_domains == ["evil.example"] and grouped[1].malicious_urls is None


def test_salted_join_equals_broadcast_join(spark):
    facts = spark.range(20_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    lookup = Lookup(spark.createDataFrame([("hot", 1, 5), ("k1", 2, 9), ("k2", 3, 0)], "k string, v int, lo int"), "t")
    assert 0 < lookup.bytes < 1000
    for how in ("inner", "left", "left_semi"):
        small, big = (lookup.join(facts, ["k"], how, "event_id", limit=limit, heavy_rows=1000) for limit in (10**9, 0))
        assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, small.collect())) == sorted(map(str, big.select(*small.columns).collect()))
    near = F.col("l.event_id") > F.col("r.lo")
    counts = [lookup.join(facts, ["k"], "inner", "event_id", extra=near, limit=limit).count() for limit in (10**9, 0)]
    assert counts[0] == counts[1] > 6000


def test_only_heavy_keys_are_split(spark):
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997))
    facts = spark.range(80_000).select(F.col("id").alias("event_id"), key.alias("k"))
    assert [r.k for r in heavy_keys(facts, ["k"], 1000).collect()] == ["hot"] and heavy_keys(facts, ["k"], 50_000).count() == 0
    lookup = Lookup(facts.select("k", F.lit(1).alias("v")).distinct(), "t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup.join(facts, ["k"], "inner", "event_id", limit=0, heavy_rows=1000)
        parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(parts) == 80_000 and max(parts) <= 2 * sum(parts) / 8


def hunted(spark, *values, pack=None):
    rows = hunt(texts(spark, *values), flat_view({"t": "t"}), *([pack] if pack else [])).orderBy("event_id").collect()
    return [r.threat_hunting for r in rows]


def test_hunting(spark):
    got = hunted(spark, "quiet words", "run NC now; psexec", "once upon", "/find?id=7' or 1=1", "Vulnerability in LDAP and MySQL", "x" * 150 + "' tail", "rsh-ell rsh", "POWER\u017fHELL -enc " + "A" * 20)
    assert got[0] is None
    assert got[1].suspicious_process == "nc" and [p.pattern for p in got[1].suspicious_patterns] == ["command_injection"]
    assert [r.rule for r in got[1].correlation_rules] == ["lateral_movement"]
    assert got[2].suspicious_process == "nc"
    assert [p.pattern for p in got[3].suspicious_patterns] == ["sql_injection"] and got[3].suspicious_patterns[0].field_path == "t"
    assert got[4].critical_asset_access == "ldap" and got[4].correlation_rules[0].rule == "network_threat_detected"
    assert got[5].suspicious_patterns[-1].sample == "x" * 100
    assert [r.rule for r in got[6].correlation_rules] == ["high_risk_protocol"]
    assert "obfuscated_powershell" in [p.pattern for p in got[7].suspicious_patterns]


def test_keywords_span_fields_but_patterns_do_not(spark):
    rows = spark.createDataFrame([(1, "net", "user"), (2, "drop", "table")], "event_id int, a string, b string")
    got = {r.event_id: r.threat_hunting for r in hunt(rows, flat_view({"a": "a", "b": "b"})).collect()}
    assert got[1].suspicious_process == "net user" and got[1].suspicious_patterns is None
    assert got[2].suspicious_patterns is None and [r.rule for r in got[2].correlation_rules] == ["sql_injection_attempt"]


def test_words_are_tried_only_where_one_of_them_begins():
    assert any_word_pattern(["sudo", "nmap", "1=1"]).startswith("(?=[1ns])")
    assert [m[1] for m in re.finditer(any_word_pattern(["sudo", "nmap", "1=1"]), "0 1=1 1=2 nnmap sudo")] == ["1=1", "nmap", "sudo"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*searched_words(DEFAULT_PACK), "x", "1", " "]), max_size=6), st.integers(0, 2))
def test_one_pass_finds_every_word(parts, cut):
    """Also words that overlap, begin alike or lie inside one another."""
    text, words = "".join(part[cut:] for part in parts), searched_words(DEFAULT_PACK)
    found = [m[1] for m in re.finditer(any_word_pattern(words), text)]
    assert [w for w in words if w in text] == [w for w in words if any(w in f for f in found)]


def test_letters_with_odd_case_in_words(spark):
    """A long s is an s for the rules, but not for process names; an I with a dot is an i and a mark for these alone."""
    rows = hunt(texts(spark, "p\u017fexec", "PSEXEC", "HM\u0130", "P\u0130NG", "ncatelnet"), flat_view({"t": "t"}))
    got = {r.event_id: r.threat_hunting for r in rows.collect()}
    assert [r.rule for r in got[0].correlation_rules] == ["lateral_movement"] and got[0].suspicious_process is None
    assert got[1].suspicious_process == "psexec" and got[2].critical_asset_access == "hmi" and got[3] is None
    assert got[4].suspicious_process == "nc"


def test_text_is_put_together_once(spark):
    """The searches read one column; each use of an expression over arrays would join all fields again."""
    rows = spark.range(1).selectExpr("id as event_id", "cast(id as string) as a", "cast(id as string) as b")
    plan = detect(rows, flat_view({"a": "a", "b": "b"}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws") == 2


def test_own_rules(spark):
    pack = RulePack(patterns={"digits": r"\d{3}"}, processes=("forklift",), assets=("vault",), rules={"both": r"(?i)vault.*forklift"})
    got = hunted(spark, "Vault 123 and FORKLIFT", "12", pack=pack)
    assert got[0].suspicious_patterns[0].pattern == "digits" and got[0].suspicious_process == "forklift" and got[0].correlation_rules[0].rule == "both"
    assert got[1] is None
    assert hunted(spark, "nc' drop table", pack=RulePack({}, (), (), {})) == [None]


def geo_table(spark):
    return spark.createDataFrame([("45.0.0.0", "45.255.255.255", "ZZ", "Zedland", None, 1.0, None)],
                                 "ip_lo string, ip_hi string, country_code string, country_name string, city string, lat double, lon double")


def test_firewall_end_to_end(spark):
    lines = ["<14>Jan 02 PA-A " + common(p14="telnet", p8="9.9.9.9"), common(p8="45.1.1.1", p14="web"), common(p8="192.168.0.1", p14="web"), "nothing",
             "<14>Jan 02 PA-A " + common(p3="THREAT", p7="10.9.9.9") + ",/q?id=1%27%20OR%201=1,SQL Injection Attempt(7),any,high"]
    frame = spark.createDataFrame(list(enumerate(lines)), "event_id bigint, raw string").withColumn("ingest_ts", F.lit("2030-01-02 03:04:07").cast("timestamp"))
    run = enrich_firewall(frame, indicator_table(spark), geo_table(spark))
    rows = {r.event_id: r[ENRICHMENT_FIELD] for r in run.events.collect()}
    assert rows[0].ioc_matches.malicious_ips[0].asDict() == {"ip": "9.9.9.9", "source_count": 2, "sources": ["f1", "f2"], "status": "blocklisted"}
    assert rows[0].threat_hunting.suspicious_process == "telnet" and rows[0].intel_last_updated == "2030-01-01T00:00:00+00:00"
    assert rows[0].geoip is None and rows[0].behavioral_anomalies is None
    assert rows[1].geoip.src is None and rows[1].geoip.dst.asDict(True) == {"city": "Unknown", "country_code": "ZZ", "country_name": "Zedland", "location": {"lat": 0.0, "lon": 0.0}}
    assert rows[2] is None
    assert rows[4].threat_hunting.correlation_rules[0].rule == "sql_injection_attempt"
    assert run.rejects.count() == 1
    assert run.metrics().first().asDict() == {"received": 5, "parsed": 4, "rejected": 1, "enriched": 3, "to_store": 4, "to_siem": 3}
    assert sorted(r.event_id for r in run.siem_lines().collect()) == [0, 1, 4]
    off = enrich_firewall(frame, indicator_table(spark), settings=Settings(enrich=False))
    assert off.events.where(f"{ENRICHMENT_FIELD} is not null").count() == 0 and off.events.count() == 4 and off.siem_lines().count() == 0


def test_packets_end_to_end(spark):
    lines = [packet(ip=IP, tcp={"tcp_tcp_srcport": "1", "tcp_tcp_dstport": "2"}, http={"uri": ["/a", "x' y"]}), packet(ip={"ip_ip_src": "10.0.0.1"})]
    good, _ = parse_packets(spark.createDataFrame(list(enumerate(lines)), "event_id bigint, raw string"))
    rows = {r.event_id: r[ENRICHMENT_FIELD] for r in enrich_packets(good, indicator_table(spark)).drop("event").collect()}
    assert [m.ip for m in rows[0].ioc_matches.malicious_ips] == ["8.8.4.4"]
    assert [(p.field_path, p.pattern) for p in rows[0].threat_hunting.suspicious_patterns] == [("http.uri[1]", "sql_injection")]
    assert rows[1] is None


def test_generic_events_use_the_same_job(spark):
    rows = spark.createDataFrame([(i, "evil.example", "ann", "2030-01-01 00:00:%02d" % i) for i in range(12)], "event_id int, url string, user string, at string")
    got = enrich(rows, flat_view({"url": "url", "user": "user"}), indicator_table(spark), None, "at").orderBy("event_id").collect()
    assert all(r[ENRICHMENT_FIELD].ioc_matches.malicious_domains == ["evil.example"] for r in got)
    assert [r[ENRICHMENT_FIELD].behavioral_anomalies is not None for r in got] == [False] * 10 + [True] * 2
    assert got[10][ENRICHMENT_FIELD].behavioral_anomalies.high_frequency_user.asDict() == {"count": 11, "time_window_minutes": 5}


def test_missing_location_table_only_warns(spark, tmp_path):
    with pytest.warns(UserWarning, match="not located"):
        assert read_geo(spark, str(tmp_path / "none")) is None
    geo_table(spark).coalesce(1).write.parquet(str(tmp_path / "geo"))
    assert read_geo(spark, str(tmp_path / "geo")).count() == 1


def test_plans_have_no_python_and_no_nested_loops(spark):
    frame = spark.createDataFrame([(1, common())], "event_id bigint, raw string")
    plan = enrich_firewall(frame, indicator_table(spark), geo_table(spark)).events._jdf.queryExecution().executedPlan().toString()
    assert not re.search("BatchEvalPython|ArrowEvalPython|BroadcastNestedLoop|CartesianProduct|SinglePartition", plan)


def test_default_feeds():
    from tidewatch.sources.readers import DEFAULT_FEEDS, default_manifest

    assert [len(DEFAULT_FEEDS[k]) for k in ("ip", "domain", "url", "hash")] == [12, 5, 3, 3]
    assert len({m["path"] for m in default_manifest("/feeds")}) == 23
