"""Firewall lines, packets, SIEM lines and JSON output."""

import json

from pyspark.sql import functions as F

from tidewatch.operators.normalize_firewall import normalize_firewall
from tidewatch.operators.normalize_packets import normalize_packets
from tidewatch.operators.siem import quoted_list, siem_line
from tidewatch.schema import ENRICHMENT_FIELD
from tidewatch.sources.readers import parse_packets
from tidewatch.sources.sinks import firewall_json, packet_json

import pytest

TAIL = "100,60,40,7,2030/01/02 03:04:00,9,any,,55,0x0,A,B,,3,4,aged-out,1,2,3,4,,fw-host,from-policy"


def common(**changes):
    fields = ["1", "2030/01/02 03:04:05", "0099", "TRAFFIC", "end", "10", "2030/01/02 03:04:04", "10.1.2.3", "45.33.32.156", "", "",
              "rule-one", "", "", "ssl", "vsys1", "in", "out", "eth1", "eth2", "fwd", "2030/01/02 03:04:06", "77", "1", "5000", "443",
              "0", "0", "0x1", "tcp", "allow"]
    for position, value in changes.items():
        fields[int(position[1:])] = value
    return ",".join(fields)


def run(spark, *lines):
    frame = spark.createDataFrame(list(enumerate(lines)), "event_id bigint, raw string").withColumn(
        "ingest_ts", F.lit("2030-01-02 03:04:07").cast("timestamp"))
    events, rejects = normalize_firewall(frame)
    return {r.event_id: r for r in events.collect()}, {r.event_id: r for r in rejects.collect()}


def test_envelopes_types_and_rejects(spark):
    threat = common(p3="THREAT") + ",/login?x=1,Bad Thing(1),any,high,c2s"
    events, rejects = run(
        spark, common(),                                             # 0 bare
        "<14>Jan 02 03:04:05 PA-EDGE-9 " + common() + "," + TAIL,    # 1 device host
        "<14>Jan 02 03:04:05 other-host " + common() + "," + TAIL,   # 2 date found
        "<14>" + common(),                                           # 3 glued header
        "some free text", common()[:-6], "",                         # 4 5 6
        "<14>Jan 02 PA-X " + threat,                                 # 7
        common() + "," + TAIL.replace("fw-host", "PA-HOST"),         # 8 cut at the device name
        common(p11='"a, ""b"""'), common(p24="many", p25="9" * 30, p22="+7", p5="-1"), common(p7=" \u3000 ", p8="\t1.1.1.1 "),
        "PA-" + common().replace(" ", "_"),                          # 12 no blank after the host mark
        "<14>no,2030/ blank",                                        # 13
    )
    assert sorted(rejects) == [4, 5, 6, 8, 13] and rejects[5].reason.startswith("Palo Alto line has 30 CSV fields")
    assert rejects[4].raw == "some free text"
    assert events[0].log_number == 1 and events[0].serial_number == "0099" and events[0].source_address == "10.1.2.3"
    assert events[0].nat_source_ip is None and events[0]["@timestamp"] == "2030-01-02T03:04:07+00:00" and events[0].log_source == "palo_alto"
    for i in (1, 2):
        assert (events[i].bytes, events[i].device_name, events[i].session_end_reason, events[i].source_port) == (100, "fw-host", "aged-out", 5000)
    assert events[3].log_number is None and events[3].unparsed == {"log_number": "<14>1"}
    assert events[7].type == "THREAT" and events[7].threat_name == "/login?x=1" and events[7].bytes is None and events[7].severity == "high"
    assert events[9].rule_name == 'a, "b"'
    assert events[10].unparsed == {"source_port": "many", "destination_port": "9" * 30}
    assert events[10].session_id == 7 and events[10].config_version == -1
    assert events[11].source_address is None and events[11].destination_address == "1.1.1.1"
    assert events[12].unparsed == {"log_number": "PA-1"}


def test_floats(spark):
    head = common() + "," + "," * 70
    events, _ = run(spark, head + ",1.5", head + ",inf", head + ",1d", head + ",-NaN", head + ",1e999", head + ",.5e1", head + ",2030-01-02T03:04:05")
    assert [events[i].high_resolution_timestamp for i in range(7)] == [1.5, 0.0, None, 0.0, 0.0, 5.0, None]
    assert events[2].unparsed == {"high_resolution_timestamp": "1d"}


def test_json_output(spark):
    frame = spark.createDataFrame([(1, common(p24="odd"))], "event_id bigint, raw string").withColumn("ingest_ts", F.lit("2030-01-02 03:04:07").cast("timestamp"))
    events, _ = normalize_firewall(frame)
    text = events.withColumn(ENRICHMENT_FIELD, F.expr("named_struct('a', cast(null as string), 'b', 2)")).select(firewall_json()).first()[0]
    data = json.loads(text)
    assert list(data) == sorted(data) and " " not in text.split('"rule-one"')[0][:14]
    assert data["source_port"] == "odd" and data["destination_port"] == 443 and data[ENRICHMENT_FIELD] == {"b": 2}
    assert "source_user" not in data


def test_siem_line(spark):
    frame = spark.createDataFrame([(1, common(p30="allow \"x\"", p11="-") + "," + TAIL)], "event_id bigint, raw string").withColumn(
        "ingest_ts", F.lit("2030-01-02 03:04:07").cast("timestamp"))
    events, _ = normalize_firewall(frame)
    line = events.withColumn(ENRICHMENT_FIELD, F.expr("named_struct('intel_last_updated', 'then', 'geoip', 1)")).select(siem_line()).first()[0]
    assert line.startswith('<134>PaloAlto: device_name=fw-host serial_number=0099 generated_time="2030/01/02 03:04:04" src_ip=10.1.2.3 dst_ip=45.33.32.156 '
                           'src_port=5000 dst_port=443 action="allow \\"x\\"" application=ssl action_flags=0x0 ')
    assert line.endswith(" virtual_system=vsys1 enrich_intel_last_updated=then") and "log_source" not in line and "@timestamp" not in line


def test_siem_list_value(spark):
    got = spark.sql("select array('a b', 'c', 'd\"e') as l").select(F.expr(quoted_list("l"))).first()[0]
    assert got == '"a b,c,d\\e"'


def packet(**layers):
    return json.dumps({"timestamp": "1700000000123", "layers": layers})


IP = {"ip_ip_src": "8.8.4.4", "ip_ip_dst": "10.0.0.9"}


def test_packets(spark):
    lines = [
        packet(ip=IP, tcp={"tcp_tcp_srcport": "4444", "tcp_tcp_dstport": "80"},
               frame={"frame_frame_len": "512", "frame_frame_protocols": "eth:ip:tcp", "frame_frame_time_utc": "t"}),     # 0
        packet(ipv6={"ipv6_ipv6_src": "2a00::1"}, udp={"udp_udp_srcport": "53", "udp_udp_dstport": "99999"}),               # 1
        packet(frame={"frame_frame_len": "60"}), json.dumps({"layers": {"ip": IP}}),                                       # 2 3
        json.dumps({"timestamp": "soon", "layers": {"ip": IP}}), json.dumps({"timestamp": 17, "layers": {"ip": IP}}),       # 4 5
        packet(ip={"ip_ip_src": "1.1.1.1"}, source_address="raw", tcp={"tcp_tcp_srcport": "x"}),                            # 6
        packet(ip={"ip_ip_src": "", "ip_ip_dst": ""}, ipv6={"ipv6_ipv6_src": "2a00::1"}),                                   # 7 empty v4 wins
        packet(ip={"ip_ip_src_host": "2.2.2.2", "ip_ip_dst": 5, "ip_ip_dst_host": "3.3.3.3"}),                              # 8
        packet(ip=["not", "an", "object"], ipv6={"ipv6_ipv6_dst": "2a00::2"}),                                              # 9
        '{"index":{}}', "{broken", "  ",                                                                                     # 10 11 12
    ]
    good, bad = parse_packets(spark.createDataFrame(list(enumerate(lines)), "event_id bigint, raw string"))
    flows = normalize_packets(good)
    rows = {r.event_id: r for r in flows.withColumn(ENRICHMENT_FIELD, F.expr("if(event_id = 0, named_struct('x', 1, 'y', cast(null as int)), null)"))
            .withColumn("json", packet_json()).drop("event").collect()}
    assert [r.event_id for r in bad.collect()] == [11] and sorted(rows) == [0, 1, 6, 8, 9]
    r = rows[0]
    assert (r.source_address, r.destination_address, r.ip_version, r.source_port, r.destination_port, r.ip_protocol, r.bytes, r.protocols,
            r.timestamp_ms, r.log_type) == ("8.8.4.4", "10.0.0.9", 4, 4444, 80, "TCP", 512, "eth:ip:tcp", 1700000000123, "tshark")
    assert (rows[1].ip_version, rows[1].ip_protocol, rows[1].destination_address, rows[1].destination_port, rows[1].bytes) == (6, "UDP", "", 0, 0)
    assert (rows[6].source_address, rows[6].destination_address, rows[6].source_port, rows[6].ip_protocol) == ("1.1.1.1", "", 0, "TCP")
    assert (rows[8].source_address, rows[8].destination_address) == ("2.2.2.2", "")
    assert (rows[9].destination_address, rows[9].ip_version, rows[9].ip_protocol) == ("2a00::2", 6, "OTHER")
    out = json.loads(rows[0].json)
    assert out["Source Port"] == 4444 and out["Bytes"] == 512 and out["ip"] == IP and out[ENRICHMENT_FIELD] == {"x": 1}
    assert json.loads(rows[6].json)["source_address"] == "1.1.1.1" and ENRICHMENT_FIELD not in json.loads(rows[6].json)
