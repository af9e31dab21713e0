"""Security inputs derived from the given tables, as Spark DataFrames.

Every function reads whole tables; ``checks/twins.py`` derives the same rows in plain SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

APPS = ["ssl", "web-browsing", "dns", "ntp", "smtp", "ssh", "ftp", "telnet", "rdp", "smb", "snmp",
        "imap", "pop3", "sip", "ldap", "kerberos", "mysql", "redis", "quic", "icmp"]
PORTS = [443, 80, 53, 123, 25, 22, 21, 23, 3389, 445, 161, 143, 110, 5060, 389, 88, 3306, 6379, 8443, 8080]
ACTIONS = ["allow", "deny", "drop", "reset-both", "reset-client", "reset-server", "alert", "block-url",
           "block-ip", "sinkhole", "continue", "override"]
# One phrase per correlation rule and scan pattern, and a clean one; no commas, no double quotes.
MESSAGES = [
    "authentication failure for admin", "nmap sweep seen", "trojan dropper", "unusual login time",
    "ftp transfer of dump", "sudo to root", "configuration changed", "service stopped", "service created",
    "autostart entry", "wmi execution", "beacon to host", "security policy note", "blocked connection",
    "mining pool login", "union  select from users", "exploit kit", "rlogin session",
    "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVphYmNkZWZnaGlqa2xtbm9w",
    r"\x41\x42\x43\x44\x45\x46\x47\x48\x49\x4a\x4b", r"ABCDEF",
    "powershell -enc QUJDREVGR0hJSktMTU5PUA==", "bash -c echo|$({})", "id=1' or 1=1", "<script>alert(1)",
    "ls /tmp && id", "../../etc/passwd", "sqlmap scanner", "xmrig worker", "emotet loader",
    "regular keepalive",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events dealt over all cores: their file has few row groups, and one can only be read by one task."""
    return table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism)


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def source_address() -> Column:
    user = F.col("user_id")
    return F.concat(
        F.when(user % 3 == 0, "10.0.").otherwise("93.184."),
        text(F.floor(user / 256)), F.lit("."), text(user % 256),
    )


def destination_address() -> Column:
    event = F.col("event_id")
    return F.concat(F.lit("185.220."), text(event % 16), F.lit("."), text(event % 250))


def firewall_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, ingest_ts, raw): one firewall line per event, some of them malformed."""
    event, user = F.col("event_id"), F.col("user_id")
    stamp = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    cents = text(F.floor(F.col("value") * 100))
    is_threat = F.col("event_type") == "error"
    blank = F.lit("")
    common = [
        F.lit("1"), stamp, F.concat(F.lit("00795"), text(user)),
        F.when(is_threat, "THREAT").when(F.col("event_type") == "signup", "SYSTEM").otherwise("TRAFFIC"),
        F.when(is_threat, "spyware").otherwise("end"), F.lit("2561"), stamp,
        source_address(), destination_address(), blank, blank,
        F.when(event % 97 == 2, '"allow, ""web"""').otherwise("allow-web"),
        F.when(user % 2 == 0, F.concat(F.lit("user"), text(user))).otherwise(""), blank,
        pick(APPS, event % 20), F.lit("vsys1"), F.lit("trust"), F.lit(" untrust "),
        F.lit("ethernet1/2"), F.lit("ethernet1/1"), F.lit("forward"), stamp, text(event), F.lit("1"),
        F.when(event % 97 == 3, F.concat(F.lit("sp"), text(event))).otherwise(text(1024 + event % 50000)),
        text(pick(PORTS, user % 20)), F.lit("0"), F.lit("0"), F.lit("0x400019"),
        F.lit("tcp"),
    ]
    action = F.when(event % 50 == 0, "").otherwise(pick(ACTIONS, F.floor(event / 7) % 12))
    device = F.when(event % 20 == 2, "PA-FW-01").otherwise("FW-01")
    traffic = [cents, cents, F.lit("0"), text(event % 9), stamp, text(user % 60), F.lit("any"), blank,
               text(event), F.lit("0x0"), F.lit("10.0.0.0-10.255.255.255"), F.lit("Nowhere"), blank,
               F.lit("3"), F.lit("4"), F.lit("tcp-fin"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"),
               blank, device, F.lit("from-policy")]
    threat = [pick(MESSAGES, event % 31), F.lit("(40001)"), F.lit("any"), F.lit("high"),
              F.lit("client-to-server")]
    short = F.concat_ws(",", *common)
    full = F.concat_ws(
        ",", *common, action,
        F.when(is_threat, F.concat_ws(",", *threat)).otherwise(F.concat_ws(",", *traffic)),
    )
    body = F.when(event % 97 == 0, F.concat(F.lit("link flap on port "), text(event))).when(
        event % 97 == 1, short
    ).otherwise(full)
    head = (
        F.when(event % 4 == 0, "<14>Jan 02 13:10:01 PA-FW-01 ")
        .when(event % 4 == 1, "<14>").when(event % 4 == 2, "").otherwise("<14>Jan 02 13:10:01 fw-edge-01 ")
    )
    return events(spark, sf_dir).select(
        "event_id", F.col("ts").cast("timestamp").alias("ingest_ts"), F.concat(head, body).alias("raw")
    )


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feed, kind, line): raw lines of four kinds of feeds, with comments, blanks and repeats."""
    events = table(spark, sf_dir, "events").select(
        "event_type", "value", source_address().alias("src"), destination_address().alias("dst")
    )
    pages = table(spark, sf_dir, "pages").select("url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
    documents = table(spark, sf_dir, "documents")
    kind = F.col("event_type")

    def feed(rows: DataFrame, name: str, kind_name: str, line: Column, listed: Column) -> DataFrame:
        """A line for every row: those that the feed doesn't list are comments."""
        text = F.when(F.coalesce(listed, F.lit(False)), line).otherwise(F.concat(F.lit("# "), line))
        return rows.select(F.lit(name).alias("feed"), F.lit(kind_name).alias("kind"), text.alias("line"))

    hashes = documents.select(
        "lang", F.explode(F.regexp_extract_all("text", F.lit(r"\b(?:[a-f0-9]{64}|[a-f0-9]{40}|[a-f0-9]{32})\b"), 0)).alias("h")
    )
    asked = F.contains("url", F.lit("?"))
    parts = [
        feed(events, "addresses-a", "ip",
             F.when(kind == "error", F.col("dst")).when(kind == "signup", F.col("src"))
             .when(kind == "click", F.concat(F.col("dst"), F.lit("/24")))
             .when(kind == "view", F.concat(F.lit("# "), F.col("dst")))
             .otherwise(F.concat(F.lit("  "), F.col("dst"), F.lit("\t"))), (F.col("value") > 60) | (kind == "signup")),
        feed(events, "addresses-b", "ip",
             F.when(kind == "purchase", F.col("dst")).when(kind == "error", F.col("dst"))
             .when(kind == "click", F.lit("")).otherwise(F.concat(F.lit("; "), F.col("src"))), F.col("value") > 80),
        feed(pages, "urls", "url", F.col("url"), F.startswith("url", F.lit("http://"))),
        feed(pages, "hosts", "domain", F.col("host"), asked),
        feed(pages, "hosts", "domain", F.concat(F.lit("// "), F.col("url")), asked),
        feed(hashes, "digests", "hash", F.col("h"), F.col("lang") == "en"),
    ]
    return reduce(DataFrame.unionByName, parts)


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One /24 per destination network seen, one wide block of sources inside a wider one, one v6 block.

    Networks above .11 stay unlisted; every fifth nation lacks names or coordinates.
    """
    nets = (
        table(spark, sf_dir, "events").select((F.col("event_id") % 16).alias("net")).distinct()
        .join(table(spark, sf_dir, "nation"), F.col("net") == F.col("n_nationkey"))
        .where("net < 12")
        .select(
            F.concat(F.lit("185.220."), text("net"), F.lit(".0")).alias("ip_lo"),
            F.concat(F.lit("185.220."), text("net"), F.lit(".255")).alias("ip_hi"),
            F.when(F.col("net") % 5 != 0, F.concat(F.lit("N"), text("net"))).alias("country_code"),
            F.when(F.col("net") % 5 != 0, F.col("n_name")).alias("country_name"),
            F.when(F.col("net") % 5 != 0, F.concat(F.lit("City "), text("net"))).alias("city"),
            F.col("net").cast("double").alias("lat"),
            F.when(F.col("net") % 5 != 1, F.col("net").cast("double") * 2).alias("lon"),
        )
    )
    wide = table(spark, sf_dir, "region").select(
        pick(["93.184.0.0", "93.128.0.0", "93.184.0.10", "2a00::", "0.0.0.0"], F.col("r_regionkey")).alias("ip_lo"),
        pick(["93.184.255.255", "93.255.255.255", "93.184.0.77", "2a00:ffff:ffff::", "10.255.255.255"],
             F.col("r_regionkey")).alias("ip_hi"),
        F.concat(F.lit("R"), text("r_regionkey")).alias("country_code"),
        F.col("r_name").alias("country_name"), F.lit("Region").alias("city"),
        F.lit(1.5).alias("lat"), F.lit(-2.5).alias("lon"),
    )
    return nets.unionByName(wide)


def packet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, raw): capture JSON, one line per event, some of them unusable."""
    event = F.col("event_id")
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    stamp = F.when(event % 50 == 1, "not-a-number").otherwise(text(millis))

    def obj(*pairs: tuple[str, Column]) -> Column:
        parts = [F.concat(F.lit(f'"{key}":"'), value, F.lit('"')) for key, value in pairs]
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    v6 = F.concat(F.lit("2a00:1450::"), F.lower(F.hex(event % 4096)))
    ip = F.when(event % 50 == 0, None).when(
        event % 50 == 3,
        F.concat(F.lit('"ipv6":'), obj(("ipv6_ipv6_src", v6), ("ipv6_ipv6_dst", F.lit("fe80::1")))),
    ).otherwise(
        F.concat(F.lit('"ip":'), obj(("ip_ip_src", source_address()), ("ip_ip_dst", destination_address())))
    )
    dport = F.when(event % 50 == 2, "99999").otherwise(text(pick(PORTS, F.col("user_id") % 20)))
    transport = F.when(event % 3 == 0, F.concat(F.lit('"tcp":'), obj(
        ("tcp_tcp_srcport", text(1024 + event % 50000)), ("tcp_tcp_dstport", dport)))
    ).when(event % 3 == 1, F.concat(F.lit('"udp":'), obj(
        ("udp_udp_srcport", text(1024 + event % 50000)), ("udp_udp_dstport", dport))))
    frame = F.concat(F.lit('"frame":'), obj(
        ("frame_frame_len", text(F.floor(F.col("value") * 10))),
        ("frame_frame_protocols", F.when(event % 3 == 0, "eth:ip:tcp:telnet").otherwise("eth:ip:udp")),
        ("frame_frame_time_utc", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
    ))
    http = F.when(F.col("event_type") == "error", F.concat(
        F.lit('"http":{"uri":["'), pick(["/index.html", "/a/../../etc/passwd", "/q?id=1' or 1=1"], event % 3),
        F.lit('",{"agent":"'), pick(["curl/8.1", "Mozilla"], event % 2), F.lit('","size":7}]}'),
    ))
    packet = F.concat(
        F.lit('{"timestamp":"'), stamp, F.lit('","layers":{'),
        F.concat_ws(",", frame, http, ip, transport), F.lit("}}"),
    )
    return events(spark, sf_dir).select(
        "event_id",
        F.when(event % 50 == 4, '{"index":{"_index":"packets"}}').when(event % 50 == 5, '{"timestamp": broken')
        .otherwise(packet).alias("raw"),
    )


def generic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, ts, source_address, user, logid); some rule ids do not fit 32 bits."""
    event = F.col("event_id")
    return events(spark, sf_dir).select(
        "event_id", "ts", text("user_id").alias("source_address"), F.col("event_type").alias("user"),
        F.when(event % 100 == 0, F.lit(4294967296)).otherwise(event % 20).alias("logid"),
    )


LOG_TYPES = {"click": "prodepa_json", "error": "wazuh_alert", "signup": "fortigate_raw", "view": "tshark"}


def collected_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, log_type, timestamp, message, at_timestamp): what arrives at the collector."""
    event = F.col("event_id")
    log_type = F.lit("syslog_json")
    for name, value in LOG_TYPES.items():
        log_type = F.when(F.col("event_type") == name, F.lit(value)).otherwise(log_type)
    later = F.col("ts").cast("timestamp") + F.expr("interval 36 hours")
    return table(spark, sf_dir, "events").select(
        "event_id", log_type.alias("log_type"),
        F.when(event % 2 == 0, F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(event % 3 == 0, F.lit("yesterday")).alias("timestamp"),
        F.when(
            F.col("event_type") == "signup",
            F.concat(F.lit('<134>devname="fw '), text(event % 7), F.lit('" srcip='), source_address(),
                     F.lit(" action=deny user="), text("user_id"), F.lit(" action=close")),
        ).otherwise(F.lit("plain text")).alias("message"),
        F.col("ts").cast("timestamp").alias("at_timestamp"),
    )


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, address): addresses of all classes, valid or not, spread by event and user."""
    event, user = F.col("event_id"), F.col("user_id")
    first = pick([8, 10, 127, 169, 172, 192, 198, 203, 224, 255, 0, 100], event % 12)
    second = pick([0, 16, 31, 32, 51, 64, 168, 254], F.floor(event / 12) % 8)
    quad = F.concat_ws(".", text(first), text(second), text(pick([0, 2, 100, 113], F.floor(event / 96) % 4)), text(user % 300))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.concat(quad, F.lit("/24")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("0"), quad)).otherwise(quad).alias("address"),
    )


def v6_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, address, public): IPv6 addresses with their expected class."""
    event = F.col("event_id")
    low = F.lower(F.hex(event % 65536))
    heads = ["fe80::", "febf:1::", "fec0::", "fc00::", "fdff::", "ff02::", "2001:db8::", "2001:db9::",
             "2a04:4e42:3b::", "::ffff:8.8.", "2001:DB8:1:2:3:4:5:", "::"]
    public = [False, False, True, False, False, False, False, True, True, True, False, True]
    index = event % 12
    tail = F.when(index == 9, F.concat(text(event % 250), F.lit("."), text(F.col("user_id") % 250))).when(
        index == 11, F.concat(F.lit("abcd:"), low)
    ).otherwise(low)
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(pick(heads, index), tail).alias("address"), pick(public, index).alias("public")
    )
