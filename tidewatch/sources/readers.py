"""Log lines, packets, feeds, location ranges and JSON events from files or streams."""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.text import strip
from tidewatch.functions.variants import member, string_value
from tidewatch.operators.routing import ALERT_TYPE, JSON_TYPE
from tidewatch.plans.joins import Lookup
from tidewatch.session import computed_once

# First characters of comment lines in feeds.
COMMENT_MARKS = ("#", ";", "/")
#: Most tasks for each core that a scan of lines is cut into.
TASKS_A_CORE = 32


def clean_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Replace bad bytes, trim, and drop blank lines."""
    return lines.withColumn(raw, strip(F.make_valid_utf8(F.col(raw)))).where(F.col(raw) != "")


def _text(spark: SparkSession, path: str | list[str], streaming: bool, options: dict[str, str] | None) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).options(**(options or {}))
    return reader.text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
    )


def _digits(number: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), width, "0")


def with_event_ids(lines: DataFrame) -> DataFrame:
    """Name every line by where it comes from: a hash of the file and the line's number in it, or of topic and partition and the offset.

    A number counts the lines of the file's earlier blocks and those before it in its block, so
    a line has the same ``event_id`` however a reader cuts files into blocks and packs these into
    tasks, and in every run. Lines are counted in a narrow scan of their own; what that leaves
    is one row a block, so lines get their number without being moved. Lines without a place
    (tables made by hand) are named by their text and their place in the scan.
    """
    if "src_offset" in lines.columns:
        source = F.xxhash64("src_topic", "src_partition")
        return lines.withColumn("event_id", F.concat(_digits(source, 16), _digits(F.col("src_offset"), 16)))
    row = F.monotonically_increasing_id()
    if "src_file" not in lines.columns:
        return lines.withColumn("event_id", F.concat(_digits(F.xxhash64("raw"), 16), _digits(row, 16)))
    if lines.isStreaming:
        # Micro-batches are numbered when they come; this says no more than the column's type.
        return lines.withColumn("event_id", F.lit("").cast("string"))
    placed = lines.withColumn("_row", row).withColumn("_file", F.xxhash64("src_file"))
    # Rows are numbered below this, so a task may take many blocks: small ones would else be a task each, twice.
    placed = placed.coalesce(TASKS_A_CORE * lines.sparkSession.sparkContext.defaultParallelism)
    blocks = placed.groupBy("_file", "src_block").agg(F.min("_row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("_file").orderBy("src_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select("_file", "src_block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("_shift"))
    numbered = Lookup(shifts, "line-blocks").join(placed, ["_file", "src_block"], "inner", spread_by="_row")
    name = F.concat(_digits(F.col("_file"), 16), _digits(F.col("_row") + F.col("_shift"), 16))
    return numbered.select(*[F.col(f"`{c}`") for c in lines.columns], name.alias("event_id"))


def read_log_lines(
    spark: SparkSession, path: str | list[str], streaming: bool = False, options: dict[str, str] | None = None
) -> DataFrame:
    """(raw, src_file, src_block, ingest_ts[, event_id]): one row per line that is not blank.

    For a table, lines are counted at once, see ``with_event_ids``; a stream's get their ids batch by batch.
    ``options`` go to the reader; for a stream, ``maxFilesPerTrigger`` bounds a micro-batch.
    """
    lines = clean_lines(_text(spark, path, streaming, options)).withColumn("ingest_ts", F.current_timestamp())
    return lines if streaming else with_event_ids(lines)


def read_topic_lines(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Lines from a message topic; needs the Kafka connector of Spark on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    lines = clean_lines(topic_columns(reader.load()))
    return lines if streaming else with_event_ids(lines)


def topic_columns(records: DataFrame) -> DataFrame:
    """Records of a topic as lines, with the place that names them."""
    return records.select(
        F.col("value").cast("string").alias("raw"), F.col("timestamp").alias("ingest_ts"), F.col("topic").alias("src_topic"),
        F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset"),
    )


def parse_packets(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lines(event_id, raw)`` -> (packets with a ``packet`` VARIANT, lines that are no JSON).

    Index lines are dropped before anything is parsed.
    """
    bodies = clean_lines(lines).where(~F.col("raw").startswith('{"index"'))
    parsed = computed_once(bodies, F.try_parse_json("raw").alias("packet"))
    good = parsed.where(F.col("packet").isNotNull()).drop("raw")
    return good, parsed.where(F.col("packet").isNull()).select("event_id", "raw")


def read_packets(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_packets(read_log_lines(spark, path))


def clean_feed(lines: DataFrame) -> DataFrame:
    """``lines(feed, kind, line)`` -> distinct (feed, kind, value) without comments and blanks.

    A remark behind a value stays part of it.
    """
    value = strip(F.col("line"))
    comment = reduce(lambda a, b: a | b, [value.startswith(mark) for mark in COMMENT_MARKS])
    return lines.where(~comment & (value != "")).select("feed", "kind", value.alias("value")).distinct()


def read_feeds(spark: SparkSession, manifest: list[dict[str, str]]) -> DataFrame:
    """Feeds listed as ``{"feed", "kind", "path"}``, one text file or folder each.

    A feed whose file is missing is left out, with a warning.
    """
    parts = []
    for entry in manifest:
        lines = _existing(lambda: spark.read.text(entry["path"]))
        if lines is None:
            warnings.warn(f"feed {entry['feed']} is left out: nothing at {entry['path']}", stacklevel=2)
            continue
        parts.append(lines.select(
            F.lit(entry["feed"]).alias("feed"), F.lit(entry["kind"]).alias("kind"), F.col("value").alias("line")
        ))
    if not parts:
        parts = [spark.createDataFrame([], "feed string, kind string, line string")]
    return clean_feed(reduce(DataFrame.unionByName, parts))


def _existing(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# ---------------------------------------------------------------------------
# The public lists that are read by default, by kind of indicator.
# ---------------------------------------------------------------------------
DEFAULT_FEEDS = {
    "ip": [
        "https://lists.blocklist.de/lists/all.txt",
        "https://raw.githubusercontent.com/firehol/blocklist-ipsets/master/firehol_level1.netset",
        "https://raw.githubusercontent.com/firehol/blocklist-ipsets/master/firehol_level2.netset",
        "https://raw.githubusercontent.com/firehol/blocklist-ipsets/master/dshield.netset",
        "https://www.binarydefense.com/banlist.txt",
        "https://rules.emergingthreats.net/fwrules/emerging-Block-IPs.txt",
        "https://www.spamhaus.org/drop/drop.txt",
        "https://www.spamhaus.org/drop/edrop.txt",
        "https://feodotracker.abuse.ch/downloads/ipblocklist.txt",
        "https://check.torproject.org/torbulkexitlist?ip=1.1.1.1",
        "https://raw.githubusercontent.com/stamparm/ipsum/master/ipsum.txt",
        "https://cinsscore.com/list/ci-badguys.txt",
    ],
    "domain": [
        "https://www.malwaredomainlist.com/hostslist/domains.txt",
        "https://raw.githubusercontent.com/hagezi/dns-blocklists/main/domains/pro.txt",
        "https://hole.cert.pl/domains/domains.txt",
        "https://raw.githubusercontent.com/Spam404/lists/master/main-blacklist.txt",
        "https://raw.githubusercontent.com/DandelionSprout/adfilt/master/Alternate%20versions%20Anti-Malware%20List/AntiMalwareHosts.txt",
    ],
    "url": [
        "https://urlhaus.abuse.ch/downloads/text/",
        "https://openphish.com/feed.txt",
        "https://phishing.army/download/phishing_army_blocklist_extended.txt",
    ],
    "hash": [
        "https://bazaar.abuse.ch/export/txt/sha256/full/",
        "https://bazaar.abuse.ch/export/txt/md5/full/",
        "https://raw.githubusercontent.com/stamparm/maltrail/master/trails/static/malware/generic.txt",
    ],
}
# ---------------------------------------------------------------------------


def default_manifest(folder: str) -> list[dict[str, str]]:
    """Manifest of the default lists, each expected in ``folder`` under the hash of its address."""
    return [
        {"feed": url, "kind": kind, "path": f"{folder}/{hashlib.sha256(url.encode()).hexdigest()}"}
        for kind, urls in DEFAULT_FEEDS.items() for url in urls
    ]


def feed_id(url: Column) -> Column:
    """Name of a feed's stored snapshot."""
    return F.sha2(url, 256)


def read_geo(spark: SparkSession, path: str) -> DataFrame | None:
    """Range table, Parquet or CSV; None, with a warning, if there is none."""
    is_csv = path.rstrip("/").endswith(".csv")
    table = _existing(lambda: spark.read.csv(path, header=True) if is_csv else spark.read.parquet(path))
    if table is None:
        warnings.warn(f"no location table at {path}: events are not located", stacklevel=2)
        return None
    return table.select(
        "ip_lo", "ip_hi", "country_code", "country_name", "city",
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
    )


def json_events(lines: DataFrame, log_type: str) -> tuple[DataFrame, DataFrame]:
    """``lines(event_id, raw)`` -> (events with an ``event`` VARIANT and ``log_type``, bad lines)."""
    parsed = computed_once(clean_lines(lines), F.try_parse_json("raw").alias("event"))
    good = parsed.where(F.col("event").isNotNull()).drop("raw").withColumn("log_type", F.lit(log_type))
    return good, parsed.where(F.col("event").isNull()).select("event_id", "raw")


def read_alerts(spark: SparkSession, path: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    return json_events(read_log_lines(spark, path, streaming), ALERT_TYPE)


def read_events_json(spark: SparkSession, path: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    return json_events(read_log_lines(spark, path, streaming), JSON_TYPE)


def json_field(name: str) -> Column:
    """Text of a top-level field of ``event``, null if it is absent or no text."""
    return string_value(member(F.col("event"), name))


def json_columns(events: DataFrame) -> DataFrame:
    """Add the text fields the routing steps read: ``message``, ``timestamp``, ``at_timestamp``."""
    return events.withColumns({
        "message": json_field("message"),
        "timestamp": json_field("timestamp"),
        "at_timestamp": F.coalesce(F.try_to_timestamp(json_field("@timestamp")), F.col("ingest_ts")),
    })
