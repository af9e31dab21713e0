"""Firewall log lines -> typed events and a reject table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.ip import let
from tidewatch.functions.text import (
    WHITESPACE, TextView, csv_fields, flat_view, rfc3339, sql_text, strip,
)
from tidewatch.schema import (
    COMMON_FIELDS, EVENT_KEYS, INTEGER_COLUMNS, LOG_COLUMNS, NUMERIC_COLUMNS, THREAT_POSITIONS,
    TRAFFIC_POSITIONS,
)
from tidewatch.session import computed_once

MIN_FIELDS = len(COMMON_FIELDS)
LOG_SOURCE = "palo_alto"
_INTEGER = r"^[+-]?[0-9]+\z"
_FLOAT = r"^(?i)[+-]?(?:inf|infinity|nan|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?)\z"
_SPECIAL_FLOAT = r"^(?i)[+-]?(?:inf|infinity|nan)\z"


def csv_payload(raw: Column) -> Column:
    """The CSV part of a line: what follows the device host, the syslog header or ``<pri>``."""
    device = F.substr(raw, F.instr(raw, F.lit("PA-")))
    device_end = F.instr(device, F.lit(" "))
    before_time = F.left(raw, F.regexp_instr(raw, F.lit(r"(?U),\d{4}/")) - 1)
    header_end = F.length(before_time) - F.instr(F.reverse(before_time), F.lit(" ")) + 1
    return (
        F.when(raw.contains("PA-"), F.substr(device, device_end + 1))
        .when(
            raw.rlike(r"(?U),\d{4}/"),
            F.when(before_time.contains(" "), F.substr(raw, header_end + 1)).otherwise(raw),
        )
        .otherwise(F.substr(raw, F.instr(raw, F.lit(">")) + 1))
    )


def split_lines(lines: DataFrame) -> DataFrame:
    """Add the ``fields`` array and, for a line that is not a log record, ``reason``."""
    payload = lines.withColumn("_csv", csv_payload(F.col("raw")))
    fields = computed_once(payload, csv_fields(F.col("_csv")).alias("fields")).drop("_csv")
    count = F.size("fields")
    return fields.withColumn(
        "reason",
        F.when(
            count < MIN_FIELDS,
            F.concat(F.lit("Palo Alto line has "), count.cast("string"),
                     F.lit(f" CSV fields, needs {MIN_FIELDS}")),
        ),
    )


def classify_lines(lines: DataFrame) -> DataFrame:
    """Every line once: typed columns, plus ``raw`` and ``reason`` where it was rejected.

    One column per known field, null where it is absent. A numeric field that does not parse
    keeps its text in the ``unparsed`` map.
    """
    if "ingest_ts" not in lines.columns:
        lines = lines.withColumn("ingest_ts", F.current_timestamp())
    split = split_lines(lines).withColumn("is_threat", strip(F.get("fields", F.lit(3))) == "THREAT")
    blanks = sql_text(WHITESPACE)

    def at(position: int | None) -> str:
        return "cast(null as string)" if position is None else f"get(fields, {position})"

    def field(name: str) -> str:
        threat, other = THREAT_POSITIONS.get(name), TRAFFIC_POSITIONS.get(name)
        text = at(other) if threat == other else f"if(is_threat, {at(threat)}, {at(other)})"
        return f"nullif(btrim({text}, {blanks}), '') as {name}"

    texts = split.selectExpr(
        "event_id", "ingest_ts", "reason", "if(reason is not null, raw, null) as raw",
        *[field(name) for name in LOG_COLUMNS],
    )
    leftovers = ", ".join(
        f"if({name} is not null and {_number(name)} is null,"
        f" named_struct('key', '{name}', 'value', {name}), null)"
        for name in LOG_COLUMNS if name in NUMERIC_COLUMNS
    )
    unparsed = let(
        F.expr(f"filter(array({leftovers}), entry -> entry is not null)"),
        lambda entries: F.when(F.size(entries) > 0, F.map_from_entries(entries)),
    )
    return texts.select(
        "event_id",
        "ingest_ts",
        F.try_to_timestamp("generated_time", F.lit("yyyy/MM/dd HH:mm:ss")).alias("event_ts"),
        rfc3339(F.col("ingest_ts")).alias("@timestamp"),
        F.lit(LOG_SOURCE).alias("log_source"),
        *[F.expr(f"{_number(name)} as {name}") if name in NUMERIC_COLUMNS else name for name in LOG_COLUMNS],
        unparsed.alias("unparsed"),
        "raw",
        "reason",
    )


def _number(name: str) -> str:
    if name in INTEGER_COLUMNS:
        return f"if({name} rlike {sql_text(_INTEGER)}, try_cast({name} as bigint), null)"
    finite = f"try_cast({name} as double)"
    return (
        f"case when {name} rlike {sql_text(_SPECIAL_FLOAT)} then 0.0D"
        f" when {name} rlike {sql_text(_FLOAT)} then if(abs({finite}) = double('infinity'), 0.0D, {finite}) end"
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull()).drop("raw", "reason")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNotNull()).select("event_id", "raw", "reason", "ingest_ts")


def normalize_firewall(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lines(event_id, raw[, ingest_ts])`` -> (events, rejects)."""
    classified = classify_lines(lines)
    return accepted(classified), rejected(classified)


def event_value(name: str) -> str:
    """SQL for the text of an event key if it is a string: numbers that parsed are not text."""
    return f"try_element_at(unparsed, '{name}')" if name in NUMERIC_COLUMNS else f"`{name}`"


def firewall_text() -> TextView:
    return flat_view({name: event_value(name) for name in EVENT_KEYS})
