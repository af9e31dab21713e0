"""Enriched firewall events -> one SIEM syslog line each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import sql_text
from tidewatch.operators.filters import enriched_only
from tidewatch.schema import ENRICHMENT_FIELD, EVENT_KEYS, NUMERIC_COLUMNS

# ---------------------------------------------------------------------------
# The line header, the leading keys with their short names, and keys left out.
# ---------------------------------------------------------------------------
HEADER = "<134>PaloAlto: "
LEADING = {
    "device_name": "device_name", "serial_number": "serial_number",
    "generated_time": "generated_time", "source_address": "src_ip",
    "destination_address": "dst_ip", "source_port": "src_port",
    "destination_port": "dst_port", "action": "action", "application": "application",
}
LEFT_OUT = {"palo_alto_raw_log", "log_source", ENRICHMENT_FIELD}
# ---------------------------------------------------------------------------


def quoted(text: str) -> str:
    """SQL: text with a blank or a quote in it goes between quotes, inner quotes escaped."""
    return (
        f"""if(contains({text}, ' ') or contains({text}, '"'),"""
        f""" concat('"', replace({text}, '"', {sql_text(chr(92) + '"')}), '"'), {text})"""
    )


def quoted_list(texts: str) -> str:
    """SQL: a list becomes one quoted, comma-separated value without inner quotes."""
    items = f"""transform({texts}, item -> replace({quoted('item')}, '"', ''))"""
    return f"""concat('"', array_join({items}, ','), '"')"""


def event_text(name: str) -> str:
    if name in NUMERIC_COLUMNS:
        return f"coalesce(cast(`{name}` as string), try_element_at(unparsed, '{name}'))"
    return f"`{name}`"


def siem_line() -> Column:
    """The line of one event.

    Leading keys come first, the others in key order. Of the enrichment only its time is
    written: all its other members are objects, which have no text form.
    """

    def pair(label: str, value: str) -> str:
        return f"if({value} <> '', concat('{label}=', {quoted(value)}), null)"

    rest = [k for k in EVENT_KEYS if k not in LEADING and k not in LEFT_OUT and not k.startswith("@")]
    pairs = [pair(label, event_text(name)) for name, label in LEADING.items()]
    pairs += [pair(name, event_text(name)) for name in rest]
    pairs.append(pair("enrich_intel_last_updated", f"{ENRICHMENT_FIELD}.intel_last_updated"))
    return F.expr(f"concat('{HEADER}', concat_ws(' ', {', '.join(pairs)}))")


def format_siem_syslog(events: DataFrame, id_col: str = "event_id") -> DataFrame:
    """(id, line) for the enriched events; the others are not sent to the SIEM."""
    return enriched_only(events).select(id_col, siem_line().alias("line"))
