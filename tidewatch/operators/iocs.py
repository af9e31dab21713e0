"""Indicator extraction: addresses, domains, hashes and URLs inside an event's text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.ip import let
from tidewatch.functions.rules import (
    DOMAIN_CUTS, DOMAIN_FIND, DOMAIN_HEAD, DOMAIN_RUNS, DOTLESS_I, DOTTED_I, IOC_PATTERNS, OTHER_LETTER, spark_pattern,
)

# Lines of an event that can't hold an indicator: short words, as most of its fields are.
_WORTHLESS = r"(?md)^[^.:\n]{0,31}+\n"
# What a text must at least have to hold an indicator of a kind; only then the expression runs.
_WORTH = {
    "ip": lambda text: text.contains(".") | text.contains(":"),
    "domain": lambda text: text.rlike("\\.[A-Za-z\u017f\u212a]{2}"),
    "hash": lambda text: text.rlike("[0-9A-Fa-f]{32}"),
    "url": lambda text: text.contains("://") | F.lower(text).contains("www."),
}


def ioc_array(lines: Column) -> Column:
    """All distinct indicators of a text as array<struct<kind, value, ord>>.

    ``lines`` is the event's text with one value per line (``TextView.lines``); no indicator
    can hold a line feed, so nothing matches across two values. Within a kind the order is
    that of first appearance, and case is kept.
    """
    read_as = F.translate(lines, DOTTED_I + DOTLESS_I, OTHER_LETTER * 2)
    text = F.when(lines.contains(DOTTED_I) | lines.contains(DOTLESS_I), read_as).otherwise(lines)
    return let(
        F.regexp_replace(text, _WORTHLESS, ""), lambda some: F.flatten(F.array(*[_found(some, kind) for kind in IOC_PATTERNS]))
    )


def domains(text: Column) -> Column:
    """All matches of the domain expression, in a time that grows with the text and without recursion."""
    runs = F.regexp_extract_all(F.regexp_replace(text, DOMAIN_CUTS, "\n"), F.lit(DOMAIN_RUNS), 0)
    heads = F.filter(F.transform(runs, lambda run: F.regexp_extract(run, DOMAIN_HEAD, 0)), lambda head: head != "")
    return F.regexp_extract_all(F.array_join(heads, "\n"), F.lit(DOMAIN_FIND), 0)


def _found(text: Column, kind: str) -> Column:
    matches = domains(text) if kind == "domain" else F.regexp_extract_all(text, F.lit(spark_pattern(IOC_PATTERNS[kind])), 0)
    some = F.when(_WORTH[kind](text), F.array_distinct(matches)).otherwise(F.array().cast("array<string>"))
    return F.transform(some, lambda value, i: F.struct(
        F.lit(kind).alias("kind"), value.alias("value"), i.alias("ord")
    ))


def extract_iocs(events: DataFrame, lines: Column, id_col: str = "event_id") -> DataFrame:
    """One row per event, kind and distinct value: (id, kind, value, ord)."""
    return events.select(id_col, lines.alias("_lines")).select(
        id_col, F.inline(ioc_array(F.col("_lines")))
    )
