"""Threat hunting: scan patterns per field, keyword lists and correlation rules per event."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.ip import let
from tidewatch.functions.rules import (
    DEFAULT_PACK, DOTLESS_I, DOTTED_I, HOLDS, LONG_LINE, LONG_PATTERNS, OTHER_LETTER, RulePack,
    any_word_pattern, occurrence_pattern, word_list,
)
from tidewatch.functions.text import TextView, plain_case, replaced, sql_text
from tidewatch.session import computed_once

SAMPLE_CHARS = 100
_RULES = "array<struct<pattern:string,rule:string>>"
_HITS = "array<struct<ord:int,pattern:string,field_path:string,sample:string>>"


def first_keyword(text: str, words: Iterable[str]) -> str:
    """SQL for the first word of the list that occurs anywhere in ``text``.

    A word with an earlier one inside it can never be the first, so it is not looked for.
    """
    reachable: list[str] = []
    for word in words:
        if not any(earlier in word for earlier in reachable):
            reachable.append(word)
    tests = " ".join(f"when contains({text}, {sql_text(w)}) then {sql_text(w)}" for w in reachable)
    return f"case {tests} end" if reachable else "cast(null as string)"


def matches(text: str, pattern: str) -> str:
    """SQL test for ``pattern`` in ``text``; ``_folded`` holds the words that occur in the event's text, case aside.

    A choice of words is looked up as such. Other expressions run only on events that hold
    one of the words they need.
    """
    test = f"{text} rlike {sql_text(occurrence_pattern(pattern))}"
    words = word_list(pattern)
    if words:
        return f"({_any_word(words)})"
    if pattern in HOLDS:
        return f"(({_any_word(HOLDS[pattern])}) and {test})"
    return test


def _any_word(words: Iterable[str]) -> str:
    return " or ".join(f"contains(_folded, {sql_text(word)})" for word in words)


def searched_words(pack: RulePack) -> list[str]:
    """All plain texts that the tests of a pack look for."""
    found = {*pack.processes, *pack.assets}
    for pattern in (*pack.patterns.values(), *pack.rules.values()):
        found.update(word_list(pattern) or HOLDS.get(pattern, ()))
    return sorted(found)


def hunt(events: DataFrame, view: TextView, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Add ``threat_hunting`` to every event, null where nothing was found.

    Runs as plain projections. Each pattern first looks at the whole text; only where it
    occurs are the single fields taken apart to say which of them holds it, if any: the first
    look may see a match across two lines, but, as no pattern is anchored, it misses none.
    """
    kept = [f"`{c}`" for c in events.columns]
    flags = {name: f"_pattern_{i}" for i, name in enumerate(sorted(pack.patterns))}
    fired = {rule: f"_rule_{i}" for i, rule in enumerate(pack.rules)}
    # One pass finds at each place the longest of all words; the others that are there begin it.
    # So a word is in the text if it is in one of those found, mostly none or a few.
    words = searched_words(pack)
    # Ignoring case, a long s equals an s, but it is lower case already.
    folded = replaced(f"lower({plain_case('_joined')})", ("\u017f", "s"), within="_joined")
    found = f"array_join(array_distinct(regexp_extract_all({folded}, {sql_text(any_word_pattern(words))}, 1)), '\\uFFFF')" if words else "''"
    lines = plain_case("_lines")
    long_lines = f"array_join(filter(split({lines}, '\\n', -1), line -> length(line) >= {LONG_LINE}), '\\n')"
    # Every projection copies the whole event, so the steps share as few of them as they can.
    searched = (
        events.select("*", view.lines.alias("_lines"), view.joined.alias("_joined"))
        .selectExpr(
            *kept, f"{lines} as _lines", f"{plain_case('_joined')} as _joined",
            # For process and asset names a long s is another letter, and an I with a dot an i and a mark.
            f"if(contains(_joined, '\u017f') or contains(_joined, {sql_text(DOTTED_I)}), lower(_joined), null) as _lower",
            f"{found} as _folded",
            f"if(_lines rlike '(?md)^[^\\\\n]{{{LONG_LINE}}}', {long_lines}, '') as _long",
        )
        .selectExpr(
            *kept,
            *[
                f"{matches('_long' if pattern in LONG_PATTERNS else '_lines', pattern)} as {flags[name]}"
                for name, pattern in sorted(pack.patterns.items())
            ],
            *[f"{matches('_joined', pattern)} as {fired[rule]}" for rule, pattern in pack.rules.items()],
            f"if(_lower is null, {first_keyword('_folded', pack.assets)}, {first_keyword('_lower', pack.assets)}) as _asset",
            f"if(_lower is null, {first_keyword('_folded', pack.processes)}, {first_keyword('_lower', pack.processes)}) as _process",
        )
    )

    def fields_with(name: str, leaves: Column) -> Column:
        pattern = occurrence_pattern(pack.patterns[name])
        holding = F.filter(leaves, lambda leaf: F.translate(
            leaf.value, DOTTED_I + DOTLESS_I, OTHER_LETTER * 2).rlike(pattern))
        hits = F.transform(holding, lambda leaf: F.struct(
            leaf.ord.alias("ord"), F.lit(name).alias("pattern"), leaf.path.alias("field_path"),
            F.left(leaf.value, F.lit(SAMPLE_CHARS)).alias("sample"),
        ))
        return F.when(F.col(flags[name]), hits).otherwise(F.array().cast(_HITS))

    any_flag = F.expr(" or ".join(flags.values()) or "false")
    rules = ", ".join(
        f"if({fired[rule]}, named_struct('pattern', {sql_text(pattern)}, 'rule', {sql_text(rule)}), null)"
        for rule, pattern in pack.rules.items()
    )
    any_rule = F.expr(" or ".join(fired.values()) or "false")
    rule_hits = F.expr(f"filter(cast(array({rules}) as {_RULES}), rule -> rule is not null)")
    hits = let(view.leaves, lambda leaves: F.array_sort(
        F.concat(F.array().cast(_HITS), *[fields_with(n, leaves) for n in flags])
    ))
    samples = F.transform(hits, lambda hit: F.struct(
        hit.field_path.alias("field_path"), hit.pattern.alias("pattern"), hit.sample.alias("sample")
    ))
    gathered = computed_once(
        searched, F.when(any_flag, samples).alias("_hits"), F.when(any_rule, rule_hits).alias("_rules"),
        F.col("_asset").alias("_critical"), F.col("_process").alias("_suspicious"),
    )
    return gathered.selectExpr(
        *kept,
        """if(size(_hits) > 0 or size(_rules) > 0 or _critical is not null or _suspicious is not null,
             named_struct('correlation_rules', if(size(_rules) > 0, _rules, null),
                          'critical_asset_access', _critical,
                          'suspicious_patterns', if(size(_hits) > 0, _hits, null),
                          'suspicious_process', _suspicious), null) as threat_hunting""",
    )


def pattern_rows(hunted: DataFrame, id_col: str = "event_id") -> DataFrame:
    return hunted.select(id_col, F.inline("threat_hunting.suspicious_patterns")).select(
        id_col, "pattern", "field_path", "sample"
    )


def rule_rows(hunted: DataFrame, id_col: str = "event_id") -> DataFrame:
    return hunted.select(id_col, F.posexplode("threat_hunting.correlation_rules").alias("ord", "r")).select(
        id_col, "ord", "r.rule", "r.pattern"
    )


def keyword_rows(hunted: DataFrame, id_col: str = "event_id") -> DataFrame:
    return hunted.select(
        id_col, "threat_hunting.suspicious_process", "threat_hunting.critical_asset_access"
    ).where("suspicious_process is not null or critical_asset_access is not null")
