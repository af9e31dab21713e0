"""Secret scans with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: clauses that must
all hold, each a choice of words all of whose trigrams must occur. Postings (trigram to
documents, cut in chunks) are intersected, and only the candidates are verified with the
expression itself. A rule without a mandatory trigram scans every text. Everything runs as
DataFrame operations.

Defined cases: a null or empty text has no spans; a null ``doc_id`` can't be looked up and is
verified for every rule; rows that repeat a ``doc_id`` share its postings, and each is verified
on its own text; spans count code points, end exclusive; extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as code
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stage


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; one counts if ``group`` of it has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The base kinds, in this order.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
)
# Published shapes of tokens and keys.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + FURTHER
MOST_WORDS = 64
CHUNK_DOCS = 4096


def trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def _words(items, start: set[str] | None = None) -> tuple[set[str] | None, list[set[str]]]:
    """All words a part can match (None if not a short list), and the lists of words of which one must occur in it."""
    words, clauses = {""} if start is None else start, []

    def cut() -> None:
        nonlocal words
        if all(len(w) >= 3 for w in words):
            clauses.append(words)
        words = {""}

    exact = True
    for op, value in items:
        more: set[str] | None = None
        if op is code.LITERAL:
            more = {chr(value).lower()}
        elif op is code.IN and all(o is code.LITERAL for o, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif op is code.SUBPATTERN:
            more, inner = _words(value[3])
            if more is None:
                clauses += inner
        elif op is code.BRANCH:
            parts = [_words(p)[0] for p in value[1]]
            more = set().union(*parts) if all(p is not None for p in parts) else None
        elif op is code.MAX_REPEAT and value[:2] == (0, 1):
            more = _words(value[2])[0]
            more = more | {""} if more is not None else None
        if more is None or len(words) * len(more) > MOST_WORDS:
            cut()
            exact = False
            if more is not None:
                words = more
        else:
            words = {a + b for a in words for b in more}
    if exact:
        return words, clauses
    cut()
    return None, clauses


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that must all hold; a clause holds if all trigrams of one of its choices occur. Case is folded."""
    words, clauses = _words(parser.parse(pattern))
    if words is not None and all(len(w) >= 3 for w in words):
        clauses = [*clauses, words]
    out = []
    for clause in clauses:
        choices = {trigrams(w) for w in clause}
        # A choice that asks for more than another one adds nothing.
        out.append(sorted((c for c in choices if not any(d < c for d in choices)), key=sorted))
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once even where ``use`` loops."""
    return F.transform(F.array(value), use)[0]


def postings(docs: DataFrame, wanted: list[str], chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """``trigram, chunk, docs``: an inverted index of the ``wanted`` trigrams. A chunk bounds the list of a frequent one."""
    chunks = max(1, math.ceil(docs.count() / chunk_docs))
    present = let(F.lower("text"), lambda low: F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(low, t)))
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(present).alias("trigram"))
    return rows.groupBy("trigram", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")).agg(F.collect_set("doc_id").alias("docs"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, kinds``: for each document the indexed rules whose query its trigrams fulfil."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    wanted = sorted({t for q in queries.values() for clause in q for choice in clause for t in choice})
    listed = [
        (kind, i, len(q), j, len(choice), t)
        for kind, q in queries.items() for i, clause in enumerate(q) for j, choice in enumerate(clause) for t in sorted(choice)
    ]
    asked = docs.sparkSession.createDataFrame(listed, "kind string, clause int, clauses int, choice int, needs int, trigram string")
    index = stage(postings(docs, wanted), "trigram-postings")
    found = index.join(F.broadcast(asked), "trigram").select("kind", "clause", "clauses", "choice", "needs", F.explode("docs").alias("doc_id"))
    choices = found.groupBy("doc_id", "kind", "clause", "clauses", "choice", "needs").count().where("count = needs")
    whole = choices.groupBy("doc_id", "kind", "clauses").agg(F.countDistinct("clause").alias("held")).where("held = clauses")
    return whole.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """``array<struct<start, kind, end>>`` of the matches that count, leftmost and non-overlapping.

    Matches and the stretches between them come from the same search; a match starts after
    all earlier ones. Sums run within chunks of 256, so many matches cost little more than few.
    """
    pattern, chunk = F.lit(rule.pattern), 256

    def place(found: Column, gaps: Column, values: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(m).cast("long") + F.length(F.get(gaps, i)))
        total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, b: a + b)

        def with_sums(step: Column) -> Column:
            chunk_sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(step) - 1) / chunk).cast("int")), lambda c: total(F.slice(step, c * chunk + 1, chunk)))
            return let(chunk_sums, lambda sums: let(
                F.transform(sums, lambda _, c: total(F.slice(sums, 1, c))),
                lambda before: F.transform(found, lambda m, i: let(
                    F.get(before, F.floor(i / chunk).cast("int")) + total(F.slice(step, F.floor(i / chunk).cast("int") * chunk + 1, i % chunk)) + F.length(F.get(gaps, i)),
                    lambda at: F.struct(at.alias("start"), (at + F.length(m)).alias("end"), F.length(F.get(values, i)).alias("size")),
                )),
            ))

        return let(steps, with_sums)

    everything = let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, let(
        F.split(text, rule.pattern), lambda gaps: place(found, gaps, F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found)
    )))
    kept = F.filter(everything, lambda s: s["size"] >= rule.least)
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(RULES.index(rule) if rule in RULES else 99).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs(doc_id, text)`` plus ``found``: the spans of all rules by start, then by rule."""
    docs = docs.select("doc_id", "text")
    joined = docs.join(candidates(docs, rules), "doc_id", "left")
    nothing = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    parts = []
    for rule in rules:
        if trigram_query(rule.pattern):
            ask = F.col("doc_id").isNull() | F.array_contains("kinds", rule.kind)
        elif not rule.group and re.fullmatch(r"\[[^\]\\]+\]\+", rule.pattern):
            # A run of one class counts from a length on; most texts have none that long.
            ask = F.col("text").rlike(f"{rule.pattern.removesuffix('+')}{{{rule.least}}}")
        else:
            ask = F.lit(True)
        parts.append(F.coalesce(F.when(ask, spans(F.col("text"), rule)), nothing))
    return joined.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("found"))


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text, for every row."""
    found, names = F.col("found"), [r.kind for r in BASE]
    of = lambda kind: F.filter(found, lambda s: s["kind"] == kind)
    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    base = F.filter(found, lambda s: s["kind"].isin(names))
    return scan(docs).select("doc_id", *counts, F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(found).alias("spans"))
