"""Remove repeated passages by overlapping windows of three lines.

Every run of three lines is hashed. A window that occurs more than once keeps its first
occurrence, by ``doc_id``, text hash and position; later occurrences cover their three lines,
and all covered lines are removed, so overlapping windows merge to the whole repeated passage.

Defined cases: texts of fewer than three lines, and null or empty ones, have no window and
stay as they are; windows of blank lines alone don't count; where a window meets its own first
occurrence in the same text (a run of equal lines), only lines beyond that occurrence go; rows
that repeat both ``doc_id`` and text are one occurrence and get the same result; null
``doc_id`` comes first; a text whose lines all go is empty. Other columns pass unchanged.

With ``sentences`` the units are sentences as well as lines: a text is cut after line breaks and
after sentence ends, blanks around a unit don't count, blank units belong to no window and go
only from inside one, and a text of fewer than three units is one window, found where another
text has the same units and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import named
from tidewatch.session import stage

LINES = 3
#: Where units end: after a line break, and after the end of a sentence that a blank or, with full-width marks, anything follows.
#: The first look says no almost everywhere.
UNIT_ENDS = r"""(?<=[\n.!?…"'”’»)\]。！？])(?:(?<=\n)|(?<=[.!?…])(?=[^\S\n])|(?<=[.!?…]["'”’»)\]])(?=[^\S\n])|(?<=[。！？]))"""
BLANKS = " \t\n\x0b\f\r"


def _keys(doc_id: str, text: str) -> list[Column]:
    """128 bits that tell rows apart."""
    return [F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)) for seed in (3, 5)]


def window_rows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``h1, h2`` (hash of the window), ``doc, k1, k2, at`` (where it is) for every window of ``docs(doc_id, text)``."""
    split = docs.select(F.col("doc_id").alias("doc"), *[k.alias(f"k{i}") for i, k in enumerate(_keys("doc_id", "text"), 1)], F.split("text", "\n").alias("l"))
    starts = F.when(F.size("l") >= lines, F.sequence(F.lit(0), F.size("l") - lines))

    def window(at: Column) -> Column:
        parts = [F.get("l", at + i) for i in range(lines)]
        filled = F.length(F.trim(F.concat(*parts))) > 0
        return F.struct(at.alias("at"), F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(F.lit(2), *parts).alias("h2"), filled.alias("filled"))

    return split.select("doc", "k1", "k2", F.inline(F.transform(starts, window))).where("filled").drop("filled")


def unit_rows(docs: DataFrame, lines: int = LINES, first_hash: bool = False) -> DataFrame:
    """The same for sentences and lines, with ``last``, the position of a window's last unit; or ``h1`` alone."""
    ids = [F.col("doc_id").alias("doc"), *[k.alias(f"k{i}") for i, k in enumerate(_keys("doc_id", "text"), 1)]] if not first_hash else []
    seeds = (1,) if first_hash else (1, 2)
    cut = docs.select(*ids, F.split("text", UNIT_ENDS).alias("l"))
    numbered = F.transform("l", lambda unit, i: F.struct(i.alias("i"), F.btrim(unit, F.lit(BLANKS)).alias("t")))
    filled = F.filter(numbered, lambda unit: unit["t"] != "")
    hashed = F.transform(filled, lambda unit: F.struct(unit["i"].alias("i"), *[F.xxhash64(F.lit(s), unit["t"]).alias(f"h{s}") for s in seeds]))
    held = [c for c in ("doc", "k1", "k2") if not first_hash]
    units = cut.select(*held, hashed.alias("u"))
    starts = F.when(F.size("u") > 0, F.sequence(F.lit(0), F.greatest(F.size("u") - lines, F.lit(0))))

    def window(at: Column) -> Column:
        # Past the end of a short text there is null, which leaves a hash as it is.
        hashes = [F.xxhash64(*[F.get("u", at + i)[f"h{s}"] for i in range(lines)]).alias(f"h{s}") for s in seeds]
        last = F.get("u", F.least(at + lines, F.size("u")) - 1)["i"]
        return F.struct(*([] if first_hash else [F.get("u", at)["i"].alias("at"), last.alias("last")]), *hashes)

    return units.select(*held, F.inline(F.transform(starts, window)))


def repeated_unit_rows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Windows whose first hash occurs again; only that hash is shuffled to tell."""
    often = unit_rows(docs, lines, first_hash=True).groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1")
    # Staged, so that the join reads nothing but shuffles and a frequent window can be split.
    return stage(unit_rows(docs, lines).join(stage(often, "window-often"), "h1"), "window-repeated")


def covered_lines(docs: DataFrame, lines: int = LINES, sentences: bool = False) -> DataFrame:
    """``k1, k2, covered``: for each row the positions of the lines that later occurrences cover."""
    windows = repeated_unit_rows(docs, lines) if sentences else window_rows(docs, lines)
    last, first_last = (F.col("last"), F.col("first.last")) if sentences else (F.col("at") + lines - 1, F.col("first.at") + lines - 1)
    place = F.struct("doc", "k1", "k2", "at", *["last"] * sentences)
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    later = windows.join(repeated.select("h1", "h2", "first"), ["h1", "h2"]).where(place != F.col("first"))
    own = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    begin = F.when(own, F.greatest(F.col("at"), first_last + 1)).otherwise(F.col("at"))
    at = later.select("k1", "k2", F.explode(F.sequence(begin, last)).alias("line"))
    return at.groupBy("k1", "k2").agg(F.collect_set("line").alias("covered"))


def remove_repeated(docs: DataFrame, lines: int = LINES, removed: str | None = None, sentences: bool = False) -> DataFrame:
    """``docs`` with cleaned ``text``; ``removed`` names a further column for the number of lines (or units) that went."""
    keys, covered = [named(docs, k) for k in ("window_k1", "window_k2")], named(docs, "window_covered")
    keyed = docs.select("*", *[k.alias(name) for k, name in zip(_keys("doc_id", "text"), keys)])
    found = covered_lines(docs.select("doc_id", "text"), lines, sentences)
    found = found.select(F.col("k1").alias(keys[0]), F.col("k2").alias(keys[1]), F.col("covered").alias(covered))
    joined = keyed.join(found, keys, "left")
    text, between = (F.split("text", UNIT_ENDS), "") if sentences else (F.split("text", "\n"), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(text) - 1), F.col(covered))
    kept = F.transform(F.array(text), lambda all_lines: F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), between))[0]
    clean = F.when(F.col(covered).isNull(), F.col("text")).otherwise(kept)
    out = joined.select(*[clean.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.col(covered))
    count = [F.coalesce(F.size(covered), F.lit(0)).cast("long").alias(removed)] if removed else []
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *count)
