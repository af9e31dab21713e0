"""Mix sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source is one line of words: its documents in a seeded order, shard after shard. The
line is cut into blocks of equal length, ``block_words`` at most. Blocks are allocated to
sources by the highest quotients ``wanted / (2 k + 1)``; a source that is wanted more than
once takes its whole line ``base`` times and ``extra`` further blocks, spread evenly over the
line from a seeded phase, so a shard's quota is the number of chosen blocks that begin in it.
What a document gives is the overlap of the chosen blocks with its stretch of the line.

Defined cases: a null text or one without words has size 0 and is never taken; a null source
is a source of its own, the last; equal rows each take their own stretch; an empty table
gives an empty result. Reruns agree: order and phase come from hashes of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import named, word_count
from tidewatch.session import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 128
DOCS_PER_SHARD = 256
#: Bounds the table of shards per source; beyond it shards just hold more documents.
MAX_SHARDS = 1 << 16
SEED = 7


def source_key(source: Column) -> Column:
    """Sorts by code point with null last, and is never null itself."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``key, total`` (one row per source) plus ``target``: ``share`` of all words by weight, none above ``most`` x total.

    Stopped sources pass their excess on by weight, so the targets are ``min(most * total,
    level * weight)`` for one level. With sources ordered by the level at which they stop, the
    level is found at the first one that does not. Both windows see one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(everything.orderBy("key")) - 1) % len(weights) + 1).cast("int"))
    )
    stops = ranked.withColumn("stop", most * F.col("total") / F.col("weight"))
    order = everything.orderBy("stop", "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = stops.select(
        "*",
        ((F.lit(share) * F.sum("total").over(everything) - F.coalesce(F.sum(most * F.col("total")).over(before), F.lit(0)))
         / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))).alias("level"),
    )
    level = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "key", "level"))).over(everything)["level"]
    return levels.select(
        "key", "total", F.least(most * F.col("total").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target")
    )


def block_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, most: int = MOST) -> DataFrame:
    """``targets`` plus ``blocks`` of the source's line and the ``quota`` of them that it may give, repeats counted.

    The highest quotients are found from the rounded quotas: these differ from the wanted
    number of blocks by a few seats only, and no source can gain or lose more than that
    difference, so just those quotients are listed and ordered.
    """
    spark = targets.sparkSession
    wanted = F.when(F.col("total") > 0, F.col("target") * F.col("blocks") / F.col("total")).otherwise(0.0)
    rows = targets.withColumn("blocks", F.ceil(F.col("total") / block_words)).withColumn("wanted", wanted)
    rows = stage(rows.withColumn("rounded", F.least(F.floor(F.col("wanted") + 0.5), most * F.col("blocks"))), "mix-sources")
    sums = rows.agg(F.sum("wanted"), F.sum("rounded")).first()
    if sums[0] is None:
        return rows.withColumn("quota", F.lit(0).cast("long"))
    missing = math.floor(sums[0] + 0.5) - sums[1]
    if missing == 0:
        return rows.withColumn("quota", F.col("rounded"))
    if missing > 0:
        seats = F.sequence(F.col("rounded"), F.col("rounded") + (missing - 1))
        best = [F.desc("quotient"), F.asc("key")]
    else:
        seats = F.when(F.col("rounded") > 0, F.sequence(F.greatest(F.col("rounded") + missing, F.lit(0)), F.col("rounded") - 1))
        best = [F.asc("quotient"), F.desc("key")]
    offered = rows.select("key", "wanted", "blocks", F.explode(seats).alias("seat")).where(F.col("seat") < most * F.col("blocks"))
    moved = offered.withColumn("quotient", F.col("wanted") / (2 * F.col("seat") + 1)).orderBy(*best).limit(abs(missing))
    moved = moved.groupBy("key").agg(F.count("*").alias("moved"))
    sign = 1 if missing > 0 else -1
    return rows.join(moved, "key", "left").withColumn(
        "quota", F.col("rounded") + sign * F.coalesce("moved", F.lit(0))
    ).drop("moved")


def taken_before(x: Column, mix: Column) -> Column:
    """Words of the extra blocks that lie before position ``x`` of the source's line, to the next whole word."""
    block = mix.getField
    j = F.least(F.floor(x / block("length")), block("blocks") - 1)
    upto = lambda n: F.floor(n * (block("extra") / block("blocks")) + block("phase"))
    return F.floor(upto(j) * block("length") + (upto(j + 1) - upto(j)) * (x - j * block("length")) + 0.5)


def plan_mix(docs: DataFrame, size: str, source: str = "source", doc_id: str = "doc_id", seed: int = SEED,
             block_words: int = BLOCK_WORDS, docs_per_shard: int = DOCS_PER_SHARD, mix: str = "mix") -> DataFrame:
    """All columns of ``docs`` plus the struct named ``mix``: the source's line, and where the document lies on it.

    ``docs`` is read twice: narrowly for the sums per shard and source, and once with all its
    columns, shuffled by (shard, source). Those groups hold a few hundred rows even where one
    source has a third of all documents.
    """
    shards = max(1, min(MAX_SHARDS, math.ceil(docs.count() / docs_per_shard)))
    order = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(size))
    placed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(size).alias("words"), source_key(F.col(source)).alias("key"),
        order.alias("order"), F.pmod(F.xxhash64(order), F.lit(shards)).alias("shard"),
    )
    groups = stage(placed.groupBy("shard", "key").agg(F.sum("words").alias("words")), "mix-groups")
    quotas = block_quotas(source_targets(groups.groupBy("key").agg(F.sum("words").alias("total"))), block_words)
    lines = quotas.select(
        "key",
        F.struct(
            "total", "target", "blocks", "quota", (F.col("total") / F.col("blocks")).alias("length"),
            F.floor(F.col("quota") / F.col("blocks")).alias("base"), F.pmod("quota", "blocks").alias("extra"),
            (F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 20)) / (1 << 20)).alias("phase"),
        ).alias("line"),
    )
    first = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("offset", F.coalesce(F.sum("words").over(first), F.lit(0))).drop("words").join(lines, "key")
    within = Window.partitionBy("shard", "key").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.withColumn("before", F.coalesce(F.sum("words").over(within), F.lit(0)))
    joined = before.join(offsets, ["shard", "key"])
    return joined.select("row.*", F.struct("line.*", (F.col("offset") + F.col("before")).alias("start")).alias(mix))


def mix_sizes(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document: how many of its words the mix takes."""
    sized = stage(docs.select("doc_id", "source", word_count(F.col(text)).alias("size")), "mix-sizes")
    line = F.col("mix")
    extra = taken_before(line["start"] + F.col("size"), line) - taken_before(line["start"], line)
    taken = F.when(F.col("size") > 0, F.col("mix.base") * F.col("size") + F.least(F.greatest(extra, F.lit(0)), F.col("size")))
    return plan_mix(sized, "size", **options).select(
        "doc_id", "size", F.col("mix.total").alias("source_size"), F.col("mix.target").alias("target"),
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: whole documents once per time they are taken, cut ones with the words taken.

    A document on the edge of a chosen block gives only the words inside it, with the blanks
    that follow them; its ``n_chars`` is counted anew.
    """
    size, line, pieces = named(docs, "mix_size"), named(docs, "mix"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    planned = plan_mix(docs.withColumn(size, word_count(F.col("text"))), size, mix=line, **options).where(F.col(size) > 0)
    mix = F.col(line)
    start, base = mix["start"], mix["base"]
    extra = F.least(F.greatest(taken_before(start + F.col(size), mix) - taken_before(start, mix), F.lit(0)), F.col(size))
    chosen = F.filter(pieces, lambda _, i: taken_before(start + i + 1, mix) > taken_before(start + i, mix))
    part = F.when(extra == F.col(size), F.col("text")).otherwise(F.rtrim(F.array_join(chosen, "")))
    whole = F.when(base > 0, F.array_repeat("text", base.cast("int"))).otherwise(F.array().cast("array<string>"))
    texts = F.concat(whole, F.when(extra > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    out = named(docs, "mix_text")
    rows = planned.withColumn(out, F.explode(texts))
    length = F.when(F.col(out) == F.col("text"), F.col("n_chars")).otherwise(F.length(out)) if "n_chars" in docs.columns else None
    return rows.select(*[
        F.col(out).alias("text") if c == "text" else length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns
    ])
