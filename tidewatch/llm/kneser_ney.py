"""Text quality by an interpolated modified Kneser-Ney model of character n-grams.

A model per language is trained on all trusted documents: character n-grams are counted in the
tasks that read them and summed; continuation counts, the three discounts of each order and the
weights of contexts follow from grouped joins of the count tables. The model is stored in shards
by the symbol before the last one, which all orders of an n-gram share; scoring joins a batch's
distinct n-grams with one shard after the other, so a worker holds one shard of bounded size.
Every document's perplexity is held against a quantile of its language, taken over trusted
documents that were kept out of training.

Symbols are lower-case code points, folded to 16 bits; a document begins after three start
symbols and ends with an end symbol.

Defined cases: a null or empty text has no perplexity and is kept; a null language is a
language of its own; a language without trusted text has no model or threshold and its texts
are kept; a document with labels of both kinds isn't trusted; repeated rows are scored each, and
trusted ones counted as often as they come; a null ``doc_id`` is scored but never trusted; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as dataset
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches
from tidewatch.llm.textarrays import pieces
from tidewatch.session import stage, stage_path

ORDER = 4
#: The share of clean documents of a language below its threshold.
QUANTILE = 0.995
#: Thresholds lie this much above the quantile, for languages with few trusted documents.
SLACK = 1.1
#: A text of n symbols may lie above its threshold by a factor of exp(SPREAD / sqrt(n)), as short texts scatter more.
SPREAD = 2.0
#: One in so many trusted documents sets thresholds instead of being counted.
KEPT_OUT = 5
SHARD_ROWS = 4_000_000
#: Distinct n-grams that a counting task holds before it passes them on.
HELD_GRAMS = 2_000_000
START, END = 0, 1


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram of every symbol of the texts, the symbols before it in the upper bits; each text's first, and number."""
    texts = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    pad = chr(START) * (ORDER - 1)
    raw = np.frombuffer("".join(f"{pad}{t}{chr(END)}" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = (raw & 0xFFFF).astype(np.uint64)
    grams = raw.copy()
    for k in range(1, ORDER):
        grams[k:] |= raw[:-k] << np.uint64(16 * k)
    begin = np.cumsum(sizes + ORDER - 1) - sizes
    inside = np.ones(len(raw), bool)
    for k in range(1, ORDER):
        inside[begin - k] = False
    return grams[inside], np.cumsum(sizes) - sizes, sizes


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    langs, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
    for lang in sorted(set(langs)):
        rows = np.array([i for i in np.flatnonzero(langs == lang) if texts[i]], np.int64)
        if len(rows):
            yield lang, rows, [texts[i] for i in rows]


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task."""
    held: dict[str, list[pd.Series]] = {}
    rows = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            total = pd.concat(parts).groupby(level=0).sum()
            keys = total.index.to_numpy(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(total.to_numpy(np.int64))], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for piece in pieces(batch, "text"):
            for lang, _, texts in by_language(piece):
                codes, keys = pd.factorize(symbols(texts)[0])
                parts = held.setdefault(lang, [])
                parts.append(pd.Series(np.bincount(codes, minlength=len(keys)), index=keys))
                rows += len(keys)
                if len(parts) > 16:
                    rows -= sum(map(len, parts))
                    parts[:] = [pd.concat(parts).groupby(level=0).sum()]
                    rows += len(parts[0])
            if rows > HELD_GRAMS:
                yield from passed_on()
                rows = 0
    yield from passed_on()


def part(gram: Column | str, low: int, size: int) -> Column:
    """``size`` symbols of an n-gram, the lowest being number ``low`` from its end."""
    moved = F.shiftrightunsigned(gram, 16 * low) if low else F.col(gram) if isinstance(gram, str) else gram
    return moved if low + size >= ORDER else moved.bitwiseAND(F.lit((1 << (16 * size)) - 1))


def model_tables(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``counts(lang, gram, n)`` of the highest order to ``size, lang, gram, alpha`` and ``size, lang, context, gamma``.

    The probability of a symbol is ``alpha + gamma * (probability after the shorter context)``.
    """
    tables = [stage(counts, "kn-counts").select(F.lit(ORDER).alias("size"), "lang", "gram", "n")]
    for size in range(ORDER - 1, 0, -1):
        shorter = tables[-1].groupBy("lang", part("gram", 0, size).alias("gram")).agg(F.count("*").alias("n"))
        tables.append(stage(shorter.select(F.lit(size).alias("size"), "lang", "gram", "n"), "kn-counts"))
    every = tables[0]
    for other in tables[1:]:
        every = every.union(other)
    often = every.groupBy("size", "lang").agg(*[F.count_if(F.col("n") == k).cast("double").alias(f"t{k}") for k in (1, 2, 3, 4)])
    y = F.when(F.col("t1") > 0, F.col("t1") / (F.col("t1") + 2 * F.col("t2"))).otherwise(0.5)

    def discount(k: int) -> Column:
        exact = F.when(F.col(f"t{k}") > 0, k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}"))
        return F.greatest(F.least(F.coalesce(exact, F.lit(k / 2)), F.lit(float(k))), F.lit(0.05))

    # One row per order and language.
    discounts = stage(often.select("size", "lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)]), "kn-discounts")
    grams = every.withColumn("context", F.shiftrightunsigned("gram", 16))
    contexts = grams.groupBy("size", "lang", "context").agg(
        F.sum("n").alias("total"), *[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2)], F.count_if(F.col("n") > 2).alias("n3")
    ).join(discounts, ["size", "lang"])
    contexts = stage(contexts.withColumn("gamma", sum(F.col(f"d{k}") * F.col(f"n{k}") for k in (1, 2, 3)) / F.col("total")), "kn-contexts")
    less = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    alphas = grams.join(contexts, ["size", "lang", "context"]).select("size", "lang", "gram", ((F.col("n") - less) / F.col("total")).alias("alpha"))
    return alphas, contexts.select("size", "lang", "context", "gamma")


def store_model(counts: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[str, int]:
    """Write the model's shards; the folder, and how many there are. The unigrams are in a shard of their own."""
    spark = counts.sparkSession
    alphas, gammas = (stage(t, "kn-model") for t in model_tables(counts))
    shards = max(1, math.ceil((alphas.count() + gammas.count()) / shard_rows))
    last = lambda symbol: F.when(F.col("size") > 1, symbol.bitwiseAND(F.lit(0xFFFF)) % shards).otherwise(-1)
    rows = alphas.select(last(F.shiftrightunsigned("gram", 16)).alias("shard"), F.lit("alpha").alias("kind"), "size", "lang", F.col("gram").alias("key"), F.col("alpha").alias("value"))
    rows = rows.union(gammas.select(last(F.col("context")), F.lit("gamma"), "size", "lang", "context", "gamma"))
    path = stage_path(spark, "kn-shards")
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return path, shards


@lru_cache(maxsize=2)
def load_shard(path: str, shard: int) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and their values by kind, order and language."""
    system, folder = fs.FileSystem.from_uri(f"{path}/shard={shard}" if ":/" in path else f"file://{path}/shard={shard}")
    if system.get_file_info(folder).type == fs.FileType.NotFound:
        return {}
    rows = dataset.dataset(folder, filesystem=system, format="parquet").to_table(columns=["kind", "size", "lang", "key", "value"]).to_pandas()
    out = {}
    for name, some in rows.groupby(["kind", "size", "lang"]):
        keys = some["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        out[name] = keys[order], some["value"].to_numpy(np.float64)[order]
    return out


def looked_up(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray, missing: float) -> np.ndarray:
    if table is None:
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], missing)


def log_probabilities(path: str, shards: int, lang: str, grams: np.ndarray) -> np.ndarray | None:
    """Of the last symbol of each n-gram after the others; None if the language has no model."""
    common = load_shard(path, -1)
    if ("alpha", 1, lang) not in common:
        return None
    known = len(common["alpha", 1, lang][0])
    first = looked_up(common["alpha", 1, lang], grams & np.uint64(0xFFFF), 0.0) + common["gamma", 1, lang][1][0] / (known + 1)
    out, before = np.empty(len(grams)), ((grams >> np.uint64(16)) & np.uint64(0xFFFF)) % np.uint64(shards)
    for shard in np.unique(before).tolist():
        rows = np.flatnonzero(before == shard)
        tables, some, p = load_shard(path, shard), grams[rows], first[rows]
        for size in range(2, ORDER + 1):
            key = some & np.uint64((1 << (16 * size)) - 1)
            p = looked_up(tables.get(("alpha", size, lang)), key, 0.0) + looked_up(tables.get(("gamma", size, lang)), key >> np.uint64(16), 1.0) * p
        out[rows] = np.log(p)
    return out


def score_batches(batches: Iterator[pa.RecordBatch], path: str, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            n, total = np.zeros(piece.num_rows, np.int64), np.full(piece.num_rows, np.nan)
            for lang, rows, texts in by_language(piece):
                grams, first, sizes = symbols(texts)
                codes, keys = pd.factorize(grams)
                logs = log_probabilities(path, shards, lang, keys)
                n[rows] = sizes
                if logs is not None:
                    total[rows] = np.add.reduceat(logs[codes], first)
            missing = np.isnan(total)
            perplexity = np.exp(-np.where(missing, 0, total) / np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("lang"), pa.array(n), pa.array(perplexity, mask=missing)], names=["doc_id", "lang", "n_symbols", "perplexity"])


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``doc_id, lang, n_symbols, perplexity, threshold, kept`` for every row of ``docs(doc_id, text, lang)``."""
    spark = docs.sparkSession
    small_batches(spark, 500)
    marked = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), marked.alias("lang"), "text")
    trusted = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("least")).where("least = 1").select("doc_id")
    kept_out = F.pmod(F.xxhash64("doc_id"), F.lit(KEPT_OUT)) == 0
    # The labels grow with the corpus: joined by a shuffle at every size, never by a broadcast.
    counted = docs.join(trusted.where(~kept_out).hint("merge"), "doc_id", "left_semi").select("lang", "text").mapInArrow(count_batches, "lang string, gram long, n long")
    path, shards = store_model(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    scored = docs.mapInArrow(lambda it: score_batches(it, path, shards), "doc_id long, lang string, n_symbols long, perplexity double")
    scored = stage(scored, "kn-scores")
    judged = scored.join(trusted.where(kept_out), "doc_id", "left_semi").where("perplexity IS NOT NULL")
    limits = judged.groupBy("lang").agg((F.percentile_approx("perplexity", quantile, 100_000) * slack).alias("threshold"))
    out = scored.join(limits, "lang", "left")
    allowed = F.col("threshold") * F.exp(SPREAD / F.sqrt("n_symbols"))
    lang = F.when(F.col("lang") != "", F.substring("lang", 2, 1 << 20))
    return out.select("doc_id", lang.alias("lang"), "n_symbols", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= allowed, F.lit(True)).alias("kept"))
