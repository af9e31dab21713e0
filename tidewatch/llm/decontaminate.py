"""Find test items in training texts: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of letters and digits in lower case. Grams are runs of two and three words and every
choice of four words out of six in order: two thirds of equal words, the least that half the score
allows where words are replaced, leave one of them whatever the places of the others. All grams of
the items are counted over the whole corpus. Seeds are those that are rare there, and those that aren't but whose neighbour in
the item comes as often: these are frequent because the item leaked, not as a common phrase. So
an item has seeds however often it leaked, and in whatever version. A passage is what lies around the seeds found in a document,
one item's length to either side. Each passage is aligned with the items of its seeds: +2 for
an equal word, -1 for another or a missing one. An alignment that reaches half of what the
whole item would reach is a copy, whether exact, edited or cut.

The corpus is scanned twice, in the tasks that read it, against a filter of bounded size; only
passages that pass it are shuffled, and joined exactly with the seeds.

Defined cases: null and empty texts and items hold no words and are never reported, nor are items
of fewer words than a seed; equal items are reported each; rows that repeat a ``doc_id`` are
reported once with their best alignment; a null ``doc_id`` is reported as null; empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches
from tidewatch.llm.textarrays import Words, alphanumeric, factors, lists, pieces
from tidewatch.session import stage

GRAM = 4
#: An n-gram is rare if it comes no more than once in so many words of the corpus, or no more than FEW times.
RARE_IN, FEW = 1_000_000, 32
LEAST_SCORE = 0.5
MATCH, MISS, GAP = 2, 1, 1
#: Bounds of the filter, as powers of two of its bits; 2 MB at most.
FILTER_BITS = (16, 24)
PROBES = (0, 21, 40)


def words_of(texts: pa.Array) -> Words:
    return Words(pc.utf8_lower(pc.fill_null(texts, "")), alphanumeric(), fold_case=False)


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def list_column(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate((np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32))), pa.array(flat))


def reach_of(n: int) -> int:
    """How many words a gram can span."""
    return n + n // 2


def shapes(n: int) -> list[tuple[int, ...]]:
    """Where the words of a gram stand: unbroken runs of fewer than ``n``, and each ``n`` of half as many more."""
    return [tuple(range(k)) for k in range(2, n)] + [(0, *rest) for rest in combinations(range(1, reach_of(n)), n - 1)]


def grams_of(words: Words, n: int, known: GramFilter | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, index of the first word and number of the shape of all grams inside one text, or of those that ``known`` passes."""
    terms = [words.hash * factor for factor in factors(reach_of(n))]
    out = []
    for number, shape in enumerate(shapes(n)):
        count = max(0, len(words.hash) - shape[-1])
        total = terms[0][:count].copy()
        for at in shape[1:]:
            total += terms[at][at : at + count]
        index = known(total) if known else np.arange(count)
        index = index[words.doc[index] == words.doc[index + shape[-1]]]
        out.append((total[index], index, np.full(len(index), number)))
    return tuple(np.concatenate(column) for column in zip(*out))


def item_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = words_of(batch.column("text"))
        grams, index, shape = grams_of(words, n)
        order = np.lexsort((index, shape, words.doc[index]))
        sizes = np.bincount(words.doc[index], minlength=words.texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_id").cast(pa.int64()), list_column(signed(words.hash), words.counts()),
                list_column(signed(grams[order]), sizes), list_column(shape[order], sizes),
            ],
            names=["item_id", "words", "grams", "shapes"],
        )


class GramFilter:
    """A Bloom filter whose size is bounded; every true gram passes, and few others do."""

    def __init__(self, grams: DataFrame):
        """``grams(gram)``; set bits are gathered per 64-bit word, so the driver gets as many rows as the filter has words, at most."""
        low, high = FILTER_BITS
        self.exponent = int(min(high, max(low, (128 * max(1, grams.count())).bit_length())))
        mask = F.lit((1 << self.exponent) - 1)
        probes = F.array(*[F.shiftrightunsigned("gram", shift).bitwiseAND(mask) for shift in PROBES])
        bits = grams.select(F.explode(probes).alias("bit"))
        rows = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
        ).collect()
        words = np.zeros(1 << (self.exponent - 6), np.int64)
        words[[r[0] for r in rows]] = [r[1] for r in rows]
        self.bits = np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << self.exponent) - 1)
        passed = np.flatnonzero(self.bits[grams & mask])
        for shift in PROBES[1:]:
            passed = passed[self.bits[(grams[passed] >> np.uint64(shift)) & mask]]
        return passed


def count_batches(batches: Iterator[pa.RecordBatch], n: int, known: GramFilter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = words_of(piece.column("text"))
            found, counts = np.unique(grams_of(words, n, known)[0], return_counts=True)
            # The number of words goes without an n-gram.
            keys = pa.array([None, *signed(found).tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate(([len(words.hash)], counts)))], names=["gram", "found"])


def passage_batches(batches: Iterator[pa.RecordBatch], n: int, seeds: GramFilter, reach: int) -> Iterator[pa.RecordBatch]:
    """Stretches of words around seeds; overlapping ones are one passage."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = words_of(piece.column("text"))
            grams, index, _ = grams_of(words, n, seeds)
            if not len(grams):
                continue
            order = np.argsort(index, kind="stable")
            grams, index = grams[order], index[order]
            doc = words.doc[index]
            low = np.maximum(index - reach, words.first[doc])
            high = np.minimum(index + reach_of(n) + reach, words.first[doc + 1])
            fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])))
            begin = np.flatnonzero(fresh)
            start, stop = low[begin], np.maximum.reduceat(high, begin)
            sizes = stop - start
            inside = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
            rows = len(begin)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + np.arange(rows)), piece.column("doc_id").take(pa.array(doc[begin])).cast(pa.int64()),
                    pa.array(start - words.first[doc[begin]]), list_column(signed(words.hash)[inside], sizes),
                    list_column(signed(grams), np.diff(begin, append=len(grams))),
                ],
                names=["passage", "doc_id", "first_word", "words", "grams"],
            )
            number += rows


def align(passages: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair of rows and the passage position where it ends; -1 and -2 pad.

    One word of the items after the other; words left out of the passage are a running maximum.
    """
    steps = GAP * np.arange(passages.shape[1] + 1, dtype=np.int32)
    scores = np.zeros((len(passages), passages.shape[1] + 1), np.int32)
    best, at = np.zeros(len(passages), np.int32), np.zeros(len(passages), np.int64)
    for word in items.T:
        given = np.maximum(scores - GAP, 0)
        np.maximum(given[:, 1:], scores[:, :-1] + np.where(passages == word[:, None], MATCH, -MISS), out=given[:, 1:])
        scores = np.maximum.accumulate(given + steps, axis=1) - steps
        end = scores.argmax(axis=1)
        top = scores[np.arange(len(scores)), end]
        better = top > best
        best[better], at[better] = top[better], end[better]
    return best, at


def padded(lists: list[np.ndarray], filler: int, reverse: bool = False) -> np.ndarray:
    out = np.full((len(lists), max(map(len, lists))), filler, np.int64)
    for i, one in enumerate(lists):
        out[i, : len(one)] = one[::-1] if reverse else one
    return out


def align_batches(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs to ``doc_id, item_id, score, first_word, last_word`` where the score is high enough."""
    for batch in batches:
        passages, items = (lists(batch.column(c)) for c in ("words", "item_words"))
        order = sorted(range(len(passages)), key=lambda i: (len(passages[i]), len(items[i])))
        docs, numbers, offsets = (batch.column(c).to_pylist() for c in ("doc_id", "item_id", "first_word"))
        rows: list[tuple] = []
        while order:
            # Pairs of like sizes together, so many that their tables stay small.
            some = order[-max(1, 500_000 // (len(passages[order[-1]]) + 1)) :]
            del order[-len(some) :]
            p, q = [passages[i] for i in some], [items[i] for i in some]
            best, end = align(padded(p, -1), padded(q, -2))
            good = [k for k, i in enumerate(some) if best[k] >= least * MATCH * len(items[i])]
            if good:
                # The same alignment read backwards from its end gives its beginning.
                heads = [p[k][: end[k]] for k in good]
                _, length = align(padded(heads, -1, reverse=True), padded([q[k] for k in good], -2, reverse=True))
                for k, size in zip(good, length.tolist()):
                    i, last = some[k], int(end[k])
                    rows.append((docs[i], numbers[i], best[k] / (MATCH * len(q[k])), offsets[i] + last - size, offsets[i] + last - 1))
        columns = list(zip(*rows)) or [[]] * 5
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "score", "first_word", "last_word"]
        )


def contaminated(docs: DataFrame, items: DataFrame, n: int = GRAM, least: float = LEAST_SCORE) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of every copy of an item in a document."""
    spark = docs.sparkSession
    small_batches(spark, 500)
    docs, items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items.select("item_id", "text")
    held = stage(items.mapInArrow(lambda it: item_batches(it, n), "item_id long, words array<long>, grams array<long>, shapes array<long>"), "leak-items")
    grams = held.select("item_id", F.explode(F.array_distinct("grams")).alias("gram"))
    known = GramFilter(grams.select("gram").distinct())
    counted = docs.mapInArrow(lambda it: count_batches(it, n, known), "gram long, found long").groupBy("gram").agg(F.sum("found").alias("found"))
    counted = stage(counted, "leak-counts")
    total = counted.where("gram IS NULL").first()
    most = max(FEW, (total["found"] if total else 0) // RARE_IN)
    placed = held.select("item_id", F.xxhash64("words").alias("version"), "shapes", F.posexplode("grams").alias("at", "gram"))
    placed = placed.withColumn("shape", F.get("shapes", "at")).drop("shapes").join(counted, "gram", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    order = Window.partitionBy("item_id", "version", "shape").orderBy("at")
    beside = F.greatest(F.lag("found", 1, 0).over(order), F.lead("found", 1, 0).over(order))
    # Frequent runs of fewer words have frequent neighbours without any leak.
    leaked = (F.col("shape") >= n - 2) & (2 * F.col("beside") >= F.col("found"))
    seeds = placed.withColumn("beside", beside).where((F.col("found") > 0) & ((F.col("found") <= most) | leaked))
    seeds = stage(seeds.select("gram", "item_id").distinct(), "leak-seeds")
    wanted = GramFilter(seeds.select("gram").distinct())
    reach = held.agg(F.max(F.size("words"))).first()[0] or 0
    passages = stage(
        docs.mapInArrow(
            lambda it: passage_batches(it, n, wanted, reach),
            "passage long, doc_id long, first_word long, words array<long>, grams array<long>",
        ),
        "leak-passages",
    )
    hits = passages.select("passage", F.explode(F.array_distinct("grams")).alias("gram"))
    pairs = hits.join(seeds, "gram").select("passage", "item_id").distinct()
    small_batches(spark, 100)
    wide = pairs.join(passages.drop("grams"), "passage").join(held.select("item_id", F.col("words").alias("item_words")), "item_id")
    aligned = wide.select("doc_id", "item_id", "first_word", "words", "item_words").mapInArrow(
        lambda it: align_batches(it, least), "doc_id long, item_id long, score double, first_word long, last_word long"
    )
    best = F.max(F.struct("score", (-F.col("first_word")).alias("before"), "last_word")).alias("best")
    found = aligned.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "best.score", (-F.col("best.before")).alias("first_word"), "best.last_word")


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a copy of an item; a row without ``doc_id`` can't be told and stays."""
    found = stage(contaminated(docs, items, **options), "leak-found")
    return docs.join(found.select(F.col("doc_id")).distinct(), "doc_id", "left_anti").select(docs.columns)
