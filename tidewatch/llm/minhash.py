"""Near-duplicate texts by circulant MinHash, banding and exact Jaccard on full shingle sets.

Two permutations make the whole signature: ``sigma`` scatters the shingles over 2**32 places,
and coordinate ``k`` is the smallest ``pi(place + k)``, that is ``pi`` shifted circularly by
``k``. Texts that agree in all rows of a band are candidates. ``banding`` takes as many rows a band
as miss a pair of the asked similarity once in a million times at most: 32 bands of 4 rows at
0.8, where one in 20 million is missed, 64 of 2 at 0.5.

Hot groups: texts with equal words form one class and only its smallest ``doc_id`` goes on, so
exact copies cost one row each. In a band's bucket every member meets the smallest one first;
what that links needs no more comparison, so a bucket of near copies is linear; the few buckets
with many members are broadcast, and the text that many others meet is given out in as many
copies as they need. Texts that
share a passage but little else crowd buckets without being similar. Members of buckets that
still hold several components are therefore regrouped by the rarest shingles of their sets:
two sets of similarity t share one of the ``n - ceil(t n) + 1`` rarest of each, whatever the
order of rarity, so this loses nothing, and a shared passage is not among its texts' rarest.

Defined cases: a null or blank text has no shingles and is linked with nothing; a null
``doc_id`` is linked with nothing and kept; rows that repeat a ``doc_id`` are judged by their
own text; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import named, small_batches
from tidewatch.llm.components import components
from tidewatch.llm.numbering import join_uneven
from tidewatch.llm.textarrays import ODD, Words, between_blanks, lists, mix64, pieces
from tidewatch.session import stage

SHINGLE = 5
PERCENT = 80
#: Coordinates of a signature, and signature bits that are kept of them.
COORDINATES = 128
BITS = 128
#: How often banding may miss a pair of the asked similarity, and how often its bits may rule one out.
MISSED = 1e-6
RULED_OUT = 1e-10
#: Pairs that meet one copy of a text.
PAIRS_PER_COPY = 128
#: Rows that a Python worker gets at a time: texts, and pairs of texts.
TEXTS_AT_ONCE = 500
PAIRS_AT_ONCE = 32
#: Buckets, hubs and shingles are joined by broadcasting those above one in so many of all rows; there are no more of them.
HEAVY_BUCKETS = 16_384
#: Rows of a few numbers that are broadcast at most; tables are counted before.
MOST_BROADCAST = 500_000
#: Places of the table that says how rare a shingle is; a power of two.
PLACES = 1 << 18

SIGNATURES = "doc_id long, class1 long, class2 long, n_shingles long, bits1 long, bits2 long, bands array<long>"


def banding(percent: int, coordinates: int = COORDINATES) -> tuple[int, int]:
    """Bands and rows: the longest rows, a power of two, that miss no more than MISSED of the pairs of similarity ``percent``."""
    rows, similarity = 1, percent / 100
    while 2 * rows <= coordinates and (1 - similarity ** (2 * rows)) ** (coordinates // (2 * rows)) <= MISSED:
        rows *= 2
    return coordinates // rows, rows


def most_bits(percent: int, bits: int = BITS) -> int:
    """In how many signature bits a pair of similarity ``percent`` differs at most, but for RULED_OUT of all pairs.

    Where two coordinates differ, their bits do in half of all cases.
    """
    p, tail = (1 - percent / 100) / 2, 0.0
    for differ in range(bits, -1, -1):
        tail += math.comb(bits, differ) * p**differ * (1 - p) ** (bits - differ)
        if tail > RULED_OUT:
            return differ
    return 0


def _pi(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    return np.bitwise_xor(x, spare, out=x)


def circulant_minhash(shingles: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Signatures (texts x coordinates) of the non-empty runs of ``shingles`` that begin at ``starts``."""
    places = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), coordinates), np.uint32)
    x, spare = np.empty_like(places), np.empty_like(places)
    for k in range(coordinates):
        np.add(places, np.uint32(k), out=x)
        out[:, k] = np.minimum.reduceat(_pi(x, spare), starts)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    for r in range(rows):
        keys = mix64(keys * ODD + parts[:, :, r])
    return keys.view(np.int64)


def distinct_counts(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if b > a:
            one = np.sort(shingles[a:b])
            out[i] = 1 + np.count_nonzero(one[1:] != one[:-1])
    return out


def sign_batches(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    is_word = between_blanks()
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = Words(piece.column("text"), is_word)
            shingles, bounds = words.shingles(shingle)
            counts = distinct_counts(shingles, bounds)
            full = np.flatnonzero(counts)
            keys, bits = np.zeros((len(counts), bands), np.int64), np.zeros((len(counts), 2), np.int64)
            # Few texts at a time, so that the arrays of one coordinate stay in the cache.
            for some in np.array_split(full, max(1, len(shingles) // 50_000)):
                if len(some):
                    low = bounds[some[0]]
                    signed = circulant_minhash(shingles[low : bounds[some[-1] + 1]], bounds[some] - low, bands * rows)
                    keys[some] = band_keys(signed, bands, rows)
                    packed = np.packbits((signed & 1).astype(np.uint8), axis=1)
                    packed = np.pad(packed, ((0, 0), (0, max(0, 16 - packed.shape[1]))))[:, :16]
                    bits[some] = np.ascontiguousarray(packed).view(np.int64)
            digest = np.zeros((len(counts), 2), np.int64)
            for i in full:
                one = words.hash[words.first[i] : words.first[i + 1]]
                digest[i] = np.frombuffer(blake2b(one.tobytes(), digest_size=16).digest(), np.int64)
            offsets = np.where(counts > 0, bands, 0).cumsum(dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").cast(pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(counts),
                    pa.array(bits[:, 0]), pa.array(bits[:, 1]),
                    pa.ListArray.from_arrays(np.concatenate((np.zeros(1, np.int32), offsets)), pa.array(keys[full].ravel())),
                ],
                names=[f.split()[0] for f in SIGNATURES.split(", ")],
            )


def verify_batches(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts to those whose full shingle sets are similar enough."""
    is_word = between_blanks()
    for batch in batches:
        for piece in pieces(batch, "text_a"):
            sides = [Words(piece.column(c), is_word).shingles(shingle) for c in ("text_a", "text_b")]
            sets = [[np.unique(h[b[i] : b[i + 1]]) for i in range(piece.num_rows)] for h, b in sides]
            yield similar_pairs(piece, sets, percent)


def verify_sets(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The same for pairs that carry their sets."""
    for batch in batches:
        yield similar_pairs(batch, [lists(batch.column(c)) for c in ("set_a", "set_b")], percent)


def similar_pairs(batch: pa.RecordBatch, sets: list[list[np.ndarray]], percent: int) -> pa.RecordBatch:
    good = np.zeros(batch.num_rows, bool)
    for i, (one, two) in enumerate(zip(*sets)):
        both = len(np.intersect1d(one, two, assume_unique=True))
        good[i] = both > 0 and 100 * both >= percent * (len(one) + len(two) - both)
    return pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])


def set_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    is_word = between_blanks()
    for batch in batches:
        for piece in pieces(batch, "text"):
            hashes, bounds = Words(piece.column("text"), is_word).shingles(shingle)
            sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("group"), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "group", "set"]
            )


def place_counts(batches: Iterator[pa.RecordBatch], places: int) -> Iterator[pa.RecordBatch]:
    """How many sets of this task hold a shingle at each of a fixed number of places."""
    counts = np.zeros(places, np.int64)
    for batch in batches:
        flat = pc.list_flatten(batch.column("set")).to_numpy(zero_copy_only=False)
        counts += np.bincount(flat & (places - 1), minlength=places)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["place", "n"])


def rarest_batches(batches: Iterator[pa.RecordBatch], counts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for one in lists(batch.column("set")):
            most = len(one) - -(-percent * len(one) // 100) + 1
            out.append(one[np.lexsort((one, counts[one & (len(counts) - 1)]))[:most]])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("group"), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "group", "keys"]
        )


def might_be_similar(percent: int) -> Column:
    """What sizes and signature bits allow, for the columns of a pair named ``_a`` and ``_b``."""
    differ = sum(F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("bits1", "bits2"))
    small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    return (100 * small >= percent * large) & (differ <= most_bits(percent))


def side(rows: DataFrame, suffix: str, keep: tuple = ()) -> DataFrame:
    return rows.select(*[F.col(c) if c in keep else F.col(c).alias(f"{c}_{suffix}") for c in rows.columns])


def join_few(left: DataFrame, right: DataFrame, on: list[str], copies: str, total: int) -> DataFrame:
    """``left`` joined to ``right``, a written table, which is broadcast whole where it has been counted and is small, else as uneven."""
    if right.count() <= MOST_BROADCAST:
        return left.join(F.broadcast(right), on)
    return join_uneven(left, right, on, copies, total, HEAVY_BUCKETS)


def star_links(members: DataFrame, reps: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links of each bucket's members with its smallest one, confirmed on whole texts.

    The smallest member of a large group is in as many pairs as the group has members. Facts
    about the few such documents are broadcast, and their texts are given out in copies.
    """
    facts = reps.select("doc_id", "n_shingles", "bits1", "bits2")
    pairs = stage(members.where("doc_id <> low").select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct(), "minhash-stars")
    met = stage(pairs.groupBy("b").agg(F.count("*").alias("met")), "minhash-hubs")
    hubs = stage(side(facts, "b").withColumnRenamed("doc_id_b", "b").join(met, "b"), "minhash-hub-facts")
    pairs = join_few(pairs.join(side(facts, "a").withColumnRenamed("doc_id_a", "a"), "a"), hubs, ["b"], "met", pairs.count())
    pairs = stage(pairs.where(might_be_similar(percent)).select("a", "b"), "minhash-pairs")
    # Each text that is in a pair is taken from the documents once.
    needed = stage(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "minhash-needed")
    few = needed.count() <= MOST_BROADCAST
    found = stage(docs.join(F.broadcast(needed) if few else needed, "doc_id"), "minhash-texts")
    # Beyond one copy's pairs a hub has several; there are few such hubs.
    several = F.broadcast(met.where(F.col("met") > PAIRS_PER_COPY).select("b", F.ceil(F.col("met") / PAIRS_PER_COPY).alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    left = pairs.join(found.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(several, "b", "left")
    left = left.select("a", "b", "text_a", F.pmod(F.xxhash64("a"), copies).alias("part"))
    texts = found.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).join(pairs.select("b").distinct(), "b").join(several, "b", "left")
    texts = texts.select("b", "text_b", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("part"))
    pairs = left.join(texts, ["b", "part"])
    # Pairs of a hub lie together, and its texts may all be long.
    small_batches(docs.sparkSession, PAIRS_AT_ONCE)
    links = stage(pairs.mapInArrow(lambda it: verify_batches(it, shingle, percent), "a long, b long"), "minhash-links")
    small_batches(docs.sparkSession, TEXTS_AT_ONCE)
    return links


def crowd_links(crowd: DataFrame, reps: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between different groups of ``crowd(doc_id, group)``, found by their rarest shingles."""
    spark = docs.sparkSession
    texts = docs.join(crowd, "doc_id").select("doc_id", "group", "text")
    sets = stage(texts.mapInArrow(lambda it: set_batches(it, shingle), "doc_id long, group long, set array<long>"), "minhash-sets")
    counted = sets.select("set").mapInArrow(lambda it: place_counts(it, PLACES), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    # One number per place: the table has the same size for any corpus.
    table, counts = counted.toArrow(), np.zeros(PLACES, np.int64)
    counts[table.column("place").to_numpy()] = table.column("n").to_numpy()
    rarest = sets.mapInArrow(lambda it: rarest_batches(it, counts, percent), "doc_id long, group long, keys array<long>")
    facts = reps.select("doc_id", "n_shingles", "bits1", "bits2")
    keyed = rarest.join(facts, "doc_id").select(F.posexplode("keys").alias("at", "key"), "doc_id", "group", "n_shingles", "bits1", "bits2")
    keyed = stage(keyed, "minhash-rarest")
    mixed = keyed.groupBy("key").agg(
        F.min("group").alias("low_group"), F.max("group").alias("high_group"), F.count("*").alias("n")
    ).where("low_group < high_group")
    # The higher of two groups is not the lowest: members of the lowest, the many, are on one side only.
    left = side(join_uneven(keyed, mixed, ["key"], "n", keyed.count(), HEAVY_BUCKETS).where("group > low_group").drop("low_group", "high_group", "n"), "a")
    # The first key that two sets share has nothing shared before it, so what can be shared at most is what follows.
    follows = F.least(F.col("n_shingles_a") - F.col("at_a"), F.col("n_shingles_b") - F.col("at_b"))
    enough = (100 + percent) * follows >= percent * (F.col("n_shingles_a") + F.col("n_shingles_b"))
    apart = (F.col("group_a") > F.col("group_b")) & might_be_similar(percent) & enough
    pairs = left.join(side(keyed, "b"), (F.col("key_a") == F.col("key_b")) & apart)
    pairs = stage(pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct(), "minhash-pairs")
    for suffix in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(suffix), F.col("set").alias(f"set_{suffix}")), suffix)
    small_batches(spark, 200)
    return stage(pairs.mapInArrow(lambda it: verify_sets(it, percent), "a long, b long"), "minhash-links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``."""
    bands, rows = banding(percent)
    small_batches(docs.sparkSession, TEXTS_AT_ONCE)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(docs.mapInArrow(lambda it: sign_batches(it, shingle, bands, rows), SIGNATURES), "minhash-signed")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    carried = F.struct("doc_id", "n_shingles", "bits1", "bits2", "bands")
    reps = stage(usable.groupBy("class1", "class2").agg(F.min(carried).alias("rep")).select("class1", "class2", "rep.*"), "minhash-reps")
    entries = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("members"))
    buckets = stage(buckets.where("low < high"), "minhash-buckets")
    entered = reps.count() * bands
    members = stage(join_few(entries, buckets, ["key"], "members", entered), "minhash-members")
    links = star_links(members, reps, docs, shingle, percent)
    grouped = components(links)
    placed = members.where("members > 2").join(grouped, F.col("doc_id") == F.col("node"), "left")
    placed = stage(placed.select("key", "doc_id", F.coalesce("component", "doc_id").alias("group")), "minhash-placed")
    crowded = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("n")).where("low < high")
    crowded = stage(crowded.select("key", "n"), "minhash-crowded")
    crowd = stage(join_few(placed, crowded, ["key"], "n", placed.count()).select("doc_id", "group").distinct(), "minhash-crowd")
    more = crowd_links(crowd, reps, docs, shingle, percent)
    if not more.isEmpty():
        grouped = components(links.union(more))
    classes = reps.join(grouped, F.col("doc_id") == F.col("node"), "left").select(
        "class1", "class2", F.coalesce("component", "doc_id").alias("reached")
    )
    found = F.when(F.col("n_shingles") > 0, F.coalesce("reached", "doc_id")).otherwise(F.col("doc_id"))
    out = signed.drop("bands", "bits1", "bits2").join(classes, ["class1", "class2"], "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), found).alias("component_id"),
        F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest ``doc_id``; rows without a ``doc_id`` stay.

    Of rows that repeat this ``doc_id`` the one with the smallest text stays.
    """
    found = near_duplicates(docs, **options)
    firsts = found.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    number = named(docs, "row_of_id")
    kept = docs.join(stage(firsts, "minhash-kept"), "doc_id", "left_semi")
    once = kept.withColumn(number, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(number) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return once.select(*columns).union(docs.where("doc_id IS NULL").select(*columns))
