"""Shards of a corpus by best-fit-decreasing bin packing of indivisible groups.

Documents of equal text are a group and never parted. Groups enter in order of falling size;
each goes to the bin with the least remaining room that still takes it, found in a balanced
tree of remaining rooms, and opens a bin where none does. ``packed`` uses as few bins of a
fixed capacity as that gives; ``even_shards`` looks for the smallest capacity at which a fixed
number of bins is enough, gives groups above it shards of their own, and levels what best fit
leaves uneven.

Groups are never listed on the driver. Only their sizes are: every size up to 65,536, and
larger ones rounded up to one of 4,096 steps an octave, so there are 260,000 size classes at
the very most, whatever the corpus. Groups of one class are interchangeable, so best fit over
(class, number of groups) gives what it would give over the groups one by one; it returns
which ranks of a class go to which bin, and groups find theirs by a join on their rank.

A group that holds a third of all rows is one row from its first aggregation on. Its rows
find their shard by a join that broadcasts the few heavy groups, and places inside shards
are counted part by part, so no task gets a whole shard.

Defined cases: a null text counts no bytes and belongs to the group of the empty text; a null
``doc_id`` is an id like others; rows that repeat are rows each and get neighbouring places;
an empty table gives an empty result. Runs agree: order comes from the rows alone. Extra
columns are left alone; those named like a result column are replaced by it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.numbering import join_uneven, numbered
from tidewatch.session import stage

SHARDS = 24
#: Bytes that a document takes besides its text.
OVERHEAD = 8
EXACT_BITS = 16
STEP_BITS = 12
#: Ranks of a class that are joined under one key.
RANKS = 4096
LAW = "bytes"

Node = tuple  # (left, key, right, height)


def _node(left, key, right) -> Node:
    return left, key, right, 1 + max(left[3] if left else 0, right[3] if right else 0)


def _balanced(left, key, right) -> Node:
    """A node over two subtrees whose heights differ by two at most, rotated so that they differ by one."""
    tall = (left[3] if left else 0) - (right[3] if right else 0)
    if tall > 1:
        a, k, b, _ = left
        if (a[3] if a else 0) >= (b[3] if b else 0):
            return _node(a, k, _node(b, key, right))
        return _node(_node(a, k, b[0]), b[1], _node(b[2], key, right))
    if tall < -1:
        a, k, b, _ = right
        if (b[3] if b else 0) >= (a[3] if a else 0):
            return _node(_node(left, key, a), k, b)
        return _node(_node(left, key, a[0]), a[1], _node(a[2], k, b))
    return _node(left, key, right)


def tree_insert(tree: Node | None, key) -> Node:
    if tree is None:
        return None, key, None, 1
    left, k, right, _ = tree
    return _balanced(tree_insert(left, key), k, right) if key < k else _balanced(left, k, tree_insert(right, key))


def tree_remove(tree: Node, key) -> Node | None:
    left, k, right, _ = tree
    if key < k:
        return _balanced(tree_remove(left, key), k, right)
    if key > k:
        return _balanced(left, k, tree_remove(right, key))
    if left is None or right is None:
        return left or right
    following = right
    while following[0]:
        following = following[0]
    return _balanced(left, following[1], tree_remove(right, following[1]))


def tree_at_least(tree: Node | None, key):
    """The smallest key that is not below ``key``."""
    found = None
    while tree:
        if tree[1] >= key:
            found, tree = tree[1], tree[0]
        else:
            tree = tree[2]
    return found


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, most_bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """``(size, groups)`` in falling order of size to ``(size, groups, bin)``; None if it takes more than ``most_bins``.

    The bin that took a group has the least room of all that fit, and less afterwards, so it
    takes the next ones of the class too while they fit. A group above ``capacity`` has a bin
    of its own. Among bins of equal room the one opened first is taken.
    """
    tree, bins, out = None, 0, []
    for size, groups in classes:
        while groups:
            found = tree_at_least(tree, (size, -1))
            if found is None:
                if bins == most_bins:
                    return None
                room, at, bins = max(capacity, size), bins, bins + 1
            else:
                room, at = found
                tree = tree_remove(tree, found)
            n = min(groups, room // size)
            out.append((size, n, at))
            groups -= n
            if room > n * size:
                tree = tree_insert(tree, (room - n * size, at))
    return out


def fair_share(classes: list[tuple[int, int]], bins: int) -> int:
    """What a bin holds at least if the largest groups, where they are more than their share, have bins of their own."""
    left = sum(size * n for size, n in classes)
    for size, n in classes:
        for _ in range(n):
            if bins <= 1 or size * bins <= left:
                return -(-left // bins)
            left, bins = left - size, bins - 1
    return -(-left // bins)


def levelled(placed: list[tuple[int, int, int]], bins: int) -> list[tuple[int, int, int]]:
    """Move groups from the fullest bin to the emptiest while that narrows the gap between them.

    Best fit leaves the last bins short where groups are coarse against the capacity, as in a
    small table; with many small groups there is nothing to move.
    """
    held: list[Counter] = [Counter() for _ in range(bins)]
    load = [0] * bins
    for size, n, at in placed:
        held[at][size] += n
        load[at] += size * n
    while True:
        low = min(range(bins), key=lambda b: (load[b], b))
        # A bin of one group has nothing to give: that group is as large as it is.
        for high in sorted(range(bins), key=lambda b: (-load[b], b)):
            gap = load[high] - load[low]
            size = max((s for s, n in held[high].items() if n and s < gap), default=None) if held[high].total() > 1 else None
            if size is not None:
                break
        else:
            return [(size, n, at) for at, groups in enumerate(held) for size, n in groups.items() if n]
        n = min(held[high][size], max(1, gap // (2 * size)))
        held[high][size] -= n
        held[low][size] += n
        load[high] -= n * size
        load[low] += n * size


def fill_evenly(classes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """Best fit at the smallest capacity found for which ``bins`` are enough: first doubling what is added to the fair share, then halving."""
    share, fails, extra = fair_share(classes, bins), -1, 0
    while (found := best_fit_decreasing(classes, share + extra, bins)) is None:
        fails, extra = extra, max(1, 2 * extra)
    while extra - fails > 1:
        middle = (fails + extra) // 2
        if (better := best_fit_decreasing(classes, share + middle, bins)) is None:
            fails = middle
        else:
            found, extra = better, middle
    return levelled(found, bins)


def size_class(size: Column) -> Column:
    """The size, rounded up to a multiple of a power of two that is at most 1/4,096 of it beyond 65,536."""
    size = F.greatest(size, F.lit(1)).cast("long")
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(size)) - 1 - STEP_BITS, F.lit(0)))
    up = size + step - 1
    return F.when(size <= 1 << EXACT_BITS, size).otherwise(up - up % step)


def _runs(placed: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Ranks of each class that go to each bin, cut where the join's key changes."""
    reached: dict[int, int] = defaultdict(int)
    for size, n, at in placed:
        low = reached[size]
        reached[size] = high = low + n
        for start in range(low - low % RANKS, high, RANKS):
            yield size, start // RANKS, max(low, start), min(high, start + RANKS), at


def _assigned(groups: DataFrame, keys: list[str], weight: str, fill) -> DataFrame:
    spark = groups.sparkSession
    sized = stage(groups.withColumn("_class", size_class(F.col(weight))), "packing-groups")
    # Bounded by the number of size classes.
    classes = [tuple(r) for r in sized.groupBy("_class").count().orderBy(F.desc("_class")).collect()]
    total = sum(n for _, n in classes)
    runs = spark.createDataFrame(list(_runs(fill(classes))) if classes else [], "_class long, _run long, _low long, _high long, shard int")
    ranked = numbered(sized, ["_class"], keys, "_rank", total).withColumn("_run", F.floor(F.col("_rank") / RANKS))
    inside = (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    return ranked.join(runs, ["_class", "_run"]).where(inside).select(*groups.columns, "shard")


def packed(groups: DataFrame, keys: list[str], weight: str, capacity: int) -> DataFrame:
    """``groups`` plus ``shard``: bins of ``capacity``, as few as best fit decreasing needs. ``keys`` tell the groups apart.

    Groups above the capacity have a bin each. Sizes above 65,536 count for up to 1/4,096 more
    than they are, so no bin overflows.
    """
    return _assigned(groups, keys, weight, lambda classes: best_fit_decreasing(classes, capacity))


def even_shards(groups: DataFrame, keys: list[str], weight: str, shards: int = SHARDS) -> DataFrame:
    """``groups`` plus ``shard`` from 0 to ``shards - 1``, near equal in weight."""
    return _assigned(groups, keys, weight, lambda classes: fill_evenly(classes, shards))


def _sized(docs: DataFrame, text: str) -> list[Column]:
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return [
        (F.octet_length(content) + OVERHEAD).cast("long").alias("size"), F.crc32(content.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(F.lit(1), content).alias("_key1"), F.xxhash64(F.lit(2), content).alias("_key2"),
    ]


_KEYS = ["_key1", "_key2"]


def text_shards(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``_key1, _key2, copies, shard``: one row per text; ``rows`` have the columns of ``_sized``."""
    texts = rows.groupBy(*_KEYS).agg(F.count("*").alias("copies"), F.sum("size").alias("weight"))
    return stage(even_shards(texts, _KEYS, "weight", shards).select(*_KEYS, "copies", "shard"), "packing-texts")


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``shard``; documents of one text share theirs."""
    sized = docs.drop("shard").select("*", *_sized(docs, text)[2:])
    found = text_shards(docs.select(*_sized(docs, text)), shards)
    total = found.agg(F.sum("copies")).first()[0] or 0
    return join_uneven(sized, found, _KEYS, "copies", total).drop(*_KEYS, "copies")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text") -> str:
    """The documents in one folder a shard, written by many tasks; rows of a shard lie in order of their text's hash."""
    shard_documents(docs, shards, text).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return path


def shard_places(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: where every row of ``docs`` lies."""
    rows = stage(docs.select("doc_id", *_sized(docs, text)), "packing-rows")
    found = text_shards(rows, shards)
    # Rows that repeat are one row with a count until their places are known.
    distinct = rows.groupBy("doc_id", "size", "text_crc32", *_KEYS).agg(F.count("*").alias("repeats"))
    facts = found.agg(F.sum("copies")).first()
    placed = stage(join_uneven(distinct, found, _KEYS, "copies", facts[0] or 0).drop("copies"), "packing-places")
    seen = placed.agg(F.count("*"), F.max("repeats")).first()
    slots = numbered(placed, ["shard"], ["doc_id", "size", "text_crc32", *_KEYS], "first", seen[0], "repeats")
    chunk = 4096
    if (seen[1] or 0) > chunk:
        chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("repeats") - 1) / chunk))
        slots = slots.withColumn("_chunk", F.explode(chunks)).repartition("shard", "first", "_chunk")
        slots = slots.withColumn("first", F.col("first") + F.col("_chunk") * chunk).withColumn(
            "repeats", F.least(F.col("repeats") - F.col("_chunk") * chunk, F.lit(chunk))
        )
    steps = F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1)
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "first", F.explode(steps).alias("_step"),
    ).select(
        "doc_id", "size", "text_crc32", "law", F.col("shard").cast("int").alias("shard"), (F.col("first") + F.col("_step")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
