"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of turns (role, text) that conversations begin with. Its key is
128 bits: the exclusive or of the hashes of (position, role, text) of its turns, which is a
running value, so a conversation of any length gets its keys slice by slice. Conversations of
equal turns are one row with a count before anything is expanded.

Subtree totals come from the centroid decomposition of the forest of parent edges. Every node
weighs the number of distinct conversations through it; the weight of a whole subtree is then
the number of steps that these conversations have below, known from the same aggregation
that finds the nodes. A component above ``piece`` is split at its centroid, the deepest
node that holds half of its weight: below it each child heads a component, above it the rest
keeps its top. The total of the component's part below the centroid is added to every node on
the path from centroid to top, and those weights are lessened by the centroid's. Components
halve in every round; those of ``piece`` and less, which have no more nodes than that, are
decomposed in the same way inside tasks that hold many of them.

Nothing is gathered by node or conversation without bound: a long conversation is cut into
slices, a node with many conversations or children is summed before the shuffle and joined by
broadcasting the few heavy nodes, and lists of members are joined slice by slice, the texts
of the slices being hashed one after another.

Defined cases: rows without ``conv_id`` take no part; a null turn comes first; rows of equal
turn come in the order of a hash of role and text, and rows that repeat are turns each; a null
role or text is empty; a conversation without turns ends at the root; an empty table gives no
nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches
from tidewatch.llm.numbering import join_uneven, sliced
from tidewatch.session import stage

#: Longest head that a conversation can take over, and how many conversations share one.
LONGEST_HEAD = 5
SHARED_BY = 100
#: Weight up to which a component is decomposed inside one task.
PIECE = 4096
#: Nodes that a task of small components has at one time, about.
BUNDLE = 16_384
_ID, _UP = ["k1", "k2"], ["p1", "p2"]
_COMPONENT = ["c1", "c2"]


def _carried(slices: DataFrame, by: str, add, *columns: str) -> DataFrame:
    """``by, slice`` and what ``add`` makes of the ``columns`` of the same ``by`` in earlier slices.

    Ranges are contiguous: only the first ``by`` of a slice goes on from earlier ones, so this
    table has fewer rows than there are slices, and is broadcast.
    """
    parts = slices.groupBy(by, "slice").agg(*[add(c).alias(c) for c in columns])
    earlier = Window.partitionBy(by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(by, "slice", *[add(c).over(earlier).alias(f"{c}_before") for c in columns])
    return F.broadcast(before.where(F.col(f"{columns[0]}_before").isNotNull()))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv, slice, pos, h1, h2, chars``: the turns of every conversation by place from 1, as hashes of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"), F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("h1"), F.col("h2"), F.col("row")]
    slices = sliced(turns, order, "trie-turns")
    before = _carried(slices.withColumn("n", F.lit(1)), "conv", F.sum, "n")
    inside = F.row_number().over(Window.partitionBy("conv", "slice").orderBy(*order[1:]))
    placed = slices.withColumn("inside", inside).join(before, ["conv", "slice"], "left")
    return stage(placed.select("conv", "slice", (F.coalesce("n_before", F.lit(0)) + F.col("inside")).alias("pos"), "h1", "h2", "chars"), "trie-places")


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % (LONGEST_HEAD + 1)).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, slice, depth, h1, h2, chars`` of the rebuilt conversations, and all ``conv`` with their first slice.

    The first turns, as many as a hash of the id says, come from the first conversation of the hundred.
    """
    convs = stage(turns.groupBy("conv").agg(F.min("slice").alias("slice")), "trie-convs")
    heads = turns.where(F.col("pos") <= LONGEST_HEAD).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "chars"))).alias("head")
    ).withColumnRenamed("conv", "base")
    base = F.col("conv") - F.col("conv") % SHARED_BY
    taken = convs.select("conv", "slice", base.alias("base")).join(heads, "base", "left").select(
        "conv", "slice", F.slice("head", F.lit(1), head_length(F.col("conv")).cast("int")).alias("head")
    )
    first = taken.select("conv", "slice", F.inline("head")).select("conv", "slice", F.col("pos").alias("depth"), "h1", "h2", "chars")
    lengths = taken.select("conv", F.coalesce(F.size("head"), F.lit(0)).alias("n_head"))
    own = turns.where(F.col("pos") > head_length(F.col("conv"))).join(lengths, "conv").select(
        "conv", "slice", (F.col("pos") - head_length(F.col("conv")) + F.greatest("n_head", F.lit(0))).alias("depth"), "h1", "h2", "chars"
    )
    return first.unionByName(own), convs


def prefix_keys(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv, depth, k1, k2, p1, p2, chars``: every step of every conversation, with the keys of its node and the node above.

    The step of depth 0 is the root, whose key is 0 and which has none above.
    """
    steps = stage(turns.select("conv", "slice", "depth", "chars", *[F.xxhash64(F.lit(n), "depth", "h1", "h2").alias(f"g{n}") for n in (1, 2)]), "trie-steps")
    before = _carried(steps, "conv", F.bit_xor, "g1", "g2")
    running = Window.partitionBy("conv", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keys = [F.bit_xor(f"g{n}").over(running).alias(f"x{n}") for n in (1, 2)]
    keyed = steps.select("*", *keys).join(before, ["conv", "slice"], "left")
    for n in (1, 2):
        keyed = keyed.withColumn(f"k{n}", F.col(f"x{n}").bitwiseXOR(F.coalesce(f"g{n}_before", F.lit(0).cast("long"))))
    below = keyed.select("conv", "depth", *_ID, *[F.col(f"k{n}").bitwiseXOR(F.col(f"g{n}")).alias(f"p{n}") for n in (1, 2)], "chars")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("chars"))
    return stage(below.withColumn("depth", F.col("depth").cast("long")).unionByName(root), "trie-keys")


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of node and slice to one digest a node; a node's texts are hashed as they come."""
    node, digest = None, None

    def done():
        return pa.RecordBatch.from_pydict({"k1": [node[0]], "k2": [node[1]], "ends_sha256": [digest.hexdigest()]})

    for batch in batches:
        for k1, k2, joined in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "joined"))):
            if node != (k1, k2):
                if node:
                    yield done()
                node, digest = (k1, k2), hashlib.sha256(joined.encode())
            else:
                digest.update(b"," + joined.encode())
    if node:
        yield done()


def member_digests(ends: DataFrame) -> DataFrame:
    """``k1, k2, conv`` to ``k1, k2, ends_sha256``: the SHA-256 of each node's ids, ascending, joined by commas.

    Ids are joined slice by slice of the order of (node, id). A node inside one slice is hashed
    there. The texts of a node over several slices, fewer of these nodes than there are
    slices, are hashed in turn by a task that holds one text at a time.
    """
    slices = sliced(ends, [*_ID, "conv"], "trie-ends")
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    parts = stage(slices.groupBy(*_ID, "slice").agg(F.array_join(ids, ",").alias("joined")), "trie-members")
    counted = parts.groupBy(*_ID).agg(F.count("*").alias("parts"), F.sha2(F.first("joined").cast("binary"), 256).alias("ends_sha256"))
    counted = stage(counted, "trie-digests")
    several = parts.join(F.broadcast(counted.where("parts > 1").select(*_ID)), _ID, "left_semi")
    small_batches(ends.sparkSession, 1)
    ordered = several.repartition(*_ID).sortWithinPartitions(*_ID, "slice").select(*_ID, "joined")
    # Written here, as batches of one text are for this step alone.
    long = stage(ordered.mapInArrow(_hash_batches, "k1 long, k2 long, ends_sha256 string"), "trie-long")
    small_batches(ends.sparkSession)
    return counted.where("parts = 1").select(*_ID, "ends_sha256").unionByName(long)


# Centroid decomposition -------------------------------------------------------------------


def centroid_totals(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree totals of a forest inside a task. ``parents`` come before their children; a top has -1."""
    n = len(parents)
    totals = [[0] * n for _ in values]
    heads = list(range(n))
    trees: dict[int, list[int]] = {}
    for x, up in enumerate(parents):
        heads[x] = heads[up] if up >= 0 else x
        trees.setdefault(heads[x], []).append(x)
    todo = list(trees.values())
    size, branch = [0] * n, [-1] * n
    while todo:
        nodes = todo.pop()
        top = nodes[0]
        for x in nodes:
            size[x], branch[x] = 1, -1
        for x in reversed(nodes[1:]):
            size[parents[x]] += size[x]
        # Nodes that hold half of the component lie on one path, and deeper ones come later.
        centroid = next(x for x in reversed(nodes) if 2 * size[x] >= len(nodes))
        above, below = [], {}
        for x in nodes:
            if x == centroid:
                branch[x] = x
            elif x != top and branch[parents[x]] >= 0:
                branch[x] = x if parents[x] == centroid else branch[parents[x]]
                below.setdefault(branch[x], []).append(x)
            else:
                above.append(x)
        for value, total in zip(values, totals):
            part = value[centroid] + sum(value[x] for some in below.values() for x in some)
            x = centroid
            while part:
                total[x] += part
                if x == top:
                    break
                x = parents[x]
        todo.extend(some for some in (above, *below.values()) if some)
    return totals


def _totals_of(table: pa.Table, names: tuple[str, ...]) -> pa.Table:
    table = table.sort_by("depth")
    place = {key: i for i, key in enumerate(zip(table["k1"].to_pylist(), table["k2"].to_pylist()))}
    columns = [table[c].to_pylist() for c in ("k1", "k2", "p1", "p2", "c1", "c2")]
    parents = [-1 if (k1, k2) == (c1, c2) else place[p1, p2] for k1, k2, p1, p2, c1, c2 in zip(*columns)]
    totals = centroid_totals(parents, [table[c].to_pylist() for c in names])
    return pa.table({"k1": table["k1"], "k2": table["k2"]} | {c: pa.array(t, pa.int64()) for c, t in zip(names, totals)})


def subtree_totals(nodes: DataFrame, steps: DataFrame, names: tuple[str, ...], piece: int = PIECE) -> DataFrame:
    """``k1, k2`` and the sums of the columns ``names`` over each node's subtree, itself included.

    ``nodes`` are ``k1, k2, p1, p2, depth, owner, weight`` and the values: a member's id as
    ``owner``, and the weight of the subtree. ``steps`` are the paths of the owners from the
    root down. Each round splits every component above ``piece`` at its centroid; the driver
    sees one number a round.
    """
    zero = F.lit(0).cast("long")
    current = stage(nodes.select(*_ID, *_UP, "depth", "owner", "weight", *names, zero.alias("c1"), zero.alias("c2")), "trie-roots")
    small, added = [], []
    while True:
        tops = current.where("k1 = c1 AND k2 = c2").select(*_COMPONENT, F.col("weight").alias("whole"), F.col("depth").alias("top"))
        large = stage(tops.where(F.col("weight") > piece), "trie-large")
        small.append(current.join(large.select(*_COMPONENT), _COMPONENT, "left_anti"))
        if large.isEmpty():
            break
        big = current.join(large, _COMPONENT)
        deepest = F.max(F.struct("depth", "k1", "k2", "owner", "weight", "top")).alias("v")
        found = big.where(2 * F.col("weight") >= F.col("whole")).groupBy(*_COMPONENT).agg(deepest)
        centroids = stage(found.select(*_COMPONENT, *[F.col(f"v.{c}").alias(f"v_{c}") for c in ("depth", "k1", "k2", "owner", "weight", "top")]), "trie-centroids")
        # The members that pass through a child of the centroid, and that child: it heads their nodes below.
        through = steps.join(centroids.select(F.col("v_k1").alias("p1"), F.col("v_k2").alias("p2"), *_COMPONENT), _UP).select(
            F.col("conv").alias("owner"), *_COMPONENT, F.col("k1").alias("u1"), F.col("k2").alias("u2")
        )
        marked = big.join(centroids.select(*_COMPONENT, "v_depth", "v_k1", "v_k2"), _COMPONENT).join(through, ["owner", *_COMPONENT], "left")
        below = (F.col("depth") > F.col("v_depth")) & F.col("u1").isNotNull()
        middle = (F.col("k1") == F.col("v_k1")) & (F.col("k2") == F.col("v_k2"))
        marked = stage(marked.select(
            *_ID, *_UP, "depth", "owner", "weight", *names, *_COMPONENT, F.when(below, F.col("u1")).alias("n1"), F.when(below, F.col("u2")).alias("n2"),
            below.alias("below"), middle.alias("middle"),
        ), "trie-marked")
        parts = marked.where("below OR middle").groupBy(*_COMPONENT).agg(*[F.sum(c).alias(c) for c in names])
        climbs = steps.join(centroids.withColumnRenamed("v_owner", "conv"), "conv").where(
            (F.col("depth") >= F.col("v_top")) & (F.col("depth") <= F.col("v_depth"))
        ).select(*_ID, *_COMPONENT, F.col("v_weight").alias("less"))
        climbs = stage(climbs.join(parts, _COMPONENT), "trie-climbs")
        added.append(climbs.select(*_ID, *names))
        current = marked.where(~F.col("middle")).join(climbs.select(*_ID, "less"), _ID, "left").select(
            *_ID, *_UP, "depth", "owner", (F.col("weight") - F.coalesce("less", zero)).alias("weight"), *names,
            F.coalesce("n1", "c1").alias("c1"), F.coalesce("n2", "c2").alias("c2"),
        )
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    rest = stage(rest, "trie-small")
    bundles = max(1, math.ceil(rest.count() / BUNDLE))
    small_batches(nodes.sparkSession)
    kind = "k1 long, k2 long, " + ", ".join(f"{c} long" for c in names)
    local = rest.withColumn("bundle", F.pmod(F.xxhash64(*_COMPONENT), F.lit(bundles))).groupBy("bundle").applyInArrow(lambda table: _totals_of(table, names), kind)
    for more in added:
        local = local.unionByName(more)
    return local.groupBy(*_ID).agg(*[F.sum(c).alias(c) for c in names])


def prefix_trie(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, and its key ``k1, k2``."""
    keys = prefix_keys(*rebuilt(placed_turns(conversations)))
    last = stage(keys.groupBy("conv").agg(F.max(F.struct("depth", "k1", "k2")).alias("end")).select("conv", "end.*"), "trie-last")
    same = last.groupBy(*_ID).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"), F.first("depth").alias("ends"))
    steps = stage(keys.join(same.select("conv", "copies", "ends"), "conv"), "trie-paths")
    nodes = stage(steps.groupBy(*_ID).agg(
        F.first("depth").alias("depth"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("chars").alias("chars"),
        F.min("conv").alias("owner"), F.sum("copies").alias("n_convs"), F.sum(F.col("ends") - F.col("depth") + 1).alias("weight"),
    ), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    facts = stage(nodes.join(children, _ID, "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    ), "trie-facts")
    totals = subtree_totals(facts, steps.select("conv", "depth", *_ID, *_UP), ("n_leaves", "saved_tokens"), piece)
    above = facts.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("parent_conv_id"), "n_children")
    parents = join_uneven(facts.where("depth > 0").select(*_ID, *_UP), above, _UP, "n_children", facts.count()).select(*_ID, "parent_conv_id")
    digests = member_digests(last.select(*_ID, "conv"))
    return facts.select(*_ID, F.col("owner").alias("conv_id"), "depth", "n_convs", "n_children").join(totals, _ID).join(parents, _ID, "left").join(digests, _ID, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), *_ID,
    )
