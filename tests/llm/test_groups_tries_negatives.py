"""Bin packing, the conversation trie and hard negatives against plain versions."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import SMALL, no_docs, odd_docs, odd_rows, rows_of, twin_rows
from tests.llm.plain_trie import COLUMNS, plain_trie
from tidewatch.llm import catalog, hard_negatives, prefix_trie, sharding
from tidewatch.session import stage_path

# Shards ----------------------------------------------------------------------------------


def plain_best_fit(sizes, capacity):
    room, out = [], []
    for size in sorted(sizes, reverse=True):
        fits = [(r, b) for b, r in enumerate(room) if r >= size]
        if not fits:
            room.append(max(capacity, size))
            fits = [(room[-1], len(room) - 1)]
        at = min(fits)[1]
        room[at] -= size
        out.append((size, at))
    return out


def classes_of(sizes):
    return sorted(collections.Counter(sizes).items(), reverse=True)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 60))
def test_best_fit_by_classes_equals_best_fit_one_by_one(sizes, capacity):
    got = [(s, b) for s, n, b in sharding.best_fit_decreasing(classes_of(sizes), capacity) for _ in range(n)]
    assert collections.Counter(got) == collections.Counter(plain_best_fit(sizes, capacity))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 200), max_size=200))
def test_tree_stays_balanced(keys):
    tree, held = None, []
    for i, key in enumerate(keys):
        if key % 3 == 0 and held:
            tree = sharding.tree_remove(tree, held.pop(key % len(held)))
        else:
            tree = sharding.tree_insert(tree, (key, i))
            held.append((key, i))
        assert (tree[3] if tree else 0) <= 1.45 * math.log2(len(held) + 2)
        assert sharding.tree_at_least(tree, (key, -1)) == min((k for k in held if k >= (key, -1)), default=None)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=120), st.integers(1, 9))
def test_even_bins_take_all_and_no_bin_could_give(sizes, bins):
    placed = sharding.fill_evenly(classes_of(sizes), bins)
    assert collections.Counter({s: n for s, n in classes_of(sizes)}) == sum((collections.Counter({s: n}) for s, n, _ in placed), collections.Counter())
    held = collections.defaultdict(list)
    for s, n, b in placed:
        held[b] += [s] * n
    loads = [sum(held[b]) for b in range(bins)]
    assert set(held) <= set(range(bins))
    for b in range(bins):
        # Nothing that a bin holds beside other groups would narrow its gap to the emptiest bin.
        assert len(held[b]) < 2 or min(held[b]) >= loads[b] - min(loads)


def test_sizes_are_rounded_up_by_little(spark):
    sizes = [0, 1, 65535, 65536, 65537, 2**17, 2**17 + 1, 10**9 + 7, 2**40 - 1, 2**62 + 5]
    rows = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", sharding.size_class(F.col("s")).alias("c")).collect()
    for r in rows:
        assert max(r.s, 1) <= r.c <= max(r.s, 1) * (1 + 1 / 4096) and (r.s > 65536 or r.c == max(r.s, 1))


def shard_facts(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_places_of_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANKS", 2)
    rows = odd_rows() + [(None, None, None, None, None, None, None)] * 5000 + [(70, "same", None, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, odd_docs(spark).schema).withColumn("shard", F.lit("x")).withColumn("slot", F.lit(9))
    got = sharding.shard_places(docs).collect()
    text_of = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == text_of
    assert shard_facts(got) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    shards = collections.defaultdict(set)
    for r in got:
        shards[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.shard_places(no_docs(spark)).count() == 0
    again = sharding.shard_places(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_shards_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = catalog.QUERIES["op11_packed_shards"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    load, of_text = collections.Counter(), collections.defaultdict(set)
    for r in got:
        load[r.shard] += r["size"]
        of_text[texts[r.doc_id]].add(r.shard)
    assert len(got) == len(texts) and shard_facts(got) and len(load) == 24 and all(len(s) == 1 for s in of_text.values())
    assert max(load.values()) - min(load.values()) < 0.001 * max(load.values())


def test_written_shards_and_fixed_capacity(spark):
    docs = odd_docs(spark)
    path = sharding.write_shards(docs, stage_path(spark, "test-shards"), 4)
    back = spark.read.parquet(path)
    assert rows_of(back.drop("shard")) == rows_of(docs) and {r[0] for r in back.select("shard").distinct().collect()} <= set(range(4))
    rng = random.Random(4)
    sizes = [rng.randrange(1, 5000) for _ in range(500)] + [20_000]
    groups = spark.createDataFrame(list(enumerate(sizes)), "id long, weight long")
    load, n = collections.Counter(), collections.Counter()
    for r in sharding.packed(groups, ["id"], "weight", 10_000).collect():
        load[r.shard] += r.weight
        n[r.shard] += 1
    assert sum(load.values()) == sum(sizes) and all(v <= 10_000 or n[s] == 1 for s, v in load.items())
    assert len(load) == len({b for _, b in plain_best_fit(sizes, 10_000)})


# Conversation trie -----------------------------------------------------------------------


def trie_rows(spark, rows, piece=4096, extra=False):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        frame = frame.withColumn("depth", F.lit("x")).withColumn("k1", F.lit(1)).withColumn("conv", F.lit(2.0))
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(frame, piece).select(*COLUMNS).collect())


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_trie_of_odd_conversations(spark, piece):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", None, ""]), rng.choice(["a", "ü😀", "", None])) for c in [*range(0, 30), *range(100, 160, 7), 305, 306, 1000] for t in rng.sample([None, *range(8)], rng.randrange(1, 8))]
    rows += [(None, 1, "user", "lost"), (7007, None, None, None)]
    rows += [(2000 + c, t, "user", "same") for c in range(12) for t in range(3)]
    rows += [(3000, t, "r", f"turn {t % 5}") for t in range(300)] + [(3001, t, "r", f"turn {t % 5}") for t in range(200)]
    assert trie_rows(spark, rows, piece, extra=True) == plain_trie(rows)


def test_repeated_turns_and_empty_table(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, None, "u", "b"), (2, 5, "u", "a"), (2, 5, "u", "a")]
    got = trie_rows(spark, rows)
    assert got[0][1] == 0 and max(r[1] for r in got) <= 3 and got == trie_rows(spark, rows[::-1])
    assert trie_rows(spark, []) == []


def test_centroid_totals_equal_sums_of_subtrees():
    rng = random.Random(2)
    for n in (1, 2, 7, 300):
        for shape in (lambda i: rng.randrange(-1, i), lambda i: i - 1, lambda i: 0 if i else -1, lambda i: max(-1, i - rng.randrange(1, 4))):
            parents = [shape(i) if i else -1 for i in range(n)]
            value = [rng.randrange(-5, 50) for _ in range(n)]
            want = value[:]
            for x in range(n - 1, -1, -1):
                if parents[x] >= 0:
                    want[parents[x]] += want[x]
            assert prefix_trie.centroid_totals(parents, [value, [1] * n])[0] == want


def test_members_of_many_slices_are_hashed_in_order(spark):
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(c, 0, "u", "one") for c in range(1, 900)]
        assert trie_rows(spark, rows, 50) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


@pytest.mark.parametrize("piece", [4096, 40])
def test_trie_of_the_table(spark, piece):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(spark, rows, piece) == plain_trie(rows)


def test_trie_equals_its_twin(spark):
    assert rows_of(catalog.QUERIES["op12_prefix_trie"](spark, SMALL)) == twin_rows(catalog.TWINS["op12_prefix_trie"])


# Hard negatives --------------------------------------------------------------------------


def plain_negatives(rows):
    part = {}
    for vec, vector, label in rows:
        if vec is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part[vec, tuple(math.floor(256 * float(x)) for x in vector), (label + 1) % 10 if vec % 7 == 0 else label] = True
    out = []
    for a in part:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2] == a[2]) for b in part if b != a and len(b[1]) == len(a[1]))
        for score, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and 80 * -score <= 100 * -s[0] <= 100 * -score]
            out += [(a[0], positive, rank, s[1], -score, -s[0]) for rank, s in enumerate(fits[:5], 1)]
    return sorted(out)


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(spark, rows, block=4096):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("k1", F.lit("x")).withColumn("ids", F.lit(1))
    return sorted(tuple(r) for r in hard_negatives.mine_embeddings(frame, block=block).select(*NAMES).collect())


@pytest.mark.parametrize("block", [4096, 20])
def test_negatives_of_odd_vectors(spark, block):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in np.float32(centers[i % 4] + 0.4 * rng.normal(size=6))], int(rng.integers(0, 3))) for i in range(0, 900, 4)]
    same = rows[5][1]
    rows += [(i, same, 1) for i in range(1, 400, 9)] + [(i, same, 2) for i in range(2, 60, 9)]
    rows += [rows[0], rows[25], (100, same, 1), (100, same, 0), (None, same, 1), (4001, None, 1), (4002, same, None), (4003, [*same[:5], None], 1)]
    rows += [(4004, [*same[:5], float("nan")], 1), (4005, [*same[:5], float("inf")], 1), (4006, [], 1), (5000, [0.0] * 6, 1), (5001, [0.0] * 6, 2)]
    rows += [(i, [1.0, float(i % 5)], i % 2) for i in range(6000, 6400, 25)]
    assert mined(spark, rows, block) == plain_negatives(rows)


def test_no_table_has_queries_times_trees(spark, monkeypatch):
    """Without clusters every query visits nearly every tree; what is written stays as large as the rows, in any number of rounds."""
    rng = np.random.default_rng(8)
    rows = [(100 * i, [float(x) for x in np.float32(rng.normal(size=12))], int(rng.integers(0, 3))) for i in range(300)]
    staged = {}

    def counted(table, name, *options, **more):
        staged[name] = (out := stage(table, name, *options, **more)).count()
        return out

    stage = hard_negatives.stage
    monkeypatch.setattr(hard_negatives, "stage", counted)
    monkeypatch.setattr(hard_negatives, "QUERIES", 128)
    assert mined(spark, rows, 8) == plain_negatives(rows)
    assert staged["negatives-asked"] == len(rows) and max(staged.values()) <= 6 * len(rows)


def test_negatives_equal_their_twin_and_empty_table(spark):
    assert rows_of(catalog.QUERIES["op13_hard_negatives"](spark, SMALL)) == twin_rows(catalog.TWINS["op13_hard_negatives"])
    assert mined(spark, []) == [] and mined(spark, [(100, [1.0], 1)]) == []
    # Too large for a product of 64 bits: such rows take no part.
    assert mined(spark, [(100, [3e38], 1), (101, [1.0], 1), (102, [1.0], 2)]) == []


def test_search_equals_products_of_all():
    rng = np.random.default_rng(9)
    vectors = rng.integers(-300, 300, size=(700, 8))
    vectors[:200] //= 8
    labels, ids = rng.integers(0, 4, size=700), [[i] for i in range(700)]
    most = int((vectors * vectors).sum(axis=1).max())
    import io
    tree = hard_negatives.Tree(dict(np.load(io.BytesIO(hard_negatives.packed_tree(vectors, labels, ids, np.zeros((700, 2), np.int64), most)))))
    # Every node covers its vectors within its radius, and its children's centers lie apart.
    points = hard_negatives.augmented(tree.vectors, most)
    for n in range(len(tree.center)):
        gaps = np.sqrt(((points[tree.low[n] : tree.high[n]] - points[tree.center[n]]) ** 2).sum(axis=1))
        assert gaps.max() <= tree.radius[n] + 1e-9
        kids = tree.center[tree.child[n] : tree.child[n] + tree.children[n]]
        if len(kids) > 1:
            between = np.sqrt(((points[kids][:, None] - points[kids][None]) ** 2).sum(axis=2))[~np.eye(len(kids), dtype=bool)]
            assert between.min() > tree.radius[n] / hard_negatives.SHRINK - 1e-9
    for i in range(0, 700, 50):
        scores = vectors @ vectors[i]
        for same in (True, False):
            for window in ((-(2**63), 2**63 - 1), (0, int(scores[i] * 0.5)), (10**12, 10**13)):
                want = sorted((-int(s), x) for x, s in enumerate(scores) if (labels[x] == labels[i]) == same and window[0] <= s <= window[1])[:4]
                got = tree.search(vectors[i].astype(np.float64), int(labels[i]), same, [window], 4)[0]
                assert [(s, x) for s, x, _ in got] == want
