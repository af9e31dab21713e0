"""Language identification, the n-gram model and near vectors against plain versions."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SMALL, no_docs, odd_docs, odd_rows, united
from tidewatch.llm import catalog, kneser_ney, langid, vector_join

QUICK = langid.Settings(steps=60)


def test_gradients_equal_differences():
    net = langid.Network(["a", "b", "c"], langid.Settings(window=6, hidden=3))
    for unit in (net.forth, net.back):
        unit.table, unit.weights, unit.bias = (p.astype(np.float64) for p in unit.params())
    net.out, net.out_bias = net.out.astype(np.float64), net.out_bias.astype(np.float64)
    rng = np.random.default_rng(0)
    windows, lengths, labels = rng.integers(0, 4, (5, 6)).astype(np.uint8), np.array([6, 6, 2, 4, 6]), rng.integers(0, 3, 5)

    def loss():
        p, inside = net.probabilities(windows), np.arange(6)[:, None] < lengths
        return -(np.log(p[:, labels, np.arange(5)]) * inside).sum() / lengths.sum()

    for p, slope in zip(net.params(), net.gradients(windows, lengths, labels)):
        at = tuple(int(rng.integers(0, min(n, 4))) for n in p.shape)
        kept = p[at]
        sides = []
        for step in (1e-2, -1e-2):
            p[at] = kept + step
            sides.append(loss())
        p[at] = kept
        assert (sides[0] - sides[1]) / 2e-2 == pytest.approx(slope[at], abs=2e-4)


def test_document_probabilities_are_means_over_positions():
    net = langid.Network(["a", "b"])
    texts = ["", "short", "x" * 64, "some longer text " * 30]
    got = net.documents(pa.array(texts), at_once=3)
    for text, row in zip(texts, got):
        raw = np.frombuffer(text.encode(), np.uint8)
        parts = []
        for start in range(0, len(raw), 64):
            window = np.zeros((1, 64), np.uint8)
            window[0, : len(raw[start : start + 64])] = raw[start : start + 64]
            parts.append(net.probabilities(window)[: len(raw[start : start + 64]), :, 0])
        assert row == pytest.approx(np.concatenate(parts).mean(axis=0) if parts else np.zeros(2), abs=1e-5)


def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = catalog.QUERIES["op4_language_id"](spark, SMALL).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 20 < len(held) < 80 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_of_odd_and_empty_tables(spark):
    rows = langid.identify(odd_docs(spark), settings=QUICK).collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == len(odd_rows()) and {by_id[i].lang_pred for i in (4, 5, 6, 14)} == {"und"} and by_id[10].lang_pred in ("en", "de")
    assert langid.identify(no_docs(spark)).count() == 0
    nothing = langid.identify(odd_docs(spark).where("doc_id = 4"))
    assert [(r.lang_pred, r.score) for r in nothing.collect()] == [("und", 0.0)]
    unlabelled = langid.identified(odd_docs(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r.doc_id for r in unlabelled.collect()} == {0, 1, 2, 3, 7, 8, 9, 10, 11, 12, 13, 15, None}
    kept = langid.identified(odd_docs(spark), settings=QUICK)
    assert kept.columns == odd_docs(spark).columns and {4, 5, 6, 14}.isdisjoint({r.doc_id for r in kept.collect()})


# n-gram model -----------------------------------------------------------------------


class PlainModel:
    """Interpolated modified Kneser-Ney with dictionaries."""

    def __init__(self, texts, order=kneser_ney.ORDER):
        self.order = order
        self.counts = {order: collections.Counter(g for t in texts for g in self.grams(t))}
        for size in range(order - 1, 0, -1):
            self.counts[size] = collections.Counter(g[1:] for g in self.counts[size + 1])
        self.cut, self.after = {}, {}
        for size, counts in self.counts.items():
            t = [sum(n == k for n in counts.values()) for k in range(5)]
            y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0.5
            self.cut[size] = [0.0] + [min(max(k - (k + 1) * y * t[k + 1] / t[k] if t[k] else k / 2, 0.05), k) for k in (1, 2, 3)]
            self.after[size] = collections.defaultdict(list)
            for g, n in counts.items():
                self.after[size][g[:-1]].append(n)

    def grams(self, text):
        padded = "\0" * (self.order - 1) + text.lower() + "\1"
        return [padded[i : i + self.order] for i in range(len(padded) - self.order + 1)]

    def probability(self, gram):
        size = len(gram)
        if not size:
            return 1 / (len(self.counts[1]) + 1)
        shorter, rest = self.probability(gram[1:]), self.after[size].get(gram[:-1])
        if not rest:
            return shorter
        n = self.counts[size].get(gram, 0)
        return (n - self.cut[size][min(n, 3)] + sum(self.cut[size][min(m, 3)] for m in rest) * shorter) / sum(rest)


def test_perplexity_equals_a_plain_model(spark):
    rng = random.Random(2)
    texts = {lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(120)] for lang, letters in (("en", "abcde  "), ("de", "äöab \n"))}
    docs = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    docs += [(1000, None, "en"), (1001, "", "de"), (1002, "zzz", "xx"), (1003, "abc", None), (1004, "Q" * 30, "en"), (None, "abc", "en")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, lang in docs if lang in texts and i != 1004] + [(5, 0)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in kneser_ney.quality(frame, labels).collect()}
    held = {r[0] for r in frame.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {kneser_ney.KEPT_OUT}) = 0 as h").collect() if r[1]}
    models = {lang: PlainModel([t or "" for i, t, x in docs if x == lang and i not in held and i not in (5, 1004, None) and t]) for lang in texts}
    for i, text, lang in docs:
        if text and lang in models:
            grams = models[lang].grams(text)
            want = math.exp(-sum(math.log(models[lang].probability(g)) for g in grams) / len(grams))
            assert rows[i].perplexity == pytest.approx(want, rel=1e-9), i
        else:
            assert rows[i].perplexity is None and rows[i].kept
    assert not rows[1004].kept and rows[1004].threshold > 0
    total = sum(models["en"].probability("ab" + c) for c in {g for (g,) in models["en"].counts[1]})
    assert total < 1 < total + 0.05


def test_shards_give_the_same_perplexity(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    one = {r.doc_id: r.perplexity for r in kneser_ney.quality(docs, labels).collect()}
    store = kneser_ney.store_model
    monkeypatch.setattr(kneser_ney, "store_model", lambda counts: store(counts, shard_rows=5000))
    many = {r.doc_id: r.perplexity for r in kneser_ney.quality(docs, labels).collect()}
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k], rel=1e-12) for k in one)


def test_quality_on_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(0, 1), (None, 1), (2, None), (2, 0)], "doc_id long, quality int")
    assert kneser_ney.quality(odd_docs(spark), labels).count() == len(odd_rows())
    assert all(r.kept for r in kneser_ney.quality(odd_docs(spark), labels.limit(0)).collect())
    assert kneser_ney.quality(no_docs(spark), labels).count() == 0


def test_clean_documents_are_kept_and_junk_goes(spark):
    sf_dir = SMALL.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in catalog.QUERIES["op7_kneser_ney_quality"](spark, sf_dir).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean, junk = ([rows[i].kept for i, q in labels.items() if q == k] for k in (1, 0))
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.5 * len(junk)


# Near vectors -------------------------------------------------------------------------


def plain_links(rows):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    scaled = [(i, v / np.abs(v).max()) for i, v in good]
    unit = [(i, v / np.linalg.norm(v)) for i, v in scaled]
    links = [(a, b) for k, (a, v) in enumerate(unit) for b, w in unit[:k] if len(v) == len(w) and v @ w >= 0.9]
    n = collections.Counter(x for link in links for x in link)
    return {i: (n[i], g) for i, g in united([i for i, _ in rows if i is not None], links).items()}


def test_near_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    rows = [(i, (centers[rng.integers(12)] + rng.normal(size=8) * 0.35).tolist()) for i in range(500)]
    rows += [(500 + i, rows[7][1]) for i in range(40)] + [(600, None), (601, []), (602, [0.0] * 8), (603, [float("nan")] * 8), (604, [None] + [1.0] * 7), (605, [float("inf")] + [1.0] * 7)]
    rows += [(606, [1e200] * 8), (607, [1e-200] * 8), (608, [1.0, 0.0]), (609, [1.0, 0.1]), (None, [1.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_join.near_vectors(frame).collect() if r.vec_id is not None}
    assert got == plain_links(rows)


def test_small_blocks_and_many_cells_lose_nothing(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(20, 6))
    rows = [(i, (centers[rng.integers(20)] + rng.normal(size=6) * 0.3).tolist()) for i in range(400)]
    classes = spark.createDataFrame([(i, 1, v) for i, v in rows], "node long, copies long, vector array<double>")
    found = vector_join.range_join(classes, block=16).groupBy("node").sum("links").collect()
    want = {i: n for i, (n, _) in plain_links(rows).items() if n}
    assert {r[0]: r[1] for r in found} == want


def test_vectors_are_kept_once_however_many_cells_they_visit(spark, monkeypatch):
    """In many directions, without clusters, nothing is ruled out: the staged rows must not grow with the cells."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(600)]
    rows += [(600 + i, (np.array(rows[i][1]) * (1 + 0.02 * rng.normal(size=24))).tolist()) for i in range(0, 600, 40)]
    staged = {}

    def counted(write):
        def run(part, name, *options, **more):
            out = write(part, name, *options, **more)
            staged[name] = staged.get(name, 0) + out.count()
            return out
        return run

    monkeypatch.setattr(vector_join, "stage", counted(vector_join.stage))
    monkeypatch.setattr(vector_join, "SLICE_BLOCKS", 3, raising=False)
    shuffled = []
    explode = vector_join.F.explode
    monkeypatch.setattr(vector_join.F, "explode", lambda column: shuffled.append(column) or explode(column))
    classes = spark.createDataFrame([(i, 1, v) for i, v in rows], "node long, copies long, vector array<double>")
    found = vector_join.range_join(classes, block=16).groupBy("node").sum("links").collect()
    assert {r[0]: r[1] for r in found} == {i: n for i, (n, _) in plain_links(rows).items() if n}
    assert staged == {"vectors": len(rows)} and not shuffled


def test_near_vectors_of_an_empty_table(spark):
    assert vector_join.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, n_links int")).count() == 0
