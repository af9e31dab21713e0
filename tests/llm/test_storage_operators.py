"""Token files, WARC archives, the source mix and the pipeline against plain versions."""

import collections
import gzip
import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import SMALL, no_docs, odd_docs, odd_rows, words
from tidewatch.llm import catalog, mixing, token_blocks, warc
from tidewatch.session import stage_path

# Token files ---------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.integers(0, 1500), st.integers(0, 1500))
def test_packed_ids_come_back(ids, a, b):
    ids = np.array(ids, np.uint32)
    row = token_blocks.pack(ids) | {"n_ids": len(ids)}
    first, stop = sorted((a, b))
    assert (token_blocks.unpack(row) == ids).all() and (token_blocks.unpack(row, first, stop) == ids[first:stop]).all()


def test_outliers_go_to_exceptions():
    ids = np.tile(np.arange(100, 116, dtype=np.uint32), 32)
    ids[[3, 77]] = 40_000
    row = token_blocks.pack(ids)
    assert row["width"] == b"\x04" and np.frombuffer(row["exception_at"], "<u2").tolist() == [3, 77] and len(row["packed"]) == 256


def plain_tokens(rows):
    tokenizer = Tokenizer.from_file(catalog.tokenizer_file())
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


@pytest.mark.parametrize("shard_docs", [6, 1000])
def test_token_files_of_odd_documents(spark, shard_docs):
    extra = [(40, "<|endoftext|> A.b, it's O'Neil's 3.14!? İΣΑΣ é x y z fin."), (41, "Word, word; WORD: (word) [word].\r\n\tWord..."), (42, "<|ENDOFTEXT|>")]
    docs = odd_docs(spark).select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    path = token_blocks.write_tokens(docs, stage_path(spark, "test-tokens"), catalog.tokenizer_file(), shard_docs=shard_docs)
    want, total = plain_tokens([(r[0], r[1]) for r in odd_rows()] + extra)
    got = sorted((tuple(r) for r in token_blocks.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    middle = token_blocks.read_range(spark, path, total // 3, total // 2).orderBy("start").collect()
    assert middle[0]["start"] == total // 3 and sum(len(r["ids"]) for r in middle) == total // 2 - total // 3


def wrong_ids(texts):
    """The texts whose ids are not the tokenizer's."""
    path = catalog.tokenizer_file()
    ids, sizes = token_blocks.Encoder(path).encode(pa.array(texts))
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    ends = np.cumsum(sizes)
    return [t for t, w, n, end in zip(texts, want, sizes, ends) if w.ids != ids[end - n : end].tolist()]


def test_every_letter_before_every_mark():
    letters = [c for c in map(chr, range(0x21, 0x20000)) if unicodedata.category(c)[0] in "LM"]
    closed = [" ".join([f"{c}{m} ab{c}{m}" for m in ".,;:!?"]) for c in letters]
    inside = [f"{c}b, a{c}b a{c}{c}!?. É{c}.,; {c}" for c in letters]
    assert len(letters) > 30_000 and wrong_ids([f"{a} {b}" for a, b in zip(closed, inside)]) == []


def test_random_texts_with_letters_that_decompose():
    rng = random.Random(1)
    odd = [*"İıΣςßǅẞﬁǄ", "\u0958", "\u09df", "\u05d9\u05b4", "\ufb1d", "\ufb2a", "e\u0301", "\u0345", "'s", "'RE", "<|endoftext|>"]
    assert wrong_ids(["".join(rng.choice([*odd, *"abcXYZ .,;:!?'0 -\n"]) for _ in range(rng.randrange(60))) for _ in range(6000)]) == []


def test_token_query_and_empty_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in catalog.QUERIES["op2_token_blocks"](spark, SMALL).collect()), key=lambda r: r[1])
    assert got == plain_tokens(docs)[0]
    assert token_blocks.tokens_round_trip(no_docs(spark), catalog.tokenizer_file()).count() == 0


# WARC ------------------------------------------------------------------------------------


def test_archive_files_and_ranges(spark):
    big, small = "<p>" + "ü" * 200_000, "tiny"
    rows = [(1, "http://a/1", big), (2, None, None), (3, "http://a/3", ""), (4, "x\r\ny", small), (5, "http://a/5", small), (7, "u", big), (6, "v", big), (6, "v", big), (None, "w", big)]
    pages = spark.createDataFrame(rows, "record_id long, url string, payload string")
    path = warc.write_archive(pages, stage_path(spark, "test-warc"))
    index = warc.archive_index(spark, path).collect()
    assert len(index) == len(rows)
    for name in {r.file for r in index}:
        raw = open(name.removeprefix("file:"), "rb").read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == sum(r.file == name for r in index)
    found = warc.read_records(warc.archive_index(spark, path)).collect()
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r.record_id].append(r)
    assert [r.record_type for r in by_id[6]] == ["revisit", "revisit"] and by_id[7][0].refers_to == 1 and by_id[1][0].payload.decode() == big
    assert by_id[4][0].record_type == by_id[5][0].record_type == "response" and by_id[2][0].payload_bytes == by_id[3][0].payload_bytes == 0
    assert by_id[None][0].record_type == "response"
    assert all(r.payload_digest == hashlib.sha256(big.encode()).hexdigest() and r.payload_bytes == len(big.encode()) for i in (1, 6, 7, None) for r in by_id[i])
    some = warc.read_records(warc.archive_index(spark, path).where("record_id IN (3, 7)"))
    assert sorted(r.record_id for r in some.collect()) == [3, 7]
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_reading_tasks_follow_the_bytes(spark, monkeypatch):
    whole = warc.joined_ranges
    monkeypatch.setattr(warc, "joined_ranges", lambda selected: whole(selected, most=1 << 15))
    monkeypatch.setattr(warc, "TASK_BYTES", 1 << 16)
    rng = random.Random(6)
    rows = [(i, f"http://a/{i}", "".join(chr(rng.randrange(33, 120)) for _ in range(20_000))) for i in range(60)]
    pages = spark.createDataFrame(rows, "record_id long, url string, payload string")
    selected = warc.archive_index(spark, warc.write_archive(pages, stage_path(spark, "test-warc")))
    ranges = warc.joined_ranges(selected.select("file", "offset", "length"))
    found = warc.read_records(selected)
    assert ranges.count() >= 20 and found.rdd.getNumPartitions() >= 10
    assert sorted((r.record_id, bytes(r.payload).decode()) for r in found.collect()) == [(i, p) for i, _, p in rows]
    assert warc.place("file:///tmp/x")[1] == "/tmp/x" and warc.place("dbfs:/some/x")[1] == "/dbfs/some/x"


def test_near_ranges_are_read_together(spark):
    rows = [("f", 0, 10), ("f", 10, 10), ("f", 25, 5), ("f", 5000, 10), ("g", 5, 5)]
    ranges = warc.joined_ranges(spark.createDataFrame(rows, "file string, offset long, length long"), gap=100).collect()
    assert sorted((r.file, r.start, r.stop, len(r.records)) for r in ranges) == [("f", 0, 30, 3), ("f", 5000, 5010, 1), ("g", 5, 10, 1)]


# Mixing ------------------------------------------------------------------------------------


def plain_targets(sizes):
    """By passing on the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if share * weight[s] > 2 * sizes[s]}
        if not stopped:
            target |= {s: share * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in stopped}
        left -= sum(2 * sizes[s] for s in stopped)
        open_ -= stopped
    return target


def check_mix(rows, docs, near):
    source = {i: s for i, _, s in docs}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = plain_targets(sizes)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-6)
    assert all(abs(taken[s] - want[s]) <= near for s in want)


def test_mix_meets_its_targets(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    once, again = (catalog.QUERIES["op8_source_mix"](spark, SMALL).orderBy("doc_id").collect() for _ in range(2))
    assert once == again and {r.doc_id: r.size for r in once} == {i: len(words(t)) for i, t, _ in docs}
    check_mix(once, docs, near=3 * mixing.BLOCK_WORDS)


@pytest.mark.parametrize("missing", [-3, 4])
def test_quotas_are_the_highest_quotients(spark, missing):
    """Many small sources, so that rounding alone gives too many or too few blocks."""
    sizes = [640 + (70 if missing > 0 else 58) * (i % 2) + i for i in range(23)]
    targets = spark.createDataFrame([(f"{i:02}", n, 1.5 * n) for i, n in enumerate(sizes)], "key string, total long, target double")
    got = {r.key: r.quota for r in mixing.block_quotas(targets, 128).collect()}
    blocks = {f"{i:02}": -(-n // 128) for i, n in enumerate(sizes)}
    seats = sorted(((1.5 * blocks[k] / (2 * q + 1), k) for k in blocks for q in range(2 * blocks[k])), key=lambda s: (-s[0], s[1]))
    want = collections.Counter(k for _, k in seats[: int(sum(1.5 * b for b in blocks.values()) + 0.5)])
    assert got == dict(want)


def test_mix_of_odd_and_empty_tables(spark):
    rows = mixing.mix_sizes(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows()) and all(r.taken <= 2 * r.size for r in rows)
    assert mixing.mix_sizes(no_docs(spark)).count() == 0
    mixed = mixing.mix_documents(odd_docs(spark))
    assert mixed.columns == odd_docs(spark).columns
    got = collections.Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
    want = collections.Counter()
    for r in rows:
        want[r.doc_id] += r.taken
    assert +got == +want
    assert mixing.mix_documents(no_docs(spark)).count() == 0


# Pipeline ------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["identify_languages", "drop_near_duplicates", "drop_benchmark_copies", "mix_sources", "write_token_files"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    kept, texts = [docs], []
    for name, stage in corpus_pipeline.STAGES:
        path = stage_path(spark, f"test-{name}")
        stage(spark, kept[-1], SMALL).write.parquet(path)
        kept.append(spark.read.parquet(path))
        if name != "write_token_files":
            assert kept[-1].columns == docs.columns
            texts.append([(r.doc_id, r.text) for r in kept[-1].collect()])
    assert all(given[i] == t for rows in texts[:3] for i, t in rows) and len(texts[0]) >= len(texts[1]) >= len(texts[2]) > 150
    taken = {r.doc_id: r.taken for r in mixing.mix_sizes(kept[3]).collect()}
    got = collections.Counter()
    for i, t in texts[3]:
        got[i] += len(words(t))
    assert +got == collections.Counter({i: n for i, n in taken.items() if n})
    final = sorted((tuple(r) for r in kept[5].collect()), key=lambda r: r[1])
    assert final == plain_tokens(texts[3])[0]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(final)


def test_pipeline_of_an_empty_table(spark):
    docs = no_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
