"""Token ids in patched frame-of-reference blocks.

Documents are ordered by ``doc_id`` (null first, then by text), cut into shards by range, and
encoded; every document ends with the end id. A shard's ids are packed in segments of whole
documents. A segment holds blocks of 512 ids: the block's smallest id is subtracted, the rest is
packed at the width that a given share of the block's ids needs, and the upper bits of the few
wider ids go to an exception list of positions and values. The width of each block gives its
start, so a block is read without the ones before it; the folder ``index`` says which global
ids a shard and its segments hold.

Files are Parquet rows written by Spark: ``blocks`` (one row per segment) and ``index``. A
retried task rewrites its own rows only.

Defined cases: a null or empty text is the end id alone; repeated rows are stored as often as
they come; a text of any length is one segment; an empty table gives empty files.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches
from tidewatch.llm.textarrays import gathered, pieces
from tidewatch.session import stage_path

END_ID = 1
BLOCK = 512
#: The share of a block's ids that must fit its width; the others are exceptions.
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 16
SHARD_DOCS = 8192
#: Distinct words whose ids a worker remembers; when there are more it keeps those that came again.
MEMORY_WORDS = 400_000
#: Texts are encoded about so many bytes at a time: the more, the fewer words come twice.
WORK_BYTES = 3 << 20

SEGMENTS = (
    "shard long, segment long, first_id long, n_ids long, doc_id array<long>, doc_ids_end array<long>, "
    "base binary, width binary, packed binary, exception_count binary, exception_at binary, exception_bits binary"
)
DOCUMENTS = "doc_id long, shard long, in_shard long, n_tokens long, ids_crc32 long"


def letters_apart(tokenizer) -> str:
    """The inside of a class of letters after which closing marks are pieces of their own, whatever came before.

    Normalising may end a letter in a combining mark, as the dotted capital I, and that joins
    the closing mark. So the tokenizer itself says for each letter below U+3000 what it does.
    """
    letters = [c for c in map(chr, range(0x3000)) if unicodedata.category(c).startswith("L")]
    words = tokenizer.normalizer.normalize_str(" ".join(f"{c}," for c in letters)).split(" ")
    pieces = [[p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(word)] for word in words]
    apart = [ord(c) for c, some in zip(letters, pieces, strict=True) if len(some) > 1 and some[-1] == ","]
    runs = [[c, c] for c in apart[:1]]
    for c in apart[1:]:
        if c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in runs)


def is_plain(word: str) -> bool:
    """Whether composing and lower-casing would leave the word as it is."""
    return word.islower() and (word.isascii() or (word.lower() == word and unicodedata.is_normalized("NFC", word)))


class Encoder:
    """Encodes whole texts with a tokenizer that never joins ids across white space.

    Ids of a text are the ids of its words one after the other, so each distinct word goes to
    the tokenizer once and is remembered. Words of letters alone go there joined by blanks:
    each gives ids up to the first that ends a word. Where that doesn't give as many words as
    went in, they are encoded one by one.
    """

    def __init__(self, path: str):
        # Spark's tasks share the cores already; threads of the library's own only take memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Composed lower-case words of letters are what normalising would leave, so they go to the model as they are.
        self.plain = Tokenizer(self.tokenizer.model)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
        probe = "abcdefghijklmnopqrstuvwxyz the quick brown foxes àéîõüßñ žluťoučký"
        if self.plain.encode(probe).ids != self.tokenizer.encode(probe, add_special_tokens=False).ids:
            self.plain = self.tokenizer
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.closing = rf"([{letters_apart(self.tokenizer)}])([.,;:!?]+)(\s|$)"
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.filled = np.empty(1 << 20, np.uint32), 0
        self.starts, self.sizes, self.again = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def keep_used(self) -> None:
        """Forget words that came in one batch only."""
        kept = np.flatnonzero(self.again)
        if len(kept) > MEMORY_WORDS // 2:
            return self.forget()
        place = np.full(len(self.again), -1)
        place[kept] = np.arange(len(kept))
        self.known = {w: int(i) for w, n in self.known.items() if (i := place[n]) >= 0}
        starts, sizes = self.starts[kept], self.sizes[kept]
        ids = self.ids[run_positions(starts, sizes)]
        self.ids, self.filled = np.concatenate((ids, np.empty(1 << 20, np.uint32))), len(ids)
        self.starts, self.sizes, self.again = np.cumsum(sizes) - sizes, sizes, np.zeros(len(kept), bool)

    def encode_words(self, words: list[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
        encoded = (self.plain if plain else self.tokenizer).encode_batch_fast(words, add_special_tokens=False)
        lists = [e.ids for e in encoded]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def encode_letters(self, words: list[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_words`` for words of letters, many in one call."""
        joined = [" ".join(words[i : i + 256]) for i in range(0, len(words), 256)]
        ids, _ = self.encode_words(joined, plain)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):
            return self.encode_words(words)
        return ids, np.diff(ends, prepend=0)

    def learn(self, words: np.ndarray) -> np.ndarray:
        """Encode new words; the place of each."""
        letters, places = np.fromiter(map(str.isalpha, words), bool, len(words)), np.empty(len(words), np.int64)
        simple = letters & np.fromiter(map(is_plain, words), bool, len(words))
        kinds = ((simple, partial(self.encode_letters, plain=True)), (letters & ~simple, self.encode_letters), (~letters, self.encode_words))
        for kind, encode in kinds:
            for some in np.split(rows := np.flatnonzero(kind), range(20_000, len(rows), 20_000)):
                if len(some):
                    ids, sizes = encode(words[some].tolist())
                    need = self.filled + len(ids)
                    if need > len(self.ids):
                        self.ids = np.concatenate((self.ids[: self.filled], np.empty(2 * need - self.filled, np.uint32)))
                    self.ids[self.filled : need] = ids
                    places[some] = np.arange(len(self.sizes), len(self.sizes) + len(some))
                    self.starts = np.concatenate((self.starts, self.filled + np.cumsum(sizes) - sizes))
                    self.sizes = np.concatenate((self.sizes, sizes))
                    self.again = np.concatenate((self.again, np.zeros(len(some), bool)))
                    self.filled = need
        self.known.update(zip(words.tolist(), places.tolist()))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        texts = pc.fill_null(texts, "")
        # The vocabulary has lower case only, and closing marks after most letters are pieces of
        # their own; both only make fewer distinct words. Special tokens are case-sensitive.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, self.closing, r"\1 \2\3"))
        coded = pc.list_flatten(lists).dictionary_encode()
        words = np.array(coded.dictionary.to_pylist(), object)
        if len(self.known) > MEMORY_WORDS:
            self.keep_used()
        get = self.known.get
        which = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = which < 0
        self.again[which[~new]] = True
        if new.any():
            which[new] = self.learn(words[new])
        uses = which[coded.indices.to_numpy(zero_copy_only=False)]
        size = self.sizes[uses]
        return self.ids[run_positions(self.starts[uses], size)], segment_sums(size, pc.list_value_length(lists).to_numpy(zero_copy_only=False))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker, so that it keeps the words it knows."""
    return Encoder(path)


def run_positions(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[0], start[0] + 1, ...`` for ``size[0]`` steps, then the next run."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(values)))
    ends = np.cumsum(sizes.astype(np.int64))
    return sums[ends] - sums[ends - sizes]


def bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def pack_words(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK numbers below ``2 ** width`` to rows of ``BLOCK * width / 32`` 32-bit words."""
    groups = rows.reshape(len(rows), -1, 32)
    out = np.zeros((len(rows), groups.shape[1], width), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[:, :, word] |= groups[:, :, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, :, word + 1] |= groups[:, :, i] >> np.uint32(32 - shift)
    return out.reshape(len(rows), -1)


def unpack_words(words: np.ndarray, width: int) -> np.ndarray:
    groups = words.reshape(len(words), -1, width)
    out = np.zeros((len(words), groups.shape[1], 32), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[:, :, i] = groups[:, :, word] >> np.uint32(shift)
        if shift + width > 32:
            out[:, :, i] |= groups[:, :, word + 1] << np.uint32(32 - shift)
    return out.reshape(len(words), BLOCK) & np.uint32((1 << width) - 1)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> dict[str, bytes]:
    """Ids to blocks; the last one is filled up with its own last id."""
    blocks = -(-len(ids) // BLOCK)
    rows = np.concatenate((ids, np.full(blocks * BLOCK - len(ids), ids[-1] if len(ids) else 0, np.uint32))).reshape(blocks, BLOCK)
    base = rows.min(axis=1) if blocks else np.empty(0, np.uint32)
    rest = rows - base[:, None]
    need = bit_length(rest)
    width = np.sort(need, axis=1)[:, int(percentile * (BLOCK - 1))] if blocks else np.empty(0, np.uint8)
    at = np.flatnonzero((need > width[:, None]).ravel())
    wide = np.repeat(width, BLOCK).astype(np.uint32)[at]
    upper = rest.ravel()[at] >> wide
    starts = block_starts(width)
    packed = np.empty(starts[-1], np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        some = np.flatnonzero(width == w)
        low = rest[some] & np.uint32((1 << w) - 1 if w < 32 else 0xFFFFFFFF)
        packed[starts[some][:, None] + np.arange(BLOCK // 32 * w)] = pack_words(low, w)
    return {
        "base": base.astype("<u4").tobytes(), "width": width.tobytes(), "packed": packed.astype("<u4").tobytes(),
        "exception_count": np.bincount(at // BLOCK, minlength=blocks).astype("<u2").tobytes(),
        "exception_at": (at % BLOCK).astype("<u2").tobytes(), "exception_bits": upper.astype("<u4").tobytes(),
    }


def block_starts(width: np.ndarray) -> np.ndarray:
    """The index of block starts, in 32-bit words; one more for the end."""
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(width.astype(np.int64) * (BLOCK // 32))))


def unpack(row: dict, first: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids ``first`` to ``stop`` of a segment; only the blocks that hold them are unpacked."""
    n = row["n_ids"]
    stop = n if stop is None else min(stop, n)
    if stop <= first:
        return np.empty(0, np.uint32)
    width, base = np.frombuffer(row["width"], np.uint8), np.frombuffer(row["base"], "<u4")
    starts, packed = block_starts(width), np.frombuffer(row["packed"], "<u4")
    low, high = first // BLOCK, -(-stop // BLOCK)
    out = np.zeros((high - low, BLOCK), np.uint32)
    for w in np.unique(width[low:high]).tolist():
        if w:
            some = low + np.flatnonzero(width[low:high] == w)
            out[some - low] = unpack_words(packed[starts[some][:, None] + np.arange(BLOCK // 32 * w)], w)
    counts = np.frombuffer(row["exception_count"], "<u2").astype(np.int64)
    ends = np.cumsum(counts)
    mine = slice(ends[low] - counts[low], ends[high - 1])
    block = np.repeat(np.arange(low, high), counts[low:high])
    at = np.frombuffer(row["exception_at"], "<u2")[mine]
    out[block - low, at] |= np.frombuffer(row["exception_bits"], "<u4")[mine] << width[block].astype(np.uint32)
    out += base[low:high, None]
    return out.ravel()[first - low * BLOCK : stop - low * BLOCK]


def segment_batches(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """A shard's documents, in order, to its segments."""
    known, shard = encoder(tokenizer), TaskContext.get().partitionId()
    number, first = 0, 0
    docs: list[int | None] = []
    sizes: list[int] = []
    held: list[np.ndarray] = []

    def segment() -> pa.RecordBatch:
        ids, ends = np.concatenate(held), np.cumsum(sizes)
        row = {"shard": shard, "segment": number, "first_id": first, "n_ids": len(ids), "doc_id": list(docs), "doc_ids_end": ends.tolist()}
        types = {"doc_id": pa.list_(pa.int64()), "doc_ids_end": pa.list_(pa.int64())}
        row |= pack(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], types.get(k, pa.binary() if isinstance(v, bytes) else pa.int64())) for k, v in row.items()], names=list(row)
        )

    for batch in gathered(batches, "text", WORK_BYTES):
        for piece in pieces(batch, "text", WORK_BYTES):
            ids, counts = known.encode(piece.column("text"))
            bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
            for i, doc in enumerate(piece.column("doc_id").to_pylist()):
                docs.append(doc)
                sizes.append(int(counts[i]) + 1)
                held += [ids[bounds[i] : bounds[i + 1]], np.array([end_id], np.uint32)]
                if sum(sizes) >= SEGMENT_IDS:
                    yield segment()
                    number, first = number + 1, first + sum(sizes)
                    docs, sizes, held = [], [], []
    if docs:
        yield segment()
    # The worker stays for other tasks; what it no longer needs goes back to the system.
    pa.default_memory_pool().release_unused()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_docs: int = SHARD_DOCS) -> str:
    """Encode ``docs(doc_id, text)`` into the folder ``path``.

    The texts are shuffled once, by ranges of ``doc_id``; encoding follows the shuffle, so the
    sampling of range bounds reads no text and encodes nothing.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    shards = max(1, -(-docs.count() // shard_docs))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda it: segment_batches(it, tokenizer, end_id), SEGMENTS).write.option("compression", "none").parquet(f"{path}/blocks")
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/blocks").select("shard", "segment", "first_id", "n_ids")
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # One row per shard, that is one for some thousand documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"), "n_ids").write.parquet(f"{path}/index")
    return path


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard long, start long, n_ids long").parquet(f"{path}/index")


def document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DOCUMENTS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            data = unpack(row).astype("<u4").tobytes()
            ends = np.asarray(row["doc_ids_end"], np.int64)
            starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends)]
            columns = [row["doc_id"], [row["shard"]] * len(ends), starts + row["first_id"], ends - starts, sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, from its unpacked ids."""
    small_batches(spark, 16)
    decoded = spark.read.schema(SEGMENTS).parquet(f"{path}/blocks").mapInArrow(document_batches, DOCUMENTS)
    placed = decoded.join(shard_starts(spark, path).select("shard", F.col("start").alias("shard_start")), "shard")
    return placed.select("doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")


def range_batches(batches: Iterator[pa.RecordBatch], first: int, stop: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            at = row["start"] + row["first_id"]
            ids = unpack(row, max(0, first - at), stop - at).astype(np.int64)
            begin = max(first, at)
            yield pa.RecordBatch.from_arrays([pa.array([begin]), pa.array([ids.tolist()], pa.list_(pa.int64()))], names=["start", "ids"])


def read_range(spark: SparkSession, path: str, first: int, stop: int) -> DataFrame:
    """``start, ids`` of the global ids ``first`` to ``stop``, one row per segment: other segments and blocks are skipped."""
    small_batches(spark, 16)
    shards = shard_starts(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > first)).select("shard", "start")
    rows = spark.read.schema(SEGMENTS).parquet(f"{path}/blocks").join(shards, "shard").drop("doc_id", "doc_ids_end")
    at = F.col("start") + F.col("first_id")
    return rows.where((at < stop) & (at + F.col("n_ids") > first)).mapInArrow(lambda it: range_batches(it, first, stop), "start long, ids array<long>")


def tokens_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files to the shared folder and read every document back from them."""
    spark = docs.sparkSession
    return read_documents(spark, write_tokens(docs, stage_path(spark, "tokens"), tokenizer, end_id))
