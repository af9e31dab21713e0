"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of bytes. One gated recurrent unit reads each window forwards, one
backwards; from both states the network gives every position a probability per language, and a
document's probabilities are the mean over all its positions. The network is trained here with
numpy by backpropagation through time, on windows of a bounded sample of labelled rows
(``Settings.docs_per_language`` and ``windows_per_doc``); whole texts are predicted, in the
tasks that read them, without a shuffle.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; so is every text
if no labelled row can be learned from. A null ``doc_id`` is predicted but never learned from.
Texts of any length are worked on a few thousand windows at a time. Equal rows get equal
predictions, and extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import named, small_batches
from tidewatch.llm.textarrays import pieces, text_bytes

UNKNOWN = "und"
HELD_OUT = (4, 2)
#: Below this mean probability a text has no language that was learned.
LEAST_SCORE = 0.3


@dataclass(frozen=True)
class Settings:
    window: int = 64
    hidden: int = 8
    #: Bound of the sample: about so many labelled documents a language, and windows of each.
    docs_per_language: int = 1500
    windows_per_doc: int = 4
    steps: int = 350
    batch: int = 256
    rate: float = 0.02
    seed: int = 11


def sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Gru:
    """One direction; columns are windows, so that every step is one product of matrices."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.table = (rng.normal(size=(3 * hidden, 256)) * 0.3).astype(np.float32)
        self.table[:hidden] += 1  # Keep the state at first.
        self.weights = (rng.normal(size=(3 * hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.bias = np.zeros((hidden, 1), np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.table, self.weights, self.bias]

    def states(self, steps: list[np.ndarray], keep: list | None = None) -> Iterator[np.ndarray]:
        h, state = self.hidden, np.zeros((self.hidden, len(steps[0])), np.float32)
        for x in steps:
            given = self.table[:, x]
            own = self.weights @ state
            given[: 2 * h] += own[: 2 * h]
            gates = sigmoid(given[: 2 * h])
            recalled = own[2 * h :]
            recalled += self.bias
            new = np.multiply(gates[h:], recalled)
            new += given[2 * h :]
            np.tanh(new, out=new)
            before, state = state, state - new
            state *= gates[:h]
            state += new
            if keep is not None:
                keep.append((x, before, gates, recalled, new))
            yield state

    def gradients(self, keep: list, upstream: list[np.ndarray]) -> list[np.ndarray]:
        """Backpropagation through time; ``upstream[t]`` is the loss's slope at state ``t``."""
        h = self.hidden
        d_weights, d_bias = np.zeros_like(self.weights), np.zeros_like(self.bias)
        carried, inputs, slopes = np.zeros_like(upstream[0]), [], []
        for (x, before, gates, recalled, new), above in zip(reversed(keep), reversed(upstream)):
            d_state = above + carried
            z, r = gates[:h], gates[h:]
            d_new = d_state * (1 - z) * (1 - new * new)
            d_gates = np.concatenate((d_state * (before - new), d_new * recalled)) * gates * (1 - gates)
            d_recalled = d_new * r
            d_own = np.concatenate((d_gates, d_recalled))
            d_weights += d_own @ before.T
            d_bias += d_recalled.sum(axis=1, keepdims=True)
            carried = d_state * z + self.weights.T @ d_own
            inputs.append(x)
            slopes.append(np.concatenate((d_gates, d_new)))
        flat, all_slopes = np.concatenate(inputs), np.concatenate(slopes, axis=1)
        d_table = np.stack([np.bincount(flat, row, 256) for row in all_slopes]).astype(np.float32)
        return [d_table, d_weights, d_bias]


class Network:
    """Both directions and the layer that labels each position."""

    def __init__(self, languages: list[str], settings: Settings = Settings()):
        rng = np.random.default_rng(settings.seed)
        self.languages, self.settings = languages, settings
        self.forth, self.back = Gru(rng, settings.hidden), Gru(rng, settings.hidden)
        self.out = (rng.normal(size=(len(languages), 2 * settings.hidden)) * 0.3).astype(np.float32)
        self.out_bias = np.zeros((len(languages), 1), np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.forth.params(), *self.back.params(), self.out, self.out_bias]

    def probabilities(self, windows: np.ndarray, keep: tuple | None = None) -> np.ndarray:
        """``windows`` (n x window bytes) to probabilities (window x languages x n)."""
        h, steps = self.settings.hidden, list(np.ascontiguousarray(windows.T).astype(np.intp))
        scores = np.empty((len(steps), len(self.languages), len(windows)), np.float32)
        for t, state in enumerate(self.forth.states(steps, keep and keep[0])):
            np.matmul(self.out[:, :h], state, out=scores[t])
            if keep:
                keep[2].append(state)
        for t, state in enumerate(self.back.states(steps[::-1], keep and keep[1])):
            scores[len(steps) - 1 - t] += self.out[:, h:] @ state
            if keep:
                keep[3].append(state)
        scores += self.out_bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Slopes of the mean cross entropy over all positions inside the texts."""
        h, keep = self.settings.hidden, ([], [], [], [])
        slope = self.probabilities(windows, keep)
        slope[:, labels, np.arange(len(labels))] -= 1
        slope *= (np.arange(len(slope))[:, None] < lengths)[:, None, :]
        slope /= lengths.sum()
        both = [np.concatenate((f, b)) for f, b in zip(keep[2], reversed(keep[3]))]
        d_out = sum(s @ state.T for s, state in zip(slope, both))
        forth = self.forth.gradients(keep[0], [self.out[:, :h].T @ s for s in slope])
        back = self.back.gradients(keep[1], [self.out[:, h:].T @ s for s in slope[::-1]])
        return [*forth, *back, d_out, slope.sum(axis=(0, 2))[:, None]]

    def train(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> Network:
        """Adam over random batches; the rate falls to nothing."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        first, second = ([np.zeros_like(p) for p in self.params()] for _ in range(2))
        for step in range(1, s.steps + 1):
            some = rng.integers(0, len(labels), s.batch)
            rate = s.rate * min(1.0, step / 20) * (1 - step / (s.steps + 1))
            for p, g, m, v in zip(self.params(), self.gradients(windows[some], lengths[some], labels[some]), first, second):
                np.clip(g, -0.5, 0.5, out=g)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self

    def documents(self, texts: pa.Array, at_once: int = 2048) -> np.ndarray:
        """Mean probabilities (texts x languages) over all bytes of each text; zeros for an empty one."""
        raw, at = text_bytes(texts)
        total, width = np.zeros((len(at) - 1, len(self.languages))), self.settings.window
        counts = -(-np.diff(at) // width)
        first = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        for low in range(0, int(first[-1]), at_once):
            number = np.arange(low, min(low + at_once, int(first[-1])))
            doc = np.searchsorted(first, number, "right") - 1
            start = at[doc] + (number - first[doc]) * width
            lengths = np.minimum(at[doc + 1] - start, width)
            inside = np.arange(width) < lengths[:, None]
            windows = np.where(inside, raw[np.minimum(start[:, None] + np.arange(width), len(raw) - 1)], 0)
            found = np.einsum("tln,nt->nl", self.probabilities(windows), inside.astype(np.float32))
            np.add.at(total, doc, found)
        return total / np.maximum(np.diff(at), 1)[:, None]


def held_out(doc_id: Column) -> Column:
    modulus, remainder = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def window_batches(batches: Iterator[pa.RecordBatch], width: int, most: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Windows at random places of each sampled text."""
    for batch in batches:
        out: list[tuple[str, bytes]] = []
        for doc, text, lang in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang"))):
            raw = text.encode()
            rng = np.random.default_rng([seed, abs(doc), len(raw)])
            for start in rng.integers(0, max(1, len(raw) - width // 2), most if len(raw) > width else 1).tolist():
                out.append((lang, raw[start : start + width]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], names=["lang", "bytes"])


def learn(docs: DataFrame, settings: Settings = Settings()) -> Network | None:
    """Train on labelled rows of ``docs(doc_id, text, lang)`` that are not held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, settings.docs_per_language / n))])
    lot = F.pmod(F.xxhash64(F.lit(settings.seed), F.col("doc_id")), F.lit(1 << 30)) / (1 << 30)
    sample = usable.where(lot < share[F.col("lang")]).select(F.col("doc_id").cast("long"), "text", "lang")
    windows = sample.mapInArrow(
        lambda it: window_batches(it, settings.window, settings.windows_per_doc, settings.seed), "lang string, bytes binary"
    )
    # Twice the expected number can't be reached by chance; the order makes reruns agree.
    most = 2 * settings.docs_per_language * settings.windows_per_doc * len(counts)
    rows = sorted((r[0], bytes(r[1])) for r in windows.limit(most).collect())
    languages = sorted(counts)
    data = np.zeros((len(rows), settings.window), np.uint8)
    for i, (_, raw) in enumerate(rows):
        data[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    labels = np.array([languages.index(lang) for lang, _ in rows])
    # Every language is drawn equally often, however many rows it has.
    each = max(np.bincount(labels))
    order = np.concatenate([np.resize(np.flatnonzero(labels == k), each) for k in range(len(languages))])
    lengths = np.array([len(raw) for _, raw in rows])
    return Network(languages, settings).train(data[order], lengths[order], labels[order])


def predict_batches(batches: Iterator[pa.RecordBatch], network: Network | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    """All columns of the batches and two more, named ``names``: the language and its probability."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            texts = piece.column("text")
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if network is not None and letters.any():
                found = network.documents(texts.filter(pa.array(letters)))
                langs[letters] = np.array(network.languages, object)[found.argmax(axis=1)]
                scores[letters] = np.clip(found.max(axis=1), 0, 1)
            columns = [*piece.columns, pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*piece.schema.names, *names])


def with_language(docs: DataFrame, names: list[str], network: Network | None) -> DataFrame:
    """``docs`` with two more columns."""
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(lambda it: predict_batches(it, network, names), schema)


def identify(docs: DataFrame, training: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``; learned from ``training``, or from ``docs`` itself."""
    small_batches(docs.sparkSession, 500)
    network = learn(docs if training is None else training, settings)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return with_language(rows, ["lang_pred", "score"], network).drop("text")


def identified(docs: DataFrame, least: float = LEAST_SCORE, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without rejected texts: those without a letter, or whose language is no likelier than chance.

    Where no labelled row can be learned from, every text with a letter stays.
    """
    small_batches(docs.sparkSession, 500)
    network = learn(docs, settings)
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = [named(docs, "lang_pred"), named(docs, "lang_score")]
    found = with_language(docs, names, network)
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
