"""Language identification by a byte convolutional network, trained in numpy on labelled text.

Filters of several widths run over the bytes of a fixed-length window; each keeps its highest
response, and a softmax over these gives the languages. A text is cut into windows from end to end
and its probabilities are the mean of theirs, by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veil.llm.common import column, text_of
from veil.llm.tokens import slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
UNKNOWN = "und"
# A filter drops documents whose best language has a lower score.
LEAST = 0.4
# The training sample: documents per language, and windows of each, spread over the whole text.
SAMPLE = 250
SAMPLE_WINDOWS = 4
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7
_CHUNK = 64  # windows at once, so that responses stay in the cache
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Network:
    """Filter weights per width ``[byte in the filter, byte value, filter]``, and the output layer."""

    langs: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pair_tables(self) -> list[tuple[int, list[tuple[int, np.ndarray]]]]:
        """Each filter as sums over two bytes at a time: ``(width, [(place, table of 65536 rows)])``."""
        tables = []
        for width, t in self.filters.items():
            pairs = []
            for k in range(0, width, 2):
                second = t[k + 1] if k + 1 < width else np.zeros_like(t[k])
                pairs.append((k, (t[k][:, None, :] + second[None, :, :]).reshape(1 << 16, -1)))
            tables.append((width, pairs))
        return tables


def windows_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte windows, lower case in ASCII, filled up with zeros."""
    at = np.arange(WINDOW)
    inside = at[None, :] < sizes[:, None]
    found = data[np.minimum(starts[:, None] + at[None, :], max(0, len(data) - 1))] if len(data) else np.zeros((len(starts), WINDOW), np.uint8)
    return np.where(inside, _LOWER[found], 0).astype(np.uint8)


def features(tables, bias: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The highest response of each filter per window."""
    out = np.empty((len(windows), len(bias)), np.float32)
    for at in range(0, len(windows), _CHUNK):
        part = windows[at : at + _CHUNK].astype(np.int64)
        pair = part << 8
        pair[:, :-1] |= part[:, 1:]
        first = 0
        for width, pairs in tables:
            n = WINDOW - width + 1
            response = None
            for k, t in pairs:
                # the last byte of an odd width has a table that ignores the byte after it
                got = np.take(t, pair[:, k : k + n], axis=0)
                response = got if response is None else np.add(response, got, out=response)
            size = response.shape[2]
            out[at : at + len(part), first : first + size] = response.max(axis=1)
            first += size
    return np.maximum(out + bias, 0)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str]) -> Network:
    """Adam on the cross entropy; the gradient of a filter reaches the bytes of its best place only."""
    rng = np.random.default_rng(SEED)
    filters = {w: rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
    out = rng.normal(0, 0.1, (len(bias), len(langs))).astype(np.float32)
    weights = [*filters.values(), bias, out, np.zeros(len(langs), np.float32)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            step += 1
            batch = order[at : at + BATCH]
            for w, g, (m, v) in zip(weights, _gradients(weights, windows[batch], labels[batch]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(langs, dict(zip(WIDTHS, weights)), *weights[len(WIDTHS) :])


def _gradients(weights: list[np.ndarray], windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    *filters, bias, out, out_bias = weights
    best, pooled = [], []
    for t in filters:
        n = WINDOW - len(t) + 1
        response = sum(t[k][windows[:, k : k + n]] for k in range(len(t)))
        best.append(response.argmax(axis=1))
        pooled.append(np.take_along_axis(response, best[-1][:, None, :], axis=1)[:, 0])
    raw = np.concatenate(pooled, axis=1) + bias
    active = np.maximum(raw, 0)
    p = softmax(active @ out + out_bias)
    p[np.arange(len(labels)), labels] -= 1
    p /= len(labels)
    back = (p @ out.T) * (raw > 0)
    gradients = []
    for i, t in enumerate(filters):
        g = np.zeros_like(t)
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        columns = np.broadcast_to(np.arange(FILTERS), own.shape)
        for k in range(len(t)):
            np.add.at(g[k], (np.take_along_axis(windows, best[i] + k, axis=1), columns), own)
        gradients.append(g)
    return [*gradients, back.sum(axis=0), active.T @ p, p.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, spread: int = SAMPLE_WINDOWS) -> Network:
    """Train on at most ``sample`` labelled documents per language that are not held out."""
    ids = docs.select(column("doc_id").alias("doc_id"), column("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample).select("doc_id").distinct()
    # at most ``sample`` ids per language
    rows = (
        docs.select(column("doc_id").alias("doc_id"), column("lang").cast("string").alias("lang"), text_of().alias("text"))
        .where("lang IS NOT NULL")
        .join(F.broadcast(chosen), "doc_id", "left_semi")
        .mapInArrow(lambda batches: _samples(batches, spread), "doc_id long, lang string, place int, bytes binary")
        # one window a place, however often an id is repeated
        .groupBy("doc_id", "lang", "place")
        .agg(F.min("bytes").alias("bytes"))
        .toPandas()
        .sort_values(["lang", "doc_id", "place", "bytes"])
    )
    langs = sorted(set(rows["lang"]))
    if not langs:
        return Network([], {}, *[np.zeros(0)] * 3)
    windows = np.frombuffer(b"".join(rows["bytes"]), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.searchsorted(langs, rows["lang"]), langs)


def _samples(batches: Iterator[pa.RecordBatch], spread: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, lang, place, found = [], [], [], []
        for d, name, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            data = np.frombuffer(text.encode(), np.uint8)
            if not any(map(str.isalpha, text)):
                continue
            starts = np.unique(np.linspace(0, max(0, len(data) - WINDOW), spread).astype(np.int64))
            for k, w in enumerate(windows_of(data, starts, np.minimum(WINDOW, len(data) - starts))):
                doc.append(d), lang.append(name), place.append(k), found.append(w.tobytes())
        columns = [pa.array(doc, pa.int64()), pa.array(lang, pa.string()), pa.array(place, pa.int32()), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "place", "bytes"])


class Predictor:
    """A trained network as it runs in a task."""

    def __init__(self, network: Network):
        self.network, self.tables = network, network.pair_tables()

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each text of a string array without nulls."""
        net = self.network
        lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if not net.langs or not len(texts):
            return lang, score
        strings = texts.cast(pa.large_string())
        binary = strings.cast(pa.large_binary())
        offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
        data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)
        sizes = np.diff(offsets)
        counts = np.maximum(1, -(-sizes // WINDOW))
        owner = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts, length = offsets[:-1][owner] + nth * WINDOW, np.minimum(WINDOW, sizes[owner] - nth * WINDOW)
        total = np.zeros((len(texts), len(net.langs)))
        for at in range(0, len(owner), 1024):
            part = slice(at, at + 1024)
            p = softmax(features(self.tables, net.bias, windows_of(data, starts[part], length[part])) @ net.out + net.out_bias)
            np.add.at(total, owner[part], p * length[part, None])
        best = total.argmax(axis=1)
        lettered = self._lettered(strings)
        lang[lettered] = np.array(net.langs, object)[best[lettered]]
        score[lettered] = np.clip(total[lettered, best[lettered]] / sizes[lettered], 0, 1)
        return lang, score

    @staticmethod
    def _lettered(texts: pa.Array) -> np.ndarray:
        found = pc.match_substring_regex(texts, "[A-Za-z]").to_numpy(zero_copy_only=False).copy()
        for i in np.flatnonzero(~found):
            found[i] = any(map(str.isalpha, texts[int(i)].as_py()))
        return found


def with_language(docs: DataFrame, network: Network, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``doc_id, held_out`` and the prediction of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(network)
        for batch in batches:
            found = [predictor.predict(part) for part in slices(batch.column(2))]
            langs, scores = (np.concatenate(c) if found else np.zeros(0) for c in zip(*found)) if found else ([], [])
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", lang, score])

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), held_out(column("doc_id")).alias("held_out"), text_of())
    return rows.mapInArrow(run, f"doc_id long, held_out boolean, {lang} string, {score} double")


def keep_identified(docs: DataFrame, network: Network, least: float = LEAST) -> DataFrame:
    """The documents, all columns as they are, without those whose language is ``und`` or scores below ``least``."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(network)
        for batch in batches:
            at = 0
            for part in slices(batch.column(place)):
                lang, score = predictor.predict(pc.fill_null(part, ""))
                yield batch.slice(at, len(part)).filter(pa.array((lang != UNKNOWN) & (score >= least), pa.bool_()))
                at += len(part)

    return docs.mapInArrow(run, docs.schema)


def identify_language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Learns from at most ``sample`` documents of each value of ``lang`` that are not held out, and predicts from
    the whole text alone. A text that is null or has no letter gives ``und`` and score 0, and so do
    all texts if nothing is labelled. Repeated rows keep their rows. Other columns are ignored.
    """
    return with_language(docs, fit(docs, sample))
