"""Quality classifier by co-training: what a text says and what its page record says teach each other.

Two logistic regressions see different views of a document, its text and its metadata. Both start
from the labelled sample. In each round, each view looks at every document of the corpus without a
label; of those of which it is sure, by its calibrated probability, some are drawn by a hash and
join the training set of the other view. At last both are calibrated on labelled documents kept from training, and their log odds are
added, less the prior that both contain.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from veil.llm.common import column, stored, text_of

# The bound of the labelled sample; each round adds at most PER_ROUND documents per view and label.
LABELLED = 2000
ROUNDS, SURE, PER_ROUND = 4, 0.95, 200
KEEP = 0.5
METADATA = ("source", "lang", "n_chars")
_BUCKETS = 64
_SHAPES = 8


def content_view(text: str) -> np.ndarray:
    """The share of each ASCII character, and how much words and lines repeat."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(129 + _SHAPES, np.float32)
    if not len(data):
        return out
    out[:128] = np.sqrt(np.bincount(np.minimum(data, 128), minlength=129)[:128] / len(data))
    out[128] = np.sqrt(np.count_nonzero(data >= 128) / len(data))
    words, lines = text.split(), text.split("\n")
    if words:
        counts = Counter(words)
        marked = sum(n for w, n in counts.items() if not w[-1].isalnum())
        odd = sum(n for w, n in counts.items() if len(w) > 1 and not (w[-1].isalnum() or w[-2].isalnum()))
        out[129:] = (
            len(counts) / len(words),
            max(counts.values()) / len(words),
            len(set(lines)) / len(lines),
            marked / len(words),
            odd / len(words),
            sum(n for w, n in counts.items() if w.isupper() and len(w) > 1) / len(words),
            sum(len(w) * n for w, n in counts.items()) / len(words) / 10,
            np.log1p(len(words)) / 10,
        )
    return out


def metadata_view(values: tuple) -> np.ndarray:
    """Hashed values of the record's other columns; numbers by their power of two."""
    out = np.zeros(_BUCKETS * len(METADATA), np.float32)
    for i, v in enumerate(values):
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            v = int(np.log2(v)) if v and v > 0 and np.isfinite(v) else 0
        out[i * _BUCKETS + zlib.crc32(repr(v).encode()) % _BUCKETS] = 1
    return out


@dataclass(frozen=True)
class Logistic:
    """Logistic regression on standardised features, with a calibration of its log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]
        return self.slope * raw + self.shift

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        """With the slope and shift that fit held-out labels best."""
        raw = Logistic(self.mean, self.scale, self.weights).odds(x)
        slope, shift = _newton(np.stack([raw, np.ones(len(raw))], 1), y, 1e-3)
        return Logistic(self.mean, self.scale, self.weights, max(0.0, float(slope)), float(shift))


def fit_logistic(x: np.ndarray, y: np.ndarray, strength: float = 3.0) -> Logistic:
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-2)
    design = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    return Logistic(mean, scale, _newton(design, y, strength))


def _newton(x: np.ndarray, y: np.ndarray, strength: float) -> np.ndarray:
    # labels a little inside 0 and 1, so that separable classes have finite odds
    y = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], strength)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = probability(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@dataclass(frozen=True)
class CoTrained:
    content: Logistic | None
    metadata: Logistic | None
    prior: float

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by text, by metadata, and by both."""
        if self.content is None or self.metadata is None:
            same = np.full(len(content), self.prior)
            return same, same, same
        a, b = self.content.odds(content), self.metadata.odds(metadata)
        prior = np.log(self.prior / (1 - self.prior))
        return probability(a), probability(b), probability(a + b - prior)


@dataclass(frozen=True)
class Sure:
    """Documents with which a view teaches the other one."""

    view: int
    value: int
    content: np.ndarray
    metadata: np.ndarray


Draw = Callable[[list[Logistic], int], list[Sure]]


def sure_of(models: list[Logistic], content: np.ndarray, metadata: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """For each view and label, which documents the view is sure of."""
    found = {}
    for view, (model, x) in enumerate(zip(models, (content, metadata))):
        p = probability(model.odds(x))
        found[view, 0], found[view, 1] = 1 - p >= SURE, p >= SURE
    return found


def draw_from(content: np.ndarray, metadata: np.ndarray) -> Draw:
    """Draw from documents in memory."""

    def draw(models: list[Logistic], turn: int) -> list[Sure]:
        if not len(content):
            return []
        h = np.array([xxhash.xxh64_intdigest(c.tobytes() + m.tobytes(), turn) for c, m in zip(content, metadata)], np.uint64)
        out = []
        for (view, value), sure in sure_of(models, content, metadata).items():
            at = np.flatnonzero(sure)
            at = at[np.argsort(h[at], kind="stable")[:PER_ROUND]]
            out.append(Sure(view, value, content[at], metadata[at]))
        return out

    return draw


def co_train(
    content: np.ndarray, metadata: np.ndarray, label: np.ndarray, kept_out: np.ndarray, draw: Draw | None = None
) -> CoTrained:
    """Train on rows with ``label`` 0 or 1; the views teach each other with what ``draw`` finds, at first among rows of label -1."""
    known = label >= 0
    draw = draw or draw_from(content[~known], metadata[~known])
    good = int((label == 1).sum())
    prior = (good + 1) / (known.sum() + 2)
    teach, check = known & ~kept_out, known & kept_out
    if any(len(set(label[part])) < 2 for part in (teach, check)):
        return CoTrained(None, None, float(prior))
    views = [content, metadata]
    taught = [(x[teach], label[teach]) for x in views]
    met: list[set[bytes]] = [set(), set()]
    for turn in range(ROUNDS + 1):
        models = [fit_logistic(x, y).calibrated(v[check], label[check]) for (x, y), v in zip(taught, views)]
        if turn == ROUNDS:
            break
        for found in draw(models, turn):
            other = 1 - found.view
            keys = [c.tobytes() + m.tobytes() for c, m in zip(found.content, found.metadata)]
            fresh = [i for i, key in enumerate(keys) if key not in met[other]]
            met[other].update(keys)
            x, y = taught[other]
            taught[other] = (
                np.concatenate([x, (found.content, found.metadata)[other][fresh]]),
                np.append(y, np.full(len(fresh), found.value, y.dtype)),
            )
    return CoTrained(*models, float(prior))


def _views(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    content = np.stack([content_view(t.as_py()) for t in batch.column(first)])
    rows = zip(*(batch.column(first + 1 + i).to_pylist() for i in range(len(METADATA))))
    return content, np.stack([metadata_view(r) for r in rows])


def _described(docs: DataFrame, *first) -> DataFrame:
    have = {f.name: "double" if isinstance(f.dataType, NumericType) else "string" for f in docs.schema.fields}
    described = [column(m).cast(have[m]) if m in have else F.lit(None).cast("string") for m in METADATA]
    return docs.select(*first, text_of(), *[c.alias(f"m{i}") for i, c in enumerate(described)])


_DESCRIBED = "doc_id long, label int, content binary, metadata binary"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Views as bytes; of the metadata, the places of its ones."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            content, metadata = _views(part, 2)
            ones = [np.flatnonzero(row).astype(np.uint8) for row in metadata]
            packed = [pa.array([row.tobytes() for row in v], pa.binary()) for v in (content, ones)]
            columns = [part.column(0).cast(pa.int64()), part.column(1).cast(pa.int32()), *packed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "content", "metadata"])


def _unpacked(content: list[bytes], metadata: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ones = np.frombuffer(b"".join(metadata), np.uint8).reshape(len(metadata), len(METADATA))
    spread = np.zeros((len(metadata), _BUCKETS * len(METADATA)), np.float32)
    spread[np.arange(len(metadata))[:, None], ones] = 1
    return np.frombuffer(b"".join(content), np.float32).reshape(len(content), -1), spread


def draw_at_scale(pool: DataFrame) -> Draw:
    """Draw from a stored table of ``content, metadata``: a count of the sure documents sets the hash below which they are drawn."""

    def sure_rows(models: list[Logistic], turn: int, ends: dict | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    content, metadata = (batch.column(i).slice(at, 1000).to_pylist() for i in (0, 1))
                    sure = sure_of(models, *_unpacked(content, metadata))
                    # above 0, so that it is a long
                    h = np.array([xxhash.xxh64_intdigest(c + m, turn) >> 1 for c, m in zip(content, metadata)], np.int64)
                    for (view, value), there in sure.items():
                        kept = np.flatnonzero(there & (h <= (-1 if ends is None else ends.get((view, value), -1))))
                        n = 1 if ends is None else len(kept)
                        full = lambda x, n=n: pa.array(np.full(n, x, np.int64))
                        names = ["view", "value", "n", "h", "content", "metadata"]
                        told = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary())]
                        drawn = [pa.array(h[kept])] + [pa.array([x[i] for i in kept], pa.binary()) for x in (content, metadata)]
                        columns = [full(view), full(value), full(int(there.sum())), *(told if ends is None else drawn)]
                        yield pa.RecordBatch.from_arrays(columns, names)

        return pool.mapInArrow(run, "view long, value long, n long, h long, content binary, metadata binary")

    def draw(models: list[Logistic], turn: int) -> list[Sure]:
        counts = sure_rows(models, turn, None).groupBy("view", "value").agg(F.sum("n").alias("n")).collect()
        # half as many again, because a hash draws a few more or less than its share
        ends = {(r["view"], r["value"]): min(2**63 - 1, int(2**63 * 1.5 * PER_ROUND / r["n"])) for r in counts if r["n"]}
        drawn = sure_rows(models, turn, ends)
        out = []
        if not ends:
            return out
        # at most ``PER_ROUND`` rows per view and label
        place = W.partitionBy("view", "value").orderBy("h", "content", "metadata")
        kept = drawn.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= PER_ROUND).drop("_n").toPandas()
        for (view, value), rows in kept.sort_values(["h", "content", "metadata"]).groupby(["view", "value"]):
            out.append(Sure(int(view), int(value), *_unpacked(list(rows["content"]), list(rows["metadata"]))))
        return out

    return draw


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> CoTrained:
    """Train on at most ``labelled`` documents with a label; all others take part in the exchange, equal ones as one."""
    order = [F.xxhash64("doc_id"), "doc_id"]
    marks = (
        labels.where("quality IN (0, 1)")
        .groupBy(column("doc_id").alias("doc_id"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where("label = most")
        .select("doc_id", "label")
    )
    ids = docs.select(column("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    known = ids.join(marks, "doc_id").orderBy(*order).limit(labelled)
    # at most ``labelled`` rows
    wanted = F.broadcast(stored(known.withColumnRenamed("doc_id", "_wanted"), "quality-labels"))
    same = column("doc_id") == F.col("_wanted")
    rows = _described(docs.join(wanted, same), F.col("_wanted"), F.col("label").cast("int"))
    # one row an id, however often it is repeated
    one = F.min(F.struct("content", "metadata")).alias("one")
    found = rows.mapInArrow(_describe, _DESCRIBED).groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.*").toPandas()
    if found.empty:
        return CoTrained(None, None, 0.5)
    found = found.sort_values("doc_id")
    views = _unpacked(list(found["content"]), list(found["metadata"]))
    label = found["label"].to_numpy()
    kept_out = np.array([zlib.crc32(str(d).encode()) % 4 == 0 for d in found["doc_id"]])
    nothing = F.lit(None).cast("int")
    others = _described(docs.join(wanted, same, "left_anti"), column("doc_id"), nothing).mapInArrow(_describe, _DESCRIBED)
    pool = stored(others.groupBy("content", "metadata").agg(F.lit(1).alias("one")).select("content", "metadata"), "quality-pool")
    return co_train(*views, label, kept_out, draw_at_scale(pool))


def score_quality(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``doc_id, text_score, metadata_score, score, kept`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                both = model.scores(*_views(part, 1))
                columns = [part.column(0), *map(pa.array, both), pa.array(both[2] >= KEEP)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_score", "metadata_score", "score", "kept"])

    rows = _described(docs, column("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(run, "doc_id long, text_score double, metadata_score double, score double, kept boolean")


def keep_good(docs: DataFrame, model: CoTrained, least: float = KEEP) -> DataFrame:
    """The documents, all columns as they are, without those that score below ``least``."""
    places = [docs.columns.index(c) if c in docs.columns else None for c in ("text", *METADATA)]
    numbers = [isinstance(docs.schema[c].dataType, NumericType) if c in docs.columns else False for c in METADATA]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                none = pa.nulls(part.num_rows, pa.string())
                columns = [none if p is None else part.column(p) for p in places]
                columns[0] = pc.fill_null(columns[0], "")
                columns[1:] = [c.cast(pa.float64() if n else pa.string()) for c, n in zip(columns[1:], numbers)]
                score = model.scores(*_views(pa.RecordBatch.from_arrays(columns, ["text", *METADATA]), 0))[2]
                yield part.filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)


def quality_classifier(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """One row per document with the probability of good quality by each view and by both.

    The labelled sample is bounded; every whole text is scored, in the exchange and at the end. A null text is empty; missing or null metadata
    is a value of its own. Labels other than 0 and 1 and contradicting ones are ignored. Without
    labels of both kinds every document has the prior as its score. Rows that repeat keep their
    rows; other columns are ignored.
    """
    return score_quality(docs, fit(docs, labels, labelled))
