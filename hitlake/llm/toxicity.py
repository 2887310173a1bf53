"""Toxicity: a convolutional text classifier in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first bytes, so unseen words of a known
family are placed near it.  Filters of several widths slide over the word vectors, each filter's largest value
over the whole text is kept, and a logistic unit weighs those.  Training is stochastic gradient descent with
adaptive steps on a bounded sample of labelled rows (``sample_rows``); the score is calibrated on a held-back
part of it, and so is one threshold per language.  Scoring runs in the tasks that read the texts.

Words are runs of ASCII letters and digits and of non-ASCII characters, ASCII lowered.  Null and empty texts have
no words and get the score that the model gives to no evidence.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlake.llm.batches import LOWER, Hasher, byte_view, runs, word_spans

MEMBER = np.zeros(256, bool)
MEMBER[0x30:0x3A] = MEMBER[0x61:0x7B] = MEMBER[0x80:] = True

WIDTHS = (1, 2, 3)
FILTERS = 8
SIZE = 16
#: Bytes of a word's beginning that have an embedding of their own; 0 is the whole word.
HEADS = (0, 4, 6)
TABLE = 1 << 15

#: Batches between two looks at the rows held back, and looks without gain that end training.
LOOK, PATIENCE = 50, 4

#: Training texts that a word must stand in to be learnt.
LEAST_TEXTS = 3

#: Words that go through the filters at once; a longer text goes through in parts.
PART_WORDS = 1 << 16


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table for each word (n words x len(HEADS)), and each text's first word (n + 1)."""
    data, offsets = byte_view(column)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, MEMBER)
    hasher = Hasher(data)
    made = np.empty((len(starts), len(HEADS)), np.int32)
    for n, head in enumerate(HEADS):
        spans = hasher.spans(starts, np.minimum(ends, starts + head) if head else ends)
        made[:, n] = (spans % np.uint64(TABLE)).astype(np.int32) + n * TABLE
    return made, first


def _all_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of many texts, a bounded run at a time."""
    rows, counts = [np.zeros((0, len(HEADS)), np.int32)], [np.zeros(1, np.int64)]
    for run in runs([pa.RecordBatch.from_arrays([texts], names=["text"])], 0, 1 << 20):
        own, first = features(run.column(0))
        rows.append(own)
        counts.append(np.diff(first))
    return np.concatenate(rows), np.cumsum(np.concatenate(counts))


@dataclass
class Model:
    """Weights, calibration and thresholds."""

    words: np.ndarray
    filters: list[np.ndarray]
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """Filter outputs at each word (n x filters); filters that would reach past the end are -inf there."""
        vectors = self.words[rows[:, 0]]
        for n in range(1, rows.shape[1]):
            vectors = vectors + self.words[rows[:, n]]
        out = np.full((len(rows), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        for k, width in enumerate(WIDTHS):
            count = len(rows) - width + 1
            if count > 0:
                total = vectors[:count] @ self.filters[k][0]
                for j in range(1, width):
                    total += vectors[j : j + count] @ self.filters[k][j]
                out[:count, k * FILTERS : (k + 1) * FILTERS] = total
        return out

    def pooled(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each text, 0 where there is none above it."""
        pooled = np.zeros((len(first) - 1, len(WIDTHS) * FILTERS), np.float32)
        reach = max(WIDTHS) - 1
        begin = 0
        while begin < len(first) - 1:  # texts that fit together, or a long one in overlapping parts
            end = max(begin + 1, int(np.searchsorted(first, first[begin] + PART_WORDS, "right")) - 1)
            if end > begin + 1 or first[end] - first[begin] <= PART_WORDS:
                _pool(self, rows, first, begin, end, pooled)
            else:
                for at in range(int(first[begin]), int(first[end]), PART_WORDS):
                    stop = min(at + PART_WORDS + reach, int(first[end]))
                    pooled[begin] = np.maximum(pooled[begin], self.responses(rows[at:stop]).max(axis=0))
            begin = end
        return pooled

    def scores(self, column: pa.Array) -> np.ndarray:
        margin = self.pooled(*features(column)) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _pool(model: Model, rows: np.ndarray, first: np.ndarray, begin: int, end: int, pooled: np.ndarray) -> None:
    base, stop = int(first[begin]), int(first[end])
    if base == stop:
        return
    values = model.responses(rows[base:stop])
    heads = first[begin : end + 1] - base
    for k, width in enumerate(WIDTHS[1:], 1):  # a filter stays within its text
        for back in range(1, width):
            crossing = heads[1:] - back
            crossing = crossing[(crossing >= 0) & (crossing < len(values))]
            values[crossing, k * FILTERS : (k + 1) * FILTERS] = -np.inf
    full = np.flatnonzero(np.diff(heads))
    best = np.maximum.reduceat(values, heads[:-1][full], axis=0)
    pooled[begin + full] = np.maximum(best, 0)


class _Steps:
    """Adaptive step sizes of one array."""

    def __init__(self, array: np.ndarray, rate: float):
        self.array, self.rate, self.seen = array, rate, np.full(array.shape, 1e-6, array.dtype)

    def take(self, gradient: np.ndarray) -> None:
        self.seen += gradient * gradient
        self.array -= self.rate * gradient / np.sqrt(self.seen)

    def take_rows(self, rows: np.ndarray, gradient: np.ndarray) -> None:
        touched, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(touched), gradient.shape[1]), self.array.dtype)
        np.add.at(total, place, gradient)
        self.seen[touched] += total * total
        self.array[touched] -= self.rate * total / np.sqrt(self.seen[touched])


def train(texts: pa.Array, labels: np.ndarray, langs: list, steps: int = 1000, seed: int = 11, precision: float = 0.98) -> Model:
    """Fit on four fifths of the rows in at most ``steps`` batches, calibrate on the rest.

    Training ends when the log loss on the rest has not fallen for ``PATIENCE`` looks; the best weights are kept.

    The same rows in the same order give the same model.
    """
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.1, (len(HEADS) * TABLE, SIZE)).astype(np.float32),
        [rng.normal(0, 0.2, (width, SIZE, FILTERS)).astype(np.float32) for width in WIDTHS],
        np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)).astype(np.float32) * np.tile([1, -1], len(WIDTHS) * FILTERS // 2).astype(np.float32),
    )
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    model.bias = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return model
    rows, first = _all_features(texts)
    # Only words of several texts are learnt: those of one text would just name it.  The others stay at zero.
    seen = np.zeros(len(model.words), np.int32)
    for n in range(len(first) - 1):
        seen[np.unique(rows[first[n] : first[n + 1]])] += 1
    known = seen >= LEAST_TEXTS
    model.words[~known] = 0
    held = np.arange(len(labels)) % 5 == 4
    fitted = np.flatnonzero(~held)
    words, filters = _Steps(model.words, 0.05), [_Steps(f, 0.03) for f in model.filters]
    weights, bias = _Steps(model.weights, 0.05), _Steps(np.array([model.bias], np.float32), 0.05)
    kept = np.flatnonzero(held)
    kept_rows, kept_first = _all_features(texts.take(pa.array(kept)))
    best, kept_best, looks = np.inf, None, 0
    batches = max(1, len(fitted) // 48)
    for step in range(steps):
        if step % batches == 0:
            order = np.array_split(rng.permutation(fitted), batches)
        if step % LOOK == 0:
            margin = model.pooled(kept_rows, kept_first) @ model.weights + bias.array[0]
            loss = float(np.logaddexp(0, np.where(labels[kept] > 0, -margin, margin)).mean())
            if loss < best - 1e-5:
                kept_best = (model.words.copy(), [f.copy() for f in model.filters], model.weights.copy(), float(bias.array[0]))
                best, looks = loss, 0
            elif (looks := looks + 1) >= PATIENCE:
                break
        batch = order[step % batches]
        chosen = [rows[first[n] : first[n + 1]] for n in batch]
        heads = np.concatenate([[0], np.cumsum([len(c) for c in chosen])])
        own = np.concatenate(chosen)
        if not len(own):
            continue
        # Forward, with the place of each filter's largest response.
        values = model.responses(own)
        place = np.full((len(batch), values.shape[1]), -1, np.int64)
        pooled = np.zeros((len(batch), values.shape[1]), np.float32)
        for n in range(len(batch)):
            part = values[heads[n] : heads[n + 1]]
            for k, width in enumerate(WIDTHS):
                valid = part[: max(0, len(part) - width + 1), k * FILTERS : (k + 1) * FILTERS]
                if len(valid):
                    at = valid.argmax(axis=0)
                    top = valid[at, np.arange(FILTERS)]
                    pooled[n, k * FILTERS : (k + 1) * FILTERS] = np.maximum(top, 0)
                    # A filter below zero everywhere still learns a little, or it would never start.
                    place[n, k * FILTERS : (k + 1) * FILTERS] = heads[n] + at
        margin = pooled @ model.weights + bias.array[0]
        miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]
        miss = (miss / len(batch)).astype(np.float32)
        slope = np.where(pooled > 0, np.float32(1), np.float32(0.05)) * (place >= 0)
        back = miss[:, None] * model.weights[None, :] * slope
        weight_gradient = pooled.T @ miss
        # Backward: only the words under each filter's place.
        for k, width in enumerate(WIDTHS):
            at, g = place[:, k * FILTERS : (k + 1) * FILTERS], back[:, k * FILTERS : (k + 1) * FILTERS]
            keep = at >= 0
            text, which = np.nonzero(keep)
            if not len(text):
                continue
            change = np.zeros_like(model.filters[k])
            touched, moved = [], []
            for j in range(width):
                word = own[at[text, which] + j]
                vector = model.words[word].sum(axis=1)
                weight = g[text, which]
                np.add.at(change[j].T, which, vector * weight[:, None])
                touched.append(word)
                moved.append(model.filters[k][j].T[which] * weight[:, None])
            filters[k].take(change)
            word, move = np.concatenate(touched).ravel(), np.repeat(np.concatenate(moved), len(HEADS), axis=0)
            words.take_rows(word[known[word]], move[known[word]])
        weights.take(weight_gradient)
        bias.take(np.array([miss.sum()], np.float32))
    model.words, model.filters, model.weights, model.bias = kept_best
    margin = model.pooled(kept_rows, kept_first) @ model.weights + model.bias
    _calibrate(model, margin.astype(np.float64), labels[kept], [langs[n] for n in kept], precision)
    return model


def _calibrate(model: Model, margin: np.ndarray, labels: np.ndarray, langs: list, precision: float) -> None:
    """Slope and shift by gradient steps on the log loss, then per language the lowest threshold that is precise."""
    a, b = 1.0, 0.0
    target = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / (len(labels) - labels.sum() + 2))
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * margin).mean(), (p - target).mean()])
        curve = np.array([[(w * margin * margin).mean() + 1e-4, (w * margin).mean()], [(w * margin).mean(), w.mean() + 1e-4]])
        step = np.linalg.solve(curve, gradient)
        a, b = float(np.clip(a - 0.5 * step[0], 0.2, 4.0)), float(np.clip(b - 0.5 * step[1], -4.0, 4.0))
    model.slope, model.shift = float(a), float(b)
    score = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        order = np.argsort(-score[own])
        s, y = score[own][order], labels[own][order]
        right = np.cumsum(y) / np.arange(1, len(y) + 1)
        good = np.flatnonzero((right >= precision) & (y > 0))
        below = s[good[-1] + 1] if len(good) and good[-1] + 1 < len(s) else 0.0
        model.thresholds[lang] = float((s[good[-1]] + below) / 2) if len(good) else 0.5


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = 12_000) -> Model:
    """Train on the ``sample_rows`` labelled rows whose keys have the smallest hashes, held-out keys left aside.

    The bound keeps what reaches the driver to some tens of megabytes at any size of the corpus.  Rows without a
    label, a key or a text are no training rows; a key with several labels is used once for each.
    """
    own = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    chosen = own.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)
    rows = documents.where("text IS NOT NULL").select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")
    table = rows.toArrow()
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    labelled = table.column("toxic").to_numpy().astype(np.float32)
    return train(table.column("text").combine_chunks(), labelled, table.column("lang").to_pylist())


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with columns toxic_score and toxic_threshold (its language's, or 0.5) added."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns
    kept = documents.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("text"), F.col("lang").cast("string").alias("lang"))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for run in runs(batches, limit=1 << 20):
            limit = pa.array([own.thresholds.get(lang, 0.5) for lang in run.column(2).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([run.column(0), pa.array(own.scores(run.column(1)), pa.float64()), limit], names=["row", "toxic_score", "toxic_threshold"])

    schema = kept.select("row").schema.add("toxic_score", "double").add("toxic_threshold", "double")
    return kept.mapInArrow(apply, schema).select("row.*", "toxic_score", "toxic_threshold")
