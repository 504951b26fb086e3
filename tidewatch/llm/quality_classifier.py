"""Quality classifier: a factorisation machine over hashed words and structure of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.llm.labelled import fold, training_rows
from tidewatch.llm.quality_rules import text_counts
from tidewatch.llm.text import lowered, range_hashes, slices, word_spans

PER_CLASS = 8_000  # labelled documents of each class that the model is fitted on, at most
WORD_BITS = 16
RANK = 8
EPOCHS, BATCH, RATE, PENALTY = 6, 256, 0.08, 1e-5
THRESHOLD = 0.3
_LEVELS = 16  # steps of each structure measure

_UPPER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _structure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Level, below ``_LEVELS``, of each structure measure of each row."""
    counts = text_counts(data, offsets)
    size = np.maximum(np.diff(offsets), 1)
    sums = [np.concatenate(([0], np.cumsum(kind[data], dtype=np.int64))) for kind in (_UPPER, _DIGIT, _MARK)]
    shares = [(s[offsets[1:]] - s[offsets[:-1]]) / size for s in sums]
    words, chars = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1)
    shares += [counts["n_symbols"] / chars, counts["n_dup_lines"] / words, counts["n_repeat_words"] / words]
    scales = [np.log1p(counts["n_words"]) * 1.3, counts["word_chars"] / words, *[np.sqrt(s) * 20 for s in shares]]
    return np.stack([np.minimum(s, _LEVELS - 1).astype(np.int64) for s in scales], 1)


N_STRUCTURE = 8
N_FEATURES = (1 << WORD_BITS) + N_STRUCTURE * _LEVELS


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of each row, laid end to end, and the bounds of the rows.

    The distinct words of a row, hashed, share a length of one; each structure measure gives a one at its level.
    Nothing but the text goes in.
    """
    rows = len(offsets) - 1
    starts, ends, firsts = word_spans(data, offsets)
    words = range_hashes(lowered(data), starts, ends) >> np.uint64(64 - WORD_BITS)
    row = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(firsts))
    distinct = np.unique((row << np.uint64(WORD_BITS)) | words)
    row = (distinct >> np.uint64(WORD_BITS)).astype(np.int64)
    n = np.bincount(row, minlength=rows)
    bounds = np.concatenate(([0], np.cumsum(n + N_STRUCTURE)))
    index = np.empty(bounds[-1], np.int64)
    value = np.ones(bounds[-1], np.float32)
    place = np.arange(len(row)) + row * N_STRUCTURE
    index[place] = (distinct & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    value[place] = 1 / np.sqrt(n[row])
    levels = _structure(data, offsets) + (1 << WORD_BITS) + np.arange(N_STRUCTURE) * _LEVELS
    index[(bounds[1:, None] - N_STRUCTURE + np.arange(N_STRUCTURE)).ravel()] = levels.ravel()
    return index, value, bounds


def interaction(model: tuple, index: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of rows and their sums of factors: all pairs at once, as half of (square of the sum less sum of the squares)."""
    bias, linear, factors = model
    scaled = factors[index] * value[:, None]
    sums = np.add.reduceat(scaled, bounds[:-1])
    squares = np.add.reduceat(np.square(scaled).sum(1), bounds[:-1])
    return bias + np.add.reduceat(linear[index] * value, bounds[:-1]) + 0.5 * (np.square(sums).sum(1) - squares), sums


def fit(index: np.ndarray, value: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> tuple:
    """Logistic loss, classes weighed alike, by adaptive gradient steps over batches in a fixed order."""
    draw = np.random.default_rng(7)
    linear = np.zeros(N_FEATURES, np.float32)
    factors = draw.normal(0, 0.05, (N_FEATURES, RANK)).astype(np.float32)
    seen_linear, seen_factors = np.full(N_FEATURES, 1e-6, np.float32), np.full((N_FEATURES, RANK), 1e-6, np.float32)
    bias = 0.0
    share = max(labels.mean(), 1e-9), max(1 - labels.mean(), 1e-9)
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            lengths = bounds[rows + 1] - bounds[rows]
            inner = np.concatenate(([0], np.cumsum(lengths)))
            take = np.repeat(bounds[rows] - inner[:-1], lengths) + np.arange(inner[-1])
            i, v = index[take], value[take]
            score, sums = interaction((bias, linear, factors), i, v, inner)
            y = labels[rows]
            error = ((1 / (1 + np.exp(-score)) - y) * np.where(y > 0, 0.5 / share[0], 0.5 / share[1]) / len(rows)).astype(np.float32)
            each = np.repeat(np.arange(len(rows)), lengths)
            used, place = np.unique(i, return_inverse=True)
            slope = np.bincount(place, error[each] * v, len(used)).astype(np.float32) + PENALTY * linear[used]
            pull = (sums[each] * v[:, None] - factors[i] * np.square(v)[:, None]) * error[each][:, None]
            slopes = np.stack([np.bincount(place, pull[:, k], len(used)) for k in range(RANK)], 1).astype(np.float32)
            slopes += PENALTY * factors[used]
            seen_linear[used] += np.square(slope)
            seen_factors[used] += np.square(slopes)
            linear[used] -= RATE * slope / np.sqrt(seen_linear[used])
            factors[used] -= RATE * slopes / np.sqrt(seen_factors[used])
            bias -= RATE * float(error.sum())
    return bias, linear, factors


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in slices(batch.column("text")):
            index, value, bounds = features(data, offsets)
            parts = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, len(parts)), batch.column("label").slice(first, len(parts)),
                 pa.array([index[p].astype(np.int32).tobytes() for p in parts], pa.binary()),
                 pa.array([value[p].tobytes() for p in parts], pa.binary())], ["doc_id", "label", "i", "v"])


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> tuple:
    """Fit on the features of at most ``2 * per_class`` labelled documents; no labels give a model that says 0.5."""
    rows = training_rows(documents, labels, label, per_class)
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("label", rows.schema["label"].dataType),
                           T.StructField("i", T.BinaryType()), T.StructField("v", T.BinaryType())])
    found = sorted(rows.select("doc_id", "label", "text").mapInArrow(_pack, schema).collect(), key=lambda r: r["doc_id"])
    if not found:
        return 0.0, np.zeros(N_FEATURES, np.float32), np.zeros((N_FEATURES, RANK), np.float32)
    index = np.concatenate([np.frombuffer(r["i"], np.int32) for r in found])
    value = np.concatenate([np.frombuffer(r["v"], np.float32) for r in found])
    bounds = np.concatenate(([0], np.cumsum([len(r["i"]) // 4 for r in found])))
    return fit(index, value, bounds, np.array([r["label"] for r in found], np.float32))


def _scorer(model, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [1 / (1 + np.exp(-np.clip(interaction(model.value, *features(data, offsets))[0], -30, 30).astype(float)))
                      for _, data, offsets in slices(batch.column(position))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "_tw_score"])
    return run


def scored(documents: DataFrame, model: tuple) -> DataFrame:
    """``documents`` with ``_tw_score``, 0 to 1; a null or empty text is scored by its structure.  The model has a fixed size."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*documents.schema.fields, T.StructField("_tw_score", T.DoubleType())])
    return documents.mapInArrow(_scorer(held, documents.columns.index("text")), schema)


def op3_fm_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of each document; repeated rows score alike, an empty table gives an empty table."""
    rows = scored(documents.select("doc_id", "text"), train(documents, labels))
    return rows.select("doc_id", (fold() == 0).alias("held_out"), F.col("_tw_score").alias("score"),
                       F.when(F.col("_tw_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
