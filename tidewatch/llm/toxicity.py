"""Toxicity: a support vector machine over a gappy subsequence kernel, with Nystroem landmarks.

The kernel compares words with their borders; a document is judged by its worst words together.  Labels are those of whole
documents, so the words that they stand for are found along the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.llm.labelled import fold, training_rows
from tidewatch.llm.text import mix, range_hashes, slices, word_spans

PER_CLASS = 3_000  # labelled documents of each class that the model is fitted on, at most
LANDMARKS = 128
DECAY = 0.6  # weight of a subsequence for each character it leaves out
ROUNDS = 4
COMMON, DRAWN = 20_000, 40_000  # words of clean documents in a fit besides their worst ones: the commonest, and drawn ones, at most
WORST = 3  # worst words that a document is judged by
CHECKED = 4  # one labelled document in so many is kept out of a fit; rounds and scores are set by those
SEEN, SHARE = 5, 0.8  # toxic documents with a word, and their share of all with it, to start from it
SURE = 0.98  # share of clean documents whose worst word lies below what counts as found in a toxic one
THRESHOLD = 0.5
FLOOR = -3.0  # in place of the score of a word that a document does not have
PIECE, STRIDE = 24, 12  # longer words are looked at in overlapping pieces

# Characters that stand in for letters.
_STANDS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_CODE = np.zeros(256, np.uint8)
for _c in range(26):
    _CODE[65 + _c] = _CODE[97 + _c] = _c + 1
for _sign, _letter in _STANDS.items():
    _CODE[ord(_sign)] = ord(_letter) - 96
_CODE[128:] = 27 + np.arange(128) % 4
_BORDER = 31
_SPACE = 1 << 15
# Subsequences of three characters with up to two left out between them.
_GAPS = [(1, 1), (1, 2), (2, 1), (2, 2), (1, 3), (3, 1)]


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of the distinct words of a slice, as rows padded with zeros; each word's row; the bounds of the documents.

    A word is lower-cased and freed of what is no letter, so inserted marks vanish, and has a sign for its border at both
    ends; words of one letter in a row, as in spaced-out writing, count as one word.  A long word gives several rows.
    """
    starts, ends, firsts = word_spans(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    letters = _CODE[data]
    solid = np.concatenate(([0], np.cumsum(letters > 0)))
    single = (solid[ends] - solid[starts]) <= 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    lead = np.flatnonzero(~joined)
    starts, doc = starts[lead], doc[lead]
    ends = ends[np.append(lead[1:], len(ends)) - 1] if len(lead) else ends
    kept = letters[letters > 0]
    starts, ends = solid[starts], solid[ends]
    real = ends - starts >= 3
    starts, ends, doc = starts[real], ends[real], doc[real]
    pieces = np.maximum(1, -(-(ends - starts + 2 - PIECE) // STRIDE) + 1)
    word = np.repeat(np.arange(len(starts)), pieces)
    place = (np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRIDE  # of a piece in its bordered word
    starts, length, doc = starts[word], (ends - starts)[word], doc[word]
    low, high = np.maximum(place - 1, 0), np.minimum(place + PIECE - 1, length)
    marks = (place == 0).astype(np.uint64) + 2 * (place + PIECE > length + 1).astype(np.uint64)
    hashes = mix(range_hashes(kept, starts + low, starts + high) + marks)
    _, which, row = np.unique(hashes, return_index=True, return_inverse=True)
    at = place[which][:, None] + np.arange(PIECE)
    last = length[which][:, None] + 1
    letter = kept[np.clip(starts[which][:, None] + at - 1, 0, max(len(kept) - 1, 0))] if len(kept) else at
    shown = np.where((at == 0) | (at == last), _BORDER, np.where(at < last, letter, 0))
    return shown.astype(np.uint8), row, np.searchsorted(doc, np.arange(len(offsets)))


def subsequences(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and weight (0 where there is none) of each gappy subsequence of each word; weights have length one."""
    wide = words.astype(np.int32)
    codes, weights = [], []
    for one, two in _GAPS:
        a, b, c = wide[:, :PIECE - one - two], wide[:, one:PIECE - two], wide[:, one + two:]
        codes.append((a * 32 + b) * 32 + c)
        weights.append(np.where(c > 0, DECAY ** (one + two - 2), 0).astype(np.float32))
    codes, weights = np.concatenate(codes, 1), np.concatenate(weights, 1)
    length = np.sqrt(np.square(weights).sum(1, keepdims=True))
    return codes, weights / np.maximum(length, 1e-9)


def _dense(words: np.ndarray) -> np.ndarray:
    codes, weights = subsequences(words)
    out = np.zeros((len(words), _SPACE), np.float32)
    np.add.at(out, (np.arange(len(words))[:, None], codes), weights)
    return out


def _against(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel of words with the columns of ``table``, some words at a time."""
    out = np.empty((len(words), table.shape[1]), np.float32)
    for at in range(0, len(words), 128):
        codes, weights = subsequences(words[at:at + 128])
        out[at:at + 128] = np.einsum("wf,wfk->wk", weights, table[codes])
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Squared-hinge machine with a constant as its last weight, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(25):
        active = y * (x @ w) < 1
        part = x[active] * weight[active, None].astype(x.dtype)
        new = np.linalg.solve(part.T @ x[active] + ridge, part.T @ y[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def worst_words(score: np.ndarray, row: np.ndarray, bounds: np.ndarray, distinct: bool = False) -> np.ndarray:
    """What a document is judged by: scores of its ``WORST`` worst distinct words (``FLOOR`` where it has fewer), and the
    logarithms of its numbers of bad words and of distinct words, as among more words some look worse by chance."""
    count = len(bounds) - 1
    doc = np.repeat(np.arange(count, dtype=np.int32), np.diff(bounds))
    if not distinct:
        pairs = np.unique(doc.astype(np.int64) * max(len(score), 1) + row)
        doc, row = (pairs // max(len(score), 1)).astype(np.int32), pairs % max(len(score), 1)
    each = score[row] if len(score) else np.zeros(0, np.float32)
    order = np.lexsort((-each, doc))
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    out = np.full((count, WORST + 2), FLOOR)
    top = rank < WORST
    out[doc[top], rank[top]] = each[order][top]
    out[:, WORST] = np.log1p(np.bincount(doc, each > 0, count))
    out[:, WORST + 1] = np.log1p(np.bincount(doc, minlength=count))
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        p = _curve(x, w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _curve(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:x.shape[1]] + (w[-1] if len(w) > x.shape[1] else 0), -30, 30)))


def fit(texts: list[str], labels: np.ndarray) -> tuple:
    """Weight of each subsequence, the constant, and the curve from a document's worst words to its score.

    The machine has to find the words that toxic documents are labelled for.  It starts from words that are far commoner in
    toxic documents (``SEEN``, ``SHARE``); after a round it adds the worst words of toxic documents that lie above nearly all clean
    documents' worst ones (``SURE``), and the worst words of clean documents are its hard negatives.  One labelled document in ``CHECKED``
    takes no part in that: the round is kept that tells those documents apart best, and the curve is fitted on them.
    Landmarks are half found words and half words of clean documents; words enter as their kernels with them, whitened.
    The weights of the landmarks fold into one weight for each subsequence.
    """
    words, row, bounds = [], [], [0]
    for _, data, offsets in slices(pa.array(texts, pa.string())):
        w, r, b = units(data, offsets)
        row.append(r + sum(map(len, words)))
        words.append(w)
        bounds.extend((b[1:] + bounds[-1]).tolist())
    words, row, bounds = np.concatenate(words), np.concatenate(row), np.array(bounds)
    words, again = np.unique(words, axis=0, return_inverse=True)
    row = again.ravel()[row]
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pairs = np.unique(doc.astype(np.int64) * max(len(words), 1) + row)
    doc, row = (part.astype(np.int32) for part in (pairs // max(len(words), 1), pairs % max(len(words), 1)))
    del again, pairs
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    draw = np.random.default_rng(5)
    checked = np.zeros(len(texts), bool)
    for value in (0, 1):
        own = draw.permutation(np.flatnonzero(labels == value))
        checked[own[:len(own) // CHECKED]] = True
    if not (checked & (labels > 0)).any():
        checked[:] = True
    used = ~checked if (~checked & (labels > 0)).any() and (~checked & (labels == 0)).any() else np.ones(len(texts), bool)
    in_toxic, in_clean = (np.bincount(row[used[doc] & (labels[doc] == v)], minlength=len(words)) for v in (1, 0))

    def worst(score: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return np.array([row[bounds[d]:bounds[d + 1]][np.argmax(score[row[bounds[d]:bounds[d + 1]]])]
                         for d in docs if bounds[d] < bounds[d + 1]], np.int64)

    bad, good = np.flatnonzero(used & (labels > 0)), np.flatnonzero(used & (labels == 0))
    in_bad = np.isin(doc, bad)
    ratio = (in_toxic / max(len(bad), 1)) / ((in_clean + 0.5) / max(len(good), 1))
    telling = (in_toxic >= SEEN) & (in_toxic >= SHARE * (in_toxic + in_clean))
    start = row[in_bad & telling[row]] if telling.any() else worst(ratio, bad)
    found = start
    clean = np.flatnonzero(in_clean > 0)
    clean = clean[np.argsort(-in_clean[clean], kind="stable")]
    clean = np.concatenate([clean[:COMMON], draw.permutation(clean[COMMON:])[:DRAWN]])
    hard, best = np.zeros(0, np.int64), None
    for _ in range(ROUNDS if len(found) and len(clean) else 0):
        marks, times = np.unique(found, return_counts=True)
        marks = marks[np.argsort(-times, kind="stable")][:LANDMARKS // 2]
        marks = np.concatenate([marks, np.unique(hard)[:LANDMARKS // 4], clean[:LANDMARKS // 2]])[:LANDMARKS]
        basis = _dense(words[marks])
        size, axes = np.linalg.eigh((basis @ basis.T).astype(float))
        whiten = axes[:, size > 1e-4] / np.sqrt(size[size > 1e-4])
        table = np.ascontiguousarray((basis.T @ whiten).astype(np.float32))
        # a word found in many documents is one row that weighs as much
        sides = [(*np.unique(found, return_counts=True), 1 / len(found)), (clean, np.ones(len(clean)), 0.5 / len(clean)),
                 (*np.unique(hard, return_counts=True), 0.5 / max(len(hard), 1))]
        x = np.concatenate([_against(words[part], table) for part, _, _ in sides])
        y = np.repeat([1.0, -1.0, -1.0], [len(part) for part, _, _ in sides])
        weight = np.concatenate([count * share for _, count, share in sides]) * (len(found) + len(clean) + len(hard)) / 200
        w = _svm(x, y, weight.astype(np.float32))
        del x
        each = (table @ w[:-1]).astype(np.float32)
        score = word_scores(words, each) + w[-1]
        judged = worst_words(score, row, bounds, True)
        curve = _logistic(judged[checked], labels[checked])
        p = np.clip(_curve(judged[checked], curve), 1e-9, 1 - 1e-9)
        loss = -np.mean(np.where(labels[checked] > 0, np.log(p), np.log(1 - p)))
        if best is None or loss < best[0]:
            best = loss, each, float(w[-1]), curve
        hard = worst(score, good)
        limit = np.quantile(score[hard], SURE) if len(hard) else -np.inf
        more = worst(score, bad)
        found = np.concatenate([start, more[(score[more] > limit) & ~np.isin(more, start)]])
    if best is None:  # no words at all
        share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6))
        return np.zeros(_SPACE, np.float32), 0.0, np.append(np.zeros(WORST + 2), np.log(share / (1 - share)))
    return best[1:]


def word_scores(words: np.ndarray, weight: np.ndarray) -> np.ndarray:
    out = np.empty(len(words), np.float32)
    for at in range(0, len(words), 8192):
        codes, weights = subsequences(words[at:at + 8192])
        out[at:at + 8192] = (weight[codes] * weights).sum(1)
    return out


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> tuple | None:
    """Fit on at most ``2 * per_class`` labelled documents; None where a class is missing."""
    found = sorted(map(tuple, training_rows(documents, labels, label, per_class).collect()), key=lambda r: r[0])
    y, texts = np.array([r[1] for r in found], float), [r[2] for r in found]
    del found
    return fit(texts, y) if 0 < y.sum() < len(y) else None


def _scorer(model, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for _, data, offsets in slices(batch.column(position)):
                if model.value:
                    weight, constant, curve = model.value
                    words, row, bounds = units(data, offsets)
                    scores.append(_curve(worst_words(word_scores(words, weight) + constant, row, bounds), curve))
                else:
                    scores.append(np.zeros(len(offsets) - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores), pa.float64())],
                                             [*batch.schema.names, "_tw_score"])
    return run


def scored(documents: DataFrame, model: tuple | None) -> DataFrame:
    """``documents`` with ``_tw_score``, by the worst words of the whole text.

    A null or empty text counts as one without words; without a model (a class has no labels) scores are 0.  Repeated rows get
    the same score each, other columns pass through, and an empty table gives an empty table.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*documents.schema.fields, T.StructField("_tw_score", T.DoubleType())])
    return documents.mapInArrow(_scorer(held, documents.columns.index("text")), schema)


def op9_string_kernel_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of ``documents`` as ``labels.toxic`` marks it; see ``scored`` for odd rows.  A null id counts as held out."""
    rows = scored(documents.select("doc_id", "text"), train(documents, labels))
    return rows.select("doc_id", (fold() == 0).alias("held_out"), F.col("_tw_score").alias("score"),
                       F.when(F.col("_tw_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
