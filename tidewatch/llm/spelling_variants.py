"""Spelling variants: words one edit apart, found as shared prefixes of sorted permuterm rotations."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

import tidewatch.llm.memory  # noqa: F401 - applies in every worker that imports this
from tidewatch.llm.rows import numbered
from tidewatch.session import stored

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 5, 3
DELETED = 97  # one (document, word) in so many loses a code point
RATIO = 2  # a form is at least so many times as frequent as its variant
HELD_WORDS = 100_000  # words that a task counts before it passes them on
BLOCK = 1 << 20  # characters of a text that are split into words at a time, about
SPELT = 64  # code points of a rotation that is sorted as it is; a longer one is sorted by a digest of 127 bits
ROTATIONS = 50_000  # rotations in a batch, about
_TERMINATOR = "\x00"  # no letter
_MODULUS, _BASE = 2 ** 127 - 1, 0x5851F42D4C957F2D14057B7EF767814F

_runs = re.compile(f"[{LETTERS}]+").findall
_break = re.compile(f"[^{LETTERS}]").search
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """Distinct words of a text with their counts, after the deletions that its id and the words decide."""
    found, at = Counter(), 0
    while at < len(text):
        cut = _break(text, at + BLOCK)
        stop = cut.start() if cut else len(text)
        found.update(_runs(text, at, stop))
        at = stop
    lower = Counter()
    for run, times in found.items():
        lower[run.lower() if run.isascii() else run.translate(_LOWER)] += times
    lead = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    for word, times in lower.items():
        mark = zlib.crc32(word.encode(), lead)
        if mark % DELETED == 0:
            gone = mark % len(word)
            word = word[:gone] + word[gone + 1:]
        if len(word) >= LEAST_LENGTH:
            yield word, times


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = defaultdict(int)

    def counted() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for word, times in words_of(doc_id, text.as_py() or ""):
                held[word] += times
            if len(held) >= HELD_WORDS:
                yield counted()
    yield counted()


def vocabulary(documents: DataFrame) -> DataFrame:
    """``(word, n)`` of the words that occur often enough; a task sends each word it holds once."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _digests(word: str) -> tuple[list[int], list[int]]:
    """Digests of the rotations of a marked word, and of what they are without their last letter, by place of the cut."""
    heads, powers = [0], [1]
    for c in word:
        heads.append((heads[-1] * _BASE + ord(c) + 1) % _MODULUS)
        powers.append(powers[-1] * _BASE % _MODULUS)
    powers.append(powers[-1] * _BASE % _MODULUS)
    total = heads[-1]
    tails = [(total - heads[k] * powers[len(word) - k]) % _MODULUS for k in range(len(word) + 1)]
    whole = [((tails[k] * _BASE + 1) * powers[k] + heads[k]) % _MODULUS for k in range(len(word) + 1)]
    less = [((tails[k + 1] * _BASE + 1) * powers[k] + heads[k]) % _MODULUS for k in range(len(word))]
    return whole, less


def rotations(word: str) -> Iterator[tuple[bytes, int]]:
    """``(key, kind)`` of all rotations of the marked word.

    Kind 0 is a whole rotation: the word with a place to insert at its end.  Kind 1 and 2 are rotations without their last
    letter: words that differ in that letter alone share it, and it is the whole rotation of the word that lacks the letter.
    In a run of a letter, whichever is left out the word is the same, so only the run's first is kind 2, a deletion.
    """
    n = len(word)
    kinds = [2 if k == 0 or word[k] != word[k - 1] else 1 for k in range(n)]
    if n < SPELT:
        whole = [(word[k:] + _TERMINATOR + word[:k]).encode() for k in range(n + 1)]
    else:
        digests, shorter = _digests(word)
        whole = [b"\xff" + d.to_bytes(16, "big") for d in digests]
    if n <= SPELT:
        less = [(word[k + 1:] + _TERMINATOR + word[:k]).encode() for k in range(n)]
    else:
        less = [b"\xff" + d.to_bytes(16, "big") for d in shorter]
    yield from ((key, 0) for key in whole)
    yield from zip(less, kinds)


_ROTATION = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("kind", T.IntegerType()),
                          T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])


def _rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, kinds, ids, counts = [], [], [], []

    def rotated() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(kinds, pa.int32()), pa.array(ids, pa.int64()),
                                          pa.array(counts, pa.int64())], _ROTATION.names)
        for column in (keys, kinds, ids, counts):
            column.clear()
        return out

    for batch in batches:
        for word, n, number in zip(*(batch.column(k).to_pylist() for k in range(3))):
            for key, kind in rotations(word):
                keys.append(key)
                kinds.append(kind)
            ids.extend([number] * (len(keys) - len(ids)))
            counts.extend([n] * (len(keys) - len(counts)))
            if len(keys) >= ROTATIONS:
                yield rotated()
    yield rotated()


_NEAR = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_near", T.LongType()),
                      T.StructField("near_n", T.LongType()), T.StructField("near_id", T.LongType())])


def neighbours(group: np.ndarray, kind: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each rotation that meets others: its word, how many words it meets there, and the best of them with its count.

    Rows come by group; in it the whole rotation first, if any, then the others, the most frequent first and ties by word.
    A word's best is the group's first or, for the first, the second: no pairs are formed.
    """
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
    lead = first[of]  # the group's first row
    whole = kind == 0
    has = whole[first][of]
    top = lead + has  # the best of the words that end in some letter
    others = np.bincount(of, ~whole, len(first)).astype(np.int64)[of]
    place = np.arange(len(group))
    # words of equal length: all in the group but the word itself
    best = np.where(place == top, top + 1, top)
    count = np.where(whole, 0, others - 1)
    near_n, near_id = np.full(len(group), -1), np.full(len(group), -1)
    known = (count > 0).nonzero()[0]
    near_n[known], near_id[known] = n[best[known]], ids[best[known]]

    def offer(rows: np.ndarray, of_n: np.ndarray, of_id: np.ndarray) -> None:
        better = (of_n > near_n[rows]) | ((of_n == near_n[rows]) & (of_id < near_id[rows]))
        near_n[rows[better]], near_id[rows[better]] = of_n[better], of_id[better]

    # a word and what it is without the letter
    deletion = np.flatnonzero((kind == 2) & has)
    count[deletion] += 1
    offer(deletion, n[lead[deletion]], ids[lead[deletion]])
    if len(deletion):
        count += np.where(whole, np.bincount(of[deletion], minlength=len(first))[of], 0)
        fresh = np.append(True, of[deletion][1:] != of[deletion][:-1])  # the best deletion of each group comes first
        offer(lead[deletion[fresh]], n[deletion[fresh]], ids[deletion[fresh]])
    met = count > 0
    return ids[met], count[met], near_n[met], near_id[met]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        held = pa.concat_batches([held, batch]) if held is not None else batch
        keys = held.column(0)
        if len(keys) < 2:
            continue
        fresh = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        borders = np.flatnonzero(fresh)
        if len(borders):  # the last group may go on in the next batch
            whole = int(borders[-1]) + 1
            yield _found(held.slice(0, whole), fresh[:whole - 1])
            held = held.slice(whole)
    if held is not None and held.num_rows:
        keys = held.column(0)
        yield _found(held, pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False))


def _found(rows: pa.RecordBatch, fresh: np.ndarray) -> pa.RecordBatch:
    group = np.concatenate(([0], np.cumsum(fresh)))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in neighbours(group, *(rows.column(k).to_numpy() for k in (1, 2, 3)))], _NEAR.names)


def near_words(words: DataFrame) -> DataFrame:
    """``(id, n_near, near_n, near_id)`` of the words (``word``, ``n``, ``id``, in order of words) that have near words.

    All rotations of all words are sorted; each group of a prefix lies in one task and has at most one word for each letter of
    the alphabet and one more.  Two words meet in one group, except through a run of a letter (see ``rotations``).
    """
    dealt = words.select("word", "n", "id").mapInArrow(_rotate, _ROTATION).repartition("key")
    order = dealt.sortWithinPartitions("key", F.col("kind") > 0, F.desc("n"), "id")
    found = order.mapInArrow(_scan, _NEAR)
    best = F.max(F.struct("near_n", (-F.col("near_id")).alias("negative")))
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "id", "n_near", F.col("best.near_n").alias("near_n"), (-F.col("best.negative")).alias("near_id"))


def roots(forms: DataFrame) -> DataFrame:
    """``(id, root)`` of words that have a form (``id``, ``to``): the last of the forms they lead to.

    Each step doubles how far a word has gone; counts at least double along a chain, so there are few steps.
    """
    paths = stored(forms.select("id", F.col("to").alias("root")), "roots")
    while True:
        on = paths.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        longer = stored(paths.join(on, "root", "left").select("id", F.coalesce("_next", "root").alias("root"),
                                                              F.col("_next").isNotNull().alias("_moved")), "roots")
        paths = longer.drop("_moved")
        if longer.filter("_moved").isEmpty():
            return paths


def spelling_variants(documents: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of all texts.

    Words are lower-cased runs of letters, of five code points or more and found three times or more; one in 97 of a document's
    words has lost a code point.  ``n_near`` counts the words one insertion, deletion or replacement away.  ``form`` is the
    most frequent of them (ties: the first in code-point order) if it is twice as frequent, else null; ``root`` is where forms
    lead in the end, the word itself if it has none.

    A null or empty text has no words, a null id counts as an empty one, repeated rows count each, other columns are not
    read, and an empty table gives an empty table.  A very long word has as many rotations as letters, each of fixed size.
    """
    words = numbered(vocabulary(documents), ["word"], "spelling-words").withColumnRenamed("row_number", "id")
    words = stored(words, "spelling-vocabulary")
    rated = stored(words.join(near_words(words), "id", "left").withColumn(
        "to", F.when(F.col("near_n") >= RATIO * F.col("n"), F.col("near_id"))), "spelling-forms")
    linked = rated.filter("to is not null").select("id", "to")
    ends = linked.join(roots(linked), "id")
    named = words.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    shown = ends.join(named.select(F.col("_id").alias("to"), F.col("_word").alias("form")), "to").join(
        named.select(F.col("_id").alias("root"), F.col("_word").alias("root_word")), "root").select("id", "form", "root_word")
    return rated.join(shown, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("to").isNotNull(), F.col("near_n")).alias("form_n"))


def op11_spelling_variants(documents: DataFrame) -> DataFrame:
    """Spelling variants of the words of ``documents``; see ``spelling_variants`` for odd rows."""
    return spelling_variants(documents)
