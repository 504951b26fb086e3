"""Alignment of two tokenizers over the same bytes: which tokens overlap, where both end, and which id pairs belong together."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.llm.chunks import expand, rows_of, squeeze
from tidewatch.llm.packing import _engine
from tidewatch.llm.text import slices
from tidewatch.session import stored

CACHED_WORDS, CACHED_LENGTH = 300_000, 64
_between_words = re.compile("(?<! ) ").split


class WordPieces(dict):
    """Ids of B for a blank and the word after it, as bytes, found once each; None where their bytes are not those of the word.

    Texts are cut at blanks that follow another character, which no piece may hold within (``cuts``); further blanks stay with
    the word after them.  Without that property a text is one word.
    """

    def __init__(self, path: str):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.cuts = all("▁" not in piece.lstrip("▁") for piece in pieces)
        self.bytes = [bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()
                      for k, piece in enumerate(pieces)]
        self.blank = self.model.piece_to_id("▁")

    def _split(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        return text.split(" ") if text[0] != " " and "  " not in text else _between_words(" " + text)[1:]

    def of(self, texts: list[str]) -> list[bytes | None]:
        """Ids of each text that is not empty; None where their bytes are not a blank and the text.

        The words that are not known yet are encoded together.
        """
        split = [self._split(text) if text else [] for text in texts]
        words = set().union(*split)
        new = list(words.difference(self))
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = list(words)
        for word, found in zip(new, self.model.encode(new, num_threads=1)):
            found = found or [self.blank]
            spelt = b"".join(map(self.bytes.__getitem__, found)) == b" " + word.encode()
            self[word] = array("i", found).tobytes() if spelt else None
        out = []
        for parts in split:
            ids = [self[word] for word in parts]
            out.append(None if not ids or None in ids else b"".join(ids))
        for word in new:
            if len(word) > CACHED_LENGTH:
                del self[word]
        return out


class Tokenizers:
    """Both vocabularies: ids of a text, and the lengths and printed forms of ids.

    A is a byte-level BPE file, which gets a space before the text; B is a piece model, which adds that space itself.  Strings
    of special tokens in a text are plain text.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = _engine(a_path), WordPieces(b_path)
        self.a_bytes = [self._a_entry(k) for k in range(self.a.n_vocab)]
        self.a_length, self.b_length = (np.array([len(entry) for entry in table]) for table in (self.a_bytes, self.b.bytes))
        self.every_byte = {bytes([k]) for k in range(256)} <= set(self.a_bytes)  # then A spells whatever it is given

    def _a_entry(self, number: int) -> bytes:
        try:
            return self.a.decode_single_token_bytes(number)
        except KeyError:  # a number without an entry
            return b""

    @cached_property
    def printed(self) -> list[bytes]:
        """Ids with what follows them: A's as ``,`` or ``|`` (the last of a group), then B's as ``,`` or ``;``."""
        return [b"%d%s" % (k, sign) for signs, count in (((b",", b"|"), len(self.a_length)), ((b",", b";"), len(self.b_length)))
                for k in range(count) for sign in signs]

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where either side's bytes are not those of the text with a space before it."""
        nothing = np.zeros(0, np.int32)
        out = []
        for text, b in zip(texts, self.b.of(texts)):
            a = self.a.encode_to_numpy(" " + text, disallowed_special=()) if b else nothing
            if b and not self.every_byte and b"".join(self.a_bytes[k] for k in a) != b" " + text.encode():
                a, b = nothing, None
            out.append((a, np.frombuffer(b, np.int32) if b else nothing))
        return out


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of an A and a B token of a document whose ranges overlap.

    Tokens of a side lie end to end from their document's first byte, so the token that covers a byte is the last one to start
    at or before it.  Each A start finds its B token and each B start its A token; pairs that start together are found twice
    and kept once.  Starts ascend over the documents.
    """
    a = pd.DataFrame({"doc": doc_a, "at": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"doc": doc_b, "at": start_b, "b": np.arange(len(start_b))})
    down = pd.merge_asof(a, b, on="at", by="doc")
    up = pd.merge_asof(b, a, on="at", by="doc")
    alone = start_a[up["a"].to_numpy()] != start_b
    return (np.concatenate([down["a"].to_numpy(), up["a"].to_numpy()[alone]]),
            np.concatenate([down["b"].to_numpy(), up["b"].to_numpy()[alone]]))


class Aligned:
    """Alignment of some texts: counts and printed groups of each, and the id pairs that each one links."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str | None]):
        found = tokenizers.ids([text or "" for text in texts])
        self.n_a, self.n_b = (np.array([len(ids[side]) for ids in found], np.int64) for side in (0, 1))
        a, b = (np.concatenate([ids[side] for ids in found]).astype(np.int64) for side in (0, 1))
        end_a, end_b = np.cumsum(tokenizers.a_length[a]), np.cumsum(tokenizers.b_length[b])
        docs = np.arange(len(texts))
        doc_a, doc_b = np.repeat(docs, self.n_a), np.repeat(docs, self.n_b)
        both = end_a[np.isin(end_a, end_b, assume_unique=True)]
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        last_a, last_b = (np.diff(g, append=len(both)) > 0 for g in (group_a, group_b))
        self.n_groups = np.bincount(doc_a[last_a], minlength=len(texts))
        self.sha256 = self._printed(tokenizers, a, b, group_a, group_b, last_a, last_b)
        if len(a):
            at_a, at_b = overlaps(doc_a, end_a - tokenizers.a_length[a], doc_b, end_b - tokenizers.b_length[b])
        else:
            at_a = at_b = np.zeros(0, np.int64)
        self.n_links = np.bincount(doc_a[at_a], minlength=len(texts))
        wide = len(tokenizers.b_length)
        every = len(tokenizers.a_bytes) * wide
        keys, self.times = np.unique(doc_a[at_a] * every + a[at_a] * wide + b[at_b], return_counts=True)
        self.bounds = np.searchsorted(keys, np.arange(len(texts) + 1) * every)
        self.pairs, self.which, self.documents = np.unique(keys % every, return_inverse=True, return_counts=True)

    def _printed(self, tokenizers, a, b, group_a, group_b, last_a, last_b) -> list[str]:
        before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b))))
        upto_a = np.cumsum(np.bincount(group_a))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + before_b[group_a]] = 2 * a + last_a
        codes[np.arange(len(b)) + upto_a[group_b]] = 2 * (b + len(tokenizers.a_bytes)) + last_b
        out, codes = [], codes.tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        for first, last in zip([0, *ends], ends):
            shown = b"".join(map(tokenizers.printed.__getitem__, codes[first:last]))
            out.append(hashlib.sha256(shown[:-1]).hexdigest() if shown else "")
        return out


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
                       *[T.StructField(name, T.ArrayType(T.LongType())) for name in _COUNTS],
                       T.StructField("groups_sha256", T.ArrayType(T.StringType())), T.StructField("bounds", T.BinaryType()),
                       T.StructField("which", T.BinaryType()), T.StructField("times", T.BinaryType()),
                       T.StructField("pairs", T.BinaryType()), T.StructField("documents", T.BinaryType())])
_BLOBS = {"bounds": np.int64, "which": np.uint32, "times": np.uint32, "pairs": np.int64, "documents": np.uint32}


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, _, offsets in slices(batch.column(1)):
                part = batch.slice(first, len(offsets) - 1)
                found = Aligned(tokenizers, part.column(1).to_pylist())
                values = {"chunk": pa.array([number], pa.int64()), "doc_ids": [part.column(0).to_pylist()],
                          **{name: [getattr(found, name)] for name in _COUNTS}, "groups_sha256": [found.sha256],
                          **{name: [squeeze(getattr(found, name).astype(kind))] for name, kind in _BLOBS.items()}}
                values["doc_ids"] = pa.array(values["doc_ids"], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(values)
                number += 1
    return run


def _blob(row: dict, name: str) -> np.ndarray:
    return np.frombuffer(expand(row[name]), _BLOBS[name])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        pairs = _blob(row, "pairs")
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["chunk"])), pa.array(pairs),
                                          pa.array(_blob(row, "documents").astype(np.int64))], ["chunk", "pair", "documents"])


_RESULT = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(name, T.LongType()) for name in _COUNTS],
                        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                        T.StructField("groups_sha256", T.StringType())])


def _rated(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    row = chunk.to_pylist()[0]
    order = np.argsort(answers.column("pair").to_numpy())
    count, best = (answers.column(name).to_numpy()[order].astype(np.int64) for name in ("count", "best"))
    which, times, bounds = (_blob(row, name) for name in ("which", "times", "bounds"))
    sums = [np.concatenate(([0], np.cumsum(times * values[which]))) if len(which) else np.zeros(1, np.int64) for values in (best, count)]
    n_best, count_sum = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
    return pa.table([pa.array(row["doc_ids"], pa.int64()), *[pa.array(row[name], pa.int64()) for name in _COUNTS],
                     pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(row["groups_sha256"], pa.string())],
                    names=_RESULT.names)


def aligned_chunks(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents (``doc_id``, ``text``) in chunks of a few megabytes, aligned, with the distinct id pairs of each; stored."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_align(a_path, b_path), _CHUNK), "aligned-chunks")


def pair_counts(chunks: DataFrame, b_size: int) -> DataFrame:
    """``(pair, a, count, best)``: documents in which A id ``a`` overlaps B id ``pair % b_size``, and whether none of ``a`` has more.

    Each chunk sends one row for each of its pairs.  What is broadcast has a row for each id of A's vocabulary at most.
    """
    counts = stored(chunks.mapInArrow(_pairs, "chunk long, pair long, documents long").groupBy("pair").agg(
        F.sum("documents").alias("count")).withColumn("a", F.call_function("div", "pair", F.lit(b_size))), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), "a").select("pair", "a", "count", (F.col("count") == F.col("highest")).alias("best"))


def token_alignment(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of each document.

    Texts are tokenized and aligned once, by chunk.  Chunks ask for the counts of their distinct pairs over all documents, and
    each chunk's answers come back to it as one group, whose size is that of the chunk.

    A null or empty text, or one whose tokens do not spell it, has no tokens: counts of 0 and an empty digest.  Repeated rows
    are documents of their own in results and counts, a null id stays null, other columns are not read, and an empty table
    gives an empty table.
    """
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    chunks = aligned_chunks(documents, a_path, b_path)
    asked = chunks.mapInArrow(_pairs, "chunk long, pair long, documents long").select("chunk", "pair")
    told = asked.join(pair_counts(chunks, b_size).select("pair", "count", F.col("best").cast("int").alias("best")), "pair")
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_rated, _RESULT)


def op13_token_alignment(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``byte_bpe_50k.json`` against ``piece_bpe_32k.model`` over ``documents``; see ``token_alignment`` for odd rows."""
    return token_alignment(documents, a_path or public_tokenizers.path("byte_bpe_50k.json"),
                           b_path or public_tokenizers.path("piece_bpe_32k.model"))
