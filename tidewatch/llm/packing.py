"""Packing token sequences: best fit in streams, large pieces first, with a bound on open bins."""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

import tidewatch.llm.memory  # noqa: F401 - applies in every worker that imports this

END = 2
LENGTH = 1024
OPEN_BINS = 4_096  # of the pieces that the check's tables give a stream, about 4,500 would be open at once without a bound
STREAM_PIECES = 20_000  # pieces that one packer takes, about; they come to it large first
_SEQUENCE_BITS = 40


def _engine(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE file in the form of ranks, whose merges run several times as fast.

    The rank of an entry is its id, which grows with the order of merges.  Added tokens are found in the text first, as the
    file says.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    added = {token["content"]: token["id"] for token in content["added_tokens"]}
    # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up, in order.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    code = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    merged = {a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
    ranks = {bytes(code[c] for c in entry): number for entry, number in model["vocab"].items()
             if len(entry) == 1 or entry in merged}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


PIECES = T.StructType([T.StructField("row", T.LongType()), T.StructField("piece", T.IntegerType()),
                       T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                       T.StructField("ids_crc32", T.LongType())])


def _cut(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(_engine(path).encode, allowed_special="all", disallowed_special=())
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out = [[] for _ in PIECES]
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = array("I", encode(text or "")).tobytes() + end
                total = len(tokens) // 4
                start, piece = 0, 0
                while start < total:
                    size = min((total - start) % length or length, total - start)
                    body = tokens[4 * start:4 * (start + size)]
                    for column, value in zip(out, (row, piece, start, size, zlib.crc32(body))):
                        column.append(value)
                    start, piece = start + size, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                PIECES.names)
    return run


class BestFit:
    """Open bins on a shelf for each free space; one bit of ``mask`` says whether a shelf has any."""

    def __init__(self, capacity: int, bins: int):
        self.capacity, self.bins = capacity, bins
        self.shelves: list[list[int]] = [[] for _ in range(capacity)]
        self.mask, self.open, self.opened = 0, 0, 0

    def _take(self, free: int) -> int:
        shelf = self.shelves[free]
        number = shelf.pop()
        if not shelf:
            self.mask &= ~(1 << free)
        self.open -= 1
        return number

    def put(self, size: int) -> tuple[int, int]:
        """Bin and offset of a piece: the fullest open bin it fits into, else a new one."""
        fitting = self.mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.opened
            self.opened += 1
        left = free - size
        if left:
            if self.open == self.bins:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
            self.shelves[left].append(number)
            self.mask |= 1 << left
            self.open += 1
        return number, self.capacity - free


def _pack(length: int, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, packer = None, None
        for batch in batches:
            streams, sizes = (batch.column(k).to_pylist() for k in ("_stream", "length"))
            numbers, offsets = [0] * len(sizes), [0] * len(sizes)
            for i, (key, size) in enumerate(zip(streams, sizes)):
                if key != stream:
                    stream, packer = key, BestFit(length, bins)
                number, offsets[i] = packer.put(size)
                numbers[i] = (key << _SEQUENCE_BITS) | number
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                                             [*batch.schema.names, "sequence_id", "offset"])
    return run


def token_pieces(documents: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``(row, piece, start, length, ids_crc32)``: texts as ids with an end mark, cut so that only a first piece is short.

    ``documents`` has ``doc_id`` and ``text``; a null or empty text is the end mark alone.  Texts are not shuffled.
    """
    return documents.select(F.col("doc_id").cast("long").alias("row"), "text").mapInArrow(_cut(tokenizer, length), PIECES)


def best_fit_packing(documents: DataFrame, tokenizer: str, length: int = LENGTH, bins: int = OPEN_BINS,
                     stream_pieces: int = STREAM_PIECES) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it.

    Pieces are dealt at random, by a hash, into streams of about ``stream_pieces``; each stream has one packer that sees
    its pieces once, large ones first, and holds ``bins`` open bins.  A task's memory is those bins.  The number
    of streams follows from the number of documents.  Repeated rows are packed each; an empty table gives an empty table.
    """
    rows = documents.count()
    streams = max(1, round(rows / stream_pieces))
    place = F.xxhash64("row", "piece", "length", "ids_crc32")
    dealt = (token_pieces(documents, tokenizer, length).withColumn("_place", place)
             .withColumn("_stream", F.pmod(F.hash("_place"), F.lit(streams)).cast("long"))
             .repartition("_stream").sortWithinPartitions("_stream", F.desc("length"), "_place", "row", "piece"))
    schema = T.StructType([*dealt.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.mapInArrow(_pack(length, bins), schema).select(
        F.col("row").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_best_fit_packing(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Pieces of each row and their places; a null or empty text is its end mark alone, repeated rows are packed each, an empty
    table gives an empty table."""
    return best_fit_packing(documents, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
