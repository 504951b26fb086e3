"""Whole texts in chunks, and questions about hashed keys that all chunks ask together.

A chunk is a few megabytes of consecutive texts as one row.  Keys are asked about in blocks: each chunk sends its distinct
keys once, cut at fixed borders into buckets; a bucket counts in how many documents each key is, and sends one byte for
each key back.  So a key that a third of all documents share reaches a bucket once from each chunk, and what is shuffled
are a few rows of packed numbers instead of a row for each key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.llm.text import slices
from tidewatch.session import stored

NO_ID = 2 ** 63 - 1
BUCKET_BYTES = 8 << 20  # of text for each bucket of keys
LEAST_BUCKETS = 32

CHUNK = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.BinaryType()),
                      T.StructField("lengths", T.BinaryType()), T.StructField("texts", T.BinaryType()),
                      T.StructField("size", T.LongType())])


def squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def expand(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, data, offsets in slices(batch.column(1)):
            rows = len(offsets) - 1
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([number], pa.int64()), "ids": [squeeze(ids[first:first + rows])],
                "lengths": [squeeze(np.diff(offsets))], "texts": [squeeze(data)], "size": pa.array([len(data)], pa.int64())})
            number += 1


def pack(documents: DataFrame, label: str) -> DataFrame:
    """Documents (``doc_id``, ``text``) in chunks, stored, so that later passes see the same chunks.

    A null text has no bytes; a null id is ``NO_ID``, which nothing is smaller than.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_pack, CHUNK), label)


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of a chunk."""
    ids, lengths = (np.frombuffer(expand(row[k]), np.int64) for k in ("ids", "lengths"))
    return ids, np.frombuffer(expand(row["texts"]), np.uint8), np.concatenate(([0], np.cumsum(lengths)))


def bucket_count(chunks: DataFrame) -> int:
    """So many buckets that each gets the keys of a bounded amount of text."""
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):  # one at a time: a row is large
            yield batch.slice(at, 1).to_pylist()[0]


def _planes(keys: np.ndarray) -> np.ndarray:
    """The six bytes of ascending 48-bit keys, place by place: the leading ones hardly vary and take no room."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :6].T)


def _keys(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return out.view(np.uint64).ravel()


QUESTION = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("chunk", T.LongType()),
                         T.StructField("n", T.LongType()), T.StructField("blob", T.BinaryType())])


def _asking(keys_of: Callable, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = np.array([-(-(b << 48) // buckets) for b in range(buckets + 1)], np.uint64)
        for row in rows_of(batches):
            keys, counts = keys_of(*unpack(row))
            cuts = np.searchsorted(keys, borders)
            used = np.flatnonzero(np.diff(cuts))
            blobs = [squeeze(_planes(keys[cuts[b]:cuts[b + 1]]), np.minimum(counts[cuts[b]:cuts[b + 1]], 255).astype(np.uint8))
                     for b in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([row["chunk"]] * len(used), pa.int64()),
                 pa.array(np.diff(cuts)[used], pa.int64()), pa.array(blobs, pa.binary())], QUESTION.names)
    return run


def _answering(table: pa.Table) -> pa.Table:
    sizes = table.column("n").to_numpy()
    parts = [np.frombuffer(expand(blob), np.uint8).reshape(7, n) for blob, n in zip(table.column("blob").to_pylist(), sizes)]
    keys = np.concatenate([_keys(p[:6]) for p in parts])
    counts = np.concatenate([p[6] for p in parts]).astype(np.int64)
    order = np.argsort(keys)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[order][1:] != keys[order][:-1]
    starts = np.flatnonzero(fresh)
    total = np.add.reduceat(counts[order], starts)
    step = np.where(total > 1, np.ceil(np.log2(total + 1)), 0).astype(np.uint8)
    answers = np.empty(len(keys), np.uint8)
    answers[order] = np.repeat(step, np.diff(np.append(starts, len(keys))))
    bounds = np.cumsum(sizes)[:-1]
    return table.select(["bucket", "chunk", "n"]).append_column(
        "blob", pa.array([squeeze(a) for a in np.split(answers, bounds)], pa.binary()))


def questions(chunks: DataFrame, keys_of: Callable, buckets: int) -> DataFrame:
    """``(chunk, answer)``: what the buckets answer each chunk, see ``ask``."""
    asked = chunks.mapInArrow(_asking(keys_of, buckets), QUESTION)
    told = asked.groupBy("bucket").applyInArrow(_answering, QUESTION)
    return told.select("chunk", F.struct("bucket", "blob").alias("answer"))


def ask(chunks: DataFrame, keys_of: Callable, buckets: int) -> DataFrame:
    """``chunks`` with ``answers``: for each key a chunk asks about, 0 if one document has it, else a step that grows with
    the logarithm of the number of documents.

    ``keys_of(ids, data, offsets)`` gives ascending distinct 48-bit keys and the number of the chunk's documents with each.
    A step is a function of the key alone.  Keys that only share their 48 bits count as one: steps rank keys and rule out
    those of a single document, and must not be taken as proof of equality.
    """
    return with_answers(chunks, questions(chunks, keys_of, buckets))


def with_answers(chunks: DataFrame, told: DataFrame) -> DataFrame:
    """``chunks`` with all their ``answer`` values as an array (null where there are none)."""
    by_chunk = told.groupBy("chunk").agg(F.collect_list("answer").alias("answers"))
    return chunks.join(by_chunk, "chunk", "left")


def answers_of(row: dict) -> np.ndarray:
    """The steps of a chunk's keys, in the order of its keys."""
    parts = sorted(row["answers"] or [], key=lambda a: a["bucket"])
    return np.concatenate([np.frombuffer(expand(a["blob"]), np.uint8) for a in parts]) if parts else np.zeros(0, np.uint8)
