"""Exact top-k by inner product: columnar branch and bound over blocks of candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidewatch.llm.chunks import rows_of
from tidewatch.session import stored

SCALE = 64
TOP = 20
CANDIDATES, QUERIES = 4096, 512  # vectors in a block, about
STRIP = 32  # queries whose candidates are compacted together
DIMENSIONS = 16  # columns between two checks of the bounds
LANE_BLOCKS, LEAST_LANES = 32, 8  # blocks of candidates in one task, at most, and how many such lanes there are at least
PART_BLOCKS = 128  # blocks of queries in one task, at most
EXACT = float(2 ** 53)

_BLOCK = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.BinaryType()),
                       T.StructField("dims", T.IntegerType()), T.StructField("short", T.BooleanType()),
                       T.StructField("columns", T.BinaryType())])


def _columnar(table: pa.Table) -> pa.Table:
    """A group of vectors as one row, column after column; shorter vectors end in zeros."""
    ids = table.column("id").to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    vectors = table.column("v").combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    dims = int(lengths.max(initial=0))
    matrix = np.zeros((len(ids), dims))
    matrix[np.arange(dims) < lengths[:, None]] = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False))
    columns = np.ascontiguousarray(matrix[order].T)
    short = bool(np.abs(columns).max(initial=0) < 2 ** 15)
    return pa.table({"block": table.column("block").slice(0, 1), "ids": [ids[order].tobytes()], "dims": pa.array([dims], pa.int32()),
                     "short": [short], "columns": [columns.astype(np.int16 if short else float).tobytes()]})


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["columns"], np.int16 if row["short"] else float).reshape(row["dims"], len(ids)).astype(float)


def _blocks(vectors: DataFrame, per_block: int, label: str) -> tuple[DataFrame, int]:
    number = max(1, -(-vectors.count() // per_block))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(number)).cast("long"))
    return stored(dealt.groupBy("block").applyInArrow(_columnar, _BLOCK), label), number


def _rest(columns: np.ndarray) -> np.ndarray:
    """Length of what remains of each vector from each strip of dimensions on, rounded up."""
    squares = np.add.reduceat(np.square(columns), np.arange(0, len(columns), DIMENSIONS), axis=0)
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1]) * (1 + 1e-12)


class Best:
    """The best ``top`` of each query so far, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, top: int):
        self.ids, self.top = ids, top
        self.scores = [np.zeros(0)] * len(ids)
        self.found = [np.zeros(0, np.int64)] * len(ids)
        self.least = np.full(len(ids), -np.inf)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.ids[query]
        scores = np.concatenate([self.scores[query], scores[other]])
        ids = np.concatenate([self.found[query], ids[other]])
        order = np.lexsort((ids, -scores))[:self.top]
        self.scores[query], self.found[query] = scores[order], ids[order]
        if len(order) == self.top:
            self.least[query] = scores[order[-1]]


def bound_and_branch(best: Best, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray) -> None:
    """Add a block of candidates: scores grow strip by strip of dimensions, and candidates that no query of a strip of
    queries can still use, by the product of remaining lengths, are left out of the next."""
    dims = max(len(queries), len(candidates))
    if not dims or not len(ids):
        for q in range(len(best.ids)):
            best.add(q, np.zeros(len(ids)), ids)
        return
    queries, candidates = (np.pad(m, ((0, dims - len(m)), (0, 0))) if len(m) < dims else m for m in (queries, candidates))
    if np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * dims >= EXACT:
        return _in_whole_numbers(best, queries, ids, candidates)
    rest_q, rest_c = _rest(queries), _rest(candidates)
    for first in range(0, queries.shape[1], STRIP):
        strip = slice(first, min(first + STRIP, queries.shape[1]))
        least = best.least[strip]
        alive = np.arange(candidates.shape[1])
        score = np.zeros((strip.stop - first, len(alive)))
        for number, at in enumerate(range(0, dims, DIMENSIONS)):
            part = candidates[at:at + DIMENSIONS]
            score += queries[at:at + DIMENSIONS, strip].T @ (part if len(alive) == part.shape[1] else part[:, alive])
            if at + DIMENSIONS < dims and np.isfinite(least).all():
                reach = score + rest_q[number + 1, strip, None] * rest_c[number + 1, alive]
                some = (reach >= least[:, None] - 1e-6 * np.abs(least[:, None])).any(0)
                if some.mean() < 0.8:
                    alive, score = alive[some], score[:, some]
        for q in range(score.shape[0]):
            hit = np.flatnonzero(score[q] >= least[q])
            hit = hit[ids[alive[hit]] != best.ids[first + q]]  # before the cut: many rows may have the query's id
            if len(hit) > 4 * best.top:
                cut = np.partition(score[q, hit], -best.top)[-best.top]
                hit = hit[score[q, hit] >= cut]
            if len(hit):
                best.add(first + q, score[q, hit], ids[alive[hit]])


def _in_whole_numbers(best: Best, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray) -> None:
    """For values too large for exact floating sums; scores beyond 64 bits are held at their ends."""
    whole = [[int(x) for x in column] for column in candidates.T]
    for q, query in enumerate(queries.T):
        query = [int(x) for x in query]
        scores = [min(max(sum(a * b for a, b in zip(query, c)), -2 ** 63), 2 ** 63 - 1) for c in whole]
        order = sorted((k for k in range(len(ids)) if ids[k] != best.ids[q]), key=lambda k: (-scores[k], ids[k]))
        best.scores[q] = np.concatenate([best.scores[q].astype(object), np.array([scores[k] for k in order], object)])
        best.found[q] = np.concatenate([best.found[q], ids[order]])
        order = sorted(range(len(best.found[q])), key=lambda k: (-best.scores[q][k], best.found[q][k]))[:best.top]
        best.scores[q], best.found[q] = best.scores[q][order], best.found[q][order]
        if len(order) == best.top:
            best.least[q] = float(best.scores[q][-1])


_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def _search(top: int):
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        query_ids, ids, scores = [], [], []
        for query_row in rows_of(asked.to_batches()):
            own, queries = _unpacked(query_row)
            best = Best(own, top)
            for row in rows_of(held.to_batches()):
                bound_and_branch(best, queries, *_unpacked(row))
            query_ids.append(np.repeat(own, [len(part) for part in best.scores]))
            ids.extend(best.found)
            scores.extend(int(score) for part in best.scores for score in part)
        nothing = np.zeros(0, np.int64)
        return pa.table([pa.array(np.concatenate([*query_ids, nothing])), pa.array(np.concatenate([*ids, nothing])),
                         pa.array(scores, pa.int64())], names=_FOUND.names)
    return run


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``(id, v)``, without null ids and vectors that are null or hold a null or a number that is not finite.

    Components enter the blocks times ``SCALE``, rounded down.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = ~F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), x.alias("_x")).filter(
        F.col("id").isNotNull() & F.col("_x").isNotNull()).filter(good)
    return rows.select("id", F.col("_x").alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` largest inner products of each query with all other ids.

    Queries and candidates are cut into blocks of bounded size.  Candidates are dealt into lanes and queries into parts; a
    task takes the queries of a part, block by block, through the blocks of a lane and carries their best, which bound the
    next block.  So candidates are shuffled once for each part and queries once for each lane, and both are few.  Vectors of
    unlike lengths meet as if ended by zeros.  Rows with a query's id count as the query's own, other repeated rows count
    each, and a repeated query is answered once.  Other columns are not read, and an empty table gives an empty table.
    """
    blocks, number = _blocks(vectors, CANDIDATES, "candidates")
    asked, query_blocks = _blocks(queries.dropDuplicates(["id"]), QUERIES, "queries")
    lanes, parts = max(LEAST_LANES, -(-number // LANE_BLOCKS)), -(-query_blocks // PART_BLOCKS)

    def each(count: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    left = asked.select("*", F.pmod("block", F.lit(parts)).cast("int").alias("_part"), each(lanes, "_lane"))
    right = blocks.select("*", F.pmod("block", F.lit(lanes)).cast("int").alias("_lane"), each(parts, "_part"))
    found = left.groupBy("_lane", "_part").cogroup(right.groupBy("_lane", "_part")).applyInArrow(_search(top), _FOUND)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


def op10_exact_top_k(embeddings: DataFrame) -> DataFrame:
    """The 20 best of all other rows for each row whose id 20 divides; see ``whole_vectors`` and ``top_k`` for odd rows."""
    vectors = stored(whole_vectors(embeddings), "vectors")
    return top_k(vectors, vectors.filter(F.col("id") % 20 == 0))
