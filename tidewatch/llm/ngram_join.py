"""Similarity join on n-gram Jaccard: a blocked sparse matrix product of documents by n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.llm.chunks import NO_ID, answers_of, ask, bucket_count, pack, rows_of, squeeze, expand, unpack, with_answers
from tidewatch.llm.rows import components, numbered
from tidewatch.llm.text import lowered, mix, ngram_sets, slices
from tidewatch.session import stored

GRAM, PERCENT = 4, 85
BLOCK_GRAMS = 150_000  # n-grams in a block of documents, about
DOCUMENT_GRAMS = 256  # what a document counts besides its n-grams, so that a block has a bounded number of rows
LISTED = 24  # columns with more documents are multiplied as a dense strip
STRIP = 2048


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """N-grams that a set of ``n`` must share with any set it links to."""
    return -(-percent * n // 100)


def candidate_part(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many n-grams of a set, smallest hashes first, are looked at, and how many of them a link shares at least.

    Two linked sets of n and m share ``needed`` n-grams, so the first ``n - needed + k`` of the one and ``m - needed + k``
    of the other share k.  k is 15 in 100 of the set, and what counts is the k of the smallest set that it can link to.
    """
    spare = n - needed(n, percent)
    k = np.maximum(1, -(-(100 - percent) * n // 100))
    least = np.maximum(1, -(-(100 - percent) * needed(n, percent) // 100))
    return np.minimum(n, spare + k), least


class _Sets:
    """The n-gram sets of a chunk's documents."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, gram: int, percent: int):
        grams, bounds = [], [np.zeros(1, np.int64)]
        for _, part, inner in slices(_as_array(data, offsets)):
            found, edges = ngram_sets(lowered(part), inner, gram)
            grams.append(found)
            bounds.append(edges[1:] + bounds[-1][-1])
        self.ids, self.grams = ids, np.concatenate([*grams, np.zeros(0, np.uint64)])
        self.bounds = np.concatenate(bounds)
        self.n = np.diff(self.bounds)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.grams ^ np.uint64(0x5851F42D4C957F2D)))))
        # one number for a whole set; equal sets, and by all odds no others, have the same
        self.node = mix(sums[self.bounds[1:]] - sums[self.bounds[:-1]] + self.n.astype(np.uint64)).view(np.int64)
        full = np.flatnonzero(self.n)
        self.first = full[np.unique(self.node[full], return_index=True)[1]]  # a document of each distinct set
        self.part, self.least = candidate_part(self.n, percent)

    def looked_at(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``grams`` of what is looked at, and the document of each, for one document of each set."""
        lengths = self.part[self.first]
        ends = np.cumsum(lengths)
        place = np.repeat(self.bounds[self.first] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return place, np.repeat(self.first, lengths)


def _as_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def _short(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(16)


def _asked(gram: int, percent: int):
    def keys_of(ids, data, offsets):
        sets = _Sets(ids, data, offsets, gram, percent)
        return np.unique(_short(sets.grams[sets.looked_at()[0]]), return_counts=True)
    return keys_of


_MEMBER = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
                        T.StructField("chunk", T.LongType()), T.StructField("row", T.LongType())])


def _members(gram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            sets = _Sets(*unpack(row), gram, percent)
            count = len(sets.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.ids, mask=sets.ids == NO_ID), pa.array(sets.n), pa.array(sets.node, mask=sets.n == 0),
                 pa.array(np.full(count, row["chunk"])), pa.array(np.arange(count))], _MEMBER.names)
    return run


_ENTRY = T.StructType([T.StructField("gram", T.LongType()), T.StructField("node", T.LongType()), T.StructField("n", T.LongType())])


def _entries(gram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            sets = _Sets(*unpack(row), gram, percent)
            place, doc = sets.looked_at()
            grams = sets.grams[place]
            short = _short(grams)
            step = answers_of(row)[np.searchsorted(np.unique(short), short)] if len(short) else np.zeros(0, np.uint8)
            # rare n-grams first; those of a single document link nothing, but they use up places
            shared = step > 0
            alone = np.bincount(doc[~shared], minlength=len(sets.n))
            grams, doc, step = grams[shared], doc[shared], step[shared]
            order = np.lexsort((grams, step, doc))
            grams, doc = grams[order], doc[order]
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            use = rank + alone[doc] < sets.part[doc] - sets.least[doc] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[use].view(np.int64)), pa.array(sets.node[doc[use]]), pa.array(sets.n[doc[use]])], _ENTRY.names)
    return run


_BLOCK = T.StructType([T.StructField("b1", T.LongType()), T.StructField("b2", T.LongType()), T.StructField("side", T.BinaryType()),
                       T.StructField("nodes", T.BinaryType()), T.StructField("ns", T.BinaryType()), T.StructField("grams", T.BinaryType())])


def _deal(gram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            if not row["answers"]:
                continue
            sets = _Sets(*unpack(row), gram, percent)
            tasks: dict[tuple[int, int], list] = {}
            for want in row["answers"]:
                for task in want["tasks"]:
                    tasks.setdefault((task["b1"], task["b2"]), []).append((want["block"] == task["b2"], want["row"]))
            for (b1, b2), docs in tasks.items():
                rows = np.array([r for _, r in docs])
                yield pa.RecordBatch.from_pydict({
                    "b1": pa.array([b1], pa.int64()), "b2": pa.array([b2], pa.int64()),
                    "side": [np.array([s for s, _ in docs], np.uint8).tobytes()], "nodes": [sets.node[rows].tobytes()],
                    "ns": [sets.n[rows].tobytes()],
                    "grams": [np.concatenate([sets.grams[sets.bounds[r]:sets.bounds[r + 1]] for r in rows]).tobytes()]})
    return run


def overlaps(grams: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Product of the incidence matrix with its transpose: n-grams that each two of ``rows`` documents share.

    Short columns add their pairs one by one, long ones are multiplied in dense strips.
    """
    order = np.argsort(grams, kind="stable")
    grams, doc = grams[order], doc[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = grams[1:] != grams[:-1]
    column = np.cumsum(fresh) - 1
    length = np.bincount(column)
    shared = length[column] > 1
    doc, column = doc[shared], column[shared]
    long_ = length[column] > LISTED
    out = np.zeros(rows * rows, np.int32)
    d, c = doc[~long_], column[~long_]
    for step in range(1, LISTED):
        same = np.flatnonzero(c[step:] == c[:-step]) if len(c) > step else []
        if not len(same):
            break
        np.add.at(out, d[same] * rows + d[same + step], 1)
    out = out.reshape(rows, rows)
    out = out + out.T
    d, c = doc[long_], column[long_]
    if len(c):
        c = np.unique(c, return_inverse=True)[1]
        for first in range(0, int(c.max()) + 1, STRIP):
            low, high = np.searchsorted(c, (first, first + STRIP))
            strip = np.zeros((rows, STRIP), np.float32)
            strip[d[low:high], c[low:high] - first] = 1
            out += np.rint(strip @ strip.T).astype(np.int32)
    return out


def _product(percent: int):
    def run(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])
        side, nodes, ns, grams = joined("side", np.uint8), joined("nodes", np.int64), joined("ns", np.int64), joined("grams", np.uint64)
        rows = len(nodes)
        crossing = table.column("b1")[0].as_py() != table.column("b2")[0].as_py()
        shared = overlaps(grams, np.repeat(np.arange(rows), ns), rows)
        # 100 * shared >= percent * (n + m - shared), row by row: whole matrices of wide numbers would take most of the memory
        link = np.empty((rows, rows), bool)
        for k in range(rows):
            link[k] = (100 + percent) * shared[k].astype(np.int64) >= percent * (ns[k] + ns)
        del shared
        np.fill_diagonal(link, False)
        if crossing:
            link &= side[:, None] != side[None, :]
        label = np.arange(rows)
        while True:  # smallest row that each one reaches
            new = np.minimum(label, np.where(link, label[None, :], rows).min(1, initial=rows))
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        links = link.sum(1)
        kept = np.flatnonzero(links)
        return pa.table({"a": pa.array(nodes[kept]), "b": pa.array(nodes[label[kept]]), "links": pa.array(links[kept].astype(np.int64))})
    return run


def ngram_join(documents: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` of each document.

    Two documents link when the Jaccard similarity of their sets of ``gram``-word shingles is ``percent`` in 100 or more;
    a component is what links join, named by its smallest id; ``n_links`` counts the other distinct sets that a document's
    set links to.  Equal sets are one row of the matrix.  A set without n-grams links nothing, and null ids give a null
    component only where no member has an id.  Repeated rows are copies.

    1. Of each set, the part that a link must meet (``candidate_part``) asks in how many documents its n-grams are; taken
       rarest first, two linked sets meet in a few of them.  Sets that meet are clusters, found through each n-gram's
       smallest set, not through pairs.
    2. Clusters, in order of size, are cut into blocks of bounded size.  The product of two blocks is one task; pairs of
       blocks whose sizes are too far apart are left out.  It adds up overlaps and drops pairs below the bound of their sizes.
    3. A task reports a forest of its links, at most a row for each document.
    """
    chunks = pack(documents, "ngram-chunks")
    buckets = bucket_count(chunks)
    members = stored(chunks.mapInArrow(_members(gram, percent), _MEMBER), "ngram-members")
    told = ask(chunks, _asked(gram, percent), buckets)
    entries = stored(told.mapInArrow(_entries(gram, percent), _ENTRY), "ngram-entries")
    lists = entries.groupBy("gram").agg(F.min("node").alias("b"), F.max("node").alias("top")).filter("b < top").drop("top")
    clusters = components(entries.join(lists, "gram").select(F.col("node").alias("a"), "b"), "ngram-clusters")
    sized = clusters.join(entries.groupBy("node").agg(F.max("n").alias("n")), "node")
    placed = numbered(sized.withColumn("_w", F.col("n") + DOCUMENT_GRAMS), ["component", "n", "node"], "ngram-order", "_w")
    placed = stored(placed.select("node", "component", "n", F.call_function("div", "before", F.lit(BLOCK_GRAMS)).alias("block")), "ngram-blocks")
    extents = stored(placed.groupBy("component", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")), "ngram-extents")
    smaller, larger = extents.alias("s"), extents.alias("l")
    tasks = smaller.join(larger, (F.col("s.component") == F.col("l.component")) & (F.col("s.block") <= F.col("l.block"))
                         & (percent * F.col("l.low") <= 100 * F.col("s.high"))).select(
        F.col("s.component").alias("component"), F.col("s.block").alias("b1"), F.col("l.block").alias("b2"))
    task = F.struct("b1", "b2").alias("task")
    by_block = tasks.select("component", F.col("b1").alias("block"), task).unionByName(
        tasks.select("component", F.col("b2").alias("block"), task)).groupBy("component", "block").agg(
        F.collect_set("task").alias("tasks"))
    held = members.filter("n > 0").groupBy("node").agg(F.min(F.struct("chunk", "row")).alias("at"))
    wanted = placed.join(by_block, ["component", "block"]).join(held, "node").select(
        F.col("at.chunk").alias("chunk"), F.struct(F.col("at.row").alias("row"), "block", "tasks").alias("answer"))
    dealt = with_answers(chunks, wanted).filter("answers is not null").mapInArrow(_deal(gram, percent), _BLOCK)
    links = stored(dealt.groupBy("b1", "b2").applyInArrow(_product(percent), "a long, b long, links long"), "ngram-links")

    joined = components(links.select("a", "b"), "ngram-components")
    smallest = members.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("_least"))
    named = smallest.join(joined, "node", "left").withColumn("_class", F.coalesce("component", "node"))
    classes = named.groupBy("_class").agg(F.min("_least").alias("component_id"))
    nodes = named.join(classes, "_class").join(links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links")), "node", "left")
    return members.join(nodes.select("node", "component_id", "n_links"), "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def op1_ngram_jaccard(documents: DataFrame) -> DataFrame:
    """Set size, component and number of links of each row; repeated rows link with each other, texts that are null or without
    words with nothing, an empty table gives an empty table.  Columns beside ``doc_id`` and ``text`` do not matter."""
    return ngram_join(documents)
