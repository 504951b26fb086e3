"""Removal of repeated byte strings by a distributed, sparse suffix order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.llm.chunks import NO_ID, answers_of, bucket_count, expand, pack, questions, rows_of, squeeze, unpack, with_answers
from tidewatch.llm.rows import numbered
from tidewatch.llm.text import mix, range_hashes
from tidewatch.session import stored

LENGTH = 50  # bytes of a string that counts as repeated
LEAD = 24  # leading bytes that choose a suffix; every string of LENGTH bytes holds a chosen one
REACH = LENGTH - LEAD + 1
SLICE_BYTES = 1 << 20
SEGMENT = 1 << 15  # strings looked at in one go
_PLACE_BITS = 18  # hold a place in a segment and its overhang
SAMPLE = 8  # one in so many chunks gives splitters
RANGES = 4096  # ranges of leading bytes at most, so that splitters stay small; more buckets are parts of ranges
_OFFSET = np.uint64(0x9FB21C651E98DF25)
_WORDS = [np.uint64(w) for w in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)]
_LOW = np.uint64((1 << _PLACE_BITS) - 1)


def _lead_hashes(part: np.ndarray) -> np.ndarray:
    """Hash of the LEAD bytes from each place; its upper 48 bits are the good ones."""
    count = len(part) - LEAD + 1
    eight = np.ndarray(len(part) - 7, "<u8", np.ascontiguousarray(part), strides=(1,)).astype(np.uint64)
    total = eight[:count] * _WORDS[0]
    total += eight[8:8 + count] * _WORDS[1]
    total ^= total >> np.uint64(29)
    total += eight[16:16 + count]
    total *= _WORDS[2]
    total ^= total >> np.uint64(32)
    total *= _WORDS[0]
    return total


def _chosen(data: np.ndarray, at: int, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of strings from ``at`` on, of those that lie ``whole`` in one text: the first and the last string, the
    place of the suffix that they choose, and its hash."""
    part = data[at:at + len(whole) + LENGTH - 1]
    hashes = _lead_hashes(part)
    ranked = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    for width in (1, 2, 4, 8):
        ranked = np.minimum(ranked[:-width], ranked[width:])
    chosen = np.minimum(ranked[:len(whole)], ranked[REACH - 16:REACH - 16 + len(whole)])
    moved = chosen[1:] != chosen[:-1]
    begin, stop = whole.copy(), whole.copy()
    begin[1:] &= moved | ~whole[:-1]
    stop[:-1] &= moved | ~whole[1:]
    first = np.flatnonzero(begin)
    anchor = (chosen[first] & _LOW).astype(np.int64)
    return first + at, np.flatnonzero(stop) + at, anchor + at, hashes[anchor]


class _Suffixes:
    """The chosen suffixes of a chunk: of each LENGTH bytes, the one whose LEAD bytes have the smallest hash.

    Equal strings choose the suffix at the same place, whatever surrounds them.  Consecutive strings with one choice form
    a stretch: they start from ``first`` to ``last``, and ``anchor`` is the place of their suffix.
    """

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.ids, self.data, self.offsets = ids, data, offsets
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.anchor = self.row = empty
        self.key = np.zeros(0, np.uint64)
        if len(data) < LENGTH:
            return
        inside = np.zeros(len(data) + 1, np.int32)
        tall = np.diff(offsets) >= LENGTH
        np.add.at(inside, offsets[:-1][tall], 1)
        np.add.at(inside, offsets[1:][tall] - LENGTH + 1, -1)
        whole = np.cumsum(inside, out=inside)[:len(data) - LENGTH + 1] > 0
        parts = [_chosen(data, at, whole[at:at + SEGMENT]) for at in range(0, len(whole), SEGMENT)]
        first, last, anchor, key = (np.concatenate(x) for x in zip(*parts))
        # a stretch that goes on in the next segment is one
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        begin = np.flatnonzero(new)
        # the chosen hashes are small ones; scrambled again, they spread evenly over the buckets that are asked
        self.first, self.anchor, self.key = first[begin], anchor[begin], mix(key[begin]) >> np.uint64(16)
        self.last = last[np.append(begin[1:], len(last)) - 1] if len(last) else last
        self.row = np.searchsorted(offsets, self.first, "right") - 1

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, and the number of documents with each (documents with one id count once)."""
        doc = self.ids[self.row]
        order = np.lexsort((doc, self.key))
        key, doc = self.key[order], doc[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        return np.unique(key[fresh], return_counts=True)


def _keys_of(ids, data, offsets):
    return _Suffixes(ids, data, offsets).keys()


def leading_words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The LEAD bytes from each place, as numbers of eight bytes that sort like them."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(LEAD)]).view(">u8").astype(np.uint64)


def leads(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The LEAD bytes from each place, as byte strings of fixed width."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(LEAD)]).view(f"S{LEAD}").ravel()


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of rows by their words: by the first, then by each next one only where all before are equal."""
    order = np.argsort(words[:, 0], kind="stable")
    for k in range(1, words.shape[1]):
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (words[order[1:], :k] == words[order[:-1], :k]).all(1)
        tied = np.flatnonzero(same[1:] | same[:-1])
        if not len(tied):
            break
        run = np.cumsum(~same[:-1])[tied]
        order[tied] = order[tied][np.lexsort((words[order[tied], k], run))]
    return order


def _repeated(row: dict, s: _Suffixes) -> np.ndarray:
    """Numbers of the stretches whose leading bytes more than one document has."""
    return np.flatnonzero(answers_of(row)[np.searchsorted(np.unique(s.key), s.key)] > 0) if len(s.key) else s.first


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leading bytes of one in 16 of the stretches that are sent, each once for its chunk."""
    for row in rows_of(batches):
        s = _Suffixes(*unpack(row))
        some = _repeated(row, s)
        some = some[np.unique(s.key[some], return_index=True)[1]]
        some = some[mix(s.key[some] + np.uint64(row["chunk"])) % np.uint64(16) == 0]
        data = np.ascontiguousarray(s.data[s.anchor[some][:, None] + np.arange(LEAD)])
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in data], pa.binary())], ["lead"])


def splitters(sample: DataFrame, ranges: int) -> np.ndarray:
    """Borders of ``ranges`` parts of the sorted ``lead`` values: only the borders, RANGES at most, reach the driver."""
    ranked = numbered(sample, ["lead"], "leads")
    total = ranked.count()
    part = F.expr(f"row_number * {ranges}L div {max(total, 1)}L")
    borders = ranked.filter((F.col("row_number") > 0) & (part != F.expr(f"(row_number - 1) * {ranges}L div {max(total, 1)}L")))
    return np.unique(np.array([bytes(r[0]) for r in borders.select("lead").collect()], f"S{LEAD}"))


_SENT = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("chunk", T.LongType()),
                      T.StructField("spans", T.BinaryType()), T.StructField("n", T.LongType()),
                      T.StructField("places", T.LongType()), T.StructField("blob", T.BinaryType())])
_RECORD = (("doc", np.int64), ("reps", np.int32), ("shift", np.uint8), ("size", np.uint8))
_PLACE = (("row", np.int32), ("first", np.int32), ("reach", np.int32))


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return squeeze(*(x.astype(np.int32) for x in (row, start, end)))


def _send(borders: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (len(borders) + 1) * width
        for number in rows_of(batches):
            s = _Suffixes(*unpack(number))
            repeated = _repeated(number, s)
            if not len(repeated):
                continue
            # equal stretches of one chunk: the document with the smallest id stands for them, the others are repeats
            first, last, anchor = (x[repeated] for x in (s.first, s.last, s.anchor))
            same = mix(range_hashes(s.data, first, last + LENGTH) + (anchor - first).astype(np.uint64) * _OFFSET)
            order = np.argsort(same, kind="stable")
            same, first, last, anchor, row = same[order], first[order], last[order], anchor[order], s.row[repeated[order]]
            fresh = np.ones(len(order), bool)
            fresh[1:] = same[1:] != same[:-1]
            begin, group, doc = np.flatnonzero(fresh), np.cumsum(fresh) - 1, s.ids[row]
            own = doc == np.minimum.reduceat(doc, begin)[group]
            # places of one stretch that touch or overlap, as in a line of dashes, are one place that reaches further
            apart = fresh.copy()
            apart[1:] |= (row[1:] != row[:-1]) | (first[1:] - first[:-1] > LENGTH)
            head = np.flatnonzero(apart)
            reach = first[np.append(head[1:], len(first)) - 1] - first[head]
            size = last[head] + LENGTH - first[head]
            place = {"row": row[head], "first": first[head] - s.offsets[row[head]], "reach": reach}
            mine = own[head]
            known = _spans(place["row"][~mine], place["first"][~mine], (place["first"] + size + reach)[~mine])
            # a stretch is sent once, with all its places in the document that stands for it
            group, at, size = group[head][mine], head[mine], size[mine]
            place = {name: x[mine] for name, x in place.items()}
            _, lead, reps = np.unique(group, return_index=True, return_counts=True)
            at, size = at[lead], size[lead]
            record = {"doc": doc[at], "reps": reps, "shift": anchor[at] - first[at], "size": size}
            bucket = np.searchsorted(borders, leads(s.data, anchor[at]), "right") * width
            bucket += (s.key[repeated[order[at]]] % np.uint64(width)).astype(np.int64)
            by_bucket, place_by_bucket = np.argsort(bucket, kind="stable"), np.argsort(bucket[group], kind="stable")
            used, cuts = np.unique(bucket[by_bucket], return_index=True)
            cuts = np.append(cuts, len(bucket))
            place_cuts = np.append(0, np.cumsum(np.add.reduceat(reps[by_bucket], cuts[:-1])))
            blobs = []
            for k in range(len(used)):
                take, where = by_bucket[cuts[k]:cuts[k + 1]], place_by_bucket[place_cuts[k]:place_cuts[k + 1]]
                blobs.append(squeeze(*(record[name][take].astype(kind) for name, kind in _RECORD),
                                     *(place[name][where].astype(kind) for name, kind in _PLACE),
                                     gather(s.data, first[at[take]], size[take])))
            empty = _spans(*[np.zeros(0)] * 3)
            home = ((number["chunk"] >> 32) + number["chunk"]) % total  # what is known already takes the way of the records
            yield pa.RecordBatch.from_arrays(
                [pa.array([home, *used], pa.int64()), pa.array([number["chunk"]] * (len(used) + 1), pa.int64()),
                 pa.array([known, *[empty] * len(used)], pa.binary()), pa.array([0, *np.diff(cuts)], pa.int64()),
                 pa.array([0, *np.diff(place_cuts)], pa.int64()), pa.array([b"", *blobs], pa.binary())], _SENT.names)
    return run


_FOUND = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("spans", T.BinaryType())])


def _compare(table: pa.Table) -> pa.Table:
    """Order a bucket's suffixes, find the groups with equal leading bytes, and in them strings of a smaller document."""
    chunks, blobs = [], []
    parts = {name: [] for name in ("owner", "bytes", *dict(_RECORD), *dict(_PLACE))}
    columns = (table.column(c).to_pylist() for c in ("chunk", "spans", "n", "places", "blob"))
    for chunk, spans, n, places, blob in zip(*columns):
        if not n:
            chunks.append(chunk)
            blobs.append(spans)
            continue
        raw, at = expand(blob), 0
        for fields, count in ((_RECORD, n), (_PLACE, places)):
            for name, kind in fields:
                width = count * np.dtype(kind).itemsize
                parts[name].append(np.frombuffer(raw[at:at + width], kind).astype(np.int64))
                at += width
        parts["bytes"].append(np.frombuffer(raw[at:], np.uint8))
        parts["owner"].append(np.full(n, chunk, np.int64))
    if parts["doc"]:
        p = {name: np.concatenate(v) for name, v in parts.items()}
        base = np.cumsum(p["size"]) - p["size"]
        words = leading_words(p["bytes"], base + p["shift"])
        order = multikey_order(words)
        fresh = np.ones(len(order), bool)
        fresh[1:] = (words[order[1:]] != words[order[:-1]]).any(1)
        begin = np.flatnonzero(fresh)
        doc = p["doc"][order]
        mixed = np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
        group = np.cumsum(fresh) - 1
        order, group = order[mixed[group]], group[mixed[group]]
        weight = np.cumsum(p["size"][order])
        results = []
        at = 0
        while at < len(order):  # whole groups, some megabytes at a time
            end = int(np.searchsorted(weight, (weight[at - 1] if at else 0) + SLICE_BYTES, "right"))
            end = max(end, at + 1)
            end = int(np.searchsorted(group, group[end - 1], "right"))
            take = order[at:end]
            results.append((take, *_repeats(p["bytes"], base[take], p["size"][take], p["doc"][take])))
            at = end
        if results:
            which = np.concatenate([t[i] for t, i, _, _ in results])
            start, stop = (np.concatenate([r[k] for r in results]) for k in (2, 3))
            # what holds for a record holds at each of its places
            reps = p["reps"][which]
            place = np.repeat((np.cumsum(p["reps"]) - p["reps"])[which] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
            start = np.repeat(start, reps) + p["first"][place]
            stop = np.repeat(stop, reps) + p["first"][place] + p["reach"][place]
            owner, row = np.repeat(p["owner"][which], reps), p["row"][place]
            place = np.argsort(owner, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(owner[place], prepend=-1)), len(place))
            for a, b in zip(cuts[:-1], cuts[1:]):
                chunks.append(int(owner[place[a]]))
                blobs.append(_spans(row[place[a:b]], start[place[a:b]], stop[place[a:b]]))
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "spans": pa.array(blobs, pa.binary())})


def _repeats(data: np.ndarray, base: np.ndarray, size: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings, within each stretch, that a smaller document has: stretch, first byte, end."""
    local = gather(data, base, size)
    inner = np.cumsum(size) - size
    strings = size - LENGTH + 1
    stretch = np.repeat(np.arange(len(size)), strings)
    shift = np.arange(len(stretch)) - np.repeat(np.cumsum(strings) - strings, strings)
    at = inner[stretch] + shift
    hashes = range_hashes(local, at, at + LENGTH)
    order = np.argsort(hashes)
    fresh = np.ones(len(order), bool)
    fresh[1:] = hashes[order][1:] != hashes[order][:-1]
    begin = np.flatnonzero(fresh)
    least = np.minimum.reduceat(doc[stretch][order], begin)
    repeat = np.empty(len(order), bool)
    repeat[order] = np.repeat(least, np.diff(np.append(begin, len(order)))) < doc[stretch][order]
    hit = np.flatnonzero(repeat)
    if not len(hit):
        return hit, hit, hit
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (stretch[hit][1:] != stretch[hit][:-1])
    start = hit[new]
    stop = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
    return stretch[start], shift[start], shift[stop] + LENGTH


_RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                        T.StructField("kept_sha256", T.StringType())])


def _covered(row: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    change = np.zeros(len(data) + 1, np.int64)
    for answer in row["answers"] or []:
        doc, start, stop = np.frombuffer(expand(answer), np.int32).reshape(3, -1).astype(np.int64)
        np.add.at(change, offsets[doc] + start, 1)
        np.add.at(change, offsets[doc] + stop, -1)
    return np.cumsum(change)[:-1] > 0


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        ids, data, offsets = unpack(row)
        gone = _covered(row, data, offsets)
        begin = gone.copy()
        begin[1:] &= ~gone[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begin[edges] = gone[edges]
        removed, runs = (np.concatenate(([0], np.cumsum(x))) for x in (gone, begin))
        kept = data[~gone].tobytes()
        at = offsets - removed[offsets]
        digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=ids == NO_ID), pa.array(np.diff(offsets)), pa.array(np.diff(removed[offsets])),
             pa.array(np.diff(runs[offsets])), pa.array(digests, pa.string())], _RESULT.names)


_TEXT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("kept", T.BinaryType())])


def _remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        ids, data, offsets = unpack(row)
        gone = _covered(row, data, offsets)
        texts = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NO_ID), pa.array(texts, pa.binary())], _TEXT.names)


def repeated_spans(documents: DataFrame) -> DataFrame:
    """The documents in chunks, with ``answers``: spans of bytes covered by a string of ``LENGTH`` bytes that also starts
    in a document with a smaller id.

    A full suffix array is not needed: of the suffixes only those that ``_Suffixes`` chooses are sorted, and every string
    holds one.  First, chunks ask which leading bytes occur in more than one document.  The stretches around those go to
    buckets, by splitters of their LEAD bytes sampled from the stretches that are sent; past RANGES buckets each range is
    parted by a hash of the leading bytes.  Equal leading bytes never part, so no group crosses a border of buckets.  A bucket
    sorts by multikey quicksort and compares strings within groups of equal leading bytes.  Strings repeated within a chunk
    are decided there: a passage is sent once from each chunk, however many documents and places there hold it.
    """
    chunks = pack(documents, "suffix-chunks")
    buckets = bucket_count(chunks)
    told = stored(questions(chunks, _keys_of, buckets), "suffix-answers")
    some = chunks.filter((F.col("chunk") % (1 << 32) == 0) | (F.pmod(F.xxhash64("chunk"), F.lit(SAMPLE)) == 0))
    borders = splitters(with_answers(some, told).mapInArrow(_sample, "lead binary"), min(buckets, RANGES))
    sent = with_answers(chunks, told).mapInArrow(_send(borders, -(-buckets // RANGES)), _SENT)
    found = sent.groupBy("bucket").applyInArrow(_compare, _FOUND)
    return with_answers(chunks, found.select("chunk", F.col("spans").alias("answer")))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``(doc_id, kept)``: the bytes that remain of each document."""
    return repeated_spans(documents).mapInArrow(_remaining, _TEXT)


def op7_suffix_dedup(documents: DataFrame) -> DataFrame:
    """Digests of what remains; a null or empty text has no bytes.  Documents with one id, and those without, never repeat each other."""
    return repeated_spans(documents).mapInArrow(_digest, _RESULT)
