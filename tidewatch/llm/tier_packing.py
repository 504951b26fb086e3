"""Packing into windows of several lengths: documents are routed to tiers, gaps of long windows are filled from shorter tiers."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

import tidewatch.llm.memory  # noqa: F401 - applies in every worker that imports this

END = 1
TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 65_536  # tokens of a step group: so many windows of one tier
STEP_GROUPS = 8  # step groups of a tier that are balanced against each other
WAITING_TOKENS = 1 << 20  # tokens that wait for a window in a task before it packs, about
CACHED_WORDS, CACHED_LENGTH = 400_000, 64
BLOCK = 1 << 20  # characters of a text that are split into words at a time, about

_LATIN = re.compile("[!-~\u00C0-\u024F]*").fullmatch
_LETTERS = re.compile("[a-z]+").fullmatch
_WORD_END = b"\xff"  # stands for the mark of a word's end; no UTF-8 has this byte


class WordIds(dict):
    """Ids of words between blanks, as bytes, found once each.

    The vocabulary drops white space and never merges across it, so the ids of a text are those of its words in a row.  Words
    of printable ASCII and Latin letters are merged by ranks, which is several times as fast as the library's own way; the
    library takes all others, and those that may hold an added token.
    """

    def __init__(self, path: str):
        super().__init__()
        self.encode = Tokenizer.from_file(path).encode
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        suffix = content["model"]["end_of_word_suffix"]
        # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up, in order.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        code = {chr(b): bytes([b]) for b in printable} | {chr(256 + k): bytes([b]) for k, b in enumerate(others)}
        added = {token["content"] for token in content["added_tokens"]}
        ranks = {}
        for entry, number in content["model"]["vocab"].items():
            if entry not in added:
                body = entry.removesuffix(suffix)
                ranks[b"".join(map(code.__getitem__, body)) + (_WORD_END if body != entry else b"")] = number
        pattern = next(p for p in content["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.parts = regex.compile(pattern).findall
        self.merge = tiktoken.Encoding("word_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def __missing__(self, word: str) -> bytes:
        if _LETTERS(word):
            ids = array("I", self.merge(word.encode() + _WORD_END)).tobytes()
        elif _LATIN(word) and "<|" not in word:
            lower = word.lower() if word.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", word)))
            ids = b"".join(self[part] if part != word else array("I", self.merge(part.encode() + _WORD_END)).tobytes()
                           for part in self.parts(lower))
        else:
            ids = np.array(self.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        out, at = [], 0
        while at < len(text):
            stop = text.find(" ", at + BLOCK)
            stop = len(text) if stop < 0 else stop
            out.append(b"".join(map(self.__getitem__, text[at:stop].replace("\n", " ").replace("\t", " ").split(" "))))
            at = stop
        return b"".join(out)


class Waiting:
    """Token runs that wait for a window, on a shelf for each length; one bit of ``mask`` says whether a shelf has any."""

    def __init__(self, longest: int):
        self.shelves: list[list[tuple]] = [[] for _ in range(longest + 1)]
        self.mask, self.tokens = 0, 0

    def put(self, document: tuple, start: int, length: int) -> None:
        self.shelves[length].append((document, start, length))
        self.mask |= 1 << length
        self.tokens += length

    def _take(self, length: int) -> tuple:
        run = self.shelves[length].pop()
        if not self.shelves[length]:
            self.mask &= ~(1 << length)
        self.tokens -= length
        return run

    def _cut(self, length: int, wanted: int) -> tuple:
        document, start, _ = self._take(length)
        self.put(document, start + wanted, length - wanted)
        return document, start, wanted

    def window(self, tiers: tuple[int, ...]) -> list[tuple]:
        """The next window: the longest run in the tier it belongs to, then whatever fills the gap, longest first.

        Where no run fits whole, the shortest one is cut.  With too few tokens left for the tier, the window is the largest
        power of two that they fill.
        """
        longest = self.mask.bit_length() - 1
        size = next(t for t in tiers if t >= longest)
        if self.tokens < size:
            size = 1 << (self.tokens.bit_length() - 1)
        runs, gap = [], size
        while gap:
            fitting = self.mask & ((2 << gap) - 1)
            if fitting:
                runs.append(self._take(fitting.bit_length() - 1))
            else:
                runs.append(self._cut((self.mask & -self.mask).bit_length() - 1, gap))
            gap -= runs[-1][2]
        return runs


def balanced(costs: list[int], groups: int, room: int) -> list[int]:
    """A group for each window: costly ones first, each to the group with the least cost that has room."""
    load, count, out = [0] * groups, [0] * groups, [0] * len(costs)
    for k in sorted(range(len(costs)), key=lambda k: -costs[k]):
        out[k] = min((g for g in range(groups) if count[g] < room), key=lambda g: (load[g], g))
        load[out[k]] += costs[k]
        count[out[k]] += 1
    return out


PIECE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                      T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                      T.StructField("tier", T.IntegerType()), T.StructField("step_group", T.LongType())])
_ARROW = [pa.int64()] * 7 + [pa.int32(), pa.int64()]


class Packer:
    """Documents in, rows of pieces out; holds what waits for a window and the windows that wait for their step group."""

    def __init__(self, tiers: tuple[int, ...], first: int):
        self.tiers, self.waiting = tiers, Waiting(tiers[-1])
        self.windows: dict[int, list[list[tuple]]] = {}
        self.sequence = self.group = first
        self.rows: list[list[int]] = [[] for _ in PIECE]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        document, total, top = (doc_id, ids, len(ids) // 4), len(ids) // 4, self.tiers[-1]
        whole = total - total % top
        for start in range(0, whole, top):
            self._window([(document, start, top)])
        if total > whole:
            self.waiting.put(document, whole, total - whole)
        if self.waiting.tokens > WAITING_TOKENS:
            self._pack(WAITING_TOKENS // 2)

    def end(self) -> None:
        self._pack(0)
        for tier in sorted(self.windows):
            self._step(tier)

    def _pack(self, least: int) -> None:
        while self.waiting.tokens > least:
            self._window(self.waiting.window(self.tiers))

    def _window(self, runs: list[tuple]) -> None:
        tier = sum(run[2] for run in runs)
        kept = [(doc_id, start, length, zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)]), total)
                for (doc_id, ids, total), start, length in runs]
        self.windows.setdefault(tier, []).append(kept)
        if len(self.windows[tier]) * tier >= STEP_GROUPS * STEP_TOKENS:
            self._step(tier)

    def _step(self, tier: int) -> None:
        windows, room = self.windows.pop(tier), max(1, STEP_TOKENS // tier)
        groups = -(-len(windows) // room)
        dealt = balanced([sum(run[2] ** 2 for run in window) for window in windows], groups, room)
        for window, group in zip(windows, dealt):
            offset = 0
            for run in window:
                for column, value in zip(self.rows, (*run, self.sequence, offset, tier, self.group + group)):
                    column.append(value)
                offset += run[2]
            self.sequence += 1
        self.group += groups

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, [[] for _ in PIECE]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _ARROW)], PIECE.names)


def _pack(path: str, tiers: tuple[int, ...], end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        mark = np.array([end], "<u4").tobytes()
        packer = Packer(tiers, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, words.of(text.as_py() or "") + mark)
                if len(packer.rows[0]) >= 10_000:
                    yield packer.batch()
        packer.end()
        yield packer.batch()
    return run


def tier_packing(documents: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, end: int = END) -> DataFrame:
    """Pieces of all documents, the window (``sequence_id``) and the place (``offset``) of each, its ``tier`` and ``step_group``.

    A document is its ids and an end mark.  Whole windows of the longest tier are cut off first; what is left goes to the
    smallest tier that holds it.  Tiers are packed from the longest down: a window takes its document, then the longest
    waiting ones that fit its gap, mostly of shorter tiers, and what gap is left is filled by cutting the shortest.  So every
    window is as long as its tier; only the last tokens of a task go to windows of smaller powers of two.  Windows of a tier
    are dealt to step groups of equal size, so that the groups' sums of squared piece lengths, what attention costs, are even.

    Nothing is shuffled: a task packs the rows of its partition, holding about a million tokens and one document.  A null or
    empty text is the end mark alone, a repeated row is packed each time, a null id stays null, other columns are not read,
    and an empty table gives an empty table.  ``tiers`` are powers of two, ascending.
    """
    if list(tiers) != sorted(set(tiers)) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers are ascending powers of two")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_pack(tokenizer, tiers, end), PIECE)


def op12_tier_packing(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``documents`` in windows of 256 to 2,048 ids of ``word_bpe_49k.json``; see ``tier_packing`` for odd rows."""
    return tier_packing(documents, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
