"""Runs, lines repeated in one document, and leading bytes that many stretches share, against plain enumeration."""

import hashlib
import random

import numpy as np
import pytest

from tidewatch.llm import suffix_dedup


def plain(docs):
    first, out = {}, []
    for doc, text in docs:
        data = text.encode()
        for k in range(len(data) - 49):
            first[data[k:k + 50]] = min(first.get(data[k:k + 50], doc), doc)
    for doc, text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k:k + 50]] < doc:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def texts():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    line = " ".join(word() for _ in range(12)) + "\n"
    other = " ".join(word() for _ in range(12)) + "\n"
    lead = "the same twenty-four bytes, and then "
    docs = [(0, "-" * 3000), (1, "x" + "-" * 900 + "y" + "-" * 49 + "z" + "-" * 51), (2, "=-" * 400 + "-" * 120),
            (3, line * 40), (4, "".join(line + word() + "\n" for _ in range(30))), (5, word() + line * 3 + other + line),
            (6, other * 9 + line), (7, ("ab" * 30 + "\n") * 25), (8, ("ab" * 24 + "\n") * 25 + "-" * 60)]
    docs += [(k, lead + " ".join(word() for _ in range(8)) + lead + line[k:] + "-" * k) for k in range(9, 60)]
    return [*docs, (60, docs[20][1]), (61, docs[20][1] + docs[4][1]), (62, ""), (63, "-" * 49), (64, "-" * 50)]


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("ranges", [4096, 3])
def test_runs_and_lines(prepared, monkeypatch, parts, ranges):
    monkeypatch.setattr(suffix_dedup, "RANGES", ranges)
    docs = texts()
    frame = prepared.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    assert sorted(tuple(r) for r in suffix_dedup.op7_suffix_dedup(frame).collect()) == plain(docs)


def test_a_run_is_one_record():
    """A megabyte of one byte sends each of its few distinct stretches once, with places that reach over the run."""
    data = np.frombuffer(b"-" * (1 << 20), np.uint8)
    found = suffix_dedup._Suffixes(np.array([4]), data, np.array([0, len(data)]))
    row = {"chunk": 0, "answers": None}
    sent = []
    for name, value in (("unpack", lambda _: (found.ids, found.data, found.offsets)), ("rows_of", lambda batches: [row]),
                        ("answers_of", lambda _: np.ones(len(np.unique(found.key)), np.uint8))):
        sent.append((name, getattr(suffix_dedup, name)))
        setattr(suffix_dedup, name, value)
    try:
        batch, = suffix_dedup._send(np.array([], "S24"), 1)(iter(()))
    finally:
        for name, value in sent:
            setattr(suffix_dedup, name, value)
    assert sum(batch.column("n").to_pylist()) < 100 and sum(batch.column("places").to_pylist()) < 200


def test_splitters(prepared):
    keys = [bytes([k % 251, k // 251]) + b"\0" * 22 for k in range(5000)]
    frame = prepared.createDataFrame([(k,) for k in keys], "lead binary")
    borders = suffix_dedup.splitters(frame, 8)
    parts = np.bincount(np.searchsorted(borders, np.array(keys, "S24"), "right"))
    assert len(parts) == 8 and parts.min() > 600 and parts.max() < 650
    assert not len(suffix_dedup.splitters(frame.limit(0), 8))


def test_keys_spread_evenly(documents):
    data = " ".join(r[0] for r in documents.select("text").dropna().collect()).encode()
    found = suffix_dedup._Suffixes(np.array([1]), np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    keys = np.unique(found.key)
    share = np.bincount((keys >> np.uint64(45)).astype(int), minlength=8) / len(keys)
    assert share.max() < 0.16 and share.min() > 0.09
