"""Alignment of two tokenizers against a plain version over byte ranges."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(docs):
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    # Fixed rule of byte-level vocabularies.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    found, counts = [], Counter()
    for _, text in docs:
        ids_a, ids_b, links, groups = [], [], [], []
        if text:
            ids_a, ids_b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            bytes_a = [bytes(code[c] for c in one.id_to_token(k)) for k in ids_a]
            bytes_b = [bytes([int(two.id_to_piece(k)[3:5], 16)]) if two.is_byte(k) else two.id_to_piece(k).replace("▁", " ").encode()
                       for k in ids_b]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ids_a, ids_b = [], []
        if ids_a:
            ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
            j = 0
            for i, stop in enumerate(ends[0]):
                while ends[1][j] <= stop - len(bytes_a[i]):
                    j += 1
                k = j
                while k < len(ids_b) and ends[1][k] - len(bytes_b[k]) < stop:
                    links.append((ids_a[i], ids_b[k]))
                    k += 1
            low = [0, 0]
            for end in sorted(set(ends[0]) & set(ends[1])):
                high = [ends[side].index(end) + 1 for side in (0, 1)]
                groups.append("|".join(",".join(map(str, ids[low[s]:high[s]])) for s, ids in enumerate((ids_a, ids_b))))
                low = high
        counts.update(set(links))
        found.append((len(ids_a), len(ids_b), groups, links))
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    return sorted((str(doc), n_a, n_b, len(groups), len(links), sum(counts[link] == highest[link[0]] for link in links),
                   sum(counts[link] for link in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
                  for (doc, _), (n_a, n_b, groups, links) in zip(docs, found))


def found(frame):
    return sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in ta.op13_token_alignment(frame).collect())


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_alignment(request, table):
    frame = request.getfixturevalue(table)
    docs = [(r["doc_id"], (r["text"] or "")[:4000]) for r in frame.select("doc_id", "text").collect()]
    short = frame.sparkSession.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 a", "2 pair", "3 count", "4 chunk")
    assert found(short) == plain(docs)


def test_odd_texts(prepared):
    docs = [(1, "a▁b"), (2, "  two  spaces \n\n x "), (3, "<s> </s> <0x41> <|endoftext|>"), (4, "漢字🎉 é ́"), (5, "\x00\x01"), (6, " "), (7, None),
            (7, "same"), (7, "same"), (None, "tabs\tand   more"), (8, "")]
    got = found(prepared.createDataFrame(docs, "doc_id long, text string"))
    assert got == plain(docs)
    assert [r[1:] for r in got if r[0] == "1"] == [(0, 0, 0, 0, 0, 0, "")]


def test_words_give_the_pieces_of_the_text(monkeypatch):
    pieces, whole = ta.WordPieces(B), sentencepiece.SentencePieceProcessor(model_file=B)
    assert pieces.cuts
    texts = ["some  words\nin a   long text, é  " * 50, " x", "  x ", " ", "x", "x ", "    ", "a b", "\n \n", "word" * 40 + " z"]
    expected = [whole.encode(text) for text in texts]

    def found():
        return [np.frombuffer(ids, np.int32).tolist() for ids in pieces.of(texts)]
    assert found() == expected and found() == expected
    monkeypatch.setattr(ta, "CACHED_WORDS", 2)
    monkeypatch.setattr(ta, "CACHED_LENGTH", 3)
    assert found() == expected and max(map(len, pieces)) <= 3
    pieces.cuts = False
    assert found() == expected
    assert pieces.of(["", "a▁b"]) == [None, None]


def test_several_chunks_share_counts(prepared, documents, monkeypatch):
    docs = [(k, f"shared words {k} and more") for k in range(40)]
    frame = prepared.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert found(frame) == plain(docs)


def test_empty_table(prepared):
    assert found(prepared.createDataFrame([], "doc_id long, text string")) == []
