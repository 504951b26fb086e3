"""Packing into tiers: exact pieces, full windows, balanced step groups."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import tier_packing as tp

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_pieces(request, table):
    frame = request.getfixturevalue(table)
    docs = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    encode = Tokenizer.from_file(PATH).encode
    ids = defaultdict(list)
    for doc, text in docs:
        ids[doc].append([*encode(text or "", add_special_tokens=False).ids, tp.END])
    rows = tp.op12_tier_packing(frame).collect()
    assert sum(r["length"] for r in rows) == sum(len(x) for copies in ids.values() for x in copies)
    covered = defaultdict(list)
    for r in rows:
        piece = lambda x: np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(piece(x)) == r["ids_crc32"] for x in ids[r["doc_id"]])
        covered[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"]))
    for (doc, total), pieces in covered.items():
        copies = sum(len(x) == total for x in ids[doc])
        times = Counter(k for start, length in pieces for k in range(start, start + length))
        assert set(times.values()) == {copies} and len(times) == total
    windows = defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"], r["tier"], r["step_group"]))
    for pieces in windows.values():
        at = 0
        for offset, length, tier, group in sorted(pieces):
            assert offset == at and tier == pieces[0][2] and group == pieces[0][3]
            at += length
        assert at == tier and at & (at - 1) == 0 and at <= 2048


def test_words_are_those_of_the_library():
    words, encode = tp.WordIds(PATH), Tokenizer.from_file(PATH).encode
    for text in ["á ́b  x", "ΑΣ ΟΔΟΣ", "it's 'sx <|startoftext|> a<|endoftext|>b|>", "A\x1cB c\r\n\td", "İ ﬁ 12 3४ 5", "\x85a b", "q̣̇ ̣̇s",
                 " ", "", "São Ünïcödé ÀÉÎÕÜß ǅ Ǆ!", "a" * 5000, "漢字 🎉🎉 \x00"]:
        for _ in range(2):
            assert words.of(text) == np.array(encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_blocks_and_full_cache(monkeypatch):
    text = "some words\nin a   long text é " * 40
    whole = tp.WordIds(PATH).of(text)
    monkeypatch.setattr(tp, "BLOCK", 7)
    monkeypatch.setattr(tp, "CACHED_WORDS", 3)
    assert tp.WordIds(PATH).of(text) == whole


def test_long_windows_are_filled_from_shorter_tiers():
    packer = tp.Packer((4, 8, 16), 0)
    for number, length in enumerate([13, 3, 9, 7, 2, 2, 5, 16]):
        packer.add(number, np.arange(length, dtype="<u4").tobytes())
    packer.end()
    rows = packer.batch().to_pylist()
    by_window = defaultdict(list)
    for r in rows:
        by_window[r["sequence_id"]].append((r["doc_id"], r["length"]))
    assert [(7, 16)] in by_window.values() and [(0, 13), (1, 3)] in by_window.values() and [(2, 9), (3, 7)] in by_window.values()


def test_step_groups_are_even():
    draw = np.random.default_rng(4)
    packer = tp.Packer(tp.TIERS, 0)
    for number, length in enumerate(draw.integers(1, 3000, 3000).tolist()):
        packer.add(number, np.arange(length, dtype="<u4").tobytes())
    packer.end()
    cost, tokens, tiers = Counter(), Counter(), defaultdict(set)
    for r in packer.batch().to_pylist():
        cost[r["step_group"]] += r["length"] ** 2
        tokens[r["step_group"]] += r["length"]
        tiers[r["step_group"]].add(r["tier"])
    assert max(tokens.values()) == tp.STEP_TOKENS and all(len(t) == 1 for t in tiers.values())
    rounds = 0
    for first in range(0, len(cost) - tp.STEP_GROUPS, tp.STEP_GROUPS):  # those that were balanced against each other
        groups = range(first, first + tp.STEP_GROUPS)
        if all(tokens[g] == tp.STEP_TOKENS and tiers[g] == {2048} for g in groups):
            rounds += 1
            assert max(cost[g] for g in groups) < 1.02 * min(cost[g] for g in groups)
    assert rounds > 2


def test_balanced_groups():
    assert sorted(Counter(tp.balanced([9, 1, 1, 1, 5, 4], 3, 2)).values()) == [2, 2, 2]


def test_empty_table_and_wrong_tiers(prepared):
    frame = prepared.createDataFrame([], "doc_id long, text string")
    assert tp.op12_tier_packing(frame).count() == 0
    with pytest.raises(ValueError):
        tp.tier_packing(frame, PATH, (100, 200))
