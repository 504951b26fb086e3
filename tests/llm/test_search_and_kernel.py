"""Search among repeated ids and ties across blocks; the string kernel by plain enumeration."""

import itertools
import math

import numpy as np
import pytest

from tidewatch.llm import ngram_join, search, toxicity


def plain_top(table, top=20):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in table]
    out, seen = [], set()
    for q, v in whole:
        if q % 20 == 0 and q not in seen:
            seen.add(q)
            scored = sorted((-sum(a * b for a, b in zip(v, u)), c) for c, u in whole if c != q)[:top]
            out.extend((q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1))
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_search_among_repeated_ids_and_ties(prepared, monkeypatch, small):
    if small:  # many blocks, lanes and parts
        for name, value in (("CANDIDATES", 9), ("QUERIES", 2), ("LANE_BLOCKS", 2), ("PART_BLOCKS", 1)):
            monkeypatch.setattr(search, name, value)
    draw = np.random.default_rng(8)
    vectors = {i: draw.integers(-2, 3, 40).astype(float) / 2 for i in range(160)}
    table = [(i, v.tolist()) for i, v in vectors.items() for _ in range(30 if i in (20, 40) else 5 if i % 20 == 0 else 1 + i % 2)]
    frame = prepared.createDataFrame(table, "vec_id long, embedding array<double>").selectExpr("*", "1 query_id", "2 rank", "3 block", "4 id")
    found = sorted(tuple(r) for r in search.op10_exact_top_k(frame).collect())
    assert found == plain_top(table)


def test_kernel_is_that_of_plain_subsequences():
    """Of the bordered words ``|word|``: all choices of three places with at most two left out between them."""
    def plain(word):
        codes, out = [31, *[ord(c) - 96 for c in word], 31], {}
        for a, b, c in itertools.combinations(range(len(codes)), 3):
            left_out = c - a - 2
            if left_out <= 2:
                key = (codes[a] * 32 + codes[b]) * 32 + codes[c]
                out[key] = out.get(key, 0) + toxicity.DECAY ** left_out
        return out

    def length(word):
        codes, squares = len(word) + 2, 0.0
        for a, b, c in itertools.combinations(range(codes), 3):
            if c - a - 2 <= 2:
                squares += toxicity.DECAY ** (2 * (c - a - 2))
        return math.sqrt(squares)
    names = ["idiot", "idxiot", "river", "aaa", "abcabcabc"]
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    words, row, _ = toxicity.units(data, np.array([0, len(data)]))
    for one, two in itertools.product(range(len(names)), repeat=2):
        x, y = plain(names[one]), plain(names[two])
        expected = sum(v * y.get(k, 0) for k, v in x.items()) / length(names[one]) / length(names[two])
        table = toxicity._dense(words[row[[two]]]).T
        assert toxicity._against(words[row[[one]]], table)[0, 0] == pytest.approx(expected, rel=1e-5)


def test_long_words_go_in_bordered_pieces():
    data = np.frombuffer(b"x " + b"abcdefghij" * 5 + b" abc", np.uint8)
    words, row, bounds = toxicity.units(data, np.array([0, len(data)]))
    shown = ["".join("|" if c == 31 else chr(96 + c) if c else "" for c in words[r]) for r in row]
    assert shown[-1] == "|abc|" and shown[0].startswith("|abc") and shown[-2].endswith("hij|")
    joined = shown[0] + "".join(piece[toxicity.PIECE - toxicity.STRIDE:] for piece in shown[1:-1])
    assert joined == "|" + "abcdefghij" * 5 + "|"


def test_classifier_without_words_or_with_few():
    for texts, labels in ((["", ""], [0.0, 1.0]), (["abc def"] * 3 + ["rude word"] * 3, [0.0] * 3 + [1.0] * 3)):
        weight, constant, curve = toxicity.fit(texts, np.array(labels))
        assert np.isfinite(weight).all() and np.isfinite(curve).all()


def test_links_of_products_stay_exact():
    draw = np.random.default_rng(1)
    sets = [set(draw.choice(200, 60, False).tolist()) for _ in range(20)]
    sets += [set(list(s)[:57]) | {1000 + k} for k, s in enumerate(sets)]
    got = ngram_join.overlaps(np.array([g for s in sets for g in s], np.uint64), np.repeat(np.arange(40), [len(s) for s in sets]), 40)
    assert all(got[i, j] == len(sets[i] & sets[j]) for i in range(40) for j in range(40) if i != j)
