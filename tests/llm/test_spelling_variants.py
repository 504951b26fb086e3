"""Spelling variants against plain versions that compare all words."""

import re
import zlib
from collections import Counter

import pytest

from tidewatch.llm import spelling_variants as sv

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) == len(short) + 1 and any(long_[:k] + long_[k + 1:] == short for k in range(len(long_)))


def plain(docs):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if mark % 97 == 0:
                word = word[:mark % len(word)] + word[mark % len(word) + 1:]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    deleted = {}
    for w in counts:
        for k in range(len(w)):
            deleted.setdefault(w[:k] + w[k + 1:], set()).add(w)
    near = {}
    for w in counts:
        some = set(deleted.get(w, ())) | {v for k in range(len(w)) for d in [w[:k] + w[k + 1:]] for v in (*deleted.get(d, ()), d)}
        near[w] = {v for v in some if v in counts and one_edit(v, w)}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def found(frame):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in sv.op11_spelling_variants(frame).collect())


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_variants(request, table):
    frame = request.getfixturevalue(table)
    got = found(frame)
    assert got == plain([(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()])
    if table == "documents":
        assert any(r[1] for r in got)


def test_runs_long_words_and_chains(prepared):
    """Runs of a letter, ties, words beyond the length that is sorted as it is, and forms of forms."""
    words = {"aaaaa": 3, "aaaaaa": 14, "aaaaaaa": 40, "aabaaa": 4, "tasty": 4, "tasta": 8, "tastb": 8, "hasty": 3, "àaaaaa": 3,
             "straße": 3, "strasse": 9, "strase": 4, "xyxyxy": 3, "xyxyx": 3, "yxyxy": 7}
    for size in (sv.SPELT - 1, sv.SPELT, sv.SPELT + 1, 300):
        base = "abcdefghij" * 40
        words |= {base[:size]: 3, base[:size - 1] + "z": 6, "y" + base[:size - 1]: 13, base[:size] + "q": 27, base[1:size]: 5}
    text = [(None, " ".join(f"{w} " * n for w, n in words.items())), (5, "aaaaa,aaaaa;AAAAA aaaaÉ")]
    got = found(prepared.createDataFrame(text, "doc_id long, text string"))
    assert got == plain(text)
    assert {r[0]: r[2] for r in got}["aaaaa"] == "aaaaaaa"


def test_blocks_of_a_long_text(monkeypatch):
    text = "Word-word's wordé " * 300
    whole = sorted(sv.words_of(7, text))
    monkeypatch.setattr(sv, "BLOCK", 10)
    assert sorted(sv.words_of(7, text)) == whole


def test_empty_table(prepared):
    assert found(prepared.createDataFrame([], "doc_id long, text string")) == []
