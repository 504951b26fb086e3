"""Operators against plain versions that look at everything at once."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import (
    mixing, ngram_join, packing, pii, quality_classifier, quality_rules, queries, search, sharding, suffix_dedup, toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect()]


def plain_components(docs, gram=4, percent=85):
    sets = {}
    for number, (_, text) in enumerate(docs):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[number] = {tuple(words[k:k + gram]) for k in range(len(words) - gram + 1)} or ({tuple(words)} if words else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for number, grams in sets.items():
        shared = Counter(other for g in grams for other in holders.get(g, ()))
        for other, n in shared.items():
            if 100 * n >= percent * (len(grams) + len(sets[other]) - n):
                parent[find(number)] = find(other)
        for g in grams:
            holders.setdefault(g, []).append(number)
    least = {}
    for number, (doc, _) in enumerate(docs):
        if doc is not None:
            root = find(number)
            least[root] = min(least.get(root, doc), doc)
    return sorted((str(doc), len(sets[n]), str(least.get(find(n)) if sets[n] else doc)) for n, (doc, _) in enumerate(docs))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_ngram_join(request, table):
    frame = request.getfixturevalue(table)
    got = sorted((str(r[0]), r[1], str(r[2])) for r in ngram_join.op1_ngram_jaccard(frame).collect())
    assert got == plain_components(rows(frame))


def test_overlaps_of_long_columns():
    draw = np.random.default_rng(1)
    sets = [set(draw.choice(60, 25, False).tolist()) for _ in range(50)]
    got = ngram_join.overlaps(np.array([g for s in sets for g in s], np.uint64), np.repeat(np.arange(50), 25), 50)
    assert all(got[i, j] == len(sets[i] & sets[j]) for i in range(50) for j in range(50) if i != j)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_suffix_dedup(request, table):
    frame = request.getfixturevalue(table)
    docs = rows(frame)
    first = {}
    for doc, text in docs:
        data = text.encode()
        for k in range(len(data) - 49):
            first[data[k:k + 50]] = min(first.get(data[k:k + 50], 2 ** 63), 2 ** 63 - 1 if doc is None else doc)
    expected = []
    for doc, text in docs:
        data, gone = text.encode(), bytearray(len(text.encode()))
        for k in range(len(data) - 49):
            if first[data[k:k + 50]] < (2 ** 63 - 1 if doc is None else doc):
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        expected.append((str(doc), len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.op7_suffix_dedup(frame).collect()) == sorted(expected)


def test_multikey_order():
    words = np.random.default_rng(2).integers(0, 3, (500, 3)).astype(np.uint64)
    assert [tuple(words[k]) for k in suffix_dedup.multikey_order(words)] == sorted(map(tuple, words))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_counts_and_rules(request, table):
    frame = request.getfixturevalue(table)
    expected = []
    for doc, text in rows(frame):
        words, seen, repeated = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        expected.append((str(doc), len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed))
    got = quality_rules.op2_mcd_quality(frame).collect()
    assert sorted((str(r[0]), *r[1:7]) for r in got) == sorted(expected)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_outliers_are_found(prepared):
    draw = np.random.default_rng(3)
    table = [(k, "en", "s", *draw.normal(5, 1, 5).tolist()) for k in range(400)]
    table += [(1000 + k, "en", "s", *[40.0] * 5) for k in range(60)]
    names = [f"x{k}" for k in range(5)]
    frame = prepared.createDataFrame(table, ["doc_id", "lang", "source", *names])
    far = {r.doc_id for r in quality_rules.outliers(frame, ["lang", "source"], [F.col(c) for c in names]).filter(
        F.col("distance") > quality_rules.CUTOFF).collect()}
    assert far == set(range(1000, 1060))


def test_classifiers_on_held_out_rows(prepared):
    folder = "/root/testdata/sf0.1"
    labels = prepared.read.parquet(f"{folder}/labels.parquet")
    for name, label in (("op3_fm_quality", "quality"), ("op9_string_kernel_toxicity", "toxic")):
        result = queries.REGISTRY[name](prepared, folder).filter("held_out").join(labels, "doc_id")
        right, total = result.agg(F.sum((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
        assert right / total > 0.97, name


def test_gapped_insults_score_high():
    clean = ["the river runs past an old mill and a quiet field", "people walked along the shore in the evening light"] * 60
    toxic = [t.replace("old", "idiot").replace("shore", "moron") for t in clean]
    weight, constant, curve = toxicity.fit(clean + toxic, np.array([0.0] * len(clean) + [1.0] * len(toxic)))

    def score(text):
        data = np.frombuffer(text.encode(), np.uint8)
        words, row, bounds = toxicity.units(data, np.array([0, len(data)]))
        return float(toxicity._curve(toxicity.worst_words(toxicity.word_scores(words, weight) + constant, row, bounds), curve)[0])
    plain = score("the river runs past a quiet field")
    for text in ("the river i.d-i_o.t field", "the river i d i o t field", "the river id1ot field", "the river mxoron field"):
        assert score(text) > plain, text


def test_scores_of_odd_rows(odd, labels, prepared):
    for operator in (quality_classifier.op3_fm_quality, toxicity.op9_string_kernel_toxicity):
        for known in (labels, labels.limit(0)):
            found = operator(odd, known).collect()
            assert len(found) == 12 and all(0 <= r["score"] <= 1 for r in found)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_pii(request, table):
    frame = request.getfixturevalue(table)
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def holds(kind, text):
        digits = re.sub("[^0-9]", "", text)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in text.split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
    expected = []
    for doc, text in rows(frame):
        found = sorted((m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p) in enumerate(kinds.items())
                       for m in re.finditer(p, text) if holds(k, m.group()))
        expected.append((str(doc), hashlib.sha256(",".join(f[2] for f in found).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in pii.op4_pii(frame).collect()) == sorted(expected)


def test_spans_beyond_the_base():
    found = pii.find_spans("bank account GB82 WEST 1234 5698 7654 32, ssn 123-45-6789, order 123-45-6789")
    assert [(k, s) for k, s, _, _ in found if k in ("iban", "ssn")] == [("iban", 13), ("ssn", 46)]
    assert pii.redacted("a x@y.zz b", pii.find_spans("a x@y.zz b")) == "a [EMAIL] b"
    assert pii.find_spans("9" * 100_000 + "." + "a@" * 1000) == []


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_sharding(request, table):
    frame = request.getfixturevalue(table)
    found = sharding.op5_feistel_sharding(frame).collect()
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1 and len(found) == frame.count()
    expected = sorted((str(d), len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in rows(frame))
    assert sorted((str(r[0]), r[1], r[2]) for r in found) == expected


@pytest.mark.parametrize("n", [1, 2, 3, 5, 97, 1000])
def test_permutation_and_its_inverse(prepared, n):
    place = prepared.range(n).select("id", sharding.permuted(F.col("id"), n, 3).alias("p"))
    found = place.select("id", "p", sharding.permuted(F.col("p"), n, 3, True).alias("back")).collect()
    assert sorted(r["p"] for r in found) == list(range(n)) and all(r["back"] == r["id"] for r in found)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_mixing(request, table):
    frame = request.getfixturevalue(table)
    found = mixing.op6_entropy_mixing(frame).collect()
    assert sorted((str(d), len(WORD.findall(t))) for d, t in rows(frame)) == sorted((str(r["doc_id"]), r["size"]) for r in found)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    sources = {}
    for r in found:
        entry = sources.setdefault((r["source_size"], r["target"]), [0, 0])
        entry[0] += r["taken"]
        entry[1] = max(entry[1], r["size"])
    if table == "documents":
        assert all(abs(taken - target) <= largest for (_, target), (taken, largest) in sources.items())
        assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.op6_entropy_mixing(frame).collect()))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_packing(request, table):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    frame = request.getfixturevalue(table)
    found = packing.op8_best_fit_packing(frame).collect()
    expected = []
    for doc, text in rows(frame):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        start, piece = 0, 0
        while start < len(ids):
            size = (len(ids) - start) % 1024 or 1024
            body = np.array(ids[start:start + size], "<u4").tobytes()
            expected.append((str(doc), piece, start, size, zlib.crc32(body)))
            start, piece = start + size, piece + 1
    assert sorted((str(r[0]), *r[1:5]) for r in found) == sorted(expected)
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.05 * sum(r["length"] for r in found) / 1024 + 1


def test_the_fullest_bin_closes_first():
    fit = packing.BestFit(10, 2)
    assert [fit.put(s) for s in (9, 5, 7, 1, 3)] == [(0, 0), (1, 0), (2, 0), (2, 7), (1, 5)]


def test_search(prepared):
    folder = "/root/testdata/sf0.01"
    found = search.op10_exact_top_k(prepared.read.parquet(f"{folder}/embeddings.parquet"))
    sql = queries.ORACLE["op10_exact_top_k"].replace("FROM embeddings", f"FROM '{folder}/embeddings.parquet'")
    assert sorted(map(tuple, found.collect())) == sorted(duckdb.sql(sql).fetchall())


def test_search_of_odd_vectors(prepared):
    table = [(0, [1.0, -0.5]), (20, [1.0, -0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (None, [1.0, 1.0]),
             (4, []), (5, [2.0]), (6, [1e300, 1.0])]
    frame = prepared.createDataFrame(table, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    found = sorted(tuple(r) for r in search.op10_exact_top_k(frame).collect())
    assert found == [(0, 1, 5, 8192), (0, 2, 20, 5120), (0, 3, 4, 0), (20, 1, 5, 8192), (20, 2, 0, 5120), (20, 3, 4, 0)]
    large = prepared.createDataFrame([(0, [1e15]), (1, [1e15]), (2, [-1e15])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in search.op10_exact_top_k(large).orderBy("rank").collect()] == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -2 ** 63)]


def test_empty_tables(documents, labels, prepared):
    none = documents.limit(0)
    for operator in (ngram_join.op1_ngram_jaccard, quality_rules.op2_mcd_quality, pii.op4_pii, sharding.op5_feistel_sharding,
                     mixing.op6_entropy_mixing, suffix_dedup.op7_suffix_dedup, packing.op8_best_fit_packing):
        assert operator(none).count() == 0, operator
    vectors = prepared.createDataFrame([], "vec_id long, embedding array<float>")
    assert search.op10_exact_top_k(vectors).count() == 0
