"""The stages of the pipeline against plain versions, each on what the one before kept, and the pipeline as a whole."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_operators import plain_components
from tidewatch.llm import quality_classifier as fm
from tidewatch.session import stored

FOLDER = "/root/testdata/sf0.001"
STAGES = [stage for _, stage in corpus_pipeline.STAGES]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL, ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b")


def plain_score(model, text):
    """The sum over all pairs of features, in long numbers."""
    data = (text or "").encode()
    index, value, _ = fm.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    bias, linear, factors = (np.asarray(part, float) for part in model)
    gram = factors[index] @ factors[index].T * np.outer(value, value).astype(float)
    return 1 / (1 + np.exp(-(bias + linear[index] @ value + np.triu(gram, 1).sum())))


def plain_targets(size, weights=(3, 1, 2), share=1.5):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    capped, left = {}, share * sum(size.values())
    while True:
        free = [s for s in order if s not in capped]
        over = [s for s in free if weight[s] * left / sum(weight[t] for t in free) > 2 * size[s]]
        if not over:
            return capped | {s: weight[s] * left / sum(weight[t] for t in free) for s in free}
        for s in over:
            capped[s] = 2 * size[s]
            left -= 2 * size[s]


def test_stages_do_what_plain_versions_do(prepared, documents, labels):
    extra = documents.filter("doc_id % 7 = 0")
    near = extra.withColumns({"doc_id": F.col("doc_id") + 1_000_000, "text": F.concat("text", F.lit(" tail"))})
    private = extra.withColumns({"doc_id": F.col("doc_id") + 2_000_000,
                                 "text": F.concat(F.lit("write to ann.lee@mail.example or 10.20.30.40 "), F.reverse("text"))})
    docs = stored(documents.unionByName(near).unionByName(private), "trial")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = stored(STAGES[0](prepared, docs, FOLDER), "stage")
    model = fm.train(docs, labels)
    scores = {doc: plain_score(model, value) for doc, value in text.items()}
    assert {r["doc_id"] for r in kept.collect()} ^ {d for d, s in scores.items() if s >= 0.3} <= {
        d for d, s in scores.items() if abs(s - 0.3) < 1e-3}
    assert kept.columns == docs.columns and 0 < kept.count() < len(text)

    before = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    alone = stored(STAGES[1](prepared, kept, FOLDER), "stage")
    groups = plain_components(before, gram=5, percent=80)
    assert sorted(str(r["doc_id"]) for r in alone.collect()) == sorted(doc for doc, _, least in groups if doc == least)
    assert alone.count() < len(before)

    clean = stored(STAGES[2](prepared, alone, FOLDER), "stage")
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(after) == {r["doc_id"] for r in alone.collect()}
    for doc, value in after.items():
        original = text[doc] or ""
        assert not EMAIL.search(value or "") and not ADDRESS.search(value or "")
        if not re.search(r"[0-9@]", original):
            assert value == text[doc]
    assert any("[EMAIL]" in value and "[IP]" in value for doc, value in after.items() if doc > 2_000_000)

    mixed = stored(STAGES[3](prepared, clean, FOLDER), "stage")
    words = {r["doc_id"]: (r["source"], len(WORD.findall(r["text"] or ""))) for r in clean.collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    size, taken = Counter(), Counter()
    for doc, (source, n) in words.items():
        size[source] += n
        taken[source] += n * copies[doc]
    assert set(copies.values()) <= {1, 2} and set(copies) <= set(words)
    for source, target in plain_targets(size).items():
        largest = max(n for s, n in words.values() if s == source)
        assert abs(taken[source] - target) <= largest

    pieces = STAGES[4](prepared, mixed, FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, got, filled = Counter(), Counter(), {}
    for r in mixed.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        expected[r["doc_id"]] += len(ids)
        if len(ids) <= 1024:
            assert (zlib.crc32(ids.tobytes()), len(ids)) in {(p["ids_crc32"], p["length"]) for p in pieces if p["doc_id"] == r["doc_id"]}
    for p in pieces:
        got[p["doc_id"]] += p["length"]
        filled.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert got == expected
    for parts in filled.values():
        ends = np.cumsum([0, *[n for _, n in sorted(parts)]])
        assert [at for at, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 1024


def test_the_whole_pipeline(prepared, documents):
    docs = documents
    for stage in STAGES:
        docs = stored(stage(prepared, docs, FOLDER), "stage")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(prepared, FOLDER)
    assert sorted(map(tuple, whole.select(*columns).collect())) == sorted(map(tuple, docs.select(*columns).collect()))
    assert whole.count() > 0
