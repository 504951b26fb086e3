"""Added tokens of the vocabulary file in texts."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidewatch.llm import packing

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "one<|endoftext|><|endoftext|>\n two  <|endoftext|>", "<|endoftext| >", "é  <|endoftext|>🎉 <|ENDOFTEXT|>",
         "w <|endoftext|>" * 700, " \n <|endoftext|>\n\n x"]


def test_ids_are_those_of_the_library(prepared):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc, text in enumerate(TEXTS):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]
        assert (50256 in ids) == ("<|endoftext|>" in text)
        start, piece = 0, 0
        while start < len(ids):
            size = (len(ids) - start) % 1024 or 1024
            expected.append((doc, piece, start, size, zlib.crc32(np.array(ids[start:start + size], "<u4").tobytes())))
            start, piece = start + size, piece + 1
    frame = prepared.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert sorted(tuple(r)[:5] for r in packing.op8_best_fit_packing(frame).collect()) == sorted(expected)
