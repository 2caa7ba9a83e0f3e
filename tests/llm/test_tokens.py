"""The encoder that cuts texts in bulk against plain calls of the tokenizer."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from countcast.llm import tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "B", "é", "È", "÷", "×", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", ",", "!", "'s", "'re", "***", "(", "|", "<|", "|>", " 12", "3", "-", "’", "ß", "ж", " ж",
          "日本", "😀", "́", "\u0085", " ", " ", "᠎", " ", "​", " ", " ", "　", "﻿", "\x1c", "\x1f", "<|endoftext|>"]


def numbers(ids):
    return np.frombuffer(ids, dtype="<u4").tolist()


def test_ids_equal_plain_calls():
    draw = random.Random(4)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 16))) for _ in range(20_000)]
    plain = [done.ids for done in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]
    assert [numbers(ids) for ids in tokens.Encoder(BPE).encode(texts)] == plain
    assert numbers(tokens.encoder(BPE).encode(["<|endoftext|>"])[0]) == [50256]


def test_slices_nulls_and_forgotten_parts(monkeypatch):
    """Small slices, sliced arrays with NULLs, texts longer than a slice, and a worker that keeps next to nothing."""
    monkeypatch.setattr(tokens, "BYTES_AT_ONCE", 50)
    monkeypatch.setattr(tokens, "KEPT_PARTS", 3)
    texts = [None, "", "a b c d e f", "x" * 200, None, " w" * 100, "", "a b c"] * 3
    plain = [Tokenizer.from_file(BPE).encode(t or "", add_special_tokens=False).ids for t in texts]
    for column in (pa.array(texts), pa.array(["cut off", *texts]).slice(1), pa.array(texts, pa.large_string())):
        slices = list(tokens.Encoder(BPE).slices(column))
        assert len(slices) > 3 and [numbers(ids) for some in slices for ids in some] == plain
    assert tokens.Encoder(BPE).encode([]) == [] and tokens.Encoder(BPE).encode([None, None]) == [b"", b""]
