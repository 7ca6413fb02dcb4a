"""Ids against the vocabulary's own library."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratum.llm.words import Codes, default_tokenizer


@pytest.fixture(scope="module")
def codes():
    return Codes(default_tokenizer())


UNALTERED = Tokenizer.from_file(default_tokenizer())


def plain(codes, text):
    return UNALTERED.encode(text, add_special_tokens=False).ids


def test_documents(codes):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    for text in texts:
        assert codes.ids(text) == plain(codes, text)
        assert np.frombuffer(codes.encode(text), "<u4").tolist() == plain(codes, text)


@pytest.mark.parametrize("text", [
    "", " ", "  \n\t x", "don't we'll I'M", "ünï¢ode 東京 🙂🙂 ½²", "<|endoftext|> a", "end <|endoftext|> start", "<|endoftext|", "x<|endoftext|><|endoftext|>y", "a" * 5000, " " * 3000 + "x", "x y z\x00\x1f", "\r\n\r\n a\x0b\x0c",
])
def test_odd_texts(codes, text):
    assert codes.ids(text) == plain(codes, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", categories=("L", "N", "P", "S", "Z", "Cc")), max_size=60))
def test_any_text(text):
    codes = Codes(default_tokenizer()) if not hasattr(test_any_text, "codes") else test_any_text.codes
    test_any_text.codes = codes
    assert codes.ids(text) == plain(codes, text)
