"""Chunked encoding gives the tokenizer's own ids for any text."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing


def check(text):
    import public_tokenizers

    path = public_tokenizers.path(packing.TOKENIZER)
    got = packing.token_bytes([text], path)[0]
    expected = packing._worker[path].whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got, "<u4").tolist() == expected, repr(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(max_codepoint=0x250, exclude_categories=["Cs"])))
def test_latin_text(text):
    check(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])))
def test_any_text(text):
    check(text)


def test_odd_texts():
    for text in ("", " ", "It's they'LL we'd 'S", "<|endoftext|> <|startoftext|>", "a\x1cb \x85c\xa0d\u3000e", "ÀÉÎ ßẞ ÿŸ µ ª º ²³ ½ × ÷", "e\u0301 \u0301x", "ΟΔΟΣ ΣΑΣ", "x" * 5000, "日本語 text", "a'b's''s"):
        check(text)


def fresh(text):
    """Against a tokenizer that nothing in the library has touched."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    got = np.frombuffer(packing.token_bytes([text], path)[0], "<u4").tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, repr(text)
    return got


def test_literals_of_added_tokens():
    assert len(fresh("end<|endoftext|> of <|startoftext|>")) == 4
    for text in ("<|endoftext|>", "a<|endoftext|><|startoftext|>b", "a <|ENDOFTEXT|> b", "<|endoftext|", "<<|endoftext|>>", "e<|endoftext|>\u0301 \x1cx", "word " * 3000 + "É<|startoftext|>é" + "x" * 200):
        fresh(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "It's", "\x85"]), st.text(st.characters(exclude_categories=["Cs"]), max_size=5)), max_size=8).map("".join))
def test_texts_with_literals(text):
    fresh(text)
