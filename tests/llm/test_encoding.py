"""Joined ids against the library's for whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attestra.llm import encoding

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
CHARS = st.sampled_from(list("abAZéÉß.,'!|#  \n\n\t\r  \x85\x1c\x1f0129-_<|>") + ["'s", "<|endoftext|>", "é", "İ", "Σ", "ς", "the "])
ENCODERS = {n: encoding.encoder(public_tokenizers.path(n)) for n in NAMES}


def whole(name, text):
    return np.array(ENCODERS[name].tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=600, deadline=None)
@given(parts=st.lists(CHARS, max_size=30))
def test_joined_ids_are_those_of_the_whole_text(name, parts):
    text = "".join(parts)
    assert ENCODERS[name].encode_batch([text, None, text]) == [whole(name, text), b"", whole(name, text)]


@pytest.mark.parametrize("name", NAMES)
def test_long_words_long_texts_and_a_full_cache(name, monkeypatch):
    monkeypatch.setattr(encoding, "KEPT", 50)
    monkeypatch.setattr(encoding, "BLOCK", 300)
    texts = [f"{k} word{k}, " + "x" * (k % 130) + f"\nNext{k % 7}. " * 40 + "<|endoftext|>end" for k in range(60)]
    assert ENCODERS[name].encode_batch(texts) == [whole(name, t) for t in texts]
    assert len(ENCODERS[name].known) < 5000


def test_kinds():
    kinds = [type(ENCODERS[n]) for n in NAMES]
    assert kinds == [encoding.ByteLevel, encoding.WordEnds]


@pytest.mark.parametrize("name", NAMES)
def test_the_model_alone_encodes_runs_of_latin_letters(name, monkeypatch):
    encoding.release()
    encoder = encoding.encoder(public_tokenizers.path(name))
    asked = []
    library = encoder.by_library
    monkeypatch.setattr(encoder, "by_library", lambda texts: asked.extend(texts) or library(texts))
    words = [f"{chr(a)}é{chr(b)}ßÞ{sign}" for a in range(97, 123) for b in range(97, 123) for sign in ("", "***", "<|", ",")]
    text = " ".join(words)
    assert encoder.encode_batch([text]) == [whole(name, text)]
    assert len(asked) < 20


@pytest.mark.parametrize("name", NAMES)
def test_letters_and_signs_beside_each_other(name):
    letters = [chr(c) for c in range(0x21, 0x250)]
    signs = ["", "s", "́", *map(chr, range(33, 127)), "<|endoftext|>"]
    texts = [" ".join(f"{c}x{s} x{c}{s} {s}{c}" for c in letters) for s in signs]
    assert ENCODERS[name].encode_batch(texts) == [whole(name, t) for t in texts]


@pytest.mark.parametrize("name", NAMES)
def test_the_model_alone_encodes_runs_of_latin_letters_behind_line_breaks(name, monkeypatch):
    encoding.release()
    encoder = encoding.encoder(public_tokenizers.path(name))
    asked = []
    library = encoder.by_library
    monkeypatch.setattr(encoder, "by_library", lambda texts: asked.extend(texts) or library(texts))
    text = "\n".join(f"{chr(a)}é{chr(b)}ßÞ{sign}" for a in range(97, 123) for b in range(97, 123) for sign in ("", "***", "<|", ","))
    assert encoder.encode_batch([text]) == [whole(name, text)]
    assert len(asked) < 20
