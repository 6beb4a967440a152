"""Token ids of whole texts, with a bounded cache of the words that texts share.

A text is cut only where its encoding cannot depend on both sides, so the joined ids are those the
library gives for the whole text.  Words the cache does not hold are encoded by the library.  Both kinds
of tokenizer split a text into words before they encode it:

* byte-level: a word takes one space before it, white space never follows a visible character in a
  word, and a run of letters ends at a comma, a full stop or a line break;
* word ends: white space is dropped, letters are lower-cased one by one, and a run of letters ends at
  a comma or a full stop.

A run of Latin letters is one word to both, whatever ASCII sign but the apostrophe follows it.  Nothing
is left to normalise or to cut in it but its case, so the library's model alone encodes it, in a fraction
of the time of the whole library's way.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np

# Python counts four control characters as white space that the tokenizers do not: texts that hold one
# are encoded whole.
UNSURE = "\x1c\x1d\x1e\x1f"
PIECE = re.compile(r"\s*\S+|\s+")
GAPS = re.compile(r"\s\s")
BOUNDARY = re.compile(r"(?<=\S)(?=\s)")
BLOCK = 1 << 20  # characters that are cut into words at once
LONGEST = 64  # characters of a word that is worth keeping
KEPT = 800_000  # words of one generation of the cache, some 150 bytes each
BIG_ENDIAN = sys.byteorder == "big" or array("I").itemsize != 4
SLICE = 4096  # words that the library encodes at once

# Letters below U+0100: each is composed already, and its lower case is one letter.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
SIGNED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")


def _byte_characters() -> dict[int, str]:
    """The character that byte-level models have for each byte: printable ones their own, the others from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(others)}


BYTES = _byte_characters()


def _characters(text: str) -> str:
    return text if text.isascii() else text.encode().decode("latin-1").translate(BYTES)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes() if BIG_ENDIAN else array("I", ids).tobytes()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The newer and the older generation: when the newer is full it becomes the older.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept = KEPT

    def by_library(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), SLICE):  # the library's own results are much larger than the ids
            found = self.tokenizer.encode_batch_fast(texts[at : at + SLICE], add_special_tokens=False)
            out += [_packed(e.ids) for e in found]
        return out

    def words(self, text: str) -> list[str]:
        """Keys of the words of a text whose ids, joined, are the text's."""
        raise NotImplementedError

    def parts(self, word: str) -> tuple[str, ...]:
        """Keys of simpler words that the word consists of, or the word alone."""
        raise NotImplementedError

    def text(self, word: str) -> str:
        """What the library encodes for a word that has no parts."""
        raise NotImplementedError

    def letters(self, word: str) -> str | None:
        """The characters that the model gets for a run of Latin letters; null for any other word."""
        raise NotImplementedError

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Make sure that ``known`` has the words; return those that are too long to keep."""
        if len(self.known) > self.kept:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        single, joined = set(), {}
        for word in words.difference(known):
            if word in older:
                known[word] = older[word]
                continue
            parts = self.parts(word)
            if len(parts) == 1 and parts[0] == word:
                single.add(word)
                continue
            joined[word] = parts
            for part in parts:
                if part not in known:
                    if part in older:
                        known[part] = older[part]
                    else:
                        single.add(part)
        order: list[str] = []
        once: dict[str, bytes] = {}
        letters, tokens = self.letters, self.model.tokenize
        for word in single:
            if len(word) <= LONGEST and (given := letters(word)) is not None:
                known[word] = _packed([t.id for t in tokens(given)])
            else:
                order.append(word)
        for word, ids in zip(order, self.by_library([self.text(w) for w in order]), strict=True):
            (known if len(word) <= LONGEST else once)[word] = ids
        for word, parts in joined.items():
            ids = b"".join([once[p] if p in once else known[p] for p in parts])
            (known if len(word) <= LONGEST else once)[word] = ids
        return once

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts; null is empty."""
        out: list[bytes | None] = [None] * len(texts)
        cut: list[tuple[int, list[str]]] = []
        for k, text in enumerate(texts):
            if not text:
                out[k] = b""
            elif any(c in text for c in UNSURE):
                out[k] = self.by_library([text])[0]
            elif len(text) > BLOCK:
                out[k] = b"".join([self._joined(self.words(block)) for block in blocks(text)])
            else:
                cut.append((k, self.words(text)))
        once = self._learn(set().union(*[w for _, w in cut]))
        known = self.known
        for k, words in cut:
            try:
                out[k] = b"".join(map(known.__getitem__, words))
            except KeyError:
                out[k] = b"".join([once[w] if w in once else known[w] for w in words])
        return out

    def _joined(self, words: list[str]) -> bytes:
        once = self._learn(set(words))
        return b"".join([once[w] if w in once else self.known[w] for w in words])


def _marked(word: str) -> bool:
    """Whether a comma or full stop ends the word after a letter: it is a word of its own."""
    return len(word) > 1 and word[-1] in ",." and word[-2].lower().isalpha()


class ByteLevel(Encoder):
    """A key is a word without the space before it, a line break and what follows it, or any text after a mark."""

    MARK = "\n "

    def words(self, text: str) -> list[str]:
        if GAPS.search(text):
            return [self.MARK + p for p in PIECE.findall(text)]
        words = text.replace("\n", " \n").split(" ")
        words[0] = self.MARK + words[0]
        return words

    def parts(self, word: str) -> tuple[str, ...]:
        after = 2 if word.startswith(self.MARK) else 0
        if signed := SIGNED.fullmatch(word, after):
            return word[:after] + signed[1], self.MARK + signed[2]
        if _marked(word):
            return (*self.parts(word[:-1]), self.MARK + word[-1])
        if word[:1] == "\n" and len(word) > 1 and word[1] != " ":
            return "\n", *self.parts(self.MARK + word[1:])
        return (word,)

    def text(self, word: str) -> str:
        if word.startswith(self.MARK):
            return word[2:]
        return word if word == "\n" else " " + word

    def letters(self, word: str) -> str | None:
        if word.startswith(self.MARK):
            return _characters(word[2:]) if LETTERS.fullmatch(word, 2) else None
        return BYTES[0x20] + _characters(word) if LETTERS.fullmatch(word) else None


class WordEnds(Encoder):
    """A key is a word between white space."""

    def words(self, text: str) -> list[str]:
        return text.split()

    def parts(self, word: str) -> tuple[str, ...]:
        if signed := SIGNED.fullmatch(word):
            return signed[1].lower(), signed[2]
        if _marked(word):
            return (*self.parts(word[:-1]), word[-1])
        return (word.lower(),) if LETTERS.fullmatch(word) else (word,)

    def text(self, word: str) -> str:
        return word

    def letters(self, word: str) -> str | None:
        return _characters(word.lower()) if LETTERS.fullmatch(word) else None


class Whole(Encoder):
    """A tokenizer of another kind: the library encodes whole texts."""

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        return self.by_library([t or "" for t in texts])


def blocks(text: str) -> Iterator[str]:
    """The text in parts of about a million characters, cut where white space follows a visible character."""
    start = 0
    while len(text) - start > BLOCK and (cut := BOUNDARY.search(text, start + BLOCK)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def kind(path: str) -> type[Encoder]:
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    pre, normal = told.get("pre_tokenizer") or {}, told.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and normal is None:
        return ByteLevel
    steps = pre.get("pretokenizers", [])
    if steps and steps[0].get("type") == "Split" and steps[0].get("invert") and steps[0].get("behavior") == "Removed":
        return WordEnds
    return Whole


_encoders: dict[str, Encoder] = {}


def encoder(path: str, kept: int = KEPT) -> Encoder:
    """The worker's encoder for a tokenizer file; its cache of ``kept`` words serves all tasks of the worker."""
    if path not in _encoders:
        _encoders[path] = kind(path)(path)
    _encoders[path].kept = kept
    return _encoders[path]


def release() -> None:
    """Give up the caches: workers outlive a job, and the next operator may need their memory."""
    _encoders.clear()
    gc.collect()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)  # freed blocks below others go back to the system too
