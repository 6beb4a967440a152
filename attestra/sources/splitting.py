"""Cut a JSON document into the exact bytes of its records, good or bad.

Only the structure is read: strings are skipped, brackets are tracked, no value is built, so a document costs no
more memory than its text.  Whether a record is valid JSON is decided later, by whoever parses it.  A
record whose brackets do not close ends where the next one begins: at a comma and an object whose first
field is the one that records of the document begin with.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

STRING = r'"[^"\\\x00-\x1f]*+(?:\\[^\x00-\x1f][^"\\\x00-\x1f]*+)*+"'
TOKEN = re.compile(STRING + r'|["{}\[\]]')
KEY = re.compile(rf"\s*({STRING})\s*:\s*")
SCALAR = re.compile(r"[^\s,\]}]+")
SPACE = re.compile(r"\s*")
FIRST_FIELD = re.compile(rf"\{{\s*({STRING})\s*:")
CLOSING = {"{": "}", "[": "]"}


@dataclass(frozen=True)
class Piece:
    """A record, or (``index`` is None) a part of the document that belongs to none; in characters, end exclusive."""

    index: int | None
    start: int
    end: int
    reason: str | None = None


def _space(text: str, at: int) -> int:
    return SPACE.match(text, at).end()


def value_end(text: str, at: int) -> int | None:
    """Where the value that begins at ``at`` ends; None if it does not close."""
    if text[at : at + 1] == '"':
        found = TOKEN.match(text, at)
        return found.end() if found.end() - at > 1 else None
    if text[at : at + 1] not in ("{", "["):
        found = SCALAR.match(text, at)
        return found.end() if found else None
    opened: list[str] = []
    for token in TOKEN.finditer(text, at):
        mark = token.group()
        if mark == '"':
            return None  # a string without an end
        if mark in ("{", "["):
            # Inside an object every container follows a colon: else a bracket is missing before it.
            if opened and opened[-1] == "{" and _before(text, token.start()) != ":":
                return None
            opened.append(mark)
        elif mark in ("}", "]"):
            if CLOSING[opened.pop()] != mark:
                return None
            if not opened:
                return token.end()
    return None


def _before(text: str, at: int) -> str:
    at -= 1
    while at >= 0 and text[at].isspace():
        at -= 1
    return text[at] if at >= 0 else ""


def _items(text: str, at: int) -> Iterator[Piece]:
    """The items of the list that opens at ``at``; the last piece has no index and ends behind the list."""
    begins: re.Pattern | None = None
    index, at = 0, _space(text, at + 1)
    if text[at : at + 1] == "]":
        yield Piece(None, at, at + 1)
        return
    while True:
        end = value_end(text, at)
        after = len(text) if end is None else _space(text, end)
        follows = text[after : after + 1]
        if end is not None and follows in (",", "]", "{", ""):
            yield Piece(index, at, end)
            if begins is None and (first := FIRST_FIELD.match(text, at)):
                begins = _begins(first)
            if follows == "{":
                yield Piece(None, end, after, "missing_comma")
            at = after
        else:
            first = FIRST_FIELD.match(text, at)
            again = begins or (first and _begins(first))
            found = again.search(text, at + 1) if again else None
            at, end = (len(text), at) if found is None else (found.start(), at)
            yield Piece(index, end, at, "unclosed_record")
            follows = text[at : at + 1]
        if follows == ",":
            comma, at = at, _space(text, at + 1)
            if text[at : at + 1] == "]":
                yield Piece(None, comma, at, "trailing_comma")
                follows = "]"
        if follows in ("]", ""):
            yield Piece(None, at, min(at + 1, len(text)))
            return
        index += 1


def _begins(first: re.Match) -> re.Pattern:
    """Where a further record begins: a comma and an object with the same first field."""
    return re.compile(rf",\s*(?=\{{\s*{re.escape(first.group(1))}\s*:)")


def pieces(text: str, records_field: str) -> tuple[str | None, list[Piece]]:
    """The metadata's text and the pieces of a document ``{metadata, <records_field>: [...]}``."""
    at = _space(text, 1 if text.startswith("﻿") else 0)
    if text[at : at + 1] != "{":
        return None, [Piece(None, at, len(text), "not_an_object")]
    metadata, found = None, []
    at = _space(text, at + 1)
    if text[at : at + 1] == "}":
        at += 1
    else:
        while True:
            key = KEY.match(text, at)
            end = None
            if key:
                name, at = json.loads(key.group(1)), key.end()
                if name == records_field and text[at : at + 1] == "[":
                    *items, last = _items(text, at)
                    found += items
                    end = last.end
                    if items and items[-1].reason == "unclosed_record" and items[-1].end == len(text):
                        return metadata, found
                else:
                    end = value_end(text, at)
                    if name == records_field and text[at:end] != "null":
                        found.append(Piece(None, at, end or len(text), "records_not_a_list"))
                    elif name == "metadata" and end is not None:
                        metadata = text[at:end]
            if end is None:
                return metadata, [*found, Piece(None, at, len(text), "malformed_document")]
            at = _space(text, end)
            if text[at : at + 1] == "}":
                at += 1
                break
            if text[at : at + 1] != ",":
                return metadata, [*found, Piece(None, at, len(text), "malformed_document")]
            at += 1
    rest = _space(text, at)
    if rest < len(text):
        found.append(Piece(None, rest, len(text), "trailing_text"))
    return metadata, found
