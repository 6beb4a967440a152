"""Words of many lines as 44-bit numbers, with numpy over the bytes of a batch.

The hash of a word is a polynomial of its bytes modulo 2**64, taken as a difference of prefix sums and
mixed; ASCII letters are lower-cased by the table of byte values.  Words are separated by ASCII white
space, lines by ``\\n``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18  # bytes that are hashed at once, few enough for the caches of a core; a longer line is hashed whole
BITS = 44
MASK = np.uint64((1 << BITS) - 1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_random = np.random.default_rng(20240229)
VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
VALUES[ord("A") : ord("Z") + 1] = VALUES[ord("a") : ord("z") + 1]
_powers: dict[str, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """``base ** k`` modulo 2**64 for ``k`` below ``size``; kept for ordinary chunks."""
    if size > CHUNK:
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, base, np.uint64))])
    if str(base) not in _powers:
        _powers[str(base)] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(CHUNK - 1, base, np.uint64))])
    return _powers[str(base)][:size]


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of each number."""
    h = (h + np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


@dataclass
class Lines:
    """Lines with words: their text's position in the batch, their number in the text, and their distinct words.

    ``words`` are ascending numbers of line after line; ``owner`` is the line of each, ``sizes`` counts them.
    """

    text: np.ndarray
    number: np.ndarray
    sizes: np.ndarray
    owner: np.ndarray
    words: np.ndarray

    def at_least(self, words: int) -> Lines:
        """The lines with so many distinct words."""
        keep = self.sizes >= words
        place = np.cumsum(keep) - 1
        mine = keep[self.owner]
        return Lines(self.text[keep], self.number[keep], self.sizes[keep], place[self.owner[mine]], self.words[mine])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each starts and ends; null is empty."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Bytes of whole lines, where texts start in them, the first text, and how many of its lines came before."""
    data, offsets = flat(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        if offsets[last] - offsets[first] <= CHUNK:
            if offsets[last] > offsets[first]:
                yield data[offsets[first] : offsets[last]], offsets[first:last] - offsets[first], first, 0
        else:  # one long text: cut behind line breaks
            at, number = int(offsets[first]), 0
            while at < offsets[last]:
                to = min(at + CHUNK, int(offsets[last]))
                if to < offsets[last]:
                    breaks = np.nonzero(data[at:to] == 10)[0]
                    if len(breaks):
                        to = at + int(breaks[-1]) + 1
                    else:
                        rest = np.nonzero(data[to : offsets[last]] == 10)[0]
                        to = to + int(rest[0]) + 1 if len(rest) else int(offsets[last])
                yield data[at:to], np.zeros(1, np.int64), first, number
                number += int((data[at:to] == 10).sum())
                at = to
        first = last


def lines(column: pa.Array) -> Iterator[Lines]:
    """The lines of a column of texts, chunk by chunk."""
    for chunk in _chunks(column):
        yield _lines(*chunk)


def hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """The numbers of all words of a column of texts, repeats included, chunk by chunk."""
    for data, starts, _, _ in _chunks(column):
        yield _hashed(data, starts)[0]


def line_counts(column: pa.Array) -> np.ndarray:
    """How many lines each text has: none if null, one if empty."""
    data, offsets = flat(column)
    breaks = np.nonzero(data[offsets[0] : offsets[-1]] == 10)[0] + offsets[0]
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    return np.where(column.is_valid().to_numpy(zero_copy_only=False), counts, 0)


def _hashed(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and places of the words of the texts that start at ``starts`` in ``data``, and where lines break."""
    gaps = np.nonzero((data - np.uint8(9) <= 4) | (data == 32))[0]
    # What lies between two gaps, or a gap and the border of a text; words are those that are not empty.
    begin = np.sort(np.concatenate([starts, gaps + 1]))
    end = np.sort(np.concatenate([starts[1:], gaps, [len(data)]]))
    some = end > begin
    begin, end = begin[some], end[some]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(VALUES[data] * _power(BASE, len(data)), out=sums[1:])
    found = mixed((sums[end] - sums[begin]) * _power(INVERSE, len(data))[begin], 0) >> np.uint64(64 - BITS)
    return found, begin, gaps[data[gaps] == 10]


def _lines(data: np.ndarray, starts: np.ndarray, first: int, number: int) -> Lines:
    """Lines of the texts that start at ``starts`` in ``data``; ``number`` lines of the first one came before."""
    found, begin, breaks = _hashed(data, starts)
    bounds = np.searchsorted(begin, np.sort(np.concatenate([starts, breaks + 1])))  # texts begin lines too
    counts = np.diff(bounds, append=len(begin))
    some = counts > 0
    counts, place = counts[some], begin[bounds[some]]
    of_text = np.searchsorted(starts, place, side="right") - 1
    numbers = np.searchsorted(breaks, place) - np.searchsorted(breaks, starts)[of_text]
    numbers[of_text == 0] += number

    keys = np.sort(np.repeat(np.arange(len(counts), dtype=np.uint64) << np.uint64(BITS), counts) | found)
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    owner = (keys >> np.uint64(BITS)).astype(np.int64)
    return Lines(of_text + first, numbers, np.bincount(owner, minlength=len(place)), owner, keys & MASK)
