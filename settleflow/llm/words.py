"""Words of whole texts as arrays of 64-bit hashes, for use inside tasks.

A word is a run of bytes other than space and 0x09-0x0D of the UTF-8 text. Hashes of words are made of their bytes, and
hashes of runs of hashes of runs half as long, by steps that are not linear: no regular arrangement of letters or words
makes two of them collide more often than chance does.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once inside a task.
PIECE = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def paired(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order."""
    return mixed(mixed(one + np.uint64(0x9E3779B97F4A7C15)) + two)


class Texts(NamedTuple):
    """Rows ``first`` to ``first + len(offsets) - 1`` of a batch: their bytes, one after the other."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Texts]:
    """Whole texts of a column in pieces of about ``limit`` bytes; null is the empty text."""
    if len(column) == 0:
        return
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield Texts(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


def spans(texts: Texts, is_word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the index of the first word of every text (one more at the end)."""
    keep = ~_SPACE[texts.data] if is_word is None else is_word[texts.data]
    edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    first[edges] = keep[edges]
    last = keep.copy()
    last[:-1] &= ~keep[1:]
    ends = texts.offsets[1:][np.diff(texts.offsets) > 0] - 1
    last[ends] = keep[ends]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, texts.offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of every word: of the three 8-byte numbers a short word is, else BLAKE2b.

    Another seed gives hashes that collide for other words.
    """
    if not len(begin):
        return np.zeros(0, np.uint64)
    size = end - begin
    padded = np.concatenate([data, np.zeros(24, np.uint8)])
    numbers = np.ndarray(len(padded) - 7, np.dtype("<u8"), padded, strides=(1,))
    out = mixed(size.astype(np.uint64) + np.uint64(seed << 32))
    for at in (0, 8, 16):
        here = np.flatnonzero(size > at) if at else slice(None)
        beyond = np.clip(8 - (size[here] - at), 0, 7).astype(np.uint64) * np.uint64(8)
        out[here] = paired(out[here], numbers[begin[here] + at] & (_ALL >> beyond))
    long = np.flatnonzero(size > 24)
    if len(long):
        raw = data.tobytes()
        pairs = zip(begin[long].tolist(), end[long].tolist())
        out[long] = np.frombuffer(b"".join([blake2b(raw[a:b], digest_size=8, salt=bytes([seed])).digest() for a, b in pairs]), np.uint64)
    return out


def sequence_keys(texts: Texts, lower: bool) -> pa.Array:
    """128 bits of the words of every text, one space between; null without words."""
    begin, end, bounds = spans(texts)
    data = (_LOWER[texts.data] if lower else texts.data).copy()
    keep = ~_SPACE[texts.data]
    inner = np.ones(len(begin), bool)
    inner[bounds[1:][np.diff(bounds) > 0] - 1] = False  # behind the last word of a text nothing is kept
    data[end[inner]] = 0x20
    keep[end[inner]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[texts.offsets]
    raw = data[keep].tobytes()
    keys = [blake2b(raw[a:b], digest_size=16).digest() if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return pa.array(keys, pa.binary())


def hashed(texts: Texts, lower: bool, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the index of the first word of every text (one more at the end)."""
    begin, end, bounds = spans(texts)
    return word_hashes(_LOWER[texts.data] if lower else texts.data, begin, end, seed), bounds


class Runs:
    """Hashes of runs of consecutive words, by doubling: a run of 2n words is a pair of runs of n."""

    def __init__(self, words: np.ndarray):
        self._doubled = [words]

    def _of_power(self, power: int) -> np.ndarray:
        """Hashes of the runs of 2**power words from every place."""
        while len(self._doubled) <= power:
            half, size = self._doubled[-1], 1 << (len(self._doubled) - 1)
            self._doubled.append(paired(half[:-size], half[size:]) if len(half) > size else half[:0])
        return self._doubled[power]

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each start."""
        if not len(start):
            return np.zeros(0, np.uint64)
        found, at = None, start
        for power in reversed(range(length.bit_length())):
            if length >> power & 1:
                part = self._of_power(power)[at]
                found = part if found is None else paired(found, part)
                at = at + (1 << power)
        return mixed(found + np.uint64(length))


def runs_in_order(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words in the order of the texts, and the index of the first of every text (one more at the end).

    With fewer than ``size`` words the whole text is one run; without words there is none.
    """
    counts = np.diff(bounds)
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    of = np.concatenate([[0], np.cumsum(per)])
    row = np.repeat(np.arange(len(counts)), per)
    start, length = np.arange(of[-1]) - of[row] + bounds[row], np.minimum(counts[row], size)
    runs, values = Runs(words), np.empty(len(start), np.uint64)
    for n in range(1, size + 1):
        here = np.flatnonzero(length == n)
        values[here] = runs.of(start[here], n)
    return values, of


def lengths_to_rows(bounds: np.ndarray) -> np.ndarray:
    """The text of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, in ascending order, and the index of the first of every text.

    With fewer than ``size`` words the whole text is one shingle; without words there is none.
    """
    values, of = runs_in_order(words, bounds, size)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(of))
    order = np.lexsort((values, row)) if len(values) else np.zeros(0, np.int64)
    values, row = values[order], row[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[fresh], row[fresh]
    return values, np.searchsorted(row, np.arange(len(bounds)))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column; hashes as signed 64-bit numbers."""
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
