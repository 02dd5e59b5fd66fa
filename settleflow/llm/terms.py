"""Terms of whole texts as byte strings, so that equal terms are equal and no hash stands for a word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from settleflow.llm.words import Texts, spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    """Which byte values belong to a term: the given ranges, ends included, and all bytes of other than ASCII characters."""
    inside = np.zeros(256, bool)
    inside[0x80:] = True
    for low, high in ranges:
        inside[low : high + 1] = True
    return inside


LETTERS = bytes_in((0x41, 0x5A), (0x61, 0x7A))
LETTERS_DIGITS = bytes_in((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


def terms_of(texts: Texts, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Every term (maximal run, A-Z in lower case) in order, and the index of the first term of every text (one more at the end)."""
    begin, end, bounds = spans(texts, inside)
    data = _LOWER[texts.data[inside[texts.data]]]
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=offsets[1:])
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return found, bounds


def codes_in(terms: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """The place of every term in the vocabulary, -1 where it has none. Bytes are compared, not hashes alone."""
    return pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
