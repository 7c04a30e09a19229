"""Words of many texts at once, as flat arrays with their places in the bytes of the texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass(frozen=True)
class Words:
    """Words between ASCII white space of the texts of one Arrow slice."""

    #: bytes of all texts, one after the other
    data: np.ndarray
    #: where each text begins and ends in ``data``
    offsets: np.ndarray
    #: first byte of each word, the byte behind its last, and the text it is in
    start: np.ndarray
    stop: np.ndarray
    text: np.ndarray
    #: the words themselves
    values: pa.Array

    def of_text(self) -> np.ndarray:
        """The numbers of the first words of the texts, and one more: where the last one ends."""
        return np.searchsorted(self.text, np.arange(len(self.offsets)))


def split_words(texts: pa.Array) -> Words:
    """Words of a slice without nulls: stretches of bytes that are not 9 to 13 or 32. A word does not reach into the next text."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        offsets = np.zeros(1, np.int64)
    else:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(texts) else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before, behind = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    start = np.flatnonzero(inside & (~before | border[:-1]))
    stop = np.flatnonzero(inside & (~behind | border[1:])) + 1
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=ends[1:])
    values = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return Words(data, offsets, start, stop, np.searchsorted(offsets, start, side="right") - 1, values)
