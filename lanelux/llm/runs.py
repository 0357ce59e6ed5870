"""Runs of word bytes in the texts of an Arrow batch, as arrays."""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class Runs:
    """``bytes`` of all runs one after another with A-Z lower-cased, their ``starts`` (one more than runs), each run's ``row``."""

    bytes: np.ndarray
    starts: np.ndarray
    row: np.ndarray

    def array(self) -> pa.Array:
        buffers = [None, pa.py_buffer(self.starts.astype(np.int64)), pa.py_buffer(self.bytes)]
        return pa.Array.from_buffers(pa.large_binary(), len(self.row), buffers)

    def only(self, chosen: np.ndarray) -> Runs:
        sizes = np.diff(self.starts)
        kept = np.repeat(chosen, sizes)
        return Runs(self.bytes[kept], np.concatenate([[0], np.cumsum(sizes[chosen])]), self.row[chosen])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins (one more than texts); a null text has none."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def runs(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Runs:
    """The maximal runs of bytes that are ``inside``, none across the bounds of a text."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    before = np.cumsum(inside)
    places = np.append(before[starts] - 1, before[-1] if len(before) else 0)
    return Runs(_FOLD[data[inside]], places, np.searchsorted(bounds, starts, "right") - 1)
