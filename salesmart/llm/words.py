"""Words of many texts at once: their bytes side by side, and where each one stands."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: What a byte is: part of a word, a gap between words, or the end of a piece of text.
WORD, GAP, BREAK = 0, 1, 2
#: White space between words where no contract says otherwise: blank and U+0009 to U+000D.
SPACE = b" \t\n\v\f\r"


def kinds(gaps: Iterable[int], breaks: Iterable[int] = ()) -> np.ndarray:
    """The kind of each of the 256 bytes."""
    table = np.zeros(256, np.uint8)
    table[list(gaps)] = GAP
    table[list(breaks)] = BREAK
    return table


def _folded() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


#: Bytes with A-Z lower-cased; bytes of longer characters stay.
FOLD = _folded()


class Words(NamedTuple):
    """Words in the order of the texts, as places in a dictionary of distinct ones."""

    distinct: pa.Array  # binary
    code: np.ndarray  # of each word
    owner: np.ndarray  # text of each word
    piece: np.ndarray  # rises by one or more at every break and every text


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without its nulls, and the offsets of its texts in them."""
    raw = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = raw.buffers()
    ends = np.frombuffer(offsets, np.int64, len(raw) + 1, raw.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def split_words(column: pa.Array, kind: np.ndarray) -> Words:
    """The lower-cased words of a string column; null is the empty text."""
    data, ends = flat_bytes(column)
    what = kind[data]
    inside = what == WORD
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    filled = ends[:-1][ends[:-1] < ends[1:]]
    first[filled] = inside[filled]
    starts = np.flatnonzero(first)
    bytes_of_words = FOLD[data[inside]]
    joined = np.append(np.flatnonzero(first[inside]), len(bytes_of_words)).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(joined), pa.py_buffer(bytes_of_words)]
    ).dictionary_encode()
    sizes = np.diff(np.searchsorted(starts, ends))
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    broken = np.bincount(np.searchsorted(starts, np.flatnonzero(what == BREAK)), minlength=len(starts) + 1)
    piece = np.cumsum(broken[: len(starts)], dtype=np.int32) + owner
    code = found.indices.to_numpy() if len(starts) else np.zeros(0, np.int32)
    return Words(found.dictionary.cast(pa.binary()), code, owner, piece)


def hashes(values: pa.Array, seed: int) -> np.ndarray:
    """64-bit hashes (SipHash with a key from the seed) of binary values, as signed numbers."""
    found = values.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(found, hash_key=f"{seed:016x}", categorize=False).view(np.int64)


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, sorted, and how often each one occurs."""
    ordered = np.sort(codes)
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    return ordered[starts], np.diff(np.append(starts, len(ordered)))
