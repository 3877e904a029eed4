"""Fingerprints by consistent weighted sampling: how many samples agree tells how alike two texts are.

A text is a weighted set: its words, lower-cased (A-Z), each weighted by its number of occurrences.  Every
sample draws, for each word alone, r and c from Gamma(2, 1) and b from (0, 1), the same wherever the word
stands.  A word of weight S gets

    t = floor(ln S / r + b),  y = exp(r (t - b)),  a = c / (y exp(r))

and the sample is the pair (word, t) of least a.  Two texts agree in a sample with the probability of their
generalised Jaccard similarity, sum of least weights over sum of greatest.  The likeness of two fingerprints
is the share of samples that agree.  A sample is kept as 16 bits of a hash of (word, t), so that two different
ones agree by chance once in 65,536.

Draws are quantiles of the gamma distribution (tables, made once and sent to the tasks) at shares that are
the bits of a hash of (word, sample): the same in every task and run.  The sample itself is a minimum of
64-bit numbers: the upper half orders by a, the lower half is the hash of (word, t).

Cases: null is the empty text; texts without words have the same fingerprint, likeness 1 to each other and
0 to others; equal texts have equal fingerprints; rows with null ids come last in the order, repeated ids go
by text, both with a row each; one row is its own next document; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.succession import RANGE_BYTES, in_ranges, successors
from salesmart.llm.words import SPACE, counted, hashes, kinds, split_words

SAMPLES = 96
SEED = 11
#: Bits of the shares that r, c and b are drawn at.
R_BITS, C_BITS, B_BITS = 16, 16, 24
#: Characters of text that a task works on at a time.
PIECE = 2 << 20

_KIND = kinds(SPACE)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Quantiles(NamedTuple):
    """Quantiles of Gamma(2, 1): of r, and of c as logarithms, at the middles of equal shares."""

    r: np.ndarray
    log_c: np.ndarray


@cache
def quantiles() -> Quantiles:
    """Distribution 1 - (1 + x) exp(-x), inverted on a fine grid of ln x."""
    log_x = np.linspace(np.log(1e-5), np.log(60.0), 1 << 21)
    x = np.exp(log_x)
    # for small x the difference of nearly equal numbers is replaced by its series
    share = np.where(x < 1e-3, x**2 / 2 - x**3 / 3, 1 - (1 + x) * np.exp(-x))

    def at(bits: int) -> np.ndarray:
        return np.interp((np.arange(1 << bits) + 0.5) / (1 << bits), share, log_x)

    return Quantiles(np.exp(at(R_BITS)).astype(np.float32), at(C_BITS).astype(np.float32))


def draws(keys: np.ndarray, sample: int, table: Quantiles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of every word (by its hash) in one sample: three shares from the bits of one hash."""
    x = _scrambled(keys.view(np.uint64) + np.uint64((sample + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
    r = np.take(table.r, (x & np.uint64((1 << R_BITS) - 1)).view(np.int64), mode="clip")
    log_c = np.take(table.log_c, (x >> np.uint64(64 - C_BITS)).view(np.int64), mode="clip")
    b = ((x >> np.uint64(R_BITS)) & np.uint64((1 << B_BITS) - 1)).astype(np.float32)
    return r, log_c, (b + np.float32(0.5)) * np.float32(2.0**-B_BITS)


def ranks(keys: np.ndarray, log_weight: np.ndarray, sample: int, table: Quantiles) -> np.ndarray:
    """For weighted words: a number that orders them by a, with the hash of (word, t) in its lower half."""
    r, log_c, b = draws(keys, sample, table)
    t = np.floor(log_weight / r + b)
    log_a = log_c - r * (t - b + np.float32(1))
    bits = log_a.view(np.int32)
    order = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))  # orders like the number
    drawn = keys.view(np.uint64).astype(np.uint32) ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
    return (order.astype(np.int64) << 32) | drawn


def signatures(texts: pa.Array, samples: int = SAMPLES, table: Quantiles | None = None) -> np.ndarray:
    """A row of 16-bit samples for each text."""
    table = table or quantiles()
    words = split_words(texts, _KIND)
    out = np.zeros((len(texts), samples), np.uint16)
    if not len(words.code):
        return out
    size = len(words.distinct)
    codes, weights = counted(words.owner.astype(np.int64) * size + words.code)
    owner, code = codes // size, codes % size
    # equal words of equal weight draw alike in every text
    kinds_of, place = np.unique(weights * size + code, return_inverse=True)
    keys = hashes(words.distinct, SEED)[kinds_of % size]
    log_weight = np.log(kinds_of // size).astype(np.float32)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    filled = owner[starts]
    found, gathered = np.zeros((samples, len(starts)), np.uint16), np.empty(len(place), np.int64)
    for sample in range(samples):
        np.take(ranks(keys, log_weight, sample, table), place, out=gathered, mode="clip")
        found[sample] = np.minimum.reduceat(gathered, starts).astype(np.uint16)
    out[filled] = found.T
    return out


def likeness(a: np.ndarray, b: np.ndarray, a_filled: np.ndarray, b_filled: np.ndarray) -> np.ndarray:
    """The share of samples that agree, row by row; a text without words is like such texts only."""
    return np.where(a_filled & b_filled, (a == b).mean(axis=1), (a_filled == b_filled).astype(np.float64))


def _digits(rows: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in rows]


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by as many first characters of the text after it."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def _filled(texts: list[str]) -> np.ndarray:
    return np.array([bool(t.strip(SPACE.decode())) for t in texts], bool)


def _encoded(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())


_FOUND = (
    "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _report(ids: list, texts: list[str], after: list[str], samples: int, table: Quantiles | None = None) -> pa.RecordBatch:
    changed = [edited(t, a) for t, a in zip(texts, after, strict=True)]
    # the text after a row is mostly the next row's text, whose signature is there already
    distinct = list(dict.fromkeys([*texts, *after]))
    place = {t: i for i, t in enumerate(distinct)}
    found = signatures(_encoded([*distinct, *changed]), samples, table)
    own = found[[place[t] for t in texts]]
    following = found[[place[t] for t in after]]
    other = found[len(distinct) :]
    filled = _filled(texts)
    return pa.RecordBatch.from_pydict(
        {
            "id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": pa.array(_digits(own), pa.string()),
            "edited_fingerprint": pa.array(_digits(other), pa.string()),
            "near_edited": pa.array(likeness(own, other, filled, _filled(changed)), pa.float64()),
            "near_next": pa.array(likeness(own, following, filled, _filled(after)), pa.float64()),
        }
    )


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", samples: int = SAMPLES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    table = docs.sparkSession.sparkContext.broadcast(quantiles())  # 0.5 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, after, held = [], [], [], 0
        for row_id, own, following in successors(batches):
            ids.append(row_id)
            texts.append(own)
            after.append(following)
            held += len(own) + len(following)
            if held >= 2 * PIECE:
                yield _report(ids, texts, after, samples, table.value)
                ids, texts, after, held = [], [], [], 0
        if ids:
            yield _report(ids, texts, after, samples, table.value)

    ranges = in_ranges(docs, id, text, range_bytes)
    if ranges is None:
        return docs.sparkSession.createDataFrame([], _FOUND).withColumnRenamed("id", id)
    return ranges.select("id", "text", "guest").mapInArrow(run, _FOUND).withColumnRenamed("id", id)
