"""Katz backoff language model, learnt and applied by distributed counting.

Tokens are words and one end for each text; every word is a symbol, and every pair of neighbours seen
in training is counted, whatever the size of the vocabulary.

    P(w | h) = d(r) * r / n        for a pair seen r times after a history seen n times
    P(w | h) = a(h) * P(w)         for others

with Good-Turing discounts d(1) .. d(K_MAX).  a(h) hands out exactly what the discounts left over:
(1 - sum of seen P) / (1 - sum of the seen words' P).  After a history whose pairs were all seen too often
to be discounted, n is one more, so that something is left.  One token more than was seen is the place of
unknown words.

With WORDS given, only so many words are symbols, the most frequent ones; all others share the symbol
"rare" and have a discounted probability of their own within it.

Words are known by 64-bit hashes and dealt by these into cells.  A cell holds all pairs that end in its
words, so their counts are known there.  Sums over a text are taken where the data is: in the cell of the
word what depends on the pair and the word; in the cell of the history, for unseen pairs only, its weight.
Tasks of the corpus send (pair, text, count), added up; a cell that holds many tokens is looked up in several
parts, each with its own copy of the cell's table, so that no frequent pair or word is a task of its own.

Cases: null is the empty text, whose only token is the end; rows without an id count as training
text; rows that repeat both id and text give as many equal rows; an empty table gives an empty one.
Without training text every token is unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, pieces

#: Words with a symbol of their own; None: all.
WORDS: int | None = None
START, END, RARE, FIRST_WORD = 0, 1, 2, 3
#: Counts up to this are discounted.
K_MAX = 5
#: Tokens that a cell, and a part of a cell, is meant to hold; most cells (beyond, parts only grow in number).
CELL_TOKENS = 2_000_000
MOST_CELLS = 4096
#: Bytes of text for each token, to choose the number of cells.
TOKEN_BYTES = 6
#: Bytes of text whose pairs a task sorts at a time.
PIECE = 4 << 20
#: Partial pair tables that one task adds up.
FAN = 8

_LOW = np.uint64((1 << 32) - 1)
_HALF = np.uint64(32)


def discounts(ones: list[int], most: int = K_MAX) -> list[float]:
    """d(0) .. d(most) from the numbers of things seen 1 .. most + 1 times; d(0) is not used.

    Katz's form of Good-Turing, or, where these numbers are too few for it, absolute discounting.
    """
    n = [0, *ones]
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    common = (most + 1) * n[most + 1] / n[1] if n[1] else 1.0
    out = [1.0]
    for r in range(1, most + 1):
        d = 0.0
        if n[r] and n[r + 1] and common < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
        out.append(d if 0 < d < 1 else (r - absolute) / r)
    return out


class Model(NamedTuple):
    total: int  # training tokens
    distinct: int
    cells: int
    parts: list[int]  # of each cell
    factors: list[float]  # discounts of pairs
    book: np.ndarray | None  # keys of the words with a symbol, if others have none
    last: tuple[int, str] | None  # count and word of the last of these
    rare_total: int
    rare_discounts: list[float]
    unknown: float  # P(unknown word | rare)


class Pairs(NamedTuple):
    """Pairs sorted by word and history: distinct sorted keys, and the place of each pair's among them."""

    words: np.ndarray
    word: np.ndarray
    histories: np.ndarray
    history: np.ndarray

    def codes(self) -> np.ndarray:
        return self.word.astype(np.uint64) << _HALF | self.history.astype(np.uint64)


def _token_codes(piece: pa.RecordBatch, text: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of the texts, the place of each token among them, and the texts' sizes."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(piece.column(text), "")))
    coded = pc.list_flatten(split).dictionary_encode()
    at = coded.indices.to_numpy() if len(coded) else np.zeros(0, np.int32)
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    # white space at the ends of a text leaves empty strings
    full = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[at]
    if not full.all():
        ends = np.append(0, np.cumsum(full))[np.append(0, np.cumsum(sizes))]
        at, sizes = at[full], np.diff(ends)
    return coded.dictionary, at, sizes


def word_keys(found: pa.Array) -> np.ndarray:
    """64-bit hashes of words, above the keys of the other symbols."""
    keys = pd.util.hash_array(np.array(found.to_pylist(), object), categorize=False)
    return np.maximum(keys, np.uint64(FIRST_WORD))


def _tokens(piece: pa.RecordBatch, text: str, book: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys; the pair of every token, ends included, as places (word, history) among them; owners; sizes."""
    found, at, sizes = _token_codes(piece, text)
    keys = word_keys(found) if len(found) else np.zeros(0, np.uint64)
    if book is not None:
        keys = np.where(np.isin(keys, book), keys, np.uint64(RARE))
    ranked, place = np.unique(np.append(np.array([START, END], np.uint64), keys), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    sequence = np.full(len(at) + len(sizes), END, np.uint64)
    sequence[np.arange(len(at)) + owner] = place[2:][at]
    history = np.append(np.uint64(START), sequence[:-1]).astype(np.uint64)
    history[np.cumsum(sizes + 1) - sizes - 1] = START
    return ranked, sequence << _HALF | history, np.repeat(np.arange(len(sizes)), sizes + 1), sizes


def _planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers byte by byte, as the high bytes are mostly zero, and compressed; the size comes first."""
    x = np.ascontiguousarray(numbers.astype(kind))
    data = x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Steps between sorted keys."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), "<u8")


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, "<u8"), dtype=np.uint64)


_PACKED = {"words": "binary", "runs": "binary", "histories": "binary", "history": "binary"}


def _packed_pairs(ranked: np.ndarray, codes: np.ndarray) -> dict[str, bytes]:
    """Sorted pairs (places of word and history among the ranked keys), packed; repeated ones stay."""
    word = codes >> _HALF
    starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    met, history = np.unique(codes & _LOW, return_inverse=True)
    return {
        "words": _packed(ranked[word[starts]]),
        "runs": _planes(np.diff(np.append(starts, len(word))), "<u4"),
        "histories": _packed(ranked[met]),
        "history": _planes(history, "<u4"),
    }


def _pairs_of(row: dict) -> Pairs:
    words, histories = _unpacked(row["words"]), _unpacked(row["histories"])
    return Pairs(words, np.repeat(np.arange(len(words)), _unplanes(row["runs"], "<u4")), histories, _unplanes(row["history"], "<u4"))


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted key among the sorted ones, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _cell_edges(cells: int) -> np.ndarray:
    """Where cells 1 .. begin among the keys."""
    return np.array([-(-(c << 64) // cells) for c in range(1, cells)], np.uint64)


def _by_cell(keys: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, int]]:
    """(cell, from, to) of the cells that sorted keys fall into."""
    ends = [0, *np.searchsorted(keys, edges), len(keys)]
    return [(c, int(a), int(b)) for c, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]


def _schema(kinds: dict[str, str]) -> tuple[pa.Schema, str]:
    of = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(n, of[k]) for n, k in kinds.items()]), ", ".join(f"{n} {k}" for n, k in kinds.items())


def count_words(frame: DataFrame, text: str) -> DataFrame:
    """(word, n) of all texts of the frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                found, at, _ = _token_codes(piece, text)
                n = np.bincount(at, minlength=len(found))
                seen = n > 0
                yield pa.RecordBatch.from_arrays([found.filter(pa.array(seen)), pa.array(n[seen])], names=["word", "n"])

    rows = frame.select(text).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def count_pairs(frame: DataFrame, text: str, book: np.ndarray | None, cells: int, parts: int) -> DataFrame:
    """For every cell one row: its packed pairs and their 8-byte counts."""
    spread = frame.sparkSession.sparkContext.broadcast(book)
    edges = _cell_edges(cells)
    kinds, sql = _schema({"cell": "bigint", "part": "bigint", **_PACKED, "counts": "binary"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                ranked, codes, _, _ = _tokens(piece, text, spread.value)
                codes, n = np.unique(codes, return_counts=True)
                part = int(codes.sum() % np.uint64(parts))
                rows = [
                    {"cell": c, "part": part, **_packed_pairs(ranked, codes[a:b]), "counts": _planes(n[a:b], "<i8")}
                    for c, a, b in _by_cell(ranked[codes >> _HALF], edges)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    def add(table: pa.Table) -> pa.Table:
        ranked = np.unique(np.concatenate([_unpacked(k.as_py()) for c in ("words", "histories") for k in table.column(c)]))
        codes, n = [], []
        for i in range(table.num_rows):
            row = table.slice(i, 1).to_pylist()[0]
            r = _pairs_of(row)
            places = (np.searchsorted(ranked, k).astype(np.uint32) for k in (r.words, r.histories))
            codes.append(Pairs(r.words, next(places)[r.word], r.histories, next(places)[r.history]).codes())
            n.append(_unplanes(row["counts"], "<i8"))
        codes, n = np.concatenate(codes), np.concatenate(n)
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
        del order
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        row = {"cell": table.column("cell")[0].as_py(), "part": table.column("part")[0].as_py()}
        row |= {**_packed_pairs(ranked, codes[starts]), "counts": _planes(np.add.reduceat(n, starts), "<i8")}
        return pa.Table.from_pylist([row], schema=kinds)

    rows = frame.select(text).mapInArrow(run, sql).groupBy("cell", "part").applyInArrow(add, sql)
    while parts > 1:
        parts = -(-parts // FAN)
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("cell", "part").applyInArrow(add, sql)
    return rows.drop("part")


def _cell_figures(table: DataFrame) -> list[dict]:
    """Tokens, distinct words and pairs seen 1 .. K_MAX + 1 times of every cell."""
    names = ["cell", "tokens", "distinct", *(f"n{r}" for r in range(1, K_MAX + 2))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = _unplanes(row["counts"], "<i8")
                ones = np.bincount(np.minimum(n, K_MAX + 2), minlength=K_MAX + 3)[1 : K_MAX + 2]
                values = [row["cell"], int(n.sum()), len(_unpacked(row["words"])), *ones.tolist()]
                yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(names, values, strict=True)}, schema=kinds)

    kinds, sql = _schema(dict.fromkeys(names, "bigint"))
    return [r.asDict() for r in table.select("cell", "words", "counts").mapInArrow(run, sql).collect()]


def _discount(counts: np.ndarray, factors: list[float]) -> np.ndarray:
    """Discounted counts."""
    return counts * np.append(factors, 1.0)[np.minimum(counts, K_MAX + 1)]


def histories(table: DataFrame, model: Model) -> DataFrame:
    """(cell, keys, every, unseen): of each history the log10 of what scales all its pairs, and, for unseen pairs,
    of its backoff weight times how often it was seen, without that scale."""
    edges, width = _cell_edges(model.cells), K_MAX + 2
    sent, sent_sql = _schema({"cell": "bigint", "keys": "binary", "sums": "binary"})
    kinds, sql = _schema({"cell": "bigint", "keys": "binary", "every": "binary", "unseen": "binary"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, n = _pairs_of(row), _unplanes(row["counts"], "<i8")
                size = len(pairs.histories)
                share = np.zeros(len(pairs.words), np.int64)
                np.add.at(share, pairs.word, n)
                share += pairs.words == RARE
                # whole numbers: how often it was seen, the seen words' counts, and its pairs seen 1 .. K_MAX times
                sums = np.zeros((size, width), np.int64)
                np.add.at(sums[:, 0], pairs.history, n)
                np.add.at(sums[:, 1], pairs.history, share[pairs.word])
                few = n <= K_MAX
                sums[:, 2:] = np.bincount(pairs.history[few] * np.int64(K_MAX) + n[few] - 1, minlength=size * K_MAX).reshape(size, K_MAX)
                rows = [{"cell": c, "keys": _packed(pairs.histories[a:b]), "sums": _planes(sums[a:b].ravel(), "<i8")} for c, a, b in _by_cell(pairs.histories, edges)]
                yield pa.RecordBatch.from_pylist(rows, schema=sent)

    def weigh(table: pa.Table) -> pa.Table:
        found = [_unpacked(k.as_py()) for k in table.column("keys")]
        keys = np.unique(np.concatenate(found))
        sums = np.zeros((len(keys), width), np.int64)
        for k, x in zip(found, table.column("sums"), strict=True):
            sums[np.searchsorted(keys, k)] += _unplanes(x.as_py(), "<i8").reshape(-1, width)
        n, unseen = sums[:, 0], model.total + 1 - sums[:, 1]
        left = sums[:, 2:] @ (np.arange(1, K_MAX + 1) * (1 - np.array(model.factors[1:])))
        none = (left <= 0) & (unseen > 0)
        counted, left = n + none, np.where(none, 1.0, left)
        # A history that every symbol has followed has nowhere to back off to; its discounts are undone by scaling.
        every = np.log10(n / np.where(unseen > 0, counted, n - left))
        weight = np.where(unseen > 0, left / counted * (model.total + 1) / np.maximum(unseen, 1), 1)
        row = {"cell": table.column("cell")[0].as_py(), "keys": _packed(keys), "every": every.tobytes()}
        row["unseen"] = (np.log10(weight * n) - every).tobytes()
        return pa.Table.from_pylist([row], schema=kinds)

    return table.mapInArrow(run, sent_sql).groupBy("cell").applyInArrow(weigh, sql)


def train(frame: DataFrame, text: str) -> tuple[Model, DataFrame | None, DataFrame]:
    """The model's bounded part, the (word, n) table if some words have no symbol, and the pair table."""
    size, texts_ = frame.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    cells = max(1, min(MOST_CELLS, -(-size // (TOKEN_BYTES * CELL_TOKENS))))
    book = last = words = None
    rare_total, rare_discounts, unknown = 0, [1.0], 1.0
    if WORDS is not None:
        words = cut(count_words(frame, text))
        distinct = words.count()
        if distinct > WORDS:
            top = words.orderBy(F.desc("n"), "word").limit(WORDS).collect()
            book = np.sort(word_keys(pa.array([r["word"] for r in top], pa.string())))
            last = (top[-1]["n"], top[-1]["word"])
            others = rare_words(words, last)
            rare_total = others.agg(F.sum("n")).first()[0]
            few = others.where(F.col("n") <= K_MAX + 1).groupBy("n").agg(F.count("*").alias("k"))
            by = {r["n"]: r["k"] for r in few.collect()}
            rare_discounts = discounts([by.get(r, 0) for r in range(1, K_MAX + 2)])
            kept = rare_total - sum(r * by.get(r, 0) * (1 - rare_discounts[r]) for r in range(1, K_MAX + 1))
            unknown = 1 - kept / (rare_total + 1)
    table = cut(count_pairs(frame, text, book, cells, max(1, -(-size // (TOKEN_BYTES * CELL_TOKENS * cells)))))
    figures = _cell_figures(table)
    parts = [1] * cells
    for f in figures:
        parts[f["cell"]] = max(1, -(-f["tokens"] // CELL_TOKENS))
    factors = discounts([sum(f[f"n{r}"] for f in figures) for r in range(1, K_MAX + 2)])
    total = sum(f["tokens"] for f in figures)
    known = sum(f["distinct"] for f in figures) if book is None else distinct + (texts_ > 0)
    return Model(total, known, cells, parts, factors, book, last, rare_total, rare_discounts, unknown), words, table


def rare_words(words: DataFrame, last: tuple[int, str] | None) -> DataFrame:
    """The words after the last of the most frequent ones, in the order in which these were taken."""
    if last is None:
        return words.where(F.lit(False))
    n, word = last
    return words.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))


_KEYS = ["id", "mark"]
_SUMS = ["copies", "n_tokens", "n_known", "base_score", "score"]
_TEXTS = {"ids": "binary", "marks": "binary", "sizes": "binary"}
_SENT = {"piece": "bigint", "cell": "bigint", "part": "bigint", **_TEXTS, **_PACKED, "counts": "binary", "owners": "binary"}
#: Sums of texts (owners), and unseen pairs' histories with texts and counts.
_FOUND = {"piece": "bigint", "cell": "bigint", **_TEXTS, "owners": "binary", "sums": "binary", "keys": "binary", "history": "binary", "texts": "binary", "counts": "binary"}


def _sent(frame: DataFrame, model: Model) -> DataFrame:
    """From (id, mark, text): (pair, text, count) for the cells, by piece of the corpus."""
    spread = frame.sparkSession.sparkContext.broadcast(model.book)
    edges, parts = _cell_edges(model.cells), model.parts
    kinds, sql = _schema(_SENT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            # at most 2 ** 16 texts at a time, whose numbers fit two bytes
            for piece in pieces(batch, "text", PIECE):
                for a in range(0, piece.num_rows, 1 << 16):
                    yield sent(piece.slice(a, 1 << 16), number)
                    number += 1

    def sent(piece: pa.RecordBatch, number: int) -> pa.RecordBatch:
        ranked, codes, owner, sizes = _tokens(piece, "text", spread.value)
        codes, which = np.unique(codes, return_inverse=True)
        entries, n = np.unique(which * np.int64(len(sizes)) + owner, return_counts=True)
        codes, owner = codes[entries // len(sizes)], entries % len(sizes)
        # the first row brings the texts themselves; every text has an end, in the first cell
        texts = {k: np.ascontiguousarray(x, np.int64).tobytes() for k, x in zip(_TEXTS, (*(piece.column(k).to_numpy() for k in _KEYS), sizes + 1), strict=True)}
        rows = []
        for c, a, b in _by_cell(ranked[codes >> _HALF], edges):
            row = {"piece": number, "cell": c, "part": (number ^ number >> 32) % parts[c], **_packed_pairs(ranked, codes[a:b])}
            rows.append(row | {"counts": _planes(n[a:b], "<u4"), "owners": _planes(owner[a:b], "<u2")} | (texts if not rows else {}))
        return pa.RecordBatch.from_pylist(rows, schema=kinds)

    return frame.mapInArrow(send, sql)


def _rare(frame: DataFrame, model: Model) -> DataFrame:
    """(id, mark, word, times) of the words without a symbol."""
    spread = frame.sparkSession.sparkContext.broadcast(model.book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, at, sizes = _token_codes(piece, "text")
                rare = ~np.isin(word_keys(found), spread.value)[at] if len(found) else np.zeros(0, bool)
                owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
                which, n = np.unique(owner * (len(found) + 1) + at[rare], return_counts=True)
                rows = pa.array(which // (len(found) + 1))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(k).take(rows) for k in _KEYS), found.take(pa.array(which % (len(found) + 1))), pa.array(n)],
                    names=[*_KEYS, "word", "times"],
                )

    return frame.mapInArrow(run, "id bigint, mark bigint, word string, times bigint")


def _text_sums(sent: DataFrame, table: DataFrame, model: Model) -> DataFrame:
    """(id, mark, n_tokens, n_known, base_score, score) of every text.

    A cell returns one row for each piece that sent to it; a piece's rows meet, and its unseen pairs go on to the
    cells of their histories: the number of rows does not grow with texts times cells.
    """
    weights = cut(histories(table, model))
    edges = _cell_edges(model.cells)
    kinds, sql = _schema(_FOUND)
    whole = math.log10(model.total + 1)

    def score(texts: pa.Table, cell: pa.Table) -> pa.Table:
        rows = cell.to_pylist()
        pairs, n = Pairs(*[np.zeros(0, np.uint64)] * 4), np.zeros(0, np.int64)
        keys, every = np.zeros(0, np.uint64), np.zeros(0)
        for row in rows:
            if row["words"] is not None:
                pairs, n = _pairs_of(row), _unplanes(row["counts"], "<i8")
            else:
                keys, every = _unpacked(row["keys"]), np.frombuffer(row["every"])
        codes, logs = pairs.codes(), np.log10(np.maximum(_discount(n, model.factors), 1e-300))
        times = np.zeros(len(pairs.words), np.int64)
        np.add.at(times, pairs.word.astype(np.int64), n)
        out = []
        for i in range(texts.num_rows):
            row = texts.slice(i, 1).to_pylist()[0]
            own, many = _pairs_of(row), _unplanes(row["counts"], "<u4").astype(np.int64)
            owner = _unplanes(row["owners"], "<u2")
            at, there = _places(pairs.words, own.words)
            count = np.where(there, times[at] if len(times) else 0, 0)
            # as a history, a word was seen as often as itself; the start as often as the end
            place, scaled = _places(keys, np.where(own.words == END, np.uint64(START), own.words))
            scale = np.where(scaled, every[place] if len(every) else 0, 0) - np.log10(np.maximum(count, 1))
            plain = np.log10(np.maximum(count, 1) + ((own.words == RARE) & (count > 0))) - whole
            before, met = _places(pairs.histories, own.histories)
            wanted = at.astype(np.uint64)[own.word] << _HALF | before.astype(np.uint64)[own.history]
            found, seen = _places(codes, wanted)
            seen &= there[own.word] & met[own.history]
            values = scale[own.word] + np.where(seen, logs[found] if len(logs) else 0, plain[own.word])
            symbol = (own.words != RARE)[own.word]
            last = int(owner.max()) + 1
            sums = [np.bincount(owner, many * x, last) for x in (symbol * (count > 0)[own.word], symbol * np.log10(count + 1)[own.word], values)]
            local = np.unique(owner)
            answer = {"piece": row["piece"], **{k: row[k] for k in _TEXTS}, "owners": _planes(local, "<u2"), "sums": np.stack(sums)[:, local].tobytes()}
            if not seen.all():
                left, history = np.unique(own.history[~seen], return_inverse=True)
                answer |= {"keys": _packed(own.histories[left]), "history": _planes(history, "<u4")}
                answer |= {"texts": _planes(owner[~seen], "<u2"), "counts": _planes(many[~seen], "<u4")}
            out.append(answer)
        return pa.Table.from_pylist(out, schema=kinds)

    def by_piece(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["ids"] is None, r["owners"], r["sums"]))
        texts = {k: rows[0][k] for k in _TEXTS}
        sums = np.zeros((3, len(texts["ids"]) // 8))
        for row in rows:
            local = _unplanes(row["owners"], "<u2")
            sums[:, local] += np.frombuffer(row["sums"]).reshape(3, -1)
        out = [{"piece": rows[0]["piece"], **texts, "sums": sums.tobytes()}]
        unseen = [r for r in rows if r["keys"] is not None]
        if unseen:
            found = [_unpacked(r["keys"]) for r in unseen]
            keys = np.unique(np.concatenate(found))
            history = np.concatenate([np.searchsorted(keys, k)[_unplanes(r["history"], "<u4")] for k, r in zip(found, unseen, strict=True)])
            owner = np.concatenate([_unplanes(r["texts"], "<u2") for r in unseen]).astype(np.int64)
            many = np.concatenate([_unplanes(r["counts"], "<u4") for r in unseen])
            order = np.lexsort((owner, history))
            history, owner, many = history[order], owner[order], many[order]
            for c, a, b in _by_cell(keys, edges):
                part = slice(*np.searchsorted(history, [a, b]))
                out.append({"piece": rows[0]["piece"], "cell": c, "keys": _packed(keys[a:b]), "history": _planes(history[part] - a, "<u4"), "texts": _planes(owner[part], "<u2"), "counts": _planes(many[part], "<u4")})
        return pa.Table.from_pylist(out, schema=kinds)

    def back_off(asked: pa.Table, cell: pa.Table) -> pa.Table:
        keys, unseen = np.zeros(0, np.uint64), np.zeros(0)
        for row in cell.to_pylist():
            keys, unseen = _unpacked(row["keys"]), np.frombuffer(row["unseen"])
        out = []
        for row in asked.to_pylist():
            at, there = _places(keys, _unpacked(row["keys"]))
            values = np.where(there, unseen[at] if len(unseen) else 0, 0)[_unplanes(row["history"], "<u4")]
            owner = _unplanes(row["texts"], "<u2")
            local = np.unique(owner)
            sums = np.bincount(owner, values * _unplanes(row["counts"], "<u4"))[local]
            out.append({"piece": row["piece"], "owners": _planes(local, "<u2"), "sums": sums.tobytes()})
        return pa.Table.from_pylist(out, schema=kinds)

    def by_text(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["ids"] is None, r["owners"] or b"", r["sums"]))
        ids, marks, sizes = (np.frombuffer(rows[0][k], np.int64) for k in _TEXTS)
        known, base, score = np.frombuffer(rows[0]["sums"]).reshape(3, -1).copy()
        for row in rows[1:]:
            score[_unplanes(row["owners"], "<u2")] += np.frombuffer(row["sums"])
        base -= sizes * math.log10(model.total + model.distinct + 1)
        return pa.table({"id": ids, "mark": marks, "n_tokens": sizes, "n_known": np.rint(known).astype(np.int64), "base_score": base, "score": score})

    parts = F.array(*[F.lit(p).cast("bigint") for p in model.parts])
    tables = table.unionByName(weights.drop("unseen"), allowMissingColumns=True)
    last = F.get(parts, F.col("cell").cast("int")) - 1
    tables = tables.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    found = sent.groupBy("cell", "part").cogroup(tables.groupBy("cell", "part")).applyInArrow(score, sql)
    found = cut(found.groupBy("piece").applyInArrow(by_piece, sql))
    asked = found.where("cell is not null").groupBy("cell").cogroup(weights.groupBy("cell")).applyInArrow(back_off, sql)
    both = found.where("cell is null").unionByName(asked).groupBy("piece")
    return both.applyInArrow(by_text, "id bigint, mark bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out(id: Column) -> Column:
    """Rows that the model does not learn from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score(frame: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = frame.select(F.col(id).cast("bigint").alias("own"), F.col(text).alias("text"))
    model, words, table = train(rows.where(~held_out(F.col("own"))), "text")
    # A text is known by its id and a mark, a hash whose last bit says that the id is null.
    mark = F.xxhash64("text").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("own").isNull().cast("bigint"))
    marked = rows.select(F.coalesce("own", F.lit(0)).alias("id"), mark.alias("mark"), "text")
    sums = _text_sums(_sent(marked, model), table, model)
    own_id = F.when(F.col("mark").bitwiseAND(1) == 0, F.col("id"))
    if model.book is not None:
        sums = _with_rare(sums, _rare(marked, model), words, model)
    return sums.select(
        own_id.alias(id),
        held_out(own_id).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def _with_rare(sums: DataFrame, rare: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """The sums with those over the words without a symbol."""
    by_word = rare.join(rare_words(words, model.last), "word", "left")
    count = F.coalesce(F.col("n"), F.lit(0))
    kept = F.coalesce(F.get(F.array(*[F.lit(d) for d in model.rare_discounts]), count.cast("int")), F.lit(1.0))
    kept = F.when(count > K_MAX, 1.0).otherwise(kept)
    within = F.when(count == 0, math.log10(model.unknown)).otherwise(F.log10(kept * count / (model.rare_total + 1)))
    by_word = by_word.select(
        *_KEYS,
        F.when(count > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10(count + 1)).alias("base_score"),
        (F.col("times") * within).alias("score"),
    )
    whole = lambda part: part.select(
        *_KEYS,
        *[
            (F.lit(1) if c == "copies" and "n_tokens" in part.columns else F.col(c) if c in part.columns else F.lit(0))
            .cast("double" if "score" in c else "bigint")
            .alias(c)
            for c in _SUMS
        ],
    )
    both = whole(sums).union(whole(by_word)).groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])
    both = both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    shared = lambda c: (F.col(c) / F.col("copies")).cast("double" if "score" in c else "bigint").alias(c)
    return both.select(*_KEYS, *[shared(c) for c in _SUMS[1:]])
