"""Benchmark passages in documents, found by latent semantic retrieval and checked word by word.

1. Words of the benchmark are the terms; every text becomes the sequence of its term numbers.
2. Inverse document frequencies are counted over passages of 2 * HALF words of all documents.
3. A randomised SVD of the TF-IDF passages, distributed: each task adds up its part of
   A'A times a random matrix.  Of that sum alone the Nystrom form of A'A follows, and its
   eigenvectors are right singular vectors of A: one pass.  The items are rows of A too, weighted to count as much as the documents, so that the space tells them apart.
4. Windows of 2 * HALF words, HALF apart, whose cosine to an item in that space is high enough are
   candidates.  A window blurs an item much shorter than itself, and a space of fixed rank many items; so
   places of an item's ANCHORS rarest words with enough of its other words around are candidates as well.
   Every verbatim copy has such a place, whatever its cosine.
5. A candidate is a leak if the longest common subsequence of the item and the words around the
   window covers enough of the item, and, for items with an announced answer or a question, that of
   the answer enough of the answer.  Both survive reworded, inserted and dropped words.

Items are taken in blocks, so that what tasks hold of the benchmark is bounded.

Cases: null texts and texts without words have no leaks, items without words match nothing; texts
are read whole; answer_overlap is null for an item without an answer; a row is returned once for each document id and item, repeated rows or not; empty
tables give an empty one.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, pieces, schema_with

HALF = 16
RANK = 160
OVERSAMPLE = 8
LEAST_COSINE = 0.6
LEAST_OVERLAP = 0.6
LEAST_ANSWER = 0.5
#: Items that tasks hold at a time.
ITEMS = 2_000
#: Terms of a row when partial sums meet, and partial sums that one task adds up.
TERM_BLOCK = 512
FAN = 32
#: Terms whose columns are dense: those in the most passages.
DENSE_TERMS = 128
#: Rarest words of an item that mark where it may stand.
ANCHORS = 3
#: Bytes of text, and of numbered words, that a task works on at a time.
TEXT_PIECE, PIECE = 2 << 20, 1 << 20
#: Gathered numbers held at a time.
NUMBERS = 1 << 21

_EDGES = string.punctuation + "«»„“”‚‘’¿¡…–—"
# What announces the answer of an item.
_ANSWER = re.compile(r"(?:^|\W)(?:answer|antwort|réponse|respuesta|a)\s*:\s*", re.I)


class Items(NamedTuple):
    ids: list[int]
    words: list[np.ndarray]  # term numbers
    answers: list[np.ndarray]  # empty for items without one
    terms: dict[str, int]


def word_list(text: str) -> list[str]:
    """Lower-case words without the punctuation around them."""
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]


def answer_of(text: str) -> str:
    """What follows an announced answer or the last question mark; empty for a plain passage, which has none."""
    if parts := list(_ANSWER.finditer(text)):
        tail = text[parts[-1].end() :]
        if word_list(tail):
            return tail
    _, mark, tail = text.rpartition("?")
    return tail if mark and word_list(tail) else ""


def items_of(rows: list[tuple[int, str]]) -> Items:
    terms: dict[str, int] = {}
    numbers = lambda text: np.array([terms.setdefault(w, len(terms)) for w in word_list(text)], np.int32)
    kept = [(i, numbers(t), numbers(answer_of(t))) for i, t in rows if t and word_list(t)]
    return Items([i for i, _, _ in kept], [w for _, w, _ in kept], [a for _, _, a in kept], terms)


def numbered(documents: DataFrame, terms: dict[str, int], id: str, text: str) -> DataFrame:
    """(id, size, words): the term number of every word as 4-byte integers; other words have len(terms).

    Beside them, with `passages` filled: for the term `size` the passages of a task that hold it, and for
    len(terms) all its passages.
    """
    spread = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, other = spread.value, len(spread.value)
        counts, kind = np.zeros(other + 1, np.int64), None
        for batch in batches:
            for piece in pieces(batch, text, TEXT_PIECE):
                split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(piece.column(text), "")))
                coded = pc.list_flatten(split).dictionary_encode()
                # -1 marks what is no word
                look_up = np.array(
                    [known.get(w, other) if (w := x.strip(_EDGES)) else -1 for x in coded.dictionary.to_pylist()], np.int32
                )
                words = look_up[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int32)
                ends = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))
                keep = words >= 0
                ends = np.append(0, np.cumsum(keep))[ends]
                words, sizes = words[keep], np.diff(ends)
                row, term, n = _passages(words, sizes, other)
                counts[:-1] += np.bincount(np.unique(row * other + term) % other, minlength=other)
                counts[-1] += n
                raw, kind = words.tobytes(), piece.column(id).type
                column = [raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(id), pa.array(sizes, pa.int64()), pa.array(column, pa.binary()), pa.nulls(len(sizes), pa.int64())],
                    names=[id, "size", "words", "passages"],
                )
        found = np.flatnonzero(counts)
        if len(found):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(found), kind), pa.array(found), pa.nulls(len(found), pa.binary()), pa.array(counts[found])],
                names=[id, "size", "words", "passages"],
            )

    added = {"size": "bigint", "words": "binary", "passages": "bigint"}
    return documents.select(id, text).mapInArrow(run, schema_with(documents, [id], added))


def _half_windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The half window of every word of texts of these sizes, and the first half of each text (and the end)."""
    first = np.append(0, np.cumsum(-(-sizes // HALF)))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    return np.repeat(first[:-1], sizes) + place // HALF, first


def _passages(words: np.ndarray, sizes: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(passage, term) of each known word of the texts' passages, which don't overlap, and their number."""
    half, first = _half_windows(sizes)
    halves = np.diff(first)
    of_document = np.cumsum(-(-halves // 2)) - -(-halves // 2)
    shift = np.repeat(of_document, halves)  # by half
    passage_of_half = shift + (np.arange(first[-1]) - np.repeat(first[:-1], halves)) // 2
    known = words < terms
    return passage_of_half[half[known]], words[known], int((-(-halves // 2)).sum())


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All words of a batch, and how many each document has."""
    return np.frombuffer(b"".join(batch.column("words").to_pylist()), np.int32), batch.column("size").to_numpy()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, "words", PIECE)


def document_frequencies(coded: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and the number of passages, from the sums of the numbering."""
    sums = coded.where(F.col("passages").isNotNull()).groupBy("size").agg(F.sum("passages").alias("n"))
    out = np.zeros(terms + 1, np.int64)
    for r in sums.collect():  # a row per term of the benchmark
        out[r["size"]] = r["n"]
    return out[:-1], int(out[-1])


def _tree_sum(coded: DataFrame, of_task: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over tasks of matrices of that shape, added up FAN at a time in blocks of rows."""
    rows, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = of_task(batches), TaskContext.get().partitionId()
        for b in range(0, rows, TERM_BLOCK):
            payload = total[b : b + TERM_BLOCK].astype(np.float32).tobytes()
            yield pa.RecordBatch.from_pydict({"part": [part], "block": [b], "payload": [payload]}, schema=kinds)

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())  # the same order, the same sum
        payloads = table.column("payload")
        total = sum(np.frombuffer(payloads[int(i)].as_py(), np.float32).astype(np.float64) for i in order).astype(np.float32)
        return pa.table({"part": [int(table.column("part").to_numpy().min()) // FAN], "block": [table.column("block")[0].as_py()], "payload": [total.tobytes()]}, kinds)

    kinds = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])
    sql = "part bigint, block bigint, payload binary"
    # the table is cut once, so that every level of the sum reads what the one before has added
    sums, parts = cut(coded.mapInArrow(run, sql)), None
    parts = (sums.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        sums = sums.groupBy(F.floor(F.col("part") / FAN).alias("level"), "block").applyInArrow(lambda t: add(t.drop_columns("level")) if "level" in t.column_names else add(t), sql)
        parts = -(-parts // FAN)
    out = np.zeros(shape)
    for r in sums.collect():
        block = np.frombuffer(r["payload"], np.float32).reshape(-1, width)
        out[r["block"] : r["block"] + len(block)] += block
    return out


class Counts:
    """A sparse matrix of word counts, rows by terms: frequent terms are dense columns, other words are listed.

    Weights of terms go into what it is multiplied by, so that a listed word costs one gathered row and one
    addition, repeated or not.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, n: int, terms: int, frequent: np.ndarray):
        """Of each word its row, rising, and its term."""
        column = np.full(terms, -1)
        column[frequent] = np.arange(len(frequent))
        at = column[term]
        is_dense = at >= 0
        cells = row[is_dense] * len(frequent) + at[is_dense]
        self.dense = np.bincount(cells, minlength=n * len(frequent)).astype(np.float32).reshape(n, len(frequent))
        self.row, self.term = row[~is_dense], term[~is_dense]
        self.n, self.terms, self.frequent = n, terms, frequent

    def squares(self, idf: np.ndarray) -> np.ndarray:
        """The squared length of each row, weighted by the frequency weights of the terms."""
        pairs, times = np.unique(self.row.astype(np.int64) * self.terms + self.term, return_counts=True)
        listed = np.bincount(pairs // self.terms, (times * idf[pairs % self.terms]) ** 2, self.n)
        return listed + (self.dense**2) @ (idf[self.frequent] ** 2)

    @staticmethod
    def _add_up(out: np.ndarray, to: np.ndarray, of: np.ndarray, x: np.ndarray) -> None:
        """out[to] += x[of], for sorted `to`."""
        step = max(1, NUMBERS // x.shape[1])
        for a in range(0, len(to), step):
            part = to[a : a + step]
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            out[part[starts]] += np.add.reduceat(np.take(x, of[a : a + step], axis=0), starts, axis=0)

    def times(self, x: np.ndarray) -> np.ndarray:
        out = self.dense @ x[self.frequent]
        self._add_up(out, self.row, self.term, x)
        return out

    def add_transposed_times(self, y: np.ndarray, out: np.ndarray) -> None:
        out[self.frequent] += self.dense.T @ y
        order = np.argsort(self.term, kind="stable")
        self._add_up(out, self.term[order], self.row[order], y)

    def add_gram_times(self, weighted: np.ndarray, idf: np.ndarray, out: np.ndarray) -> None:
        """out += C' N C times x, for rows of length one by N; the weights of x are in it, those of out are not."""
        squared = np.maximum(self.squares(idf), 1e-24).astype(np.float32)
        self.add_transposed_times(self.times(weighted) / squared[:, None], out)


def latent_space(coded: DataFrame, items: Items, idf: np.ndarray, frequent: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (terms x rank) of the TF-IDF passages of documents and items."""
    terms, width = len(idf), min(rank + OVERSAMPLE, len(idf))
    row = np.repeat(np.arange(len(items.words)), [len(w) for w in items.words])
    own = Counts(row, np.concatenate(items.words), len(items.words), terms, frequent[:0])
    start = np.random.default_rng(0).standard_normal((terms, width)).astype(np.float32)
    weighted = (idf[:, None] * start).astype(np.float32)
    spread = coded.sparkSession.sparkContext.broadcast((weighted, idf, frequent))

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        weighted, idf, frequent = spread.value
        total = np.zeros((terms + 1, width))
        for batch in _pieces(batches):
            row, term, n = _passages(*_numbers(batch), terms)
            Counts(row, term, n, terms, frequent).add_gram_times(weighted, idf, total[:-1])
            total[-1, 0] += n
        return total

    total = _tree_sum(coded.where(F.col("words").isNotNull()).select("words", "size"), part, (terms + 1, width))
    mine = np.zeros((terms, width))
    own.add_gram_times(weighted, idf, mine)
    # the items together weigh as much as all passages
    beta = max(1.0, total[-1, 0]) / len(items.words)
    sketch = idf[:, None] * (total[:-1] + beta * mine)
    # a small multiple of the identity keeps the form stable where A'A has few directions
    sketch += np.sqrt(terms) * np.finfo(np.float32).eps * np.linalg.norm(sketch) / np.sqrt(width) * start
    small = start.T.astype(np.float64) @ sketch
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    kept = values > values[-1] * 1e-7
    left, _, _ = np.linalg.svd(sketch @ (vectors[:, kept] / np.sqrt(values[kept])), full_matrices=False)
    return left[:, :rank].astype(np.float32)


def anchors_of(items: Items, df: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Of each term that is one of the rarest of an item: (item, the word's place in it)."""
    out: dict[int, list[tuple[int, int]]] = {}
    for i, words in enumerate(items.words):
        distinct, place = np.unique(words, return_index=True)
        for k in np.lexsort((distinct, df[distinct]))[:ANCHORS]:
            out.setdefault(int(distinct[k]), []).append((i, int(place[k])))
    return out


class Candidates(NamedTuple):
    """Items that may stand between two places of the words of a batch, and a half window there."""

    item: np.ndarray
    half: np.ndarray
    document: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _by_anchors(words: np.ndarray, half: np.ndarray, owner: np.ndarray, begins: np.ndarray, sizes: np.ndarray, anchors: dict, members: Callable[[int], np.ndarray], known: list[np.ndarray], overlap: float) -> list[Candidates]:
    """Where a rarest word of an item stands among enough other words of it.

    A verbatim copy holds all rarest words of its item, in whatever text it stands and however short it
    is, and so is always among these; the bound on the words around is what an overlap needs at least.
    """
    rare = np.zeros(int(words.max(initial=0)) + 1, bool)
    rare[[t for t in anchors if t < len(rare)]] = True
    places = np.flatnonzero(rare[words])
    out = []
    for term, at in _grouped(words[places], places):
        for item, offset in anchors[term]:
            size = len(known[item])
            width = 2 * size
            for a in range(0, len(at), max(1, NUMBERS // width)):
                q = at[a : a + max(1, NUMBERS // width)]
                d = owner[q]
                low = np.maximum(begins[d], q - offset - size // 2)
                high = np.minimum(begins[d] + sizes[d], low + width)
                spot = low[:, None] + np.arange(width)
                inside = members(item)[words[np.minimum(spot, len(words) - 1)]] & (spot < high[:, None])
                enough = inside.sum(axis=1) >= overlap * size
                q, d, low, high = q[enough], d[enough], low[enough], high[enough]
                out.append(Candidates(np.full(len(q), item), half[q], d, low, high))
    return out


def _grouped(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], len(keys)], strict=True):
        yield int(keys[a]), values[a:b]


def common_lengths(items: list[np.ndarray], regions: list[np.ndarray], other: int) -> np.ndarray:
    """Length of the longest common subsequence of each item and its region; words numbered `other` match nothing."""
    if not items:
        return np.zeros(0, np.int64)
    high, wide = max(map(len, items)), max(map(len, regions))
    a = np.full((len(items), high), -1, np.int32)
    b = np.full((len(items), wide), -2, np.int32)
    for i, (x, y) in enumerate(zip(items, regions, strict=True)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    b[b == other] = -2
    best = np.zeros((len(items), wide + 1), np.int32)
    for j in range(high):
        step = np.maximum(best[:, 1:], best[:, :-1] + (b == a[:, j : j + 1]))
        best[:, 1:] = np.maximum.accumulate(step, axis=1)
    return best[:, -1].astype(np.int64)


LEAKS = {"item_id": "bigint", "cosine": "double", "overlap": "double", "answer_overlap": "double"}


def search(
    coded: DataFrame,
    items: Items,
    space: np.ndarray,
    idf: np.ndarray,
    df: np.ndarray,
    frequent: np.ndarray,
    id: str,
    least: float,
    overlap: float,
    answer: float,
) -> DataFrame:
    """(id, item_id, cosine, overlap, answer_overlap) of every leak."""
    terms = len(idf)
    basis = (space * idf[:, None]).astype(np.float32)
    own = np.stack([basis[w].sum(axis=0) for w in items.words]).astype(np.float32)
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    spread = coded.sparkSession.sparkContext.broadcast((basis, own, items._replace(terms={}), anchors_of(items, df)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, targets, known, anchors = spread.value

        @cache
        def members(item: int) -> np.ndarray:
            found = np.zeros(terms + 1, bool)
            found[known.words[item]] = True
            return found

        for batch in _pieces(batches):
            words, sizes = _numbers(batch)
            if not len(words):
                continue
            half, first = _half_windows(sizes)
            inside = words < terms
            n = int(first[-1])
            halves = Counts(half[inside], words[inside], n, terms, frequent).times(basis)
            # a window is a half and the next one of its document
            last = np.zeros(n, bool)
            last[first[1:][np.diff(first) > 0] - 1] = True
            halves[:-1] += np.where(last[:-1, None], np.float32(0), halves[1:])
            halves /= np.maximum(np.linalg.norm(halves, axis=1, keepdims=True), 1e-12)
            windows, begins = halves, np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(sizes)), sizes)
            found: list[tuple] = []
            some = _by_anchors(words, half, owner, begins, sizes, anchors, members, known.words, overlap)
            lengths = np.array([len(w) for w in known.words])
            step = max(1, NUMBERS // len(targets))
            for a in range(0, n, step):
                w, k = np.nonzero(windows[a : a + step] @ targets.T >= least)
                if len(w):
                    w = a + w
                    document = np.searchsorted(first, w, side="right") - 1
                    at = begins[document] + (w - first[document]) * HALF
                    low = np.maximum(begins[document], at - lengths[k])
                    high = np.minimum(begins[document] + sizes[document], at + 2 * HALF + lengths[k])
                    some.append(Candidates(k, w, document, low, high))
            for part in some:
                for p in range(0, len(part.item), 4096):
                    c = Candidates(*[x[p : p + 4096] for x in part])
                    regions = [words[x:y] for x, y in zip(c.low, c.high, strict=True)]
                    share = common_lengths([known.words[i] for i in c.item], regions, terms) / lengths[c.item]
                    sound = np.flatnonzero(share >= overlap)
                    said = common_lengths([known.answers[c.item[x]] for x in sound], [regions[x] for x in sound], terms)
                    for x, q in zip(sound, said, strict=True):
                        i = int(c.item[x])
                        part_said = float(q) / len(known.answers[i]) if len(known.answers[i]) else None
                        if part_said is None or part_said >= answer:
                            cosine = float(windows[c.half[x]] @ targets[i])
                            found.append((int(c.document[x]), known.ids[i], cosine, float(share[x]), part_said))
            if found:
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id).take(pa.array(columns[0])), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.float64()) for c in columns[2:]]],
                    names=[id, *LEAKS],
                )

    documents = coded.where(F.col("words").isNotNull()).select(id, "size", "words")
    rows = documents.mapInArrow(run, schema_with(coded, [id], LEAKS))
    return rows.groupBy(id, "item_id").agg(*[F.round(F.max(c), 6).alias(c) for c in list(LEAKS)[1:]])


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    rank: int = RANK,
    least: float = LEAST_COSINE,
    overlap: float = LEAST_OVERLAP,
    answer: float = LEAST_ANSWER,
) -> DataFrame:
    """(id, item_id, cosine, overlap, answer_overlap) for every document and benchmark item it leaks."""
    rows = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("t"))
    blocks = max(1, -(-rows.count() // ITEMS))
    out = documents.sparkSession.createDataFrame([], schema_with(documents, [id], LEAKS))
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).distinct().orderBy("i", "t")
        items = items_of([tuple(r) for r in block.collect()])
        if not items.ids:
            continue
        coded = cut(numbered(documents, items.terms, id, text))
        df, n = document_frequencies(coded, len(items.terms))
        idf = np.log((n + 1) / (df + 1)) + 1
        frequent = np.sort(np.argsort(-df, kind="stable")[:DENSE_TERMS])
        space = latent_space(coded, items, idf, frequent, rank)
        out = out.union(search(coded, items, space, idf, df, frequent, id, least, overlap, answer))
    return out
