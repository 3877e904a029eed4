"""Phrases whose words keep together, mined from sorted occurrence relations (SETM).

Texts are lower-cased (A-Z) and split into pieces, and these into words.  A relation of length k holds
every occurrence of a phrase of k words: the place of its first word and the words.  Places are numbered
through a text with a hole after every piece, so they stand for (piece, position).  A relation is a written
table, one row for each text, sorted by place.  One length goes to the next by three steps:

    extend   merge join of the relation with itself: a phrase at a place meets the one at the next place
    count    occurrences per language and phrase, summed in tasks before the shuffle
    reduce   semi-join with the phrases seen often enough; the rest is written as the next relation

A phrase is seen often enough only if both phrases one word shorter are, so nothing is lost.  The first
count of a length goes by 64-bit hashes of the phrases, the one that counts by their words and only over what
is left, so phrases with equal hashes cannot mix.  The semi-join looks up a bitmap of bounded size (bitmap.py);
what it lets through by chance falls at the exact count.  Words are known by hashes; that no two words share
one is checked over all words, else another seed is taken.  No group of occurrences ever meets in one task: a
text is never shuffled, and a phrase is one row of each task that sees it.

With counts f over all occurrences, a phrase of a = f(phrase) >= least and each cut into a first part and a
rest scores floor(1000000 a a / (f(first) f(rest))); the lowest cut counts, ties to the earliest.  A phrase is
dropped if a longer one that holds it has at least half of its occurrences.

Cases: null is the empty text; a null language is "und"; repeated rows count as often as they occur; a text
without words adds nothing; a language without phrases has no rows; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.llm.bitmap import bitmap, found
from salesmart.llm.common import cut, pieces
from salesmart.llm.words import counted, hashes, kinds, split_words

#: Pieces end at these bytes, words at these gaps.
BREAKS, GAPS = b".,;:!?\n\v\f\r", b" \t"
MOST_WORDS = 3
LEAST = 10
#: A longer phrase with this share of the occurrences stands for a shorter one, in hundredths.
SHARE = 50
TOP = 2000
NO_LANG = "und"
#: Bytes of text, or of a relation, that a task works on at a time.
PIECE, RELATION_PIECE = 1 << 20, 2 << 20
SEEDS = 16

_KIND = kinds(GAPS, BREAKS)
_RELATION = "lang string, place binary, words binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _broadcast(frame: DataFrame, bits: np.ndarray):
    """At most 32 MB (bitmap.MOST_BITS), whatever the corpus."""
    return frame.sparkSession.sparkContext.broadcast(bits)


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, key, n): every word of every language, its hash and its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                lang = piece.column("lang").dictionary_encode()
                words = split_words(piece.column("text"), _KIND)
                size = max(1, len(words.distinct))
                codes, n = counted(lang.indices.to_numpy()[words.owner].astype(np.int64) * size + words.code)
                keys = hashes(words.distinct, seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(codes // size)),
                        words.distinct.cast(pa.string()).take(pa.array(codes % size)),
                        pa.array(keys[codes % size]),
                        pa.array(n),
                    ],
                    names=["lang", "word", "key", "n"],
                )

    found_words = texts.mapInArrow(run, "lang string, word string, key bigint, n bigint")
    return found_words.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def all_words(texts: DataFrame) -> tuple[DataFrame, int]:
    """The counts of all words, as a written table, and a seed that gives no two words one hash."""
    for seed in range(SEEDS):
        words = cut(word_counts(texts, seed))
        per_key = words.groupBy("key").agg(F.min("word").alias("first"), F.max("word").alias("last"))
        if per_key.where("first <> last").isEmpty():
            return words, seed
    raise RuntimeError(f"two words share a hash under each of {SEEDS} seeds")


def _mixed(lang: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's language and words."""
    h = lang.view(np.uint64).copy()
    for column in words.T:
        h = (h ^ column.view(np.uint64)) * _ODD
        h ^= h >> np.uint64(32)
        h *= _ODD
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _rows(places: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """Places and words as one binary value for each text; places as steps from the one before."""

    def packed(values: np.ndarray, width: int) -> pa.Array:
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64) * width).astype(np.int32)
        data = np.ascontiguousarray(values).tobytes()
        return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])

    step = np.diff(places, prepend=np.int32(0)).astype(np.int32)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    step[first] = 2  # texts never touch
    width = words.shape[1] if words.ndim == 2 else 1
    return [packed(step, 4), packed(words, 8 * width)]


def _read(piece: pa.RecordBatch, length: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Languages (encoded), places, words and text of the occurrences of some rows of a relation."""

    def plain(name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
        column = piece.column(name)
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4)
        raw = b"" if data is None else bytes(memoryview(data)[ends[0] : ends[-1]])
        return np.frombuffer(raw, kind), np.diff(ends)

    step, sizes = plain("place", np.int32)
    words, _ = plain("words", np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes // 4)
    return piece.column("lang").dictionary_encode(), np.cumsum(step, dtype=np.int64), words.reshape(-1, length), owner


def occurrences(texts: DataFrame, seed: int, frequent: np.ndarray) -> DataFrame:
    """The relation of length 1 without the words that are too rare."""
    known = _broadcast(texts, frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                words = split_words(piece.column("text"), _KIND)
                keys = hashes(words.distinct, seed)
                coded = piece.column("lang").dictionary_encode()
                lang = hashes(coded.dictionary.cast(pa.binary()), 0)[coded.indices.to_numpy()][words.owner]
                word = keys[words.code] if len(words.code) else np.zeros(0, np.int64)
                kept = found(known.value, _mixed(lang, word[:, None]))
                # a word further is a place further, a piece further one more
                place = (np.arange(len(word), dtype=np.int32) + words.piece)[kept]
                sizes = np.bincount(words.owner[kept], minlength=piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("lang"), *_rows(place, word[kept], sizes)], names=["lang", "place", "words"]
                )

    return texts.mapInArrow(run, _RELATION)


def _extended(piece: pa.RecordBatch, length: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of phrases at neighbouring places: languages, their codes, places, words, owners of longer ones."""
    lang, places, words, owner = _read(piece, length)
    at = np.flatnonzero(places[1:] == places[:-1] + 1) if len(places) else np.zeros(0, np.int64)
    longer = np.concatenate([words[at], words[at + 1, -1:]], axis=1)
    owner = owner[at]
    return lang, lang.indices.to_numpy()[owner], places[at], longer, owner


def _language_keys(lang: pa.DictionaryArray) -> np.ndarray:
    return hashes(lang.dictionary.cast(pa.binary()), 0)


def hashed_counts(relation: DataFrame, length: int) -> DataFrame:
    """(key, n): occurrences of the phrases one word longer than the relation's, by a hash of language and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "words", RELATION_PIECE):
                lang, code, _, words, _ = _extended(piece, length)
                keys, n = counted(_mixed(_language_keys(lang)[code], words))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    return relation.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def extended(relation: DataFrame, length: int, frequent: np.ndarray) -> DataFrame:
    """The relation of the phrases one word longer, without those that are too rare."""
    known = _broadcast(relation, frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "words", RELATION_PIECE):
                lang, code, places, words, owner = _extended(piece, length)
                kept = found(known.value, _mixed(_language_keys(lang)[code], words))
                sizes = np.bincount(owner[kept], minlength=piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("lang"), *_rows(places[kept].astype(np.int32), words[kept], sizes)],
                    names=["lang", "place", "words"],
                )

    return relation.mapInArrow(run, _RELATION)


def _distinct_rows(lang: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one row of each kind, and how many there are of it; equal hashes are told apart."""
    keys = _mixed(lang.astype(np.int64), words)
    order = np.argsort(keys, kind="stable")
    whole = np.column_stack([lang.astype(np.int64), words])[order]
    new = np.r_[True, keys[order][1:] != keys[order][:-1]]
    differs = np.r_[True, (whole[1:] != whole[:-1]).any(axis=1)]
    if (differs & ~new).any():
        order = np.lexsort(np.column_stack([lang.astype(np.int64), words]).T)
        whole = np.column_stack([lang.astype(np.int64), words])[order]
        differs = np.r_[True, (whole[1:] != whole[:-1]).any(axis=1)]
    starts = np.flatnonzero(differs)
    return order[starts], np.diff(np.append(starts, len(order)))


def exact_counts(relation: DataFrame, length: int, least: int) -> DataFrame:
    """(lang, w1 .. wk, a): the phrases of a relation by their words, those seen often enough."""
    names = [f"w{i + 1}" for i in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "words", RELATION_PIECE):
                lang, _, words, owner = _read(piece, length)
                if len(words):
                    code = lang.indices.to_numpy()[owner]
                    one, n = _distinct_rows(code, words)
                    columns = [pa.array(np.ascontiguousarray(words[one, i])) for i in range(length)]
                    yield pa.RecordBatch.from_arrays(
                        [lang.dictionary.take(pa.array(code[one])), *columns, pa.array(n)], names=["lang", *names, "a"]
                    )

    schema = StructType.fromDDL(", ".join(["lang string", *[f"{n} bigint" for n in names], "a bigint"]))
    return relation.mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def phrases(texts: DataFrame, most_words: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """(all words, [counts of frequent phrases of 1, 2 .. most_words words]); texts has lang and text."""
    words, seed = all_words(texts)
    frequent = cut(words.where(F.col("n") >= least).select("lang", F.col("key").alias("w1"), F.col("n").alias("a"), "word"))
    counts = [frequent]
    relation = cut(occurrences(texts, seed, _bitmap_of_words(frequent)))
    for length in range(1, most_words):
        keys = cut(hashed_counts(relation, length).where(F.col("n") >= least).select("key"))
        relation = cut(extended(relation, length, bitmap(keys, "key")))
        counts.append(cut(exact_counts(relation, length + 1, least)))
    return words, counts


def _bitmap_of_words(frequent: DataFrame) -> np.ndarray:
    """The bitmap of frequent words with their languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            own = _language_keys(lang)[lang.indices.to_numpy()]
            word = batch.column("w1").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_mixed(own, word[:, None]))], names=["key"])

    return bitmap(frequent.select("lang", "w1").mapInArrow(run, "key bigint"), "key")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _part(counts: DataFrame, names: list[str], value: str) -> DataFrame:
    """Counts of a part of a phrase, keyed by the phrase's own columns."""
    renamed = {f"w{i + 1}": n for i, n in enumerate(names)}
    return counts.select("lang", *[F.col(a).alias(b) for a, b in renamed.items()], F.col("a").alias(value))


def scored(counts: list[DataFrame], length: int) -> DataFrame:
    """(lang, w1 .. wk, a, l, r, score) of the candidates of a length, by their lowest cut."""
    names = [f"w{i + 1}" for i in range(length)]
    whole = counts[length - 1]
    cuts = []
    for k in range(1, length):
        whole = whole.join(_part(counts[k - 1], names[:k], f"l{k}"), ["lang", *names[:k]])
        whole = whole.join(_part(counts[length - k - 1], names[k:], f"r{k}"), ["lang", *names[k:]])
        above = F.lit(1_000_000).cast("decimal(7,0)") * _exact("a") * _exact("a")
        score = F.call_function("div", above, _exact(f"l{k}") * _exact(f"r{k}"))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    lowest = F.array_min(F.array(*cuts))
    return whole.select("lang", *names, "a", lowest.alias("cut")).select("lang", *names, "a", "cut.l", "cut.r", "cut.score")


def _held(counts: list[DataFrame], length: int) -> DataFrame:
    """(lang, w1 .. wk, longer): for phrases inside longer candidates, the most occurrences of one of these."""
    names = [f"w{i + 1}" for i in range(length)]
    parts = []
    for longer in range(length + 1, len(counts) + 1):
        inside = F.array(
            *[F.struct(*[F.col(f"w{i + j + 1}").alias(n) for j, n in enumerate(names)]) for i in range(longer - length + 1)]
        )
        parts.append(counts[longer - 1].select("lang", "a", F.explode(inside).alias("s")).select("lang", "a", "s.*"))
    return reduce(DataFrame.union, parts).groupBy("lang", *names).agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    most_words: int = MOST_WORDS,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases of 2 to most_words words."""
    if not 2 <= most_words <= 8:
        raise ValueError("most_words is 2 to 8")
    texts = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text"))
    words, counts = phrases(texts, most_words, least)
    spelled = counts[0].select("lang", "w1", "word")
    found_phrases = []
    for length in range(2, most_words + 1):
        names = [f"w{i + 1}" for i in range(length)]
        kept = scored([c.drop("word") for c in counts], length)
        if length < most_words:
            kept = kept.join(_held(counts, length), ["lang", *names], "left")
            kept = kept.where(F.coalesce(100 * _exact("longer") < share * _exact("a"), F.lit(True)))
        for n in names:
            kept = kept.join(spelled.select("lang", F.col("w1").alias(n), F.col("word").alias(f"s_{n}")), ["lang", n])
        phrase = F.concat_ws(" ", *[F.col(f"s_{n}") for n in names])
        found_phrases.append(kept.select("lang", phrase.alias("phrase"), "a", "l", "r", "score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = reduce(DataFrame.union, found_phrases).withColumn("rank", F.row_number().over(order).cast("bigint"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
