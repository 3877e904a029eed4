"""Byte-level BPE: encoding by batched merge rounds, decoding by gathering.

A text is cut into pre-tokens; the distinct ones of a batch lie as symbols in one flat array.  A
round looks every neighbouring pair up by binary search over the sorted pair keys, takes for each
word its pair of lowest rank, and merges all its places.  Words without a pair left are done.

Cases: null is the empty text, which has no tokens; the strings of special tokens in a text become
their ids; very long texts are worked on in one piece, with memory in proportion to the text;
repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from salesmart.llm.common import expand, pieces, schema_with, texts, with_columns

#: Fixed value: the pattern that cuts a text into pre-tokens, as the byte-level vocabularies need it.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the same pattern for texts of Latin-1 characters, spelled out for the faster matcher.
LATIN_PRE_TOKEN = (
    r" ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼½¾]+|'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)
#: Letters and numbers that the matcher's Unicode version has and the encoders' version 16 has not.
NEWER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
#: Words whose ids a worker keeps between batches, and bytes of text that it works on at a time.
CACHE_WORDS, PIECE = 150_000, 1 << 20


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """A byte-level vocabulary: symbols, merges as sorted pair keys, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, symbol = spec["model"]["vocab"], byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_pattern = (
            re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )
        self.pre_token = regex.compile(PRE_TOKEN).findall
        # The library's character classes are those of an older Unicode than the matcher's.
        ends = [r.split("-") for r in NEWER.split()]
        newer = "".join(rf"\U{int(r[0], 16):08x}-\U{int(r[-1], 16):08x}" for r in ends)
        older = PRE_TOKEN
        for kind in (r"\p{L}", r"\p{N}"):
            older = older.replace(rf" ?{kind}+", rf" ?[{kind}--[{newer}]]+")
        older = older.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
        self.has_newer = regex.compile(f"[{newer}]").search
        self.older_pre_token = regex.compile(older, regex.V1).findall
        self.latin_pre_token = re.compile(LATIN_PRE_TOKEN).findall
        size = max([*ids.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in ids.items():
            spelled[i] = bytes(symbol[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.first = np.zeros(256, np.int64)
        for c, b in symbol.items():
            self.first[b] = ids[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys, self.ranks, self.made = (left << 32 | right)[order], order, made[order]
        # A pair with a merged symbol ranks after the merge that makes the symbol, so that all
        # places of a word's best pair can be merged in one round.
        born = np.full(size, -1)
        born[made] = np.arange(len(made))
        if len(set(made.tolist())) != len(made) or not (np.maximum(born[left], born[right]) < np.arange(len(made))).all():
            raise ValueError("the merges are not in the order in which their symbols arise")

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the pairs, and the places of their keys; no merge: rank len(keys)."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys)), at

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has.  No word is empty."""
        none = len(self.keys)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        # Of each symbol and its right neighbour in the word; at a word's last symbol there is none.
        ranks, at = np.full(len(symbols), none), np.zeros(len(symbols), np.int64)
        stale = np.flatnonzero(word[1:] == word[:-1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            ranks[stale], at[stale] = self._look_up(symbols[stale], symbols[stale + 1])
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(ranks, starts)
            active = np.repeat(best < none, sizes)
            if not active.all():
                done.append((word[~active], symbols[~active]))
                symbols, word, ranks, at = symbols[active], word[active], ranks[active], at[active]
                sizes, best = sizes[best < none], best[best < none]
            hit = ranks == np.repeat(best, sizes)
            # In a run such as "aaa" every second place merges, from the left.
            place = np.arange(len(hit))
            hit &= (place - np.maximum.accumulate(np.where(hit, -1, place))) % 2 == 1
            symbols = np.where(hit, self.made[at], symbols)
            keep = ~np.append(False, hit[:-1])[: len(hit)]
            symbols, word, ranks, at, hit = symbols[keep], word[keep], ranks[keep], at[keep], hit[keep]
            # Only pairs with a symbol just made are looked up anew.
            stale = np.flatnonzero(hit | np.append(hit[1:], False)[: len(hit)])
            ranks[stale] = none
            stale = stale[stale + 1 < len(word)]
            stale = stale[word[stale] == word[stale + 1]]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        return self.bytes[expand(self.offsets[ids], self.lengths[ids])].tobytes()


class Places(dict):
    """The place of each word; a new word gets the next one and is noted down."""

    def __init__(self, words):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = place = len(self)
        return place


class Encoder:
    """Encodes lists of texts; keeps the ids of the words it met, up to CACHE_WORDS."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        # Special tokens come first: words of one id that no merge touches.  Their strings never
        # arise as pre-tokens, which don't mix letters and other characters.
        special = self.vocabulary.special
        self.places = Places(list(special))
        self.ids = np.array(list(special.values()), np.int64)
        self.sizes = np.ones(len(special), np.int64)

    def _plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            v = self.vocabulary
            return v.older_pre_token(text) if v.has_newer(text) else v.pre_token(text)
        return self.vocabulary.latin_pre_token(text)

    def _split(self, text: str) -> list[str]:
        v = self.vocabulary
        if not any(s in text for s in v.special):
            return self._plain(text)
        out: list[str] = []
        for i, part in enumerate(v.special_pattern.split(text)):
            out += [part] if i % 2 else self._plain(part)
        return out

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        if len(self.places) > CACHE_WORDS:
            self._forget()
        split = [self._split(text) for text in batch]
        counts = [len(words) for words in split]
        words = itertools.chain.from_iterable(split)
        place = np.fromiter(map(self.places.__getitem__, words), np.int64, sum(counts))
        if fresh := self.places.fresh:
            ids, sizes = self.vocabulary.merge([w.encode() for w in fresh])
            self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)
            self.places.fresh = []
        offsets, sizes = np.cumsum(self.sizes) - self.sizes, self.sizes[place]
        ids = self.ids[expand(offsets[place], sizes)]
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([0, *counts])]
        return ids, np.diff(ends)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def encode(frame: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The frame with an array column of token ids; a column of that name gives way."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                found, sizes = encoder(path).encode(texts(piece, text))
                ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))
                yield with_columns(piece, {ids: column})

    kept = [c for c in frame.columns if c != ids]
    return frame.mapInArrow(run, schema_with(frame, kept, {ids: "array<int>"}))


def decode(frame: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The frame with the text of its array column of token ids; a null array gives an empty text.

    Ids outside the vocabulary raise an error.  Bytes that are no UTF-8 become U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            # a null array becomes an empty one
            lists = batch.column(ids)
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(v.lengths)):
                raise ValueError("a token id is not in the vocabulary")
            ends = np.append(0, np.cumsum(sizes))
            out = [v.spell(flat[a:b]).decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]
            yield with_columns(batch, {text: pa.array(out, pa.string())})

    kept = [c for c in frame.columns if c != text]
    return frame.mapInArrow(run, schema_with(frame, kept, {text: "string"}))


DIGESTS = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def digests(frame: DataFrame, path: str, text: str = "text", with_ids: str | None = None) -> DataFrame:
    """The frame without its text, with the number of tokens and the SHA-256 of ids and decoded text.

    with_ids names a column for the ids themselves.  The decoded text comes from the ids alone.
    """
    added = DIGESTS | ({with_ids: "array<int>"} if with_ids else {})
    kept = [c for c in frame.columns if c not in added and c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                ids, sizes = encoder(path).encode(texts(piece, text))
                ends = np.append(0, np.cumsum(sizes))
                raw = ids.astype("<u4")
                spelled, spans = v.spell(ids), np.append(0, np.cumsum(v.lengths[ids]))[ends]
                columns = {
                    "n_tokens": pa.array(sizes.astype(np.int64)),
                    "ids_sha256": pa.array(
                        [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)], pa.string()
                    ),
                    "decoded_sha256": pa.array(
                        [
                            hashlib.sha256(spelled[a:b].decode("utf-8", "replace").encode()).hexdigest()
                            for a, b in zip(spans, spans[1:], strict=False)
                        ],
                        pa.string(),
                    ),
                }
                if with_ids:
                    columns[with_ids] = pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))
                    )
                yield with_columns(piece.select(kept), columns)

    return frame.mapInArrow(run, schema_with(frame, kept, added))
