"""How the sources of a language differ in their words: iceberg terms found by prefixes, exact shares.

A term is a run of letters and of characters beyond ASCII, A-Z lower-cased.  A language keeps the terms
that at least `least` of its documents hold.  They are found level by level: a term cannot be in more
documents than a prefix of it, so a level counts the documents of every prefix of so many bytes whose
shorter prefix had enough, and drops those below the threshold.  Terms that end within a level are counted
as themselves; those with enough documents are kept.  Levels double in length, so the longest term of n
bytes takes log2(n) of them.  A document counts once for a prefix however many of its terms begin with it:
a task makes (document, prefix) distinct before it adds up, and only sums are shuffled.  Prefixes that
survived reach the tasks as a bitmap of bounded size (bitmap.py); one let through by chance has its own
count against it, so results are exact.

With n the occurrences of a kept term in a group (language and source, or the whole language), N their sum
over the V kept terms, a share is p = 1 + floor(SCALE (n + ADDED) / (N + ADDED V)).  Two sources differ by
the sum of |p - p'| over all kept terms, also those that neither holds.  The sums run over tiles: blocks of
sources against blocks of sources, for some of the terms; each tile is a small matrix, whatever one source
holds.  Sources are put into blocks, and terms into chunks, by hash.

Cases: null text, language or source is ''; repeated rows and repeated ids are documents of their own; a group
without terms takes part with N = 0; a language without kept terms has V = 0, differences of 0 and no terms;
a language with one source has no pairs; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.bitmap import bitmap, found
from salesmart.llm.common import cut, pieces
from salesmart.llm.words import counted, flat_bytes, hashes, kinds, split_words

LEAST = 30
TOP = 50
SCALE, ADDED = 1_000_000_000, 5
#: Bytes of the first level's prefixes; every level doubles them.
FIRST_LEVEL = 4
#: Sources of a block and terms of a chunk, about.
BLOCK, CHUNK = 128, 8192
#: Bytes of text, or of terms, that a task works on at a time.
PIECE = 1 << 20

_KIND = kinds([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TERMS = "lang string, source string, terms binary, counts binary"


def document_terms(texts: DataFrame) -> DataFrame:
    """(lang, source, terms, counts): the distinct terms of every document, a blank after each, and their
    occurrences as 4-byte numbers; one value for each document, however many terms it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                words = split_words(piece.column("text"), _KIND)
                size = max(1, len(words.distinct))
                codes, n = counted(words.owner.astype(np.int64) * size + words.code)
                ends = np.searchsorted(codes, np.arange(piece.num_rows + 1, dtype=np.int64) * size)
                ended = pc.binary_join_element_wise(words.distinct, pa.scalar(b" ", pa.binary()), pa.scalar(b"", pa.binary()))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ended.take(pa.array(codes % size)))
                raw = n.astype(np.int32).tobytes()
                counts = pa.array([raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
                joined = pc.binary_join(lists, pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("lang"), piece.column("source"), joined, counts], names=["lang", "source", "terms", "counts"]
                )

    return texts.mapInArrow(run, _TERMS)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, "terms", PIECE)


def _mixed(lang: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One hash of a language's hash and a value's."""
    h = (lang.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ value.view(np.uint64)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h ^ h >> np.uint64(32)).view(np.int64)


def _coded(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    encoded = column.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy() if len(column) else np.zeros(0, np.int32)


def _entries(piece: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of some documents; of every (document, term) the term's place and the document."""
    data, ends = flat_bytes(piece.column("terms"))
    stops = np.flatnonzero(data == ord(" ")) + 1
    buffers = [None, pa.py_buffer(np.append(0, stops).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), buffers).dictionary_encode()
    sizes = np.diff(np.searchsorted(stops, ends, side="right"))
    code = found.indices.to_numpy() if len(stops) else np.zeros(0, np.int32)
    terms = pc.binary_slice(found.dictionary.cast(pa.binary()), 0, -1)  # without the blank
    return terms, code, np.repeat(np.arange(piece.num_rows), sizes)


def level_counts(documents: DataFrame, shorter: int, length: int, survivors: np.ndarray | None) -> DataFrame:
    """(lang, prefix, whole, docs) of the terms above `shorter` bytes whose prefix of so many survived.

    A term of up to `length` bytes is counted whole, a longer one by its prefix of that length.
    """
    known = documents.sparkSession.sparkContext.broadcast(survivors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _slices(batches):
            terms, code, owner = _entries(piece)
            langs, lang = _coded(piece.column("lang"))
            if not len(code):
                continue
            sizes = pc.binary_length(terms).to_numpy()
            kept = (sizes > shorter)[code]
            if known.value is not None:
                prefixes, place = _coded(pc.binary_slice(terms, 0, shorter))
                own = hashes(langs.cast(pa.binary()), 0)[lang][owner]
                kept &= found(known.value, _mixed(own, hashes(prefixes, 0)[place][code]))
            code, owner = code[kept], owner[kept]
            prefixes, place = _coded(pc.binary_slice(terms, 0, length))
            # a term that ends within the level is another thing than the same bytes as a prefix
            thing, things = 2 * place.astype(np.int64) + (sizes <= length), 2 * len(prefixes)
            once, _ = counted(owner * things + thing[code])
            pairs, docs = counted(lang[once // things] * np.int64(things) + once % things)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(pairs // things)),
                    prefixes.take(pa.array(pairs % things // 2)),
                    pa.array(pairs % 2 == 1),
                    pa.array(docs),
                ],
                names=["lang", "prefix", "whole", "docs"],
            )

    partial = documents.mapInArrow(run, "lang string, prefix binary, whole boolean, docs bigint")
    return partial.groupBy("lang", "prefix", "whole").agg(F.sum("docs").alias("docs"))


def _hashed(frame: DataFrame, value: str) -> DataFrame:
    """(key) of (lang, value) pairs, as the tasks of a level compute it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, lang = _coded(batch.column("lang"))
            if batch.num_rows:
                key = _mixed(hashes(langs.cast(pa.binary()), 0)[lang], hashes(batch.column(value), 0))
                yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    return frame.select("lang", F.col(value).cast("binary").alias(value)).mapInArrow(run, "key bigint")


def iceberg_terms(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term): the terms that at least so many documents of their language hold."""
    kept, shorter, length, survivors = [], 0, FIRST_LEVEL, None
    while True:
        enough = cut(level_counts(documents, shorter, length, survivors).where(F.col("docs") >= least))
        kept.append(enough.where("whole").select("lang", F.col("prefix").alias("term")))
        open_prefixes = enough.where(~F.col("whole"))
        if open_prefixes.isEmpty():
            return cut(reduce(DataFrame.union, kept))
        survivors = bitmap(_hashed(open_prefixes, "prefix"), "key")
        shorter, length = length, 2 * length


def group_counts(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, term, n): the occurrences of the kept terms in every group that has any."""
    known = documents.sparkSession.sparkContext.broadcast(bitmap(_hashed(terms, "term"), "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _slices(batches):
            distinct, code, owner = _entries(piece)
            if not len(code):
                continue
            langs, lang = _coded(piece.column("lang"))
            sources, source = _coded(piece.column("source"))
            n = np.frombuffer(b"".join(piece.column("counts").to_pylist()), np.int32).astype(np.int64)
            own = hashes(langs.cast(pa.binary()), 0)[lang][owner]
            kept = found(known.value, _mixed(own, hashes(distinct, 0)[code]))
            code, owner, n = code[kept], owner[kept], n[kept]
            group = (lang.astype(np.int64) * len(sources) + source)[owner] * len(distinct) + code
            order = np.argsort(group, kind="stable")
            keys, sizes = counted(group)
            sums = np.add.reduceat(n[order], np.cumsum(sizes) - sizes) if len(keys) else n
            pair = keys // len(distinct)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(pair // len(sources))),
                    sources.take(pa.array(pair % len(sources))),
                    distinct.take(pa.array(keys % len(distinct))),
                    pa.array(sums),
                ],
                names=["lang", "source", "term", "n"],
            )

    partial = documents.select("lang", "source", "terms", "counts").mapInArrow(
        run, "lang string, source string, term binary, n bigint"
    )
    counts = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    return counts.join(terms, ["lang", "term"], "left_semi").select("lang", "source", "term", "n")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + ADDED) / (N + ADDED V)), in whole numbers; null without kept terms."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(ADDED)).cast("decimal(19,0)")
    below = F.nullif((total + F.lit(ADDED) * terms).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return F.lit(1) + F.call_function("div", above, below)


def _groups(documents: DataFrame, terms: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, v, base, sources): every occurring group; base is the share of an absent term."""
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = documents.select("lang", "source").distinct()
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    whole = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").join(sizes, "lang")
    whole = whole.fillna(0, ["total", "v"])
    base = F.coalesce(_share(F.lit(0).cast("bigint"), F.col("total"), F.col("v")), F.lit(0)).cast("bigint")
    return whole.withColumn("base", base)


def _tiles(frame: DataFrame, block: int) -> DataFrame:
    """Every row once for each pair of blocks (i <= j) that its own block is in."""
    blocks = F.ceil(F.col("sources") / block).cast("int")
    own = F.pmod(F.xxhash64("source"), blocks).cast("int")
    frame = frame.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return frame.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))


def _tile_sums(key: tuple, shares: pa.Table, groups: pa.Table) -> pa.Table:
    """|p - p'| summed over a chunk of terms, for the pairs of sources of two blocks.

    Terms that neither source holds add V |b - b'| in all, which chunk 0 gives; a term of the chunk gives what
    it adds beyond that.
    """
    lang, i, j, chunk = [k.as_py() for k in key]
    names = groups.column("source").to_pylist()
    own = groups.column("own").to_numpy()
    base = groups.column("base").to_numpy()
    v = groups.column("v").to_numpy()[0] if len(names) else 0
    term = shares.column("term").combine_chunks().dictionary_encode()
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    row = {n: r for r, n in enumerate(names)}
    matrix = np.repeat(base[:, None], len(term.dictionary), axis=1)
    if len(shares):
        matrix[[row[s] for s in shares.column("source").to_pylist()], term.indices.to_numpy()] = shares.column("p").to_numpy()
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    out: dict[str, list] = {"lang": [], "source": [], "item": [], "value": []}
    for a in left:
        others = right[right > a] if i == j else right
        apart = np.abs(base[others] - base[a])
        sums = np.abs(matrix[others] - matrix[a]).sum(axis=1) - matrix.shape[1] * apart + (v * apart if chunk == 0 else 0)
        for b, value in zip(others, sums.tolist(), strict=True):
            out["source"] += [names[a], names[b]]
            out["item"] += [names[b], names[a]]
            out["value"] += [value, value]
    out["lang"] = [lang] * len(out["value"])
    return pa.table({c: pa.array(x, pa.int64() if c == "value" else pa.string()) for c, x in out.items()})


def pair_differences(shares: DataFrame, groups: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways round."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("v") / chunk)).cast("int")
    tiled = _tiles(shares.withColumn("chunk", F.pmod(F.xxhash64("term"), chunks).cast("int")), block)
    tiles = ["lang", "i", "j", "chunk"]
    own = _tiles(groups, block).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    sums = (
        tiled.select(*tiles, "source", "term", "p").groupBy(*tiles)
        .cogroup(own.select(*tiles, "source", "own", "base", "v").groupBy(*tiles))
        .applyInArrow(_tile_sums, "lang string, source string, item string, value bigint")
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def over_used(shares: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source has more of than its language."""
    everywhere = Window.partitionBy("lang", "term")
    n = F.sum("n").over(everywhere)
    above = shares.withColumn("q", _share(n, F.col("lang_total"), F.col("v"))).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("term"))
    ranked = above.withColumn("value", (F.col("p") - F.col("q")).cast("bigint")).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select(
        "lang", "source", F.col("term").cast("string").alias("item"), "value", "rank"
    )


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST,
    top: int = TOP,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """(lang, source, part, item, value, rank): differences between sources, and the terms behind them."""
    texts = docs.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))]
    )
    documents = cut(document_terms(texts))
    terms = iceberg_terms(documents, least)
    counts = cut(group_counts(documents, terms))
    groups = cut(_groups(documents, terms, counts))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    shares = counts.join(groups, ["lang", "source"]).join(langs, "lang")
    shares = shares.withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")).cast("bigint"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_differences(shares, groups, block, chunk).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).union(
        over_used(shares, top).withColumn("part", F.lit("term")).select(*columns)
    )
