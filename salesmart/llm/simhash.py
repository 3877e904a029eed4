"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has one bit for each of the 64 bits of a hash: 1 if set in over half of the hashes of
a text's shingles.  Fingerprints link if at most max_bits of their bits differ; linked ones, over
any number of links, form a component.

Distinct fingerprints are cut into blocks.  With max_bits + 2 blocks, two close ones agree in at
least two, so each pair of blocks is a bucket key.  In a bucket of up to BUCKET fingerprints all pairs are
joined and their distance verified.  The members of larger buckets are linked exactly without
pairing: each one is filed under its own value and the values that differ from it in up to half
the bits allowed.  Two fingerprints meet under a value if and only if they are close enough (for
an odd number of bits a meeting is verified), and all that meet are linked to the least of them.

Cases: null is the empty text; a text without words has fingerprint zero, which links like any
other; a null id has no part in the smallest id of a component unless it has no other; repeated
rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, pieces, schema_with
from salesmart.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints of a bucket that are paired; larger buckets are linked without pairing.
BUCKET = 32
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 14

_hash = functools.partial(xxhash.xxh64_digest, seed=SEED)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a UTF-8 text; bytes.lower and bytes.split know ASCII only, as is wanted."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    ones, n = np.zeros(64, np.int64), 0
    while part := list(map(_hash, itertools.islice(shingles, CHUNK))):
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint16)
        n += len(part)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(frame: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(id, bits): the fingerprint of every row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                raw = pc.fill_null(piece.column(text), "").cast(pa.binary()).to_pylist()
                bits = pa.array([fingerprint(t, width) for t in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(id), bits], names=[id, "bits"])

    narrow = frame.select(id, text)
    return narrow.mapInArrow(run, schema_with(frame, [id], {"bits": "bigint"}))


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of max_bits + 2 blocks of 64 bits."""
    edges = [64 * i // (max_bits + 2) for i in range(max_bits + 3)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def _bucket_keys(bits: Column, max_bits: int) -> Column:
    """An array of structs (pair of blocks, their bits)."""
    part = [F.shiftrightunsigned(bits, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in _blocks(max_bits)]
    pairs = itertools.combinations(range(len(part)), 2)
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("which"),
                F.shiftleft(part[i], _blocks(max_bits)[j][1]).bitwiseOR(part[j]).alias("value"),
            )
            for n, (i, j) in enumerate(pairs)
        ]
    )


def _flips(most: int) -> list[int]:
    """Signed masks with up to so many bits set."""
    masks = [sum(1 << b for b in c) for n in range(most + 1) for c in itertools.combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (bits) that connect all that are close."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits is 0 to 5")
    filed = distinct.select("bits", F.explode(_bucket_keys(F.col("bits"), max_bits)).alias("k")).select("bits", "k.*")
    sizes = filed.groupBy("which", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(filed.join(sizes, ["which", "value"]))
    small, close = shared.where(F.col("n") <= bucket), F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    left = small.select("which", "value", F.col("bits").alias("a"))
    right = small.select("which", "value", F.col("bits").alias("b"))
    paired = left.join(right, ["which", "value"]).where("a < b").where(close).select("a", "b")
    large = shared.where(F.col("n") > bucket).select("bits").distinct()
    masks = F.array(*[F.lit(m) for m in _flips((max_bits + 1) // 2)])
    under = large.select("bits", F.explode(masks).alias("m")).select("bits", F.col("bits").bitwiseXOR(F.col("m")).alias("value"))
    if max_bits % 2 == 0:
        # all that meet are close; a value is met by few, as its neighbours are
        least = under.groupBy("value").agg(F.min("bits").alias("b"), F.count("*").alias("n")).where("n > 1")
        met = under.join(least, "value").where("bits <> b").select(F.col("bits").alias("a"), "b")
    else:
        other = under.select("value", F.col("bits").alias("b"))
        met = under.join(other, "value").where("bits < b").select(F.col("bits").alias("a"), "b").where(close)
    return paired.union(met).distinct()


def near_duplicates(
    frame: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the least id that links reach."""
    rows = cut(fingerprints(frame, id, text, width).withColumnRenamed(id, "key"))
    distinct = cut(rows.groupBy("bits").agg(F.min("key").alias("least")))
    roots = components(links(distinct, max_bits, bucket))
    linked = distinct.join(roots, distinct["bits"] == roots["node"]).select("bits", "least", "root")
    heads = linked.select("root", "least").union(
        distinct.join(roots.select(F.col("root").alias("bits")).distinct(), "bits").select(F.col("bits").alias("root"), "least")
    )
    heads = heads.groupBy("root").agg(F.min("least").alias("component"))
    member = linked.select("bits", "root").union(heads.select(F.col("root").alias("bits"), "root"))
    found = distinct.join(member.join(heads, "root").select("bits", "component"), "bits", "left").select(
        "bits", F.coalesce("component", "least").alias("component")
    )
    # A frequent fingerprint makes a skewed join, which adaptive execution splits: one row matches each.
    return rows.join(found, "bits").select(
        F.col("key").alias(id),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
