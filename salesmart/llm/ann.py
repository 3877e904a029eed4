"""Nearest neighbours by a block matrix join with exact bounds.

Queries and candidates are dealt into blocks, and each pair of blocks is a tile.  A tile multiplies
int8 forms of its vectors.  A vector lies within a known distance of its int8 form, so a product
gives a distance with an error bound: what cannot be among a query's nearest of the tile is left
out, and the rest is computed anew from the original components in double precision, added up in
component order.  Heaps merge the nearest of the tiles, a bounded number of tiles at a time.

Nothing is lost: the bounds hold for every pair, so the result is that of an exhaustive search.

Cases: rows without an id, and vectors that are null, empty, all zero, or hold a null or non-finite
component take no part; vectors of different length are never compared; rows that repeat an id
count once, with the least vector; ties go to the smaller id; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEAREST = 10
#: Vectors of a block.
BLOCK = 4096
#: Tiles whose results one merge takes together.
FAN = 64
#: Queries of a tile whose bounds are held at a time, and pairs recomputed at a time.
STRIP, PAIRS = 256, 1 << 16

_RESULT = "query_id bigint, part bigint, vec_id bigint, score double"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 form of each row, its scale, and the distance between the row and scale * form."""
    scale = np.abs(x).max(axis=1) / 127
    form = np.rint(x / scale[:, None]).astype(np.int8)
    return form, scale, np.sqrt(((x - scale[:, None] * form) ** 2).sum(axis=1))


class Quantised(NamedTuple):
    form: np.ndarray  # int8 products are whole numbers: held in a float type that is exact for them
    scale: np.ndarray
    error: np.ndarray
    square: np.ndarray  # of the length of scale * form


def prepared(x: np.ndarray) -> Quantised:
    form, scale, error = quantised(x)
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return Quantised(form.astype(kind), scale, error, (form.astype(np.float64) ** 2).sum(axis=1) * scale**2)


def bounds(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible distance of each query to each candidate."""
    return _bounds(prepared(q), prepared(c))


def _bounds(q: Quantised, c: Quantised) -> tuple[np.ndarray, np.ndarray]:
    square = (q.form @ c.form.T).astype(np.float64)
    square *= -2 * q.scale[:, None] * c.scale[None, :]
    norms = q.square[:, None] + c.square[None, :]
    square += norms
    # What rounding of these doubles may add: a part of the squared norms under the root.
    norms *= 1e-12
    error = (q.error[:, None] + c.error[None, :]) * (1 + 1e-9)
    low = np.sqrt(np.maximum(square - norms, 0)) - error
    return low, np.sqrt(np.maximum(square, 0) + norms) + error


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of the rows: squares added in component order, each sum rounded once.

    The error of a square and that of a sum are doubles themselves, so both are added back.
    """
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        d = a[:, i] - b[:, i]
        square, split = d * d, d * 134217729.0
        high = split - (split - d)
        low = d - high
        square_error = ((high * high - square) + 2 * high * low) + low * low
        added = total + square
        part = added - total
        total = added + (((total - (added - part)) + (square - part)) + square_error)
    return np.sqrt(total)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("embedding").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, x.reshape(len(ids), -1)


def tile(queries: pa.Table, candidates: pa.Table, nearest: int) -> pa.Table:
    """The nearest candidates of the tile for each of its queries."""
    if not queries.num_rows or not candidates.num_rows:
        return pa.Table.from_pylist([], _schema())
    block = candidates.column("cb")[0].as_py()
    (qi, q), (ci, c) = _matrix(queries), _matrix(candidates)
    k, parts, known = min(nearest, len(ci)), [], prepared(c)
    for a in range(0, len(qi), STRIP):
        strip = slice(a, a + STRIP)
        low, high = _bounds(prepared(q[strip]), known)
        own = qi[strip, None] == ci[None, :]
        low[own] = high[own] = np.inf
        worst = np.partition(high, k - 1, axis=1)[:, k - 1 : k]
        parts.append(np.nonzero((low <= worst) & ~own))
    rows = np.concatenate([r + a for a, (r, _) in zip(range(0, len(qi), STRIP), parts, strict=True)])
    columns = np.concatenate([x for _, x in parts])
    score = np.empty(len(rows))
    for a in range(0, len(rows), PAIRS):
        part = slice(a, a + PAIRS)
        score[part] = distances(q[rows[part]], c[columns[part]])
    order = np.lexsort((ci[columns], score, rows))
    rows, columns, score = rows[order], columns[order], score[order]
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    keep = rank < nearest
    return pa.table(
        {
            "query_id": qi[rows[keep]],
            "part": np.full(int(keep.sum()), block),
            "vec_id": ci[columns[keep]],
            "score": score[keep],
        },
        _schema(),
    )


def _schema() -> pa.Schema:
    kinds = [("query_id", pa.int64()), ("part", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    return pa.schema(kinds)


def _merged(frame: DataFrame, nearest: int) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        heap = zip(table.column("score").to_pylist(), table.column("vec_id").to_pylist(), strict=True)
        best = heapq.nsmallest(nearest, heap)
        return pa.table(
            {
                "query_id": [table.column("query_id")[0].as_py()] * len(best),
                "part": [table.column("part")[0].as_py()] * len(best),
                "vec_id": [v for _, v in best],
                "score": [s for s, _ in best],
            },
            _schema(),
        )

    return frame.groupBy("query_id", "part").applyInArrow(merge, _RESULT)


def usable(frame: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, embedding, dim) of the vectors that take part, each id once."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = frame.where(F.col(id).isNotNull() & v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(id).cast("bigint").alias("vec_id"), v.alias("embedding"))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))


def neighbours(
    frame: DataFrame, every: int = 100, id: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest other vectors of those whose id `every` divides."""
    vectors = usable(frame, id, vector)
    is_query = F.col("vec_id") % every == 0
    n, m = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    c_blocks, q_blocks = -(-n // block) or 1, -(-m // block) or 1
    # Block numbers have one type on both sides: equal numbers of two types hash to different partitions.
    of = lambda blocks: F.pmod(F.xxhash64("vec_id"), F.lit(blocks).cast("bigint"))
    to = lambda blocks: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    candidates = vectors.select("*", of(c_blocks).alias("cb"), to(q_blocks).alias("qb"))
    queries = vectors.where(is_query).select("*", of(q_blocks).alias("qb"), to(c_blocks).alias("cb"))
    # New names on one side: the grouped join must not mix up columns of one origin.
    queries, candidates = queries.toDF(*queries.columns), candidates.toDF(*candidates.columns)
    found = (
        queries.groupBy("dim", "qb", "cb")
        .cogroup(candidates.groupBy("dim", "qb", "cb"))
        .applyInArrow(lambda q, c: tile(q, c, nearest), _RESULT)
    )
    parts = c_blocks
    while parts > 1:
        parts = -(-parts // FAN)
        found = _merged(found.withColumn("part", F.floor(F.col("part") / FAN)), nearest)

    def ranked(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("score").to_pylist(), table.column("vec_id").to_pylist(), strict=True))
        return pa.table(
            {
                "query_id": pa.array([table.column("query_id")[0].as_py()] * len(rows), pa.int64()),
                "rank": pa.array(range(1, len(rows) + 1), pa.int32()),
                "vec_id": pa.array([v for _, v in rows], pa.int64()),
                "score": pa.array([s for s, _ in rows], pa.float64()),
            }
        )

    return found.groupBy("query_id").applyInArrow(ranked, "query_id bigint, rank int, vec_id bigint, score double")
