"""Key look-ups against dimensions that may be tiny or may be billions of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; -1 when broadcasting is switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    text = text.removesuffix("b") or "0"
    return int(float(text[:-1]) * _UNITS[text[-1]]) if text[-1] in _UNITS else int(text)


def source_bytes(df: DataFrame) -> int:
    """Estimated bytes of the tables a frame reads.

    A dimension has at most as many rows as its sources, so this bounds it better than the
    estimate after joins, which is the product of both sides.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_broadcast(df: DataFrame) -> bool:
    return source_bytes(df) <= broadcast_limit(df)


def attach(lines: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``lines`` to the unique rows of ``dim`` on ``key``: one scan and one join.

    A dimension below the session's broadcast threshold is broadcast.  A larger one is a plain
    shuffled join, whose partitions adaptive execution splits where a key holds many lines:
    each line meets one dimension row, so a split costs no more than that row again.
    """
    return lines.join(F.broadcast(dim) if fits_broadcast(dim) else dim, key, how)
