"""Text columns against the types they are declared to hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_types(struct: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in struct.fields}


def as_text(struct: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in struct.fields])


def typed(types: dict[str, str]) -> list[Column]:
    return [F.col(c).try_cast(t).alias(c) for c, t in types.items()]


def misfits(types: dict[str, str]) -> Column:
    """True when a value is present that its type cannot hold."""
    bad = [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()]
    return reduce(lambda a, b: a | b, bad)
