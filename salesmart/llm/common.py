"""Helpers of the operators: the shared folder, cut lineage, slices of Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes of text that a task works on at a time.
PIECE_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares; only a local session may lack that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = local_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


@cache
def local_folder(application: str) -> str:
    """The folder of a session of one machine."""
    return tempfile.mkdtemp(prefix="llm-")


def cut(frame: DataFrame) -> DataFrame:
    """The frame as a written table of the shared folder, without its lineage."""
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    """For frames of loops: a checkpoint, whose files Spark's cleaner may remove later."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many bytes of text each; a longer text is a slice alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // most
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as str, null as empty."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def schema_with(frame: DataFrame, kept: list[str], added: dict[str, str]) -> StructType:
    """The schema of the kept columns and of new ones, given by name and SQL type."""
    own = {f.name: f for f in frame.schema.fields}
    new = StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in added.items()))
    return StructType([own[n] for n in kept] + new.fields)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with these columns at its end; columns of the same name give way."""
    names = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in names] + list(columns.values()), names=names + list(columns)
    )


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start .. start + length - 1 of every range, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)
