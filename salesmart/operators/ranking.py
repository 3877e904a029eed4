"""Ranks and tiles over whole tables without pulling the table through one task."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.operators.lookup import attach


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares; only a session of one machine may lack the setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return local_folder(spark.sparkContext.applicationId)


@cache
def local_folder(application: str) -> str:
    """The folder of a session of one machine."""
    return tempfile.mkdtemp(prefix="salesmart-")


def written(df: DataFrame) -> DataFrame:
    """The frame as a written table: computed once, and read again whatever executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/salesmart-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(df: DataFrame, order: list[Column], name: str, total: str | None) -> DataFrame:
    placed = written(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(  # one row per sort partition
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        *([F.sum("_size").over(Window.partitionBy()).alias(total)] if total else []),
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place + 1)
        .drop("_id", "_part", "_offset")
    )


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of every row in a total order.

    The sort is range-partitioned.  ``monotonically_increasing_id`` gives the partition in its
    upper bits and the place inside the partition in its lower 33 bits; adding the sizes of
    the partitions before it makes the place global.  The sorted rows are a written table, so
    both passes see the same partitions even when an executor is lost.
    ``order`` must end in a unique column, which also splits runs of equal leading values.
    """
    return _placed(df, order, name, None)


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE bucket of a position: the first ``rows % tiles`` buckets hold one row more."""
    size = F.floor(rows / tiles)
    larger = rows % tiles
    edge = larger * (size + 1)
    return F.when(position <= edge, F.ceil(position / (size + 1))).otherwise(
        larger + F.ceil((position - edge) / F.nullif(size, F.lit(0)))
    ).cast("int")


def add_tile(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    """NTILE over the whole frame."""
    placed = _placed(df, order, "_position", "_rows")
    tile = tile_of(F.col("_position"), F.col("_rows"), tiles)
    return placed.withColumn(name, tile).drop("_position", "_rows")


def add_rank(df: DataFrame, value: str, tie: str, name: str) -> DataFrame:
    """RANK over the whole frame by ``value`` descending, leaving gaps after ties."""
    placed = with_position(df, [F.desc(value), F.asc(tie)], "_position")
    first = placed.groupBy(value).agg(F.min("_position").alias(name))
    return attach(placed, first, value).drop("_position")


def with_surrogate_key(dim: DataFrame, key: str, natural_id: str) -> DataFrame:
    """Dense key 1..n in the order of the natural id, as the first column."""
    return with_position(dim, [F.asc(natural_id)], key).select(key, *dim.columns)
