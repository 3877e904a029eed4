"""Versions of a warehouse: files are written once, and a manifest, written last, says which ones count.

Every commit puts its tables into folders of its own, `<table>/commit=<id>`, and the fact's months into
`fact_sales/commit=<id>/year_month=<yyyymm>`.  A manifest is one row: for each table the commit that holds
it, for each month of the fact likewise.  It appears by one rename (or one put) of one file, so a reader
sees the version before or the one after and nothing between; files that a reader has planned with are
never written again.  A commit that fails leaves folders that no manifest names; `remove_versions` deletes
these and whatever only older versions name.

One writer at a time: a second one that commits the same version fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "year_month"  # yyyymm, the upper part of date_key
COMMIT = "commit"
_FOLDER = "manifests"
_SCHEMA = "version int, tables map<string,string>, months map<string,map<int,string>>, top_keys map<int,bigint>"


class NoVersion(LookupError):
    """The folder holds no such version."""


@dataclass(frozen=True)
class Manifest:
    """Which commit holds each table and, for tables kept by month, each month."""

    version: int
    tables: dict[str, str]
    months: dict[str, dict[int, str]]
    top_keys: dict[int, int]  # highest key of each month's lines


EMPTY = Manifest(0, {}, {}, {})


def new_commit() -> str:
    """A name that no other attempt has, so that no attempt meets the files of another."""
    return uuid.uuid4().hex


def _all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{path}/{_FOLDER}/*")


def _manifest(row) -> Manifest:
    months = {t: dict(m) for t, m in (row["months"] or {}).items()}
    return Manifest(row["version"], dict(row["tables"]), months, dict(row["top_keys"] or {}))


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The latest version, or the one asked for."""
    try:
        found = _all(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            raise NoVersion(f"no version in {path}") from error
        raise
    found = found if version is None else found.where(F.col("version") == version)
    rows = found.orderBy(F.desc("version")).limit(1).collect()
    if not rows:
        raise NoVersion(f"no version {version or ''} in {path}")
    return _manifest(rows[0])


def latest_or_empty(spark: SparkSession, path: str) -> Manifest:
    try:
        return read_manifest(spark, path)
    except NoVersion:
        return EMPTY


def versions(spark: SparkSession, path: str) -> list[int]:
    try:
        return sorted(r["version"] for r in _all(spark, path).select("version").collect())
    except AnalysisException:
        return []


def commit(spark: SparkSession, path: str, manifest: Manifest) -> Manifest:
    """Make a manifest the next version.  Everything that it names has been written before."""
    found = replace(manifest, version=manifest.version + 1)
    row = (found.version, found.tables, found.months, found.top_keys)
    frame = spark.createDataFrame([row], _SCHEMA).coalesce(1)
    frame.write.mode("errorifexists").parquet(f"{path}/{_FOLDER}/{found.version:08d}")
    return found


def write_table(frame: DataFrame, path: str, name: str, commit_id: str) -> None:
    frame.write.parquet(f"{path}/{name}/{COMMIT}={commit_id}")


def write_months(frame: DataFrame, path: str, name: str, commit_id: str) -> list[int]:
    """Write a table by month; returns the months that have rows.  The frame has the month's column."""
    folder = f"{path}/{name}/{COMMIT}={commit_id}"
    frame.write.partitionBy(MONTH).parquet(folder)
    written = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    return sorted(r[MONTH] for r in written.select(MONTH).distinct().collect())  # at most the calendar's months


def read_table(spark: SparkSession, path: str, name: str, struct: T.StructType, manifest: Manifest) -> DataFrame:
    return spark.read.schema(struct).parquet(f"{path}/{name}/{COMMIT}={manifest.tables[name]}")


def read_months(spark: SparkSession, path: str, name: str, struct: T.StructType, manifest: Manifest) -> DataFrame:
    """The months of a version, each from the commit that wrote it last; the month is a partition column."""
    months = manifest.months.get(name, {})
    whole = T.StructType([*struct.fields, T.StructField(MONTH, T.IntegerType())])
    if not months:
        return spark.createDataFrame([], whole)
    folders = [f"{path}/{name}/{COMMIT}={c}/{MONTH}={m}" for m, c in sorted(months.items())]
    located = T.StructType([*whole.fields, T.StructField(COMMIT, T.StringType())])
    return spark.read.schema(located).option("basePath", f"{path}/{name}").parquet(*folders).drop(COMMIT)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    at, files = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()] if files.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)


def remove_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the last versions and every folder that none of these names; returns what went.

    Readers of removed versions must have finished, and no writer may be at work.  Manifests go first,
    so that no version is left that lacks files.
    """
    if keep < 1:
        raise ValueError("keep at least the last version")
    manifests = [_manifest(r) for r in _all(spark, path).collect()]
    kept = sorted(manifests, key=lambda m: m.version)[-keep:]
    gone = [f"{_FOLDER}/{m.version:08d}" for m in manifests if m not in kept]
    for folder in gone:
        _delete(spark, f"{path}/{folder}")
    names = {n for m in manifests for n in [*m.tables, *m.months]}
    for name in sorted(names):
        used = {(m.tables[name], None) for m in kept if name in m.tables}
        used |= {(c, month) for m in kept for month, c in m.months.get(name, {}).items()}
        for child in _children(spark, f"{path}/{name}"):
            commit_id = child.removeprefix(f"{COMMIT}=")
            months = {month for c, month in used if c == commit_id}
            if not months:
                gone.append(f"{name}/{child}")
            elif None not in months:
                own = _children(spark, f"{path}/{name}/{child}")
                gone += [f"{name}/{child}/{f}" for f in own if f.startswith(MONTH) and int(f.split("=")[1]) not in months]
    for folder in gone:
        _delete(spark, f"{path}/{folder}")
    return gone
