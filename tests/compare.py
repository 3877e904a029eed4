"""Run a registered query and its SQL on the same tables and compare whole results."""

from __future__ import annotations

import datetime
import glob
import os
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.date().isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple(map(repr, r)))


def difference(spark, con, query, sql, sf_dir) -> tuple[str | None, int, float, float]:
    """(what differs or None, rows, Spark seconds, SQL seconds)."""
    started = time.time()
    frame = query(spark, sf_dir)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    spark_seconds = time.time() - started
    started = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    sql_seconds = time.time() - started
    problem = None
    if got[0] != want[0]:
        problem = f"columns {got[0]} != {want[0]}"
    elif len(got[1]) != len(want[1]):
        problem = f"rows {len(got[1])} != {len(want[1])}"
    else:
        bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
        if bad:
            problem = f"{len(bad)} rows differ, first {bad[0]}"
    return problem, len(got[1]), spark_seconds, sql_seconds
