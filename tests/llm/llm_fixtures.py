"""Helpers of the operators' tests."""

from __future__ import annotations

import duckdb
import pytest

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")
TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    """Rows of the smallest test tables, read without Spark."""
    return lambda name: duckdb.sql(f"SELECT * FROM '{TESTDATA}/{name}.parquet'").fetchall()


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or whole rows."""

    def make(rows):
        full = [r if len(r) == 5 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
