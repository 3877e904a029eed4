"""A training corpus from raw documents: five stages, each written as a table before the next one.

Every stage takes (spark, docs, sf_dir) and returns a frame.  All but the last return the columns of
their input.  Nothing is learnt from rows that an earlier stage has dropped.

Stages that drop rows judge each row by itself, known by its id and a hash of all its columns, whether
the id is null or repeats.  What is to go is a narrow table written first; texts meet it by a broadcast
where it is small.  Rows equal in every column are one document, of which near_duplicates keeps one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, decontaminate, language, pii, simhash
from salesmart.llm.common import cut

VOCABULARY = "byte_bpe_50k.json"
_ROW = "__row"


def row_key(docs: DataFrame) -> Column:
    """A text that orders as the id, rows without one last, and tells apart rows that differ at all."""
    columns = [F.col(c) for c in docs.columns]
    # the id's bits with the sign turned, so that hex digits order as the numbers
    place = F.lpad(F.hex(F.col("doc_id").cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    own = F.when(F.col("doc_id").isNull(), F.lit("n")).otherwise(place)
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]
    return F.concat(own, *[F.lpad(F.hex(h), 16, "0") for h in hashes])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_ROW, row_key(docs))


def _without(docs: DataFrame, gone: DataFrame, many: bool = False) -> DataFrame:
    """The rows whose key is not in a column of keys.

    What grows with the corpus, as copies do, meets the rows in one shuffle at every size.
    """
    gone = cut(gone.toDF(_ROW).distinct())
    gone = gone.hint("merge") if many else gone
    return _keyed(docs).join(gone, _ROW, "left_anti").select(docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the declared one and the source are evidence."""
    rows = _keyed(docs).select(_ROW, F.col("text").alias("__body"), F.col("lang").alias("__lang"), F.col("source").alias("__source"))
    found = language.identify(rows, "__body", declared=F.col("__lang"), host=F.col("__source"), keep_text=False)
    return _without(docs, found.where(~F.col("keep")).select(_ROW))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    found = cut(simhash.near_duplicates(_keyed(docs), _ROW).select(_ROW, "component_id"))
    kept = _without(docs, found.where(F.col(_ROW) != F.col("component_id")).select(_ROW), many=True)
    # rows equal in every column have one key; of these few, one stays
    repeated = cut(found.groupBy(_ROW).count().where("count > 1").select(_ROW))
    if repeated.isEmpty():
        return kept
    rows = _keyed(kept)
    once = rows.join(repeated, _ROW, "left_semi").dropDuplicates([_ROW])
    return rows.join(repeated, _ROW, "left_anti").unionByName(once).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    leaks = decontaminate.leaks(_keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id=_ROW)
    return _without(docs, leaks.select(_ROW))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    clean = pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document instead of its text, with digests that a reader can verify."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), with_ids="ids")


STAGES = [
    ("known_language", known_language),
    ("near_duplicates", near_duplicates),
    ("without_benchmark", without_benchmark),
    ("without_personal_data", without_personal_data),
    ("tokens", tokens),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
