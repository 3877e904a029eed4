"""Language of documents by fusing what their text says with what is declared about them.

The evidence of a row, all as likelihoods of a language:
* its text: hashed letter trigrams, learnt from a bounded sample of rows for each declared language
  (counts are summed in tasks; no text leaves them), against a class "other" for which every trigram is
  equally likely;
* the declared (markup) language, and the suffix of its address: how often each value goes with each
  language, by grouped aggregation over all rows;
* its host: a prior from the languages of the host's other rows, smoothed towards those of the
  suffix, these towards those of all rows.
What a text says is computed once and written without the text unless that is asked for; the tables of
declared values, suffixes and hosts are aggregates of it and meet it again, narrow as it is.
The posterior is their normalised product.  A row is kept if the best language is not "other", has
at least the given posterior, and the text holds letters at all.

Cases: null is the empty text, which has no language and is not kept; null declared values, hosts
and addresses add no evidence; texts are read whole; repeated rows give repeated rows; an empty
table gives an empty one; columns that have the names of the result give way.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, pieces, schema_with, texts, with_columns

#: Rows of each declared language that the trigrams are learnt from, about.
SAMPLE_ROWS = 2000
#: Declared languages that are told apart, the most frequent ones: 64 MB of trigram weights in a task.
LANGUAGES = 256
#: Bytes of text that a task works on at a time.
PIECE = 1 << 20
OTHER = "other"
BUCKETS = 1 << 16
#: Trigrams of a text count as independent up to about so many.
INDEPENDENT = 300
#: Rows that a parent's distribution weighs as in the smoothing of hosts, suffixes and declared values.
PARENT_ROWS = 10.0
LEAST_POSTERIOR = 0.5

RESULT = {"language": "string", "posterior": "double", "keep": "boolean"}
_OWN = "__language_evidence"


class Trigrams(NamedTuple):
    languages: list[str]  # with OTHER last
    logs: np.ndarray  # languages x BUCKETS


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code of each letter of the basic plane, and a space for all else."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


def trigrams(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every letter trigram of the texts, and the number of its text."""
    low = [f" {t.lower()} " for t in batch]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) for t in low])
    # letters beyond the basic plane are kept as they are
    codes = np.where(codes < 1 << 16, _letters()[np.minimum(codes, (1 << 16) - 1)], codes)
    same = (codes[1:] == 32) & (codes[:-1] == 32) & (owner[1:] == owner[:-1])
    keep = np.append(True, ~same)
    codes, owner = codes[keep], owner[keep]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    mixed = a * np.uint32(2654435761) ^ b * np.uint32(2246822519) ^ c * np.uint32(3266489917)
    mixed ^= mixed >> np.uint32(15)
    found = ((mixed * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    whole = owner[:-2] == owner[2:]
    return found[whole], owner[:-2][whole]


def evidence(batch: list[str], model: Trigrams) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each language for each text, the best at 0, and the texts' trigrams."""
    found, owner = trigrams(batch)
    n = np.bincount(owner, minlength=len(batch))
    sums = np.zeros((len(batch), len(model.languages)))
    filled = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[filled]
    for i, logs in enumerate(model.logs):
        if len(filled):
            sums[filled, i] = np.add.reduceat(np.take(logs, found), starts, dtype=np.float64)
    sums /= (1 + n / INDEPENDENT)[:, None]
    return sums - sums.max(axis=1, keepdims=True), n


def learn(counts: dict[str, np.ndarray]) -> Trigrams:
    """Smoothed logs of the trigram shares of each language, and of OTHER."""
    names = sorted(counts)
    shares = [counts[name] + 0.5 for name in names]
    logs = [np.log(x / x.sum()) for x in shares] + [np.full(BUCKETS, -np.log(BUCKETS))]
    return Trigrams([*names, OTHER], np.stack(logs).astype(np.float32))


def primary(declared: Column) -> Column:
    """The primary part of a language tag: en for EN-us."""
    return F.nullif(F.lower(F.split_part(F.translate(F.trim(declared), "_", "-"), F.lit("-"), F.lit(1))), F.lit(""))


def train(frame: DataFrame, text: str, declared: Column) -> Trigrams:
    """Trigrams of the declared languages, from a bounded sample of rows of each, texts of any length.

    The sample is what a hash of the text puts below a share that makes SAMPLE_ROWS of a language.
    """
    rows = frame.select(primary(declared).alias("declared"), F.col(text).alias("text"))
    rows = rows.where((F.octet_length("text") > 0) & F.col("declared").isNotNull())
    seen = rows.groupBy("declared").count().orderBy(F.desc("count"), "declared").limit(LANGUAGES).collect()
    if not seen:
        return learn({})
    share = F.create_map(*[F.lit(x) for r in seen for x in (r["declared"], min(1.0, SAMPLE_ROWS / r["count"]))])
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = rows.where(place < share[F.col("declared")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                coded = piece.column("declared").dictionary_encode()
                found, owner = trigrams(texts(piece, "text"))
                both = coded.indices.to_numpy()[owner].astype(np.int64) * BUCKETS + found
                keys, n = np.unique(both, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(keys // BUCKETS)), pa.array((keys % BUCKETS).astype(np.int32)), pa.array(n)],
                    names=["declared", "bucket", "n"],
                )

    sums = chosen.mapInArrow(run, "declared string, bucket int, n bigint").groupBy("declared", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # LANGUAGES * BUCKETS rows at most, whatever the corpus
    counts = {r["declared"]: np.zeros(BUCKETS) for r in seen}
    code = table.column("declared").combine_chunks().dictionary_encode()
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    for i, name in enumerate(code.dictionary.to_pylist()):
        own = code.indices.to_numpy() == i
        counts[name][bucket[own]] = n[own]
    return learn(counts)


def _with_evidence(frame: DataFrame, text: str, model: Trigrams, keep_text: bool) -> DataFrame:
    kept = [c for c in frame.columns if keep_text or c != text]
    spread = frame.sparkSession.sparkContext.broadcast(model)  # LANGUAGES * BUCKETS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(spread.value.languages)
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                logs, n = evidence(texts(piece, text), spread.value)
                flat = pa.array(np.round(logs, 6).ravel())
                column = pa.FixedSizeListArray.from_arrays(flat, size).cast(pa.list_(pa.float64()))
                column = pa.array(column.to_pylist(), pa.list_(pa.float64()), mask=n == 0)
                yield with_columns(piece.select(kept), {_OWN: column})

    return frame.mapInArrow(run, schema_with(frame, kept, {_OWN: "array<double>"}))


def _shares(counts: list[Column], parents: list[Column]) -> Column:
    """Smoothed shares of counts as an array."""
    total = functools.reduce(lambda a, b: a + b, counts)
    return F.array(*[(c + PARENT_ROWS * p) / (total + PARENT_ROWS) for c, p in zip(counts, parents, strict=True)])


def _tables(seen: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Priors of hosts, and likelihoods of suffixes and of declared values, of rows counted by them."""
    sums = [F.sum(F.when(F.col("best") == i, F.col("n")).otherwise(0)).cast("double").alias(f"n{i}") for i in range(size)]
    n = [F.col(f"n{i}") for i in range(size)]
    whole = [float(x or 0) for x in seen.agg(*sums).first()]
    overall = [(x + 1) / (sum(whole) + size) for x in whole]

    def likelihood(key: str) -> DataFrame:
        # of a value, given the language: its share among the rows of the language, smoothed by its overall share
        counts = seen.where(F.col(key).isNotNull()).groupBy(key).agg(*sums)
        total = functools.reduce(lambda a, b: a + b, n)
        logs = [
            F.log((c + PARENT_ROWS * total / max(1.0, sum(whole))) / (whole[i] + PARENT_ROWS)) for i, c in enumerate(n)
        ]
        return counts.select(key, F.array(*logs).alias(f"{key}_logs"))

    suffixes = seen.groupBy("suffix").agg(*sums).select(
        "suffix", _shares(n, [F.lit(p) for p in overall]).alias("parent")
    )
    hosts = seen.where("host is not null").groupBy("host", "suffix").agg(*sums)
    hosts = hosts.join(suffixes, hosts["suffix"].eqNullSafe(suffixes["suffix"]))
    hosts = hosts.select("host", F.array(*n).alias("host_rows"), F.col("parent").alias("host_parent"))
    # a host of several suffixes is one host: its rows add up, its parent is that of most rows
    hosts = hosts.groupBy("host").agg(
        *[F.sum(F.col("host_rows")[i]).alias(f"h{i}") for i in range(size)],
        F.max_by("host_parent", F.aggregate("host_rows", F.lit(0.0), lambda a, x: a + x)).alias("host_parent"),
    )
    hosts = hosts.select("host", F.array(*[F.col(f"h{i}") for i in range(size)]).alias("host_rows"), "host_parent")
    return hosts, likelihood("suffix"), likelihood("declared")


def identify(
    frame: DataFrame,
    text: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    least: float = LEAST_POSTERIOR,
    keep_text: bool = True,
    model: Trigrams | None = None,
) -> DataFrame:
    """The frame with language, posterior and keep; keep_text=False leaves the text out."""
    none = F.lit(None).cast("string")
    declared = none if declared is None else primary(declared.cast("string"))
    host, suffix = (none if c is None else c.cast("string") for c in (host, suffix))
    model = model or train(frame, text, declared)
    size = len(model.languages)
    keys = {"declared": declared, "host": host, "suffix": suffix}
    names = [c for c in frame.columns if c not in RESULT]
    rows = frame.select(*names, F.col(text).alias("__text"), *[c.alias(f"__{k}") for k, c in keys.items()])
    rows = rows if keep_text else rows.drop(text)
    rows = cut(_with_evidence(rows, "__text", model, False))
    best = F.array_position(_OWN, F.array_max(_OWN)) - 1
    seen = rows.where(F.col(_OWN).isNotNull()).groupBy(*[F.col(f"__{k}").alias(k) for k in keys], best.alias("best"))
    seen = cut(seen.agg(F.count("*").alias("n")))
    hosts, suffixes, declarations = (cut(t) for t in _tables(seen, size))
    for table, key in ((hosts, "host"), (suffixes, "suffix"), (declarations, "declared")):
        rows = rows.join(table.withColumnsRenamed({c: f"__t_{c}" for c in table.columns}), F.col(f"__{key}") == F.col(f"__t_{key}"), "left")
    zeros = F.array_repeat(F.lit(0.0), size)
    own = F.col(_OWN)
    mine = (F.array_position(own, F.array_max(own)) - 1).cast("int")
    places = F.sequence(F.lit(0), F.lit(size - 1))
    # of the host's rows, the row itself does not speak for itself
    others = F.transform(places, lambda i: F.col("__t_host_rows")[i] - F.when(i == mine, 1.0).otherwise(0.0))
    prior = F.transform(
        places,
        lambda i: F.log((others[i] + PARENT_ROWS * F.col("__t_host_parent")[i]) / (F.aggregate(others, F.lit(0.0), lambda a, x: a + x) + PARENT_ROWS)),
    )
    prior = F.when(F.col("__t_host_rows").isNotNull(), prior)
    total = functools.reduce(
        lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
        [F.coalesce(c, zeros) for c in (own, prior, F.col("__t_suffix_logs"), F.col("__t_declared_logs"))],
    )
    rows = rows.withColumn("__total", total).withColumn("__top", F.array_max("__total"))
    weight = F.aggregate("__total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    language = F.element_at(
        F.array(*[F.lit(x) for x in model.languages]), F.array_position("__total", F.col("__top")).cast("int")
    )
    rows = rows.select(
        *[c for c in names if keep_text or c != text],
        F.when(own.isNotNull(), language).alias("language"),
        F.when(own.isNotNull(), F.round(1 / weight, 9)).alias("posterior"),
    )
    return rows.withColumn("keep", F.coalesce((F.col("language") != OTHER) & (F.col("posterior") >= least), F.lit(False)))


def page_evidence(url: str = "url", html: str = "html") -> dict[str, Column]:
    """The declared language, host and address suffix of web pages, for `identify`."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))
    return {
        "declared": F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z_-]+)", 1), F.lit("")),
        "host": host,
        "suffix": F.element_at(F.split(host, r"\."), -1),
    }
