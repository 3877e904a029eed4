"""One query for each operator, over its whole table, with the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import ann, bpe, collocation, cotrain, decontaminate, divergence, katz, language, main_text, pii, simhash, warc, weighted

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; keep says whether the filtering stage keeps it."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return language.identify(documents, declared=F.col("lang"), host=F.col("source"), keep_text=False)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; keep says whether a filter would keep it."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    views = cotrain.learn(documents, _table(spark, sf_dir, "labels"))
    return cotrain.score(documents, views, keep_text=False)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(_table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, with the items they hold."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(documents, public_tokenizers.path(VOCABULARY))


def op11_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike these and the next document are."""
    return weighted.fingerprints(_table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and the terms that a source has more of."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's phrases of two and three words that keep together."""
    return collocation.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_language, op3_pii, op4_simhash, op5_katz, op6_quality, op7_neighbours, op8_warc, op9_leaks,
        op10_bpe, op11_weighted, op12_divergence, op13_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op7_neighbours": """
        WITH usable AS (
            SELECT vec_id, min(embedding)::DOUBLE[] AS embedding FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
            GROUP BY vec_id
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.embedding, c.embedding) AS score
            FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.embedding) = len(c.embedding)
        ), ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id))::INTEGER AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op8_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
    "op12_divergence": r"""
        WITH texts AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS document,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), found AS (
            SELECT lang, source, document,
                   unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM texts
        ), kept AS (
            SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT document) >= 30
        ), sizes AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), groups AS (
            SELECT DISTINCT lang, source FROM texts
        ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), dense AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, s.v
            FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), totals AS (
            SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang, term) AS lang_n,
                   sum(n) OVER (PARTITION BY lang) AS lang_total
            FROM dense
        ), shares AS (
            SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v)::HUGEINT AS p,
                   1 + (1000000000 * (lang_n + 5)::HUGEINT) // (lang_total + 5 * v)::HUGEINT AS q
            FROM totals
        ), apart AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        ), parts AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
            FROM parts
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces
        ), spread AS (
            SELECT lang, words, unnest([1, 2, 3]) AS size FROM worded
        ), starts AS (
            SELECT lang, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM spread
        ), f AS (
            SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*)::BIGINT AS a
            FROM starts GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
        ), candidates AS (
            SELECT *, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND a >= 10
        ), cuts AS (
            SELECT c.*, unnest(generate_series(1, size - 1)) AS k FROM candidates c
        ), scored AS (
            SELECT c.lang, c.phrase, c.size, c.words, c.a, l.a AS l, r.a AS r,
                   ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score,
                   row_number() OVER (PARTITION BY c.lang, c.phrase
                       ORDER BY (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a), k) AS nth
            FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1 : k], ' ')
                        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1 :], ' ')
        ), longer AS (
            SELECT lang, array_to_string(words[i : i + 1], ' ') AS phrase, max(a) AS most
            FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE size = 3) GROUP BY ALL
        ), ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
            FROM scored s LEFT JOIN longer x ON x.lang = s.lang AND x.phrase = s.phrase
            WHERE nth = 1 AND (most IS NULL OR 100 * most < 50 * s.a)
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
