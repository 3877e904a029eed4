"""Weighted fingerprints, the audit of sources and phrases, against brute force and SQL."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from llm_fixtures import documents, tables  # noqa: F401
from salesmart.llm import bitmap, collocation, divergence, succession, weighted
from salesmart.llm.words import kinds, split_words

SF_DIR = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows_of(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def by_sql(name, rows):
    """The registered SQL over rows given by hand."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return sorted(con.execute(entry_points.oracle_sql()[name]).fetchall(), key=repr)


# --- words and bitmaps -----------------------------------------------------------------------


def test_words_of_random_texts():
    draw, letters = random.Random(1), " \t.,ab\nAÉé\x00"
    kind = kinds(b" \t", b".,;:!?\n\v\f\r")
    for _ in range(500):
        texts = [None if draw.random() < 0.1 else "".join(draw.choices(letters, k=draw.randrange(12))) for _ in range(draw.randrange(6))]
        found = split_words(pa.array(["a b", *texts], pa.string()).slice(1), kind)
        pieces = [(i, j, p) for i, t in enumerate(texts) for j, p in enumerate(re.split("[.,;:!?\n-\r]", lower(t)))]
        expected = [(i, j, w.encode()) for i, j, p in pieces for w in re.findall("[^ \t]+", p)]
        assert [(o, found.distinct[c].as_py()) for o, c in zip(found.owner, found.code)] == [(i, w) for i, _, w in expected]
        for (a, b), (p, q) in zip(itertools.pairwise(expected), itertools.pairwise(found.piece)):
            assert (a[:2] == b[:2]) == (p == q)


def test_bitmap_holds_every_member(spark, monkeypatch):
    draw = random.Random(2)
    members = np.array([draw.getrandbits(64) - (1 << 63) for _ in range(5000)], np.int64)
    others = np.array([draw.getrandbits(64) - (1 << 63) for _ in range(5000)], np.int64)
    frame = spark.createDataFrame([(int(m),) for m in members], "key bigint")
    bits = bitmap.bitmap(frame, "key")
    assert bitmap.found(bits, members).all()
    assert bitmap.found(bits, others).mean() < 0.05
    assert not bitmap.found(bitmap.bitmap(frame.limit(0), "key"), members).any()
    monkeypatch.setattr(bitmap, "MOST_BITS", bitmap.LEAST_BITS)  # a full bitmap lets more through, loses none
    assert bitmap.found(bitmap.bitmap(spark.range(300_000).select(F.xxhash64("id").alias("key")), "key"), members).mean() > 0.5


# --- weighted fingerprints -------------------------------------------------------------------


def similarity(a, b):
    a, b = (collections.Counter(re.findall("[^ \t-\r]+", lower(t))) for t in (a, b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_samples_agree_as_often_as_the_similarity():
    pairs = [("a a a b c", "a b b d"), ("x x x x x x x x y", "x y y y"), ("one two three", "two three four"), ("a", "a a a a")]
    for a, b in pairs:
        found = weighted.signatures(pa.array([a, b, b.upper()]), 20_000)
        assert abs((found[0] == found[1]).mean() - similarity(a, b)) < 0.015  # four standard errors
        assert (found[1] == found[2]).all()


def test_signature_does_not_depend_on_neighbours(tables):
    texts = [r[1] for r in tables("documents")]
    together = weighted.signatures(pa.array(texts), 16)
    alone = np.vstack([weighted.signatures(pa.array([t]), 16) for t in texts[:40]])
    assert (together[:40] == alone).all()


def plain_successors(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(d, t or "", ordered[(i + 1) % len(ordered)][1] or "") for i, (d, t) in enumerate(ordered)]


@pytest.mark.parametrize("range_bytes", [300, 20_000, 1 << 30])
def test_weighted_equals_brute_force(documents, tables, range_bytes):
    rows = [(r[0], r[1]) for r in tables("documents")][:120]
    rows += [(7001, ""), (7002, None), (-5, "été Été x"), (1 << 62, "\U0001f600\U0001f600\U0001f600 a b"), (None, "last of all")]
    frame = documents(rows).withColumn("fingerprint", F.lit("old")).withColumn("key", F.lit(1))
    found = {r.doc_id: r for r in weighted.fingerprints(frame, range_bytes=range_bytes).collect()}
    assert len(found) == len(rows)
    off = []
    for d, text, after in plain_successors(rows):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = found[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, other = weighted.signatures(pa.array([text, edited]))
        assert (r.fingerprint, r.edited_fingerprint) == tuple(x.astype(">u2").tobytes().hex() for x in (own, other))
        off += [r.near_edited - similarity(text, edited), r.near_next - similarity(text, after)]
    assert max(map(abs, off)) < 0.2 and abs(sum(off) / len(off)) < 0.02


def test_weighted_cases(documents):
    assert weighted.fingerprints(documents([])).count() == 0
    one = weighted.fingerprints(documents([(3, "a b c d e f")])).collect()
    assert one[0].near_next == 1.0
    empty = weighted.fingerprints(documents([(1, ""), (2, None), (3, " \t")])).collect()
    assert {(r.near_edited, r.near_next) for r in empty} == {(1.0, 1.0)}
    nulls = weighted.fingerprints(documents([(None, "a b"), (None, None)]), range_bytes=1).collect()
    assert sorted(r.n_chars for r in nulls) == [0, 3]
    # one id holds most rows, with few and with many texts; every row has a row
    same = [(1, "the same text")] * 40 + [(1, f"text {i}") for i in range(40)] + [(2, "x " * 50_000), (0, "z")]
    found = weighted.fingerprints(documents(same), range_bytes=64)
    assert found.count() == len(same)
    assert found.where("n_chars = 13").select("fingerprint").distinct().count() == 1


def test_ranges_are_sorted_and_closed(spark):
    frame = spark.createDataFrame([(i % 37, f"t{i}") for i in range(400)], "doc_id bigint, text string")
    parts = succession.in_ranges(frame, "doc_id", "text", 100)
    rows = [r for p in parts.rdd.glom().collect() for r in p]
    assert len({r.part for r in rows}) > 5
    own = [r for r in rows if not r.guest]
    assert sorted((r.id, r.text) for r in own) == sorted((i % 37, f"t{i}") for i in range(400))
    ids = [r.id for part in sorted({r.part for r in rows}) for r in own if r.part == part]
    assert ids == sorted(ids, reverse=True)


# --- audit of sources ------------------------------------------------------------------------


def made_documents(seed, n, langs=("en", "de", None)):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "betas", "be", "gämma", "x", "deltadeltadelta", "deltadeltadeltas", "Ω"]
    rows = []
    for i in range(n):
        text = " ".join(draw.choices(words, weights=range(9, 0, -1), k=draw.randrange(9))) + draw.choice(["", "!", " 7up", "\nbe-ta"])
        rows.append((i, None if i % 11 == 0 else text, draw.choice(langs), draw.choice(["a", "b", "c", None, ""]), 1))
    return rows


@pytest.mark.parametrize(("block", "chunk"), [(128, 8192), (2, 2)])
def test_audit_equals_sql(documents, block, chunk):
    rows = made_documents(5, 300) + made_documents(6, 20, ("fr",)) + [(1, "alpha", "it", "only", 1)]
    rows += rows[:30]  # repeated rows are documents of their own
    frame = documents(rows).withColumn("value", F.lit(1)).withColumn("part", F.lit("x"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    found = rows_of(divergence.audit(frame, block=block, chunk=chunk), columns)
    assert found == by_sql("op12_divergence", rows)
    assert {r[0] for r in found} == {"en", "de", "", "fr"}


def test_audit_of_one_hot_source_and_long_terms(documents):
    rows = [(i, "longterm" * 500 + " common" if i % 3 else "common", "en", "hot" if i % 3 else "cold", 1) for i in range(60)]
    rows += [(100, "word " * 30_000, "en", "cold", 1)]
    found = rows_of(divergence.audit(documents(rows)), ["lang", "source", "part", "item", "value", "rank"])
    assert found == by_sql("op12_divergence", rows)
    assert any(len(r[3]) == 4000 for r in found)


def test_audit_cases(documents):
    assert divergence.audit(documents([])).count() == 0
    rows = [(1, "a", "en", "x", 1), (2, None, "en", "y", 1), (None, "", "en", None, None)]  # nothing is kept
    found = rows_of(divergence.audit(documents(rows)), ["source", "item", "value", "rank"])
    assert len(found) == 6 and {r[2] for r in found} == {0}


def test_levels_keep_what_a_full_count_keeps(documents):
    rows = made_documents(9, 400)
    texts = documents(rows).select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    found = divergence.iceberg_terms(divergence.document_terms(texts), 25).collect()
    holders = collections.Counter(
        (r[2] or "", t) for r in rows for t in set(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(r[1])))
    )
    assert sorted((r.lang, bytes(r.term).decode()) for r in found) == sorted(k for k, n in holders.items() if n >= 25)


# --- phrases ---------------------------------------------------------------------------------


def made_phrases(seed, n):
    draw = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "été", "=", "a"]
    rows = []
    for i in range(n):
        parts = [draw.choice(["New York city", "of the", *words]) for _ in range(draw.randrange(14))]
        text = draw.choice([" ", "  ", "\t"]).join(parts)
        rows.append((i, None if i % 13 == 0 else text.replace("of", "of" + draw.choice(["", ".", "\n", "; "])), draw.choice(["en", "fr", None]), "s", 1))
    return rows


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_equal_sql(documents):
    rows = made_phrases(1, 400) + [(1, "x " * 3_000, "long", "s", 1), (2, "few words here", "none", "s", 1)]
    rows += [(5, "und words " * 12, "und", "s", 1)] + rows[:50]
    frame = documents(rows).withColumn("a", F.lit(1)).withColumn("word", F.lit("x"))
    found = rows_of(collocation.collocations(frame), COLUMNS)
    assert found == by_sql("op13_collocations", rows)
    assert any(r[2] == "new york city" for r in found) and any(r[0] == "und" for r in found)


def test_phrases_with_a_full_bitmap(documents, monkeypatch):
    rows = made_phrases(2, 200)
    expected = rows_of(collocation.collocations(documents(rows)), COLUMNS)
    monkeypatch.setattr(collocation, "bitmap", lambda frame, column: np.full(1 << 12, 255, np.uint8))
    assert rows_of(collocation.collocations(documents(rows)), COLUMNS) == expected


def test_longer_phrases_equal_brute_force(documents):
    rows = made_phrases(3, 150)
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    expected = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 6}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= 50 * a for q, b in candidates.items() if len(q) > len(p) and p in [q[i : i + len(p)] for i in range(len(q))]):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        n = sum(a for p, a in f.items() if len(p) == 1)
        expected += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:50])]
    found = rows_of(collocation.collocations(documents(rows), most_words=4, least=6, top=50), COLUMNS)
    assert found == sorted(expected, key=repr)


def test_phrase_cases(documents):
    assert collocation.collocations(documents([])).count() == 0
    assert collocation.collocations(documents([(1, None), (2, ""), (3, " . , ")])).count() == 0
    with pytest.raises(ValueError):
        collocation.collocations(documents([]), most_words=1)


def test_words_that_share_a_hash_take_another_seed(documents, monkeypatch):
    real = collocation.hashes
    monkeypatch.setattr(collocation, "SEEDS", 2)
    counted = []

    def first_seed_fails(texts, seed):
        frame = word_counts(texts, seed)
        counted.append(seed)
        return frame if seed else frame.withColumn("key", F.lit(1).cast("bigint"))

    word_counts = collocation.word_counts
    monkeypatch.setattr(collocation, "word_counts", first_seed_fails)
    rows = [(i, "one two three", "en", "s", 1) for i in range(12)]
    assert [r.phrase for r in collocation.collocations(documents(rows)).collect()] == ["one two three"]
    assert counted == [0, 1] and real is collocation.hashes
