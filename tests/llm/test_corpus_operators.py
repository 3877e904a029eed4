"""Operators on pairs, archives and models against brute force, and the pipeline."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from llm_fixtures import documents, tables  # noqa: F401
from salesmart.llm import ann, cotrain, decontaminate, katz, registry, simhash, warc
from salesmart.llm.components import components

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- near duplicates -------------------------------------------------------------------------


def plain_fingerprint(text, width=3):
    words = words_of(text)
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits, ids, most):
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= most:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, d in enumerate(ids):
        groups[find(i)].append(d)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(bits))]


def test_simhash_equals_brute_force(documents, tables):
    rows = [(r[0], r[1]) for r in tables("documents")]
    rows += [(9001, rows[0][1]), (9002, rows[0][1].upper()), (9003, ""), (9004, None), (9005, "one"), (9006, "One \t"), (None, rows[1][1]), (9001, rows[0][1])]
    frame = documents(rows).withColumn("fingerprint", F.lit("old")).withColumn("component_id", F.lit(0))
    found = simhash.near_duplicates(frame).collect()
    bits = [plain_fingerprint(t) for _, t in rows]
    expected = zip([d for d, _ in rows], [f"{b:016x}" for b in bits], plain_components(bits, [d for d, _ in rows], 2), strict=True)
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize(("bucket", "most"), [(2, 2), (32, 2), (2, 1), (2, 3)])
def test_links_of_crowded_buckets(spark, bucket, most):
    draw = random.Random(3)
    values = [draw.getrandbits(64)]
    while len(values) < 250:
        x = draw.choice(values[-40:]) if draw.random() < 0.8 else draw.getrandbits(64)
        for _ in range(draw.randrange(4)):
            x ^= 1 << draw.randrange(64)
        values.append(x)
    values = sorted({x - (1 << 64) if x >> 63 else x for x in values})
    frame = spark.createDataFrame([(x,) for x in values], "bits bigint")
    root = {r.node: r.root for r in components(simhash.links(frame, most, bucket)).collect()}
    assert [root.get(x, x) for x in values] == plain_components([x % (1 << 64) for x in values], values, most)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert {n: r for n, r in found.items() if n != r} == {i: 0 for i in range(1, 101)} | {501: 500}


# --- neighbours and archives -----------------------------------------------------------------


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_equal_sql(spark, con, name):
    frame = registry.QUERIES[name](spark, SF_DIR)
    expected = con.sql(f"SELECT {', '.join(frame.columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("block", [7, 4096])
def test_neighbours_equal_brute_force(spark, block):
    draw = random.Random(8)
    rows = [(i, [draw.gauss(0, 1) for _ in range(6)]) for i in range(230)]
    rows += [(300 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(30)]  # ties, among them the query 300
    rows += [(400, None), (500, [0.0] * 6), (600, [float("nan")] + [1.0] * 5), (700, [None] + [1.0] * 5), (800, [1.0, 2.0]), (900, [1.5, 2.0]), (None, [1.0] * 6), (100, rows[100][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: v for i, v in rows if i is not None and v and None not in v and not any(map(math.isnan, v)) and any(v)}
    expected = []
    for q in (i for i in good if i % 100 == 0):
        near = sorted((math.dist(good[q], v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        expected += [(q, rank, i, pytest.approx(d, abs=1e-12)) for rank, (d, i) in enumerate(near, 1)]
    found = sorted(map(tuple, ann.neighbours(frame, block=block).collect()))
    assert found == sorted(expected, key=lambda r: r[:2])
    assert ann.neighbours(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block", [40, 4096])
def test_neighbours_meet_when_partitions_stay_apart(spark, block):
    draw = random.Random(9)
    rows = [(i, [draw.gauss(0, 1) for _ in range(6)]) for i in range(230)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = [
        (q, rank, i)
        for q in (0, 100, 200)
        for rank, (_, i) in enumerate(sorted((math.dist(rows[q][1], v), i) for i, v in rows if i != q)[:10], 1)
    ]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = ann.neighbours(frame, block=block).select("query_id", "rank", "vec_id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, found)) == expected


def test_bounds_hold():
    import numpy as np

    x = np.random.default_rng(1).normal(size=(60, 9)) * np.logspace(-3, 3, 60)[:, None]
    low, high = ann.bounds(x, x)
    for i in range(60):
        d = ann.distances(np.repeat(x[i : i + 1], 60, axis=0), x)
        assert (low[i] <= d).all() and (d <= high[i]).all()


def test_arc_of_both_versions_becomes_warc():
    for version in (1, 2):
        body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\n<p>\n1 2 3\nx</p>"
        records = [("http://a.b/c d", "1.2.3.4", "text/html", body), ("dns:a.b", "1.2.3.4", "text/dns", b""), ("http://e/", "0.0.0.0", "image/png", b"\x00\xff\n\n")]
        read = list(warc.read_arc(warc.arc_file(version, records, date="20010203040506")))
        assert [r.content for r in read[1:]] == [r[3] for r in records] and read[1].version == version
        made = [warc.convert(r) for r in read]
        assert [m.headers["WARC-Type"] for m in made] == ["warcinfo", "response", "resource", "resource"]
        assert made[1].headers["WARC-Date"] == "2001-02-03T04:05:06Z"
        assert made[1].headers["WARC-Target-URI"] == "http://a.b/c d"
        assert made == [warc.convert(r) for r in read]
        again = list(warc.read_warc(b"".join(warc.warc_bytes(m) + warc.END for m in made)))
        assert again == made
    with pytest.raises(ValueError, match="wrong length"):
        list(warc.read_arc(warc.arc_file(1, records)[:-3]))


def test_archived_pages_edge_cases(spark):
    long = "x" * 300
    rows = [(5, "u5", long), (3, "u 3", long), (9, None, long), (7, "u7", "short"), (8, "u8", "short"), (1, "u1", None), (2, "u2", ""), (4, "u4", "é\r\n\r\nWARC/1.1\r\n" * 20), (3, "u 3", long)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    found = {}
    for r in warc.archive_pages(frame).collect():
        found.setdefault(r.page_id, []).append((r.payload_bytes, r.record_type, r.refers_to))
    assert found[5] == found[9] == [(300, "revisit", 3)] and found[3] == [(300, "response", None)] * 2
    assert found[7] == found[8] == [(5, "response", None)] and found[1] == found[2] == [(0, "response", None)]
    assert found[4][0][0] == len(("é\r\n\r\nWARC/1.1\r\n" * 20).encode())
    assert warc.archive_pages(frame.limit(0)).count() == 0


# --- language model --------------------------------------------------------------------------


def plain_katz(docs, most_words):
    texts = [words_of(t) for _, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    train = [t for t, h in zip(texts, held, strict=True) if not h]
    count = collections.Counter(w for t in train for w in t)
    book = set(sorted(count, key=lambda w: (-count[w], w.encode()))[:most_words])
    total, distinct = sum(count.values()) + len(train), len(count) + 1
    rare = {w: n for w, n in count.items() if w not in book}
    size = sum(rare.values())
    seen = collections.Counter(rare.values())
    rare_d = katz.discounts([seen[r] for r in range(1, katz.K_MAX + 2)])
    cut = lambda n, d: n * d[n] if n <= katz.K_MAX else n
    unknown = 1 - sum(cut(n, rare_d) for n in rare.values()) / (size + 1)
    symbol = lambda w: w if w in book else "<rare>"
    pairs = collections.Counter()
    for t in train:
        s = ["<s>", *map(symbol, t), "<end>"]
        pairs.update(zip(s, s[1:], strict=False))
    seen = collections.Counter(pairs.values())
    d = katz.discounts([seen[r] for r in range(1, katz.K_MAX + 2)])
    symbols = {w: count[w] for w in book} | {"<end>": len(train), "<rare>": size + 1}
    whole = sum(symbols.values())
    after = collections.defaultdict(dict)
    for (h, w), n in pairs.items():
        after[h][w] = n

    def chance(h, w):
        if h not in after:
            return symbols[w] / whole
        n, own = sum(after[h].values()), after[h]
        kept, unseen = sum(cut(x, d) for x in own.values()) / n, 1 - sum(symbols[x] for x in own) / whole
        if w in own:
            return cut(own[w], d) / n / (1 if unseen > 1e-12 else kept)
        return (1 - kept) / unseen * symbols[w] / whole

    for h in list(after)[:20]:
        assert sum(chance(h, w) for w in symbols) == pytest.approx(1)
    out = []
    for (i, _), words, h in zip(docs, texts, held, strict=True):
        score = base = 0.0
        before = "<s>"
        for w in words:
            score += math.log10(chance(before, symbol(w)))
            if symbol(w) == "<rare>":
                score += math.log10(cut(rare[w], rare_d) / (size + 1) if w in rare else unknown)
            base += math.log10((count[w] + 1) / (total + distinct + 1))
            before = symbol(w)
        score += math.log10(chance(before, "<end>"))
        base += math.log10((len(train) + 1) / (total + distinct + 1))
        out.append((i, h, len(words) + 1, sum(w in count for w in words) + 1, total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("words", "cell"), [(30, 700), (100_000, 10**9)])
def test_katz_equals_brute_force(documents, monkeypatch, words, cell):
    monkeypatch.setattr(katz, "WORDS", words)
    monkeypatch.setattr(katz, "CELL_TOKENS", cell)
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdE") for _ in range(draw.randrange(1, 5))) for _ in range(150)]
    docs = []
    for i in range(200):
        chosen = draw.choices(vocabulary, [1 / (j + 1) for j in range(150)], k=draw.randrange(50))
        docs.append((i, draw.choice(["", " ", "\t"]) + draw.choice([" ", "  ", "\n"]).join(chosen) + draw.choice(["", " "])))
    docs += [(7, None), (None, "a b c"), (3, docs[3][1]), (900, "\xa0é zz"), (901, "")]
    found = katz.score(documents(docs)).collect()
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found]
    assert sorted(rows, key=str) == plain_katz(docs, words)


def test_katz_counts_pairs_of_every_word(documents):
    """More distinct words than any book of symbols would hold; a pair of two of the rarest is known as such."""
    docs = [(i, " ".join(f"w{40 * i + k}" for k in range(40))) for i in range(2_000)]  # 80,000 words, seen once
    docs += [(5_000 + i, "left right") for i in range(4)]
    aside = next(i for i in range(9_000, 9_100) if zlib.crc32(str(i).encode()) % 7 == 2)
    held = [j for j in range(aside, aside + 300) if zlib.crc32(str(j).encode()) % 7 == 2][:3]
    first = next(i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 != 2)
    a, b = f"w{40 * first + 1}", f"w{40 * first + 2}"
    docs += [(held[0], f"{a} {b}"), (held[1], f"{b} {a}"), (held[2], "left right")]
    found = katz.score(documents(docs)).collect()
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found]
    assert sorted(rows, key=str) == plain_katz(docs, 10**9)
    score = {r.doc_id: r.score for r in found}
    assert score[held[0]] > score[held[1]] + 2


def test_katz_of_often_seen_pairs_leaves_something_to_others(documents):
    docs = [(i, "left right") for i in range(100)]
    found = katz.score(documents([*docs, *[(i, "left unheard right") for i in range(200, 230)]])).collect()
    assert all(math.isfinite(r.score) for r in found)


def test_katz_splits_the_cell_of_a_frequent_pair(documents, monkeypatch):
    monkeypatch.setattr(katz, "CELL_TOKENS", 1_000)
    monkeypatch.setattr(katz, "PIECE", 500)
    docs = [(i, "hot " * 50) for i in range(80)] + [(100 + i, " ".join(f"w{20 * i + k}" for k in range(40))) for i in range(80)]
    docs += [(300 + i, f"hot once{i}") for i in range(3)]
    frame = documents(docs).withColumn("id", F.col("doc_id")).withColumn("mark", F.col("doc_id")).coalesce(1)
    model, _, _ = katz.train(frame, "text")
    busy = max(range(model.cells), key=lambda c: model.parts[c])
    rows = [r.asDict() for r in katz._sent(frame, model).collect() if r.cell == busy]
    assert model.cells > 1 and len({r["part"] for r in rows}) > 1
    counts = [n for r in rows for n in katz._unplanes(r["counts"], "<u4").tolist()]
    assert counts.count(49) == 80 and sum(counts) < 80 * 50 + 80 * 41 + 160  # one entry for a pair of a text
    found = {r.doc_id: round(r.score, 6) for r in katz.score(documents(docs)).collect()}
    assert found == {r[0]: r[-1] for r in plain_katz(docs, 10**9)}


def test_katz_of_an_empty_table(documents):
    assert katz.score(documents([(1, "a")]).limit(0)).count() == 0


# --- quality ---------------------------------------------------------------------------------


def test_co_training_on_held_out_labels(spark):
    con = duckdb.connect()
    rows = con.sql("SELECT doc_id, text, lang, source, quality FROM '/root/testdata/sf0.01/documents.parquet' LEFT JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id)").fetchall()
    frame = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    known = [(r[0], r[4]) for r in rows if r[4] is not None]
    views = cotrain.learn(frame, spark.createDataFrame([k for k in known if k[0] % 3], "doc_id long, quality int"))
    found = {r.doc_id: r for r in cotrain.score(frame, views).collect()}
    aside = [k for k in known if k[0] % 3 == 0]
    assert len(found) == len(rows)
    assert sum(found[i].keep == bool(q) for i, q in aside) >= 0.95 * len(aside)
    good = [i for i, q in aside if q]
    assert sum(found[i].keep for i in good) >= 0.98 * len(good)


def test_co_training_reads_long_labelled_texts_and_all_other_rows(spark, monkeypatch):
    draw = random.Random(4)
    text = lambda good, n: " ".join(draw.choices(["river", "stone", "meadow", "lamp"] if good else ["$$$", "WIN!!", "zzzz", "777"], k=n))
    labelled = [(i, text(i % 2, 4_000), f"s{i % 2}", "en") for i in range(40)]  # all longer than 16 KB
    others = [(100 + i, text(i % 2, 20), f"s{i % 2}", "en") for i in range(7_000)]
    frame = spark.createDataFrame([*labelled, *others], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in labelled], "doc_id long, quality int")
    taught = []
    slopes = cotrain.guessed_slopes
    monkeypatch.setattr(cotrain, "guessed_slopes", lambda *a: taught.append(slopes(*a)) or taught[-1])
    views = cotrain.learn(frame, labels)
    found = {r.doc_id: r.keep for r in cotrain.score(frame, views).collect()}
    assert views.prior is None
    assert all(found[r[0]] == bool(r[0] % 2) for r in [*labelled, *others])
    assert max(n for round in taught for _, n in round) == len(others)  # not 360 of 3,000


def test_quality_edge_cases(spark, documents):
    frame = documents([(1, None, None, None, None), (1, "", "en", "s", 0), (None, "x " * 50_000, "en", "s", 1)]).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 7)], "doc_id long, quality int")
    rows = cotrain.score(frame, cotrain.learn(frame, labels)).collect()
    assert len(rows) == 3 and all(r.score == 1.0 and r.keep for r in rows)
    assert cotrain.score(frame.limit(0), cotrain.learn(frame.limit(0), labels.limit(0))).count() == 0


def test_a_full_tile_needs_little_memory():
    """4,096 queries against 4,096 vectors in strips: what bounds hold at a time stays small, results are the same."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    x = np.random.default_rng(0).standard_normal((2 * 4096, 64))
    table = lambda first: pa.table({"vec_id": range(first, first + 4096), "embedding": list(x[first : first + 4096]), "cb": [0] * 4096})
    queries, candidates = table(0), table(4096)
    tracemalloc.start()
    found = ann.tile(queries, candidates, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 40_960 and peak < 300e6
    for q in (0, 255, 256, 4095):
        exact = np.sqrt(((x[4096:] - x[q]) ** 2).sum(axis=1))
        own = found.filter(pa.compute.equal(found.column("query_id"), q))
        assert own.column("vec_id").to_pylist() == (4096 + np.argsort(exact)[:10]).tolist()


def test_neighbours_leave_clashing_columns_alone(spark):
    rows = [(i, [float(i), 1.0], "x", 7) for i in range(0, 900, 50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, rank int").withColumn("part", F.lit(1))
    found = ann.neighbours(frame.withColumn("dim", F.lit("a")).withColumn("cb", F.lit(2)), nearest=2).collect()
    assert {r.query_id for r in found} == set(range(0, 900, 100)) and len(found) == 18


# --- decontamination -------------------------------------------------------------------------


def test_leaks_are_found_and_others_left_alone(spark, documents, tables):
    benchmark = [tuple(r) for r in tables("benchmark")]
    clean = [(r[0], r[1]) for r in tables("documents")]
    plain = lambda text: " ".join(decontaminate.word_list(text))
    clean = [(i, t) for i, t in clean if not any(f" {plain(b)} " in f" {plain(t)} " for _, b in benchmark)]
    draw = random.Random(6)
    planted = {}
    for n, (item, text) in enumerate(benchmark):
        words = text.split()
        for kind in range(2):
            changed = [w for w in words if kind == 0 or draw.random() > 0.12]  # kind 1: words dropped
            host = clean[(2 * n + kind) % len(clean)][1].split()
            at = draw.randrange(len(host) + 1)
            planted[10_000 + 2 * n + kind] = (item, " ".join([*host[:at], *changed, *host[at:]]))
    rows = clean + [(i, t) for i, (_, t) in planted.items()] + [(70, None), (71, ""), (None, "x")]
    found = decontaminate.leaks(documents(rows).withColumn("item_id", F.lit(0)), spark.createDataFrame([*benchmark, (None, None), (77, "")], "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    exact = {(i, item) for i, (item, _) in planted.items() if i % 2 == 0}
    near = {(i, item) for i, (item, _) in planted.items() if i % 2}
    assert exact <= pairs
    assert len(near & pairs) >= 0.9 * len(near)
    assert not pairs - exact - near
    assert decontaminate.leaks(documents([]), spark.createDataFrame(benchmark, "item_id long, text string")).count() == 0
    assert decontaminate.leaks(documents(clean[:3]), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_no_verbatim_copy_is_lost(spark, documents, tables):
    """Short items among 2,000: a window of 32 words blurs them and the space has fewer dimensions than items."""
    draw = random.Random(12)
    pool = [decontaminate.word_list(r[1]) for r in tables("documents") if len(r[1].split()) > 80]
    items = []
    for i in range(2_000):
        words, n = draw.choice(pool), draw.choice([8, 9, 10, 12, 15, 25, 40])
        at = draw.randrange(len(words) - n)
        items.append((i, " ".join(words[at : at + n])))
    copies, changed = {}, {}
    for k, (item, text) in enumerate(draw.sample(items, 240)):
        words, host = text.split(), draw.choice(pool)
        if k % 2:  # reworded: about a fifth of the words replaced
            words = [draw.choice(host) if draw.random() < 0.2 else w for w in words]
        at = draw.randrange(len(host))
        (changed if k % 2 else copies)[50_000 + k] = (item, " ".join([*host[:at], *words, *host[at:]]))
    docs = [(i, t) for i, (_, t) in (copies | changed).items()]
    found = decontaminate.leaks(documents(docs * 2), spark.createDataFrame(items, "item_id long, text string"))
    rows = found.collect()
    pairs = {(r.doc_id, r.item_id) for r in rows}
    assert len(rows) == len(pairs)  # repeated rows give a leak once
    assert {(i, item) for i, (item, _) in copies.items()} <= pairs
    near = {(i, item) for i, (item, _) in changed.items()}
    kept = {
        (i, item)
        for i, (item, text) in changed.items()
        if plain_overlap(decontaminate.word_list(items[item][1]), decontaminate.word_list(text)) >= 0.6
    }
    assert len(near & pairs) >= 0.9 * len(near) and len(kept & pairs) >= 0.97 * len(kept)


def plain_overlap(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(row[-1], best[j + 1], best[j] + (x == y)))
        best = row
    return best[-1] / len(a)


def test_leaks_of_long_texts_and_blocks_of_items(spark, documents, tables, monkeypatch):
    words = [w for r in tables("documents") for w in decontaminate.word_list(r[1])]
    items = [(i, " ".join(words[97 * i : 97 * i + 20])) for i in range(30)]
    long = " ".join([*words[:40_000], *words[97 * 7 : 97 * 7 + 20], *words[5_000:30_000]])
    frame = spark.createDataFrame(items, "item_id long, text string")
    held = {i for i, t in items if f" {t} " in f" {long} "}
    whole = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents([(1, long)]), frame).collect()}
    assert {(1, i) for i in held} <= whole
    monkeypatch.setattr(decontaminate, "ITEMS", 8)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents([(1, long)]), frame).collect()} >= {(1, i) for i in held}


def test_leaks_without_the_last_sentence(spark, documents):
    """A plain passage has no answer to look for; a question's answer still decides."""
    draw = random.Random(9)
    words = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(3_000)]
    sentence = lambda n: " ".join(draw.choices(words, k=n)).capitalize() + "."
    plain = [(i, f"{sentence(14)} {sentence(12)} {sentence(8)}") for i in range(20)]
    asked = [(100 + i, f"{sentence(20)[:-1]}? {sentence(8)}") for i in range(20)]
    docs = [(i, f"{sentence(40)} {text.rpartition('. ')[0]}. {sentence(40)}") for i, text in plain]
    docs += [(100 + i, f"{sentence(40)} {text.partition('? ')[0]}? {sentence(40)}") for i, text in asked]
    docs += [(500 + i, sentence(90)) for i in range(40)]
    found = decontaminate.leaks(documents(docs), spark.createDataFrame([*plain, *asked], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i, _ in plain}
    assert all(r.answer_overlap is None and r.overlap >= 0.7 for r in found)


def test_common_subsequences():
    import numpy as np

    def plain(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y != 9 else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    draw = random.Random(1)
    pairs = [([draw.randrange(9) for _ in range(draw.randrange(1, 12))], [draw.randrange(10) for _ in range(draw.randrange(1, 20))]) for _ in range(200)]
    found = decontaminate.common_lengths([np.array(a) for a, _ in pairs], [np.array(b) for _, b in pairs], 9)
    assert found.tolist() == [plain(a, b) for a, b in pairs]


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark, tables):
    """Each stage against what brute force says about its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = tables("benchmark")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "tokens":
            assert out.columns == docs.columns
            out = corpus_pipeline.cut(out)
        after = {r.doc_id: r for r in out.collect()}
        if name == "known_language":
            assert len(after) >= 0.99 * len(rows)
        elif name == "near_duplicates":
            ids = sorted(rows)
            roots = plain_components([plain_fingerprint(rows[i].text) for i in ids], ids, 2)
            assert set(after) == {i for i, r in zip(ids, roots, strict=True) if i == r}
        elif name == "without_benchmark":
            plain = {i: f" {' '.join(decontaminate.word_list(r.text))} " for i, r in rows.items()}
            held = {i for i, t in plain.items() if any(f" {' '.join(decontaminate.word_list(b))} " in t for _, b in benchmark)}
            assert set(rows) - set(after) == held
        elif name == "without_personal_data":
            assert set(after) == set(rows)
            assert all(not registry.pii.find(r.text)[0] and r.n_chars == len(r.text) for r in after.values())
        else:
            assert set(after) == set(rows) and all(len(r.ids) == r.n_tokens for r in after.values())
        docs, rows = out, after


def test_pipeline_keeps_one_of_repeated_ids(documents):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "p q r s t u"), (None, "x y z"), (3, None)]
    found = corpus_pipeline.near_duplicates(None, documents(rows), SF_DIR).collect()
    assert sorted((r.doc_id for r in found), key=str) == [1, 2, 3, None]


def test_pipeline_judges_rows_by_themselves(spark, documents, tables):
    """Rows without an id are dropped like others; of rows that share an id only the one that is meant."""
    benchmark = tables("benchmark")
    texts = [r[1] for r in tables("documents")][:6]
    leak = f"{texts[3]} {benchmark[0][1]} {texts[3]}"
    rows = [(1, texts[0]), (None, texts[0]), (2, texts[1]), (2, texts[2]), (7, texts[2]), (None, texts[4]), (None, texts[4])]
    once = corpus_pipeline.near_duplicates(spark, documents(rows), SF_DIR).collect()
    assert sorted(((r.doc_id, r.text) for r in once), key=str) == sorted(
        [(1, texts[0]), (2, texts[1]), (2, texts[2]), (None, texts[4])], key=str
    )
    rows = [(None, leak), (None, "words of one's own"), (3, leak), (3, "other words of one's own"), (4, None)]
    clean = corpus_pipeline.without_benchmark(spark, documents(rows), SF_DIR).collect()
    assert sorted(r.text or "" for r in clean) == ["", "other words of one's own", "words of one's own"]
    rows = [(None, texts[0]), (5, ""), (5, texts[1]), (None, "123 456")]
    known = corpus_pipeline.known_language(spark, documents(rows), SF_DIR).collect()
    assert sorted(r.text for r in known) == sorted([texts[0], texts[1]])


def test_pipeline_stages_of_an_empty_table_and_of_clashing_columns(spark, documents):
    names = ["keep", "language", "component_id", "item_id", "host", "declared"]
    one = documents([(1, "the words of a text in a language that is known")])
    for n in names:
        one = one.withColumn(n, F.lit("own"))
    for docs, n in ((documents([]), 0), (one, 1)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.count() == n, name
            if name != "tokens":
                assert out.columns == docs.columns


def test_ids_order_as_numbers(spark, documents):
    ids = [None, -(1 << 63), -5, -1, 0, 3, 20, (1 << 63) - 1]
    rows = documents([(i, "x") for i in ids]).collect()
    frame = documents([(r.doc_id, r.text) for r in rows])
    keyed = frame.withColumn("k", corpus_pipeline.row_key(frame)).orderBy("k").collect()
    assert [r.doc_id for r in keyed] == [*ids[1:], None]


def test_queries_are_registered():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry_points.queries())
