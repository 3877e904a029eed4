"""Encoding, personal data, language and main text against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_fixtures import documents, tables  # noqa: F401
from salesmart.llm import bpe, language, main_text, pii, registry
from salesmart.llm.dom import parse

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", "aaaaaaa aaaa", "it's  we'll\n\n  x\t\t y\x1c\x1d z\x85  w", "½²③ ٣४ ⅷ 中文 日本",
    "x<|endoftext|>y <|endoftext|><|endoftext|>", "<|endoftext", "é" * 50, "\U0001f600 ok", "՘\U00018f9a a",
]


def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def random_texts(count, seed=1):
    draw = random.Random(seed)
    pick = lambda: draw.choice([draw.randrange(32, 127), draw.randrange(9, 14), draw.randrange(0x300), draw.randrange(0x300, 0xD7FF), 32, 97])
    return ["".join(chr(pick()) for _ in range(draw.randrange(1, 40))) for _ in range(count)]


def test_bpe_equals_the_library(spark, tables):
    texts = ODD + random_texts(300) + [r[1] for r in tables("documents")[:60]] + ["word " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "none")]
    frame = spark.createDataFrame([*rows, (900, None)], "doc_id long, text string").withColumn("n_tokens", F.lit("old"))
    t = library()
    expected = []
    for i, text in [*rows, (900, "")]:
        ids = t.encode(text, add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        back = t.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    found = bpe.digests(frame, PATH).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_bpe_knows_every_character_as_the_library_does():
    """Every code point beside a letter, a digit and an apostrophe gives the library's ids."""
    library, own = Tokenizer.from_file(PATH), bpe.encoder(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    blocks = [points[i : i + 64] for i in range(0, len(points), 64)]
    texts = [" ".join(f"{chr(c)}'s a{chr(c)}1{chr(c)}!" for c in block) for block in blocks]
    ids, sizes = own.encode(texts)
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert sizes.tolist() == [len(e.ids) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e.ids]


def test_bpe_round_trip_keeps_columns(spark):
    frame = spark.createDataFrame([(t, "x") for t in ODD], "text string, ids string")
    back = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert [r.decoded for r in back] == [r.text for r in back]
    assert bpe.encode(frame.limit(0), PATH).count() == 0


# --- personal data ---------------------------------------------------------------------------


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_plain_patterns(tables):
    draw = random.Random(2)
    texts = ["".join(draw.choice("aZ0123456789.@+-() \n_é%") for _ in range(draw.randrange(60))) for _ in range(4000)]
    for text in texts + [r[1] for r in tables("documents")]:
        assert [tuple(s) for s in pii.base_spans(text)] == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("write to john at example dot com please", "email", "john at example dot com"),
        ("jоhn@example.com", "email", "jоhn@example.com"),
        ("j​ohn@exa​mple.com", "email", "j​ohn@exa​mple.com"),
        ("call plus one four one five five five five zero one two three ok", "phone", "plus one four one five five five five zero one two three"),
        ("card four one one one 1111 1111 one one one one yes", "card", "four one one one 1111 1111 one one one one"),
        ("４１１１ １１１１ １１１１ １１１１", "card", None),
        ("ip one nine two dot one six eight dot one dot one end", "ip", "one nine two dot one six eight dot one dot one"),
    ],
)
def test_disguises_are_mapped_back_to_the_source(text, kind, part):
    base, added = pii.find(text)
    assert [(s.kind, text[s.start : s.end]) for s in added] == [(kind, part or text)]
    assert base == pii.base_spans(text)
    assert pii.masked(text, [*base, *added]).count(f"[{kind.upper()}]") == 1


@pytest.mark.parametrize("text", ["look at example.com", "meet at noon dot", "one two three", "a (at) b", "3 @ 4.50 each", "dot com at last"])
def test_clean_text_has_no_spans(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize("text", ["a" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "one two " * 20_000, "a@" * 100_000, "a dot " * 30_000, "(at " * 50_000])
def test_long_texts_take_linear_time(text):
    pii.find(text)


def test_report_and_redaction(documents):
    frame = documents([(1, "a@b.co and 1.2.3.4"), (2, None), (2, ""), (None, "x")]).withColumn("spans", F.lit(1))
    rows = {r.doc_id: r for r in pii.report(frame).collect()}
    assert rows[1].spans == "email:0:6,ip:11:18" and (rows[1].n_email, rows[1].n_ip, rows[1].n_added) == (1, 1, 0)
    assert rows[1].base_sha256 == hashlib.sha256(b"email:0:6,ip:11:18").hexdigest()
    assert rows[2].spans == "" and len(rows) == 3
    masked = pii.redact(frame)
    assert masked.columns == frame.columns
    assert sorted((r.text or "") for r in masked.collect()) == ["", "", "[EMAIL] and [IP]", "x"]
    assert pii.report(frame.limit(0)).count() == 0


# --- language --------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark, tables):
    """Half of the rows train; the others' declared language is hidden and found from the text."""
    rows = tables("documents")
    frame = spark.createDataFrame([(i, t, lang, s, n, i % 2) for i, t, lang, s, n in rows], "doc_id long, text string, lang string, source string, n_chars long, odd int")
    hidden = frame.withColumn("lang", F.when(F.col("odd") == 0, F.col("lang")))
    found = language.identify(hidden, declared=F.col("lang"), host=F.col("source")).collect()
    truth = {r[0]: r[2] for r in rows}
    odd = [r for r in found if r.odd]
    assert len(found) == len(rows)
    assert sum(truth[r.doc_id] == r.language for r in odd) >= 0.97 * len(odd)
    assert sum(r.keep for r in found) >= 0.99 * len(found)


def test_language_edge_cases(documents):
    good = [(i, "the cat and the dog are in the house of the king " * 3, "en", "h1", 1) for i in range(20)]
    good += [(100 + i, "der hund und die katze sind in dem haus der mutter " * 3, "de", "h2", 1) for i in range(20)]
    odd = [(200, None, "en", "h1", 0), (201, "", None, None, 0), (202, "1234 !! ..", "en", "h1", 1), (203, "the king", None, None, 1),
           (None, "der hund und die katze", "EN-us", "h3", 1), (203, "the king", None, None, 1), (204, "漢字仮名交じり文漢字", None, None, 1)]
    found = language.identify(documents([*good, *odd]).withColumn("keep", F.lit("x")), declared=F.col("lang"), host=F.col("source")).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert len(found) == len(good) + len(odd)
    for empty in (200, 201, 202):
        assert by[empty][0].language is None and by[empty][0].keep is False
    assert [r.language for r in by[203]] == ["en", "en"] and by[203][0].posterior == by[203][1].posterior
    assert by[204][0].keep is False
    assert by[None][0].language == "de"
    empty = language.identify(documents(good).limit(0), declared=F.col("lang"))
    assert empty.count() == 0


def test_declared_language_and_host_speak_where_the_text_does_not(documents):
    rows = [(i, "la casa del rey y la reina en la tierra " * 3, "es", "hs", 1) for i in range(30)]
    rows += [(50 + i, "la casa del re e la regina nella terra sua " * 3, "it", "hi", 1) for i in range(30)]
    rows += [(200, "la casa", "it", "hi", 1), (201, "la casa", "es", "hs", 1)]
    found = {r.doc_id: r.language for r in language.identify(documents(rows), declared=F.col("lang"), host=F.col("source")).collect()}
    assert found[200] == "it" and found[201] == "es"


def test_seventy_languages(documents):
    """Each declared language is told apart, and a text without a declared one is known by its trigrams."""
    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a + b for a in "klmnopq" for b in "abcdefghij"]
    words = {n: ["".join(draw.choices(letters, k=5)) for _ in range(40)] for n in names}
    text = lambda n: " ".join(draw.choices(words[n], k=60))
    rows = [(100 * i + k, text(n), n, None, 1) for i, n in enumerate(names) for k in range(6)]
    rows += [(100_000 + i, text(n), None, None, 1) for i, n in enumerate(names)]
    rows += [(200_000, text("ka") + " " + "lang " * 300_000 + text("ka") * 3_000, "ka", None, 1)]  # very long
    found = {r.doc_id: r for r in language.identify(documents(rows), declared=F.col("lang"), keep_text=False).collect()}
    assert len(found) == len(rows)
    for i, n in enumerate(names):
        assert found[100_000 + i].language == n and found[100_000 + i].keep
        assert found[100 * i].language == n


def test_page_evidence(spark):
    frame = spark.createDataFrame([("https://www.Example.de:80/a?b", '<html lang="DE-at"><p>'), ("mailto:x", "<p>")], "url string, html string")
    rows = frame.select(*[c.alias(k) for k, c in language.page_evidence().items()]).collect()
    assert rows[0].declared == "DE-at" and rows[0].host == "www.example.de" and rows[0].suffix == "de"
    assert rows[1].declared is None and rows[1].host is None


# --- main text -------------------------------------------------------------------------------


def article_of(page):
    import html

    inner = page.split("<article>", 1)[1].split("</article>")[0]
    blocks = [re.sub(r"</?b>", "", b).replace("<br>", " ") for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_main_text_of_all_pages(spark, tables):
    pages = tables("pages")
    found = {r.page_id: r for r in registry.op1_main_text(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(pages)
    for page_id, url, page in pages:
        row = found[page_id]
        assert row.text == article_of(page) and row.url == url and row.n_chars == len(row.text)


def test_main_text_of_held_out_layouts():
    weights = main_text.default_weights()
    right = total = 0
    for page in main_text.labelled_pages(80, seed=99):
        tree = parse(page)
        labels = main_text._labels(tree)
        kept = main_text.content(tree, weights)
        for i, text in enumerate(tree.text):
            if text is not None:
                total += 1
                right += labels[i] == kept[i]
    assert right >= 0.95 * total


@pytest.mark.parametrize("tag", ["svg", "math", "object", "select", "video", "canvas", "template"])
def test_unclosed_skipped_elements_end_with_the_element_around_them(tag):
    page = f"<article><p>First one is here.</p><p>Second one <{tag}><path>lost</p><p>Third is here too.</p></article>"
    assert main_text.extract(page, main_text.default_weights()) == "First one is here.\n\nSecond one\n\nThird is here too."
    closed = page.replace("<path>lost", f"<b>lost</b></{tag}> goes on")
    assert main_text.extract(closed, main_text.default_weights()).split("\n\n")[1:-1] == ["Second one", "goes on"]


def test_pages_of_very_many_tags_take_time_in_proportion():
    import time

    main_text.default_weights()
    for page in ("<div>", "<div></span2>", "<p><div>", "<li>", "<table><tr><td>", "<svg>", "<head>", "</p>"):
        started = time.time()
        main_text.extract(page * 100_000 + "<p>The end of it.", main_text.default_weights())
        assert time.time() - started < 60


def test_messages_give_exact_marginals():
    import itertools
    import math

    draw = random.Random(4)
    parent, leaf = [-1, 0, 0, 1, 1, 2], [False, False, False, True, True, True]
    score = [draw.uniform(-2, 2) for _ in parent]
    edge = [[draw.uniform(-2, 2) for _ in range(4)] for _ in range(2)]
    weight = [[0.0, 0.0] for _ in parent]
    for y in itertools.product((0, 1), repeat=len(parent)):
        log = sum(s for s, v in zip(score, y, strict=True) if v)
        log += sum(edge[leaf[i]][2 * y[parent[i]] + y[i]] for i in range(1, len(y)))
        for i, v in enumerate(y):
            weight[i][v] += math.exp(log)
    full, _ = main_text.marginals(parent, leaf, score, edge)
    assert full == pytest.approx([math.log(b / a) for a, b in weight])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("only words", "only words"),
        ("<p>a<p>b &amp;&lt; c&nbsp;d", "a\n\nb &< c d"),
        ("<article><p>one</p><script>var a='<p>no</p>'</script><!-- <p>no --><p>two", "one\n\ntwo"),
        ("<nav><a href=x>menu</a></nav><article><p>One here.</p><section class='comments'><p>I liked it.</p></section></article>", "One here."),
        ("<article><p>first <b>bold</b><br>line</p></article><footer><p>&copy; me</p></footer>", "first bold line"),
    ],
)
def test_main_text_edge_cases(page, text):
    assert main_text.extract(page, main_text.default_weights()) == text


def test_main_text_keeps_extra_columns(spark):
    frame = spark.createDataFrame([(1, None, "a"), (1, "<p>Hi there.</p>", "b")], "page_id long, html string, text string")
    assert main_text.main_text(frame).columns == ["page_id", "text", "n_chars"]
    assert sorted(r.text for r in main_text.main_text(frame).collect()) == ["", "Hi there."]
    assert main_text.main_text(frame.limit(0)).count() == 0
