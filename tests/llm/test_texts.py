"""Pieces, page texts, token counts and personal data against brute force."""

import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
import sentencepiece
from helpers import HARD, documents, prose
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from twinloom.llm import html_text, pieces, pii, queries, token_counts

needs_files = pytest.mark.skipif(not os.path.exists(queries.PIECE_MODEL), reason="no vocabulary files")
TEXTS = st.text(alphabet="ab eé \n▁.,1中<>\U0001d4b3\t", max_size=40)


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.read_model(queries.PIECE_MODEL), most_words=500)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


@needs_files
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, max_size=5))
def test_pieces_are_those_of_the_library(coder, library, texts):
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == library.encode(text)
        assert coder.decode(ids) == text.replace("▁", " ")


@needs_files
def test_pieces_of_all_documents(spark, library):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    for row in queries.op7_pieces(spark, "/root/testdata/sf0.001").join(docs, "doc_id").collect():
        assert row.ids == library.encode(row.text) and row.round_trip and row.n_ids == len(row.ids)


@needs_files
def test_pieces_of_hard_rows(spark, library):
    docs = documents(spark, HARD)
    model = pieces.read_model(queries.PIECE_MODEL)
    rows = pieces.encode_documents(docs.drop("ids"), model, ["doc_id", "text"], check=True).collect()
    assert len(rows) == len(HARD)
    for row in rows:
        ids = None if row.text is None else library.encode(row.text)
        assert row.ids == ids and row.n_ids == (None if ids is None else len(ids)) and row.round_trip in (None, True)
    again = pieces.encode_documents(docs.drop("ids"), model, ["text"])
    assert all(r.text == r.back for r in again.select("text", pieces.decoded(F.col("ids"), model).alias("back")).collect())
    assert pieces.encode_documents(docs.limit(0), model, ["doc_id"]).collect() == []


def test_unigram_scores_are_summed():
    names = ["<unk>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "a", "b", "ab", "▁a", "ba"]
    scores = [0.0] * 257 + [-2.0, -3.0, -3.0, -4.0, -4.5, -1.0]
    model = pieces.PieceModel(names, scores, frozenset(range(257)), {b: 1 + b for b in range(256)}, 0, merges=False)
    coder = pieces.PieceCoder(model)
    assert [names[i] for i in coder.encode(["aba"])[0]] == ["▁a", "ba"]
    assert [names[i] for i in coder.encode(["abé"])[0]] == ["▁", "ab", "<0xC3>", "<0xA9>"]


PAGES = [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<b>b</b> c<p>d", "ab c d"), ("&lt;b&gt;&nbsp;x &am", "<b> x &am"),
    ("<nav>m</nav><article><h1>T</h1><p>x</p><div class='ad'>no</div><p>y</p></article><footer>f</footer>", "T x y"),
    ("<main><p>x</p><aside>no</aside><form>no</form></main>", "x"), ("<script>var t='</p>';</script>a", "a"),
    ("<article><p>a</p><section id=comments><article>no</article></section></article>", "a"),
    ("<div>" * 3000 + "deep", "deep"), ("<style>p{}</style><ul><li>a<li>b</ul>", "a b"),
]


def test_text_of_pages():
    for html, text in PAGES:
        assert html_text.main_text(html_text.parse(html), set()) == text


def test_no_name_loses_a_page():
    story = "<article><h1>T</h1><p>a b c</p></article>"
    for name in ("class='page has-sidebar'", "id=search-page", "class=no-comments", "class='page search'", "id=comments", "hidden"):
        for html in (f"<div {name}>{story}</div><p>end</p>", f"<div {name}><main>{story}</main></div>", f"<main><div {name}>{story}</div></main>",
                     f"<body {name}>{story}", f"<form><div {name}>{story}</div></form>"):
            assert html_text.main_text(html_text.parse(html), set()) == "T a b c", html
    for html, text in [
        ("<html><head><title>t</title><body><article>x</article>", "x"), ("<head><title>t</title><p>x</p>", "x"), ("<head><meta charset=a>x", "x"),
        ("<div class='page search'><nav>n</nav><p>a b c</p></div><p>end</p>", "a b c end"), ("<div class=search><p>a</p></div>", "a"),
        ("<form><p>a</p></form>", "a"), ("<p>a b</p><div class=cookie-banner>we use cookies here</div>", "a b"),
        ("<p>a b c</p><div class=related><article>no</article></div>", "a b c"), ("<article>x</article><section id=comments><article>no no</article></section>", "x"),
    ]:
        assert html_text.main_text(html_text.parse(html), set()) == text, html


def test_templates_of_a_host_go(spark):
    def page(k):
        return (f"<body><div><a href=/>Home</a> menu</div><div><p>story {k}</p><span>same words {k}</span></div>"
                "<div>all rights</div></body>")

    rows = [(k, "http://a.org/%d" % k, page(k)) for k in range(20)] + [(90, "http://b.org/", page(90)), (91, None, page(91)), (92, "http://a.org/x", None)]
    rows += [(100 + k, "http://c.org/", "<p>copied whole</p>") for k in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x"))
    found = {r.page_id: r.text for r in html_text.with_main_text(pages).collect()}
    assert len(found) == len(rows)
    for k in range(20):
        assert found[k] == f"story {k} same words {k}"
    assert found[90] == "Home menu story 90 same words 90 all rights" and found[92] == ""
    assert found[100] == "copied whole"
    assert html_text.with_main_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_templates_do_not_depend_on_the_size_of_a_host(spark, small):
    """A menu of one section in ten and a notice in articles go from a host of 300 pages as from one of 30; copies stay."""
    def page(k, of):
        menu = "<div><p>menu of one section</p></div>" if k % of == 0 else ""
        return f"<article><h1>T {k}</h1><section>{menu}</section><p>story <em>not</em> {k}</p><p>Yes.</p><ul><li>please read our terms</li></ul></article>"

    rows = [(k, "http://big.org/", page(k, 20)) for k in range(300)] + [(1000 + k, "http://small.org/", page(k, 8)) for k in range(30)]
    rows = [(k, u, h if k % 3 == 0 else h.replace("<p>Yes.</p>", "")) for k, u, h in rows]
    rows += [(2000 + k, "http://big.org/", "<article><p>one article copied as a whole</p><p>with its second paragraph</p></article>") for k in range(40)]
    rows += [(3000 + k, "http://big.org/", "<article>" + "".join(f"<p>paragraph {j} of a changed copy</p>" for j in range(6)) + f"<p>version {k}</p></article>") for k in range(12)]
    rows += [(4000 + k, "http://big.org/", f"<article><h1>changed</h1><p>first {k}</p><p>{'word ' * 40}</p></article>") for k in range(40)]
    rows += [(None, None, page(7, 8)), (None, "http://big.org/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_text.with_main_text(pages, small=small).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id is None:
            assert r.text == ("" if r.url else "T 7 story not 7 Yes. please read our terms")
        elif r.page_id < 2000:
            k = r.page_id % 1000
            yes = "" if r.page_id % 3 else " Yes."
            assert r.text == f"T {k} story not {k}{yes}"
        elif r.page_id < 3000:
            assert r.text == "one article copied as a whole with its second paragraph"
        elif r.page_id >= 4000:
            assert r.text == f"changed first {r.page_id - 4000}" + " word" * 40
        else:
            assert r.text.startswith("paragraph 0 of a changed copy") and r.text.endswith(f"version {r.page_id - 3000}")


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_text_of_the_given_pages(spark, scale):
    import html as entities

    pages = queries.table(spark, f"/root/testdata/sf{scale}", "pages").select("page_id", "html")
    for row in queries.op8_html_text(spark, f"/root/testdata/sf{scale}").join(pages, "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", row.html, re.S).group(1)
        text = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
        assert row.text == " ".join(entities.unescape(text).split()) and row.n_chars == len(row.text)


@pytest.fixture(scope="module")
def ranks():
    return token_counts.read_ranks(queries.RANKS, queries.RANKS_PATTERN)


@needs_files
@settings(max_examples=300, deadline=None)
@given(text=st.text("ab 's\n .1'rel  é中", max_size=40), edits=st.lists(
    st.tuples(st.integers(-2, 45), st.integers(-2, 45), st.text("a '\n 1.l", max_size=6)), max_size=4
))
def test_edited_trees_equal_new_ones(ranks, text, edits):
    counter = token_counts.Counter(ranks)
    tree = token_counts.CountTree.of(text, counter)
    for start, end, new in edits:
        text, _ = tree.edit(text, start, end, new, counter)
        again = token_counts.CountTree.of(text, counter)
        assert tree.tokens == again.tokens == len(counter.encode(text))
        assert tree.size == again.size and all((a == b).all() for a, b in zip(tree.levels, again.levels))


@needs_files
def test_kept_trees_of_hard_rows(spark, ranks):
    docs = documents(spark, HARD)
    edits = F.array(
        F.struct(F.lit(1).alias("start"), F.lit(2).alias("end"), F.lit(" new").alias("text")),
        F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("string").alias("text")),
    )
    kept = docs.withColumn("tree", token_counts.count_trees(docs["text"], ranks))
    rows = kept.select("text", token_counts.edited_trees(F.col("text"), F.col("tree"), edits, ranks).alias("e"),
                       token_counts.counts_with_edits(F.col("text"), edits, ranks).alias("c")).collect()
    encode = token_counts.Counter(ranks).encode
    for row in rows:
        text = row.text or ""
        after = text[:1] + " new" + text[2:]
        assert row.e.text == after and row.e.tokens == row.c.n_after == len(encode(after))
        assert row.c.n_before == len(encode(text))


@needs_files
def test_counts_touch_only_what_edits_touch(spark, ranks):
    rows = queries.op9_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert max(r.n_counted for r in rows) < 120 and max(r.n_pieces for r in rows) > 1000


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "phone" and 9 <= len(digits) <= 15 or kind == "ip" and all(
                int(p) <= 255 for p in m.group().split(".")
            ) or kind == "card" and 12 <= len(digits) <= 19 and pii.luhn(digits):
                found.append((*m.span(), kind))
    return sorted(found, key=lambda s: (s[0], list(BASE).index(s[2])))


@settings(max_examples=800, deadline=None)
@given(text=st.text("a.b@-_ 0123456789+()%é", max_size=50))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_and_failed(text)[0] == base_by_hand(text)


def test_base_spans_of_documents(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    for row in queries.op10_pii(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect():
        base = base_by_hand(row.text)
        spelled = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert row.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert {*spelled.split(","), ""} <= {*row.spans.split(","), ""} and row.n_email == sum(k == "email" for *_, k in base)


def test_added_spans_by_learned_votes(spark):
    yes = [(k, f"call tel. 0{k % 9}1 55{k % 10}-12{k % 7}{k % 3} or mail x{k}@a.org, +1 (555) 555-01{k % 10}{k % 9}") for k in range(60)]
    odd = [(100 + k, f"order id=4111-1111-1111-{1000 + k}x and version 1.2.3.{300 + k}") for k in range(60)]
    docs = documents(spark, [*yes, *odd, *HARD])
    found = docs.select("doc_id", pii.spans_of(docs["text"], pii.learn_pii(docs)).alias("p")).collect()
    assert len(found) == 120 + len(HARD)
    for row in found:
        kept = {(s.start, s.end, s.kind) for s in row.p.spans}
        assert {(s.start, s.end, s.kind) for s in row.p.base} <= kept
        if row.doc_id is not None and 100 <= row.doc_id < 160:
            assert len(kept) == len(row.p.base)
    nothing = pii.learn_pii(docs.limit(0))
    assert nothing.weights == {} and nothing.chance("email", [1] * 8) == 0


def test_reliabilities_are_estimated():
    import numpy as np

    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth).astype(int) for p in (0.95, 0.8, 0.6)], axis=1)
    likely, right = pii.estimate(votes, np.ones(4000), pii.PiiConfig())
    assert ((likely > 0.5) == truth).mean() > 0.93
    assert np.abs(right.mean(1) - [0.95, 0.8, 0.6]).max() < 0.06


@needs_files
def test_the_token_query_edits_kept_trees(spark, ranks, tmp_path):
    from twinloom import session

    documents(spark, HARD).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    with session.scratch_scope(spark):
        found = queries.op9_token_counts(spark, str(tmp_path))
        assert [p for p in session._open_scopes[-1] if "token-trees" in p]
        rows = sorted(found.collect(), key=repr)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    edits = queries.edits_of(F.col("doc_id"), F.col("text"))
    again = docs.select("doc_id", token_counts.counts_with_edits(F.col("text"), edits, ranks).alias("c")).select("doc_id", "c.*")
    assert [tuple(r) for r in rows] == [tuple(r) for r in sorted(again.collect(), key=repr)] and len(rows) == len(HARD)


def test_numbers_with_thousands_of_zeros():
    zeros = "0" * 5000
    text = f"{zeros}1.2.3.4 and {zeros}256.2.3.4 and {zeros}.0.0.{zeros}"
    base, failed = pii.base_and_failed(text)
    assert [k for *_, k in base] == ["ip", "ip"] and [k for *_, k in failed if k == "ip"] == ["ip"]


def test_personal_data_in_very_long_texts():
    words = [f"0{k % 900 + 100} {k % 9000 + 1000} {k % 700 + 200}" for k in range(100_000)]
    texts = ["; ".join(words), "x" * 200_000 + "(at", "x" * 100_000 + " (at) y.de", "(at" * 60_000, "a@" * 60_000, "1." * 100_000]
    start = time.perf_counter()
    found = [pii.candidates(t)[1] for t in texts]
    assert time.perf_counter() - start < 15
    assert len(found[0]) == 100_000 and found[2] == [(0, 100_010, "email")]


def test_masked_addresses_are_those_of_one_pattern():
    whole = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[]at[)\]] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+")
    rng = random.Random(5)
    parts = ["joe", ".", " ", "(at)", "[at]", "x-y", "(dot)", "[dot] ", "de", "@", ")", "(at"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert list(pii._masked_emails(text)) == [m.span() for m in whole.finditer(text)], text


def test_free_candidates_are_apart_from_all_others():
    rng = random.Random(6)
    parts = ["+49 30 1234567", "030 1234 567", "4111 1111 1111 1111", "1234 5678 9012 3456", "10.1.2.3", "300.1.2.3", " ", "a(at)b.de", "a@b.de", "5"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(12)))
        base, free = pii.candidates(text)
        more = pii.base_and_failed(text)[1] + [(*s, "email") for s in pii._masked_emails(text)] + [
            (*m.span(), "phone") for m in pii.GROUPED.finditer(text) if 9 <= len(pii.digits_of(m.group())) <= 15
        ]
        taken, want = [(s, e) for s, e, _ in base], []
        for s, e, kind in sorted(more, key=lambda x: (x[0], pii.KINDS.index(x[2]))):
            if all(e <= a or b <= s for a, b in taken):
                want.append((s, e, kind))
                taken.append((s, e))
        assert free == want


@needs_files
def test_large_trees_split_and_join_their_chunks(ranks):
    counter = token_counts.Counter(ranks)
    rng = random.Random(12)
    text = " ".join(rng.choice(["word", "x" * 300, "it's", "12", "\n\n", "é中", "a b c"]) for _ in range(3000))
    tree = token_counts.CountTree.of(text, counter)
    seen = set()
    for k in range(120):
        start = rng.randrange(len(text) + 1)
        end = min(len(text), start + rng.choice([0, 1, 5, 400, 5000]))
        new = " ".join(["new", "y" * 700, "it's"][k % 3] for _ in range(rng.choice([0, 1, 3, 300])))
        text, counted = tree.edit(text, start, end, new, counter)
        again = token_counts.CountTree.of(text, counter)
        assert (np.concatenate(tree.chunks, axis=1) == np.concatenate(again.chunks, axis=1)).all() and tree.tokens == again.tokens
        assert counted < 2 * len(new.split()) + 20 and max(c.shape[1] for c in tree.chunks) <= token_counts.MOST
        seen.add(len(tree.chunks))
        size, tokens, chunks, leaves = tree.packed()
        tree = token_counts.CountTree.unpacked(size, chunks, leaves)
        assert tree.size == size and tree.tokens == tokens and 2 * size <= len(leaves) < 4 * size
    assert len(seen) > 20
    text, _ = tree.edit(text, 0, len(text), "", counter)
    assert tree.size == tree.tokens == 0 and token_counts.CountTree.unpacked(*[tree.packed()[k] for k in (0, 2, 3)]).size == 0
    assert tree.edit("", 0, 0, "once more", counter)[0] == "once more" and tree.size == 2


def site_page(k, body, notice="", head="h1"):
    return (k, f"http://host.example/{k}", f"<html><body><nav>menu {k}</nav><article><{head}>Title {k}</{head}>{body}{notice}</article></body></html>")


@pytest.mark.parametrize("small", [True, False])
def test_templates_in_named_asides_do_not_hang_on_the_way(spark, small):
    banner = "<div class='strip'><p>x same banner text of the site here</p></div>"
    rows = [(k, f"http://host.example/{k}", f"<div class='ad'>{banner}<p>own words {k} of this page</p></div>") for k in range(30)]
    rows += [(100 + k, f"http://host.example/{100 + k}", f"<div>{banner}<p>page number {k} says this</p></div>") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.with_main_text(pages, small=small).collect()}
    assert found == {k: f"own words {k} of this page" for k in range(30)} | {100 + k: f"page number {k} says this" for k in range(30)}


@pytest.mark.parametrize("small", [True, False])
def test_recurring_prose_goes_only_from_a_place_of_its_own(spark, small):
    rng = random.Random(4)
    notice = "<p>This notice stands below every article of the site and says the same each time.</p>"
    quote = "<p>A sentence that many articles of this site quote somewhere within their own text.</p>"
    said = lambda html: " ".join(re.sub("<[^>]*>", " ", html).split())
    rows, want = [], {}
    for k in range(60):
        blocks = [f"<p>{prose(1000 * k + j, 8)}</p>" for j in range(9)]
        if k % 2:
            blocks.insert(rng.randrange(10), quote)
        rows.append(site_page(k, "".join(blocks), notice))
        want[k] = f"Title {k} " + said(" ".join(blocks))
    for k in range(60, 75):  # pages about the quoted sentence
        rows.append((k, f"http://host.example/{k}", f"<article><h1>{said(quote)}</h1>{quote}<p>{prose(k, 9)}</p></article>"))
        want[k] = f"{said(quote)} {said(quote)} {prose(k, 9)}"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.with_main_text(pages, small=small).collect()}
    assert found == want


def test_odd_pages_are_read_in_linear_time():
    n = 50_000
    pages = {
        "nested": "<div class=ad>" * n + "x", "stray": "</h1>" * n + "x", "unclosed": "<h1>a" * n, "held": "<p><li>" + "<h1>a" * n,
        "cells": "<td>a" * n, "lists": "<ul><li>a" * (n // 2), "bold": "<li><ul>" + "<b>" * n + "<li>a" * 10,
    }
    for name, page in pages.items():
        start = time.perf_counter()
        root = html_text.parse(page)
        html_text.candidates(root)
        html_text.main_text(root, frozenset())
        assert time.perf_counter() - start < 6, name
