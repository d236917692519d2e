"""Language identification, quality scores, page extraction and license scans."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collatio.llm import html_extract, langid, license_scan, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out(spark, docs):
    model = langid.train(docs, training_texts=400)
    found = langid.identify(docs.select("doc_id", "text", "lang"), model)
    right = found.where(langid.held_out(F.col("doc_id"))).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.avg("score")).first()
    assert right[0] > 0.98 and 0 <= right[1] <= 1


def test_language_odd_rows(spark, docs):
    model = langid.train(docs, training_texts=300)
    rows = [(1, None), (2, ""), (3, "12 ... ²"), (4, "the and of the"), (4, "the and of the"), (None, "der die und " * 20_000)]
    got = langid.identify(spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string"), model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and all(r.score == 0 for r in got[:3])
    assert got[3].lang_pred == got[4].lang_pred == "en" and got[5].lang_pred == "de"
    nothing = langid.train(docs.limit(0))
    assert nothing is None and langid.identify(docs.limit(1), nothing).first().lang_pred == "und"


def test_rare_languages_are_learned(spark):
    rare = ["ovo je rijetko", "ovo je vrlo rijetko", "nije to ovo"]
    rows = [(i, f"the word {i} of many", "en") for i in range(6000)] + [(10_000 + i, f"das wort {i} von vielen", "de") for i in range(3000)]
    rows += [(i, text, "xx") for i, text in zip([3, 5, 7], rare, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = docs.where(~langid.held_out(F.col("doc_id")))
    n_rare = learnt.where("lang = 'xx'").count()
    sample = langid.language_sample(learnt.select(F.col("doc_id").alias("id"), "text", "lang"), 100)
    counts = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert counts["xx"] == n_rare > 0 and min(counts["en"], counts["de"]) >= 45 and sum(counts.values()) <= 100
    model = langid.train(docs, training_texts=100)
    assert model.languages == ["de", "en", "xx"]
    assert langid.identify(docs.where("lang = 'xx'"), model).where("lang_pred = 'xx'").count() == len(rare)


def test_language_sample_of_repeated_ids(spark):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("id"), F.concat(F.lit("text "), F.least("id", F.lit(3000))).alias("text"), F.lit("en").alias("lang"))
    first, again = ({r.text for r in langid.language_sample(rows.repartition(n), 50).collect()} for n in (2, 7))
    assert first == again and len(first) == 50
    assert langid.language_sample(rows, 5000).count() == 3001
    assert langid.language_sample(rows.limit(0), 50).count() == 0


def test_codebooks_tell_languages_apart():
    for n in (2, 3, 4, 7, 8, 20):
        code = langid.codebook(n)
        apart = (code.shape[1] - code @ code.T)[~np.eye(n, dtype=bool)] / 2
        assert apart.min() >= 1 and len({tuple(r) for r in code}) == n


def test_one_wrong_bit_is_corrected():
    code = langid.codebook(4)
    model = langid.Model(list("abcd"), code, np.zeros((1, 7)), np.zeros(7), np.full(7, 1 / 7))
    for i in range(4):
        for bit in range(7):
            margins = 2 * code[i]
            margins[bit] *= -1
            assert model.decode(margins[None])[0][0] == i


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out")
    right, low, high = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.min("score"), F.max("score")).first()
    assert right > 0.95 and 0 <= low and high <= 1


def test_quality_odd_rows(spark, docs):
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(1, None), (2, ""), (3, " \n"), (None, "x" * 100_000), (4, "a"), (4, "a")]
    got = quality.score(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int"), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    nothing = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(docs.limit(3), nothing).first().score == pytest.approx(0.5)


def test_one_text_a_label(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda names, x, y: seen.append((x.tolist(), y.tolist())))
    rows = [(1, f"text number {i} " * (i % 7 + 1)) for i in range(3000)] + [(3, None), (4, "One text."), (5, "Two texts.")]
    ids = [i for i in (1, 3, 4, 5) if spark.range(i, i + 1).where(~quality.held_out(F.col("id"))).count()]
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1), (99, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (2, 5):
        quality.train(docs.repartition(n), labels)
    assert 1 in ids and len(seen[0][1]) == len(ids) + 1 and seen[0] == seen[1]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="sidebar-right">
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies to make this site work as well as it can for you and others.</div>
<article><header><h1>Title &amp; more</h1></header><p>First&nbsp;<b>bold</b>
 text<br>goes on.<script>var t="</p>";</script><p>One.<div class="ad"><p>Buy this now, it is very good and cheap today.</p></div>
<form><input><p>Your mail</p></form><p hidden>secret</p><p style="display: none">gone</p><ul><li>item</li></ul>
<section id="comments"><article class="comment"><p>I think that this is a very long comment about the article above.</p></article></section></article>
<aside>Related things</aside><footer>&copy; all</footer>"""


def test_page_with_furniture():
    text, found, kept = html_extract.main_text(PAGE, html_extract.trained_tree())
    assert text == "Title & more\n\nFirst bold text goes on.\n\nOne.\n\nitem" and kept == 4 < found


def test_page_that_names_no_article():
    body = " ".join(f"word{i}" for i in range(60))
    page = f"<div><a href=1>one</a></div><div><a href=2>two</a> <a href=3>three</a></div><p>{body}</p><p>{body}</p><div><a href=4>four</a></div>"
    assert html_extract.main_text(page, html_extract.trained_tree())[0] == f"{body}\n\n{body}"


@pytest.mark.parametrize("region", ["div class='story'", "article", "div role='main'"])
def test_small_regions_take_no_text(region):
    tree, body, menu = html_extract.trained_tree(), " ".join(f"word{i}" for i in range(80)), "<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul>"
    name = region.split()[0]
    teaser = f"{menu}<{region}>Read this other one as well.</{name}>{menu}"
    assert html_extract.main_text(f"{menu}<div class='content'><p>{body}</p><p>{body}</p></div>{teaser}", tree)[0] == f"{body}\n\n{body}"
    # A region of most words doesn't take long paragraphs with it that stand after it, but what is short.
    page = f"<{region}><h1>Title</h1><p>{body}</p><p>{body}</p><p>Bye.</p></{name}><div><p>{body} {body}</p></div>{menu}<p>Write to us today.</p>"
    assert html_extract.main_text(page, tree)[0] == f"Title\n\n{body}\n\n{body}\n\nBye.\n\n{body} {body}"


def test_a_marked_title_is_not_the_article():
    body = " ".join(f"word{i}" for i in range(80))
    page = f"<h1 class='entry-title'>T</h1><div class='content'><p>{body}</p><p>{body}</p></div>"
    assert html_extract.main_text(page, html_extract.trained_tree())[0] == f"T\n\n{body}\n\n{body}"


BODY = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<article><p>un<b class="k">bel</b>ievable {BODY}</p></article>', f"unbelievable {BODY}"),
        ('<article><p>See <code class="x">f()</code> and <time datetime="2">now</time>, ok</p></article>', "See f() and now, ok"),
        (f'<p>{BODY} <span class="x">word</span> goes on</p><p>{BODY}</p>', f"{BODY} word goes on\n\n{BODY}"),
        (f'<article><p>a <span class="ad">BUY</span> b <span hidden>c</span>{BODY}</p></article>', f"a b {BODY}"),
        (f"<article><p>{BODY} <math><mi>x</mi></math></p></article>", f"{BODY} x"),
        (f'<div class="no-sidebar"><article><p>{BODY}</p></article></div>', BODY),
        (f'<article><p>{BODY}</p><div id="search-history"><p>one</p></div><div class="share-price">12</div><div class="notice-board">three</div></article>', f"{BODY}\n\none\n\n12\n\nthree"),
        (f'<form id="aspnetForm"><div class="nav-left"><a href=1>x</a></div><div><p>{BODY}</p><p>{BODY}</p></div></form>', f"{BODY}\n\n{BODY}"),
        (f"<div><p>{BODY}</p><p>{BODY}</p></div><form>Write {BODY}</form>", f"{BODY}\n\n{BODY}"),
        (f'<div class="post-with-comments"><p>{BODY}</p><p>{BODY}</p></div>', f"{BODY}\n\n{BODY}"),
        ("<p>Two short ones.</p><p>Here they are.</p>", "Two short ones.\n\nHere they are."),
        (f'<article><p>{BODY}</p><section class="comments-area"><article class="comment"><p>I say {BODY} {BODY} {BODY}</p></article></section></article>', BODY),
        (f'<div class="cookie-banner"><p>{BODY} {BODY} {BODY}</p></div><main><p>{BODY}</p></main>', BODY),
        (f"<aside><article><p>{BODY}</p></article></aside><article><p>{BODY} x</p></article>", f"{BODY} x"),
        (f'<div id=page><div id=menu><a href=1>a</a></div><div class=c><h2>Head</h2><p>{BODY}</p><p>Tiny.</p><ul><li>one<li>two</ul></div><div class=bottom><p>Contact us.</p></div></div>', f"Head\n\n{BODY}\n\nTiny.\n\none\n\ntwo"),
        (f"<div><p>{BODY}</p><ul><li><a>a b</a><li><a>c</a><li><a>d e f</a><li><a>g</a></ul><p>{BODY}</p></div>", f"{BODY}\n\na b\n\ng\n\n{BODY}"),
    ],
)
def test_what_names_and_inline_elements_do(page, text):
    assert html_extract.main_text(page, html_extract.trained_tree())[0] == text


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 60), st.integers(0, 60), st.sampled_from(["span class=x", "b", "em id=nav-side data-x='>'", "code class='share-price y'", "time datetime=2", "my-part x=1"]))
def test_inline_elements_change_no_text(a, b, tag):
    text = f"An unbelievable story of {BODY}"[:80]
    a, b = sorted((a, b))
    marked = f"{text[:a]}<{tag}>{text[a:b]}</{tag.split()[0]}>{text[b:]}"
    tree = html_extract.trained_tree()
    assert html_extract.main_text(f"<article><p>{marked}</p></article>", tree)[0] == html_extract.main_text(f"<article><p>{text}</p></article>", tree)[0] == " ".join(text.split())


def test_articles_are_found_by_their_words(spark):
    """With article tags taken away, region, words and links of neighbours keep what the tags kept; no tag decides there."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    tree = html_extract.trained_tree()
    for html in pages:
        assert "<article>" in html
        bare = html.replace("<article>", "<div>").replace("</article>", "</div>")
        assert html_extract.main_text(bare, tree)[0] == html_extract.main_text(html, tree)[0]
        assert not any(b.article for b in html_extract.features(bare)[0])


@pytest.mark.parametrize("size", [10, 5_000, 2_000_000])
@pytest.mark.parametrize("quote", ['"', "'"])
def test_attribute_values_of_any_length(size, quote):
    body = " ".join(f"word{i}" for i in range(60))
    value = ("a > b, " * size)[:size]
    for name in ("src", "data-2"):
        page = f"<article><p>First.</p><img {name}={quote}{value}{quote} alt={quote}x{quote}><p>{body}</p><a href={quote}u{quote}>link</a><p>{body}</p></article>"
        assert html_extract.main_text(page, html_extract.trained_tree())[0] == f"First.\n\n{body}\n\nlink\n\n{body}"


def test_tags_with_many_attributes_and_stray_quotes():
    many = " ".join(f'a{i}="<p>{i}>"' for i in range(5000))
    tree = html_extract.trained_tree()
    assert html_extract.main_text(f"<article><p>One two.</p><p {many}>Three.</p></article>", tree)[0] == "One two.\n\nThree."
    assert html_extract.main_text("<article><p title=it's>One</p><p a\">Two</p><p class = 'x>y'>Three</p><p alt=\"open>Four</p></article>", tree)[0] == "One\n\nTwo\n\nThree\n\nFour"


def test_open_tags_lose_no_text_and_take_linear_time():
    tree = html_extract.trained_tree()
    assert html_extract.blocks("<p>One</p><p>a <b c")[0][1].text == "a <b c"
    assert "One" in html_extract.main_text("<article>" + "<a x='>' " * 100_000 + "<p>One", tree)[0]
    html_extract.blocks("<a " * 300_000)
    html_extract.blocks("<video>" * 100_000)


def test_words_in_other_values_hide_nothing():
    page = """<article><p data-hidden x2="{hidden: true}" data_id="nav">One</p><p hidden>no</p><p HIDDEN="">no</p></article>"""
    assert html_extract.main_text(page, html_extract.trained_tree())[0] == "One"


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p"), (5, "u", '<a "' * 2000), (6, "u", "<script>x"), (None, "u", "<article>" + "<b>" * 5000 + "x" * 100_000), (7, "u", "<article>a</article>"), (7, "u", "<article>a</article>")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 7] == ["a", "a"] and [r.n_chars for r in got if r.page_id is None] == [100_000]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_licenses_are_found(spark):
    texts = {
        1: "Some words before. Released under the MIT License. And words behind.",
        2: "x\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0.\ny",
        3: "this work is licensed under the gnu general public license version 3",
        4: "We spoke of the license and of the version under the tree.",
        5: None,
        6: "",
        7: "word " * 30_000 + "Licensed under CC BY-NC 4.0." + " word" * 30_000,
        8: license_scan.TEMPLATES["BSD-3-Clause"][0].replace("forms", "form"),
    }
    data = spark.createDataFrame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, license int")
    got = sorted((r.doc_id, r.license, r.first_word) for r in license_scan.scan(data).collect())
    assert got == [(1, "MIT", 3), (2, "Apache-2.0", 1), (3, "GPL-3.0", 0), (7, "CC-BY-NC-4.0", 30_000)]
    assert license_scan.scan(data.limit(0)).collect() == []


def test_licenses_equal_direct_search(spark, docs):
    """Every line of the corpus that holds a short notice, found by plain search."""
    notices = {n: [t for t in ts if len(t.split()) < 14] for n, ts in license_scan.TEMPLATES.items()}
    want = sorted({(r.doc_id, n) for r in docs.collect() for n, ts in notices.items() for t in ts if t.rstrip(".") in r.text})
    got = sorted({(r.doc_id, r.license) for r in license_scan.scan(docs).collect()})
    assert want and got == want


def test_repeated_and_adjacent_notices():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    mit, bsd, short = "Released under the MIT License.", license_scan.TEMPLATES["BSD-3-Clause"][0], "All rights reserved."
    n = len(bsd.split())
    assert scanner.scan(f"{mit} {mit}".encode()) == [("MIT", 0, 5, 1.0), ("MIT", 5, 5, 1.0)]
    assert scanner.scan(f"{mit} and so {mit}".encode()) == [("MIT", 0, 5, 1.0), ("MIT", 7, 5, 1.0)]
    assert scanner.scan(f"a {bsd} {bsd} b {short}".encode()) == [("BSD-3-Clause", 1, n, 1.0), ("BSD-3-Clause", n + 1, n, 1.0), ("All-Rights-Reserved", 2 * n + 2, 3, 1.0)]
    assert [x[:3] for x in scanner.scan((f"{mit} " * 50).encode())] == [("MIT", 5 * i, 5) for i in range(50)]


def test_every_notice_is_found_by_direct_search():
    """Texts of notices and other words at random places: each notice once, where it stands."""
    rng, scanner = random.Random(3), license_scan.Scanner(license_scan.TEMPLATES)
    notices = [(name, t) for name, ts in license_scan.TEMPLATES.items() for t in ts[:1]]
    for _ in range(60):
        words, want = [], []
        for _ in range(rng.randint(0, 12)):
            if rng.random() < 0.5:
                name, text = rng.choice(notices)
                want.append((name, len(words), len(text.split())))
                words += text.split()
            else:
                words += [f"w{rng.randrange(1000)}" for _ in range(rng.randint(1, 30))]
        assert [x[:3] for x in scanner.scan(" ".join(words).encode())] == want


def test_columns_with_the_names_of_new_ones_give_way(spark, docs):
    model = langid.train(docs, training_texts=300)
    rows = spark.createDataFrame([(1, "the and of the", 7, "x", 1)], "doc_id long, text string, score int, lang_pred string, Ambiguous int")
    got = langid.identify(rows, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "ambiguous"] and got.first().lang_pred == "en"
    pages = spark.createDataFrame([(1, "u", "<article>a</article>", 5, 6)], "page_id long, url string, html string, n_chars int, text int")
    assert html_extract.extract(pages).first().text == "a"
