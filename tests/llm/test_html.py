"""Main text of pages: labelled pages not seen in training, planted pages, and the table."""

import html
import re

import pytest
from conftest import SMALL
from passagecraft.llm import html_crf, labelled_pages


@pytest.fixture(scope="module")
def field():
    return html_crf.train(labelled_pages.pages(html_crf.TRAINING_PAGES))


def _text(page, field):
    return html_crf.main_text(page, html_crf.Blocks(), field)[0]


def test_unseen_pages(field):
    reader, right, total = html_crf.Blocks(), 0, 0
    for page in labelled_pages.pages(300, seed=77):
        want = "\n\n".join(b[0].replace(labelled_pages.KEEP, "") for b in reader.of(page) if labelled_pages.KEEP in b[0])
        right += _text(page.replace(labelled_pages.KEEP, ""), field) == want
        total += 1
    assert right >= 0.97 * total


def test_viterbi_equals_trying_all(field):
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 7):
        scores = rng.normal(size=n).tolist()

        def value(labels):
            s = field.first[labels[0]] + sum(x for x, label in zip(scores, labels) if label)
            return s + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert tuple(field.decode(scores)) == best


def test_planted_page(field):
    page = """<html><head><title>T</title><style>p{}</style></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies on this site.</p></div>
    <article><h1>Caf&eacute; &amp; co</h1><p>First   <b>bold</b>&nbsp;words&#8212;here.<br>More.<script>var a="<p>no</p>";</script>
    <div class="ad">Buy now and save a lot today.</div><p>Second paragraph is unclosed
    <ul><li>one<li>two</ul><!-- hidden --></article>
    <aside><p>Read this other story about something.</p></aside>
    <form><p>Subscribe to our letter</p><button>Go</button></form>
    <section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this text very much.</p></div></section>
    <footer>&copy; 2024 Site</footer></body></html>"""
    assert _text(page, field).split("\n\n") == ["Café & co", "First bold words—here. More.", "Second paragraph is unclosed", "one", "two"]


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    texts = {r.page_id: r for r in html_crf.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)>", article))
        assert texts[r.page_id].text == "\n\n".join(p for p in parts if p) and texts[r.page_id].n_chars == len(texts[r.page_id].text)


@pytest.mark.parametrize(("inside", "more"), [
    ('<svg viewBox="0 0 1 1"/>', []), ("<svg><path d=M0/></svg>", []), ("<math/>", []), ('<iframe src="x">', []), ("<iframe src=x></iframe>", []),
    ("<noscript><img src=x>", []), ("<object data=x>", []), ("<select>", []), ("<svg>", []), ("<math>", []),
    ("<object data=x><p>The picture shows a long and quiet river.</p></object>", ["The picture shows a long and quiet river."]),
])
def test_text_after_embedded_elements_stays(field, inside, more):
    first, last = ("The first paragraph of this article has some words.", "The last paragraph of this article has words as well.")
    page = f"<html><body><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>{first}</p>{inside}<p>{last}</p></article></body></html>"
    assert _text(page, field).split("\n\n") == ["Head", first, *more, last]


def test_formulas_are_text(field):
    page = "<article><h1>Head</h1><p>We know that <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for every one of them.</p></article>"
    assert _text(page, field).split("\n\n") == ["Head", "We know that x=2 holds for every one of them."]


@pytest.mark.parametrize(("body", "article"), [
    *((f' class="home {name}"', "") for name in ("has-sidebar", "no-sidebar", "ads-enabled", "menu-open", "search", "social")),
    *(("", f' class="post {name}"') for name in ("comments-open", "no-sidebar", "search-and-rescue", "social", "legal-news", "meta-analysis")),
    (' id="menu" class="comments"', ' id="social" class="has-ads"'),
])
def test_names_of_what_holds_the_article(field, body, article):
    first, last = "The first paragraph of this article has some words.", "The last paragraph of this article has words as well."
    page = f"""<html><body{body}><nav><a href=/>Home</a></nav><article{article}><p>{first}</p><p>{last}</p></article>
    <div class="sidebar"><p>Another story that you may want to read.</p></div><article class="comment"><p>I liked this.</p></article></body></html>"""
    assert _text(page, field).split("\n\n") == [first, last]


@pytest.mark.parametrize("part", [
    "<a ", '<a href="x \'', "<a", "<!", "<?x", "<a href='x\">", "<div>", "</p>", "<div></p>", '<p class="', "<script", "<!--", "< ", "<article><p>a ", "&amp",
    "<a href=x ",
])
def test_broken_markup_is_read_in_one_pass(field, part):
    import time

    start = time.monotonic()
    for end in ("", ">"):
        _text("<p>Some words stand here.</p>" + part * (1_000_000 // len(part)) + end, field)
    assert time.monotonic() - start < 20


def test_markup_equals_a_plain_reader():
    import random

    plain = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)>", re.S)
    rng = random.Random(4)
    for _ in range(3000):
        page = "".join(rng.choices(["<", ">", "<a", "</p", " ", "x=", '"', "'", "<!--", "-->", "<!", "<?", "/", "b"], k=rng.randint(0, 14)))
        want = [(m.start(), m.end(), m[1] or "", m[2] or "", m[3] or "") for m in plain.finditer(page)]
        assert list(html_crf.markup(page)) == want, page
