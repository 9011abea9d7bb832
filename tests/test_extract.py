import re

from conftest import SMALL, rows

from passagecraft.operators.extract import documents, extract_text, page_meta
from passagecraft.plans.corpus import build_corpus
from passagecraft.sources.tables import read_documents, read_pages


def _pages(spark, *html):
    return spark.createDataFrame([(i, f"https://User@WWW.Site{i}.org:80/a?b#c", h) for i, h in enumerate(html)],
                                 "page_id long, url string, html string")


def test_every_page_is_a_planted_document(spark):
    def flat(texts):
        return {re.sub(r"\s+", " ", t).strip() for t in texts}

    for folder in (SMALL, "/root/testdata/sf0.01"):
        pages = flat(r.text for r in extract_text(read_pages(spark, f"{folder}/pages.parquet")).collect())
        known = flat(r.text for r in read_documents(spark, "/root/testdata/sf0.1/documents.parquet").collect())
        known |= flat(r.text for r in read_documents(spark, f"{folder}/documents.parquet").collect())
        assert pages <= known


def test_article_only_with_entities_and_blocks(spark):
    html = ("<html><body><nav>menu</nav><article class=x><h1>Title</h1><p>A &amp;lt; <b>b</b>older</p>"
            "<script>var a='</p>';</script><li>item<br/>next</article><footer>foot</footer></body></html>")
    assert rows(extract_text(_pages(spark, html)), "text") == [("A &lt; bolder\nitem\nnext",)]


def test_unclosed_and_missing_article(spark):
    pages = _pages(spark, "<article><p>open end", "<body><nav>no</nav><p>plain</p><style>x</style>", "no markup", "", "<html><head><title>t</title></head><p>no body tag</p>")
    assert [r.text for r in extract_text(pages).orderBy("page_id").collect()] == ["open end", "plain", "no markup", "", "no body tag"]


def test_all_articles_and_no_furniture(spark):
    html = ("<body><header>top</header><article><p>one</p><aside>side</aside></article><article><p>two</p></article>"
            "<script>never closed")
    assert rows(extract_text(_pages(spark, html)), "text") == [("one\ntwo",)]


def test_character_references(spark):
    html = "<body><p>caf&eacute; &#8217;&#x1F600; &euro;5 &unknown; &#0; &amp;eacute; &nbsp;x &lt;b&gt;</p>"
    assert rows(extract_text(_pages(spark, html)), "text") == [("café ’😀 €5 &unknown; &eacute; x <b>",)]


def test_meta(spark):
    meta = page_meta(_pages(spark, "<HTML dir=ltr lang='DE-at'><title>a &amp; b </title>", "<html><p>x")).orderBy("page_id")
    assert [tuple(r) for r in meta.collect()] == [
        (0, "a & b", "de", "www.site0.org"), (1, "", "und", "www.site1.org")]


def test_documents_are_one_narrow_pass(spark):
    plan = documents(spark.read.parquet(f"{SMALL}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_build_corpus_profiles_what_it_wrote(spark, tmp_path):
    for fmt in ("parquet", "json"):
        total = build_corpus(spark, f"{SMALL}/pages.parquet", str(tmp_path / fmt), fmt).filter("level = 3").first()
        assert total.n_docs == 50
        assert {p.name for p in (tmp_path / fmt).glob("lang=*")} >= {"lang=en", "lang=de"}
