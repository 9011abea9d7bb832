from conftest import rows

from passagecraft.operators import prepare


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_canonical_urls(spark):
    urls = ["https://www.A.org/x/?q#f", "http://a.org:80/x.html", "https://m.a.org/x", "http://b.org", None, "no scheme"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert rows(prepare.canonical_urls(pages), "canon", "page_id", "n_pages") == [("a.org/x", 0, 3), ("b.org", 3, 1)]


def test_outlinks(spark):
    html = '<a href="/x">1</a><A class=y HREF=\'http://c.org/p/?q#z\'>2</a><a href="#top">3</a><a href="/x#y">4</a>'
    pages = spark.createDataFrame([(1, "http://a.org/z", html), (2, "http://a.org", '<a href="/x">'), (3, "u", None)], "page_id long, url string, html string")
    links = prepare.outlinks(pages)
    assert rows(links, "page_id", "target") == [(1, "a.org/x"), (1, "a.org/x"), (1, "c.org/p"), (2, "a.org/x")]
    assert rows(prepare.in_degree(links), "target", "n_links", "n_pages") == [("a.org/x", 3, 2), ("c.org/p", 1, 1)]


def test_normalize_text(spark):
    docs = _docs(spark, "\n a\u0000 \t b\r\n\r\n\r\n\r\nc\rd \n", None, "")
    assert [r.text for r in prepare.normalize_text(docs).orderBy("doc_id").collect()] == ["a b\n\nc\nd", None, ""]


def test_detect_lang(spark):
    docs = _docs(spark, "the cat and der Hund", "der und die", "xyz", "", None)
    assert rows(prepare.detect_lang(docs), "doc_id", "guess", "hits") == [(0, "en", 2), (1, "de", 3), (2, "und", 0), (3, "und", 0), (4, "und", 0)]
    assert rows(prepare.detect_lang(docs, {"b": ["cat"], "a": ["cat"]}), "guess")[0] == ("a",)


def test_doc_stats(spark):
    got = prepare.doc_stats(_docs(spark, "The A# b.\nThe A# b.\nno end", "")).orderBy("doc_id").collect()
    assert tuple(got[0])[1:] == (26, 8, 2.375, 0.25, round(4 / 15, 6), 0.625, round(1 / 3, 6), 0.25, round(2 / 3, 6))
    assert tuple(got[1])[1:] == (0, 0) + (0.0,) * 7


def test_top_terms(spark):
    docs = spark.createDataFrame([("en", "b a a"), ("en", "b c"), ("de", "x")], "lang string, text string")
    assert rows(prepare.top_terms(docs, 2), "lang", "rank", "term", "n", "share") == [("de", 1, "x", 1, 1.0), ("en", 1, "a", 2, 0.4), ("en", 2, "b", 2, 0.4)]


def test_split_by_hash(spark):
    docs = spark.range(2000).withColumnRenamed("id", "doc_id")
    split = prepare.split_by_hash(docs, {"train": 80, "test": 20})
    share = dict(rows(split.groupBy("split").count(), "split", "count"))
    assert set(share) == {"train", "test"} and 300 < share["test"] < 500
    assert rows(split.repartition(7), "doc_id", "split") == rows(split, "doc_id", "split")


def test_dialogue_pairs(spark):
    said = ["system", "user", "assistant", "user", "user", "assistant", "user"]
    turns = spark.createDataFrame([(1, i, r, f"t{i}") for i, r in enumerate(said)], "conv_id long, turn long, role string, text string")
    assert rows(prepare.dialogue_pairs(turns, 2), "turn", "prompt", "response", "context") == [
        (1, "t1", "t2", "system: t0"), (4, "t4", "t5", "assistant: t2\nuser: t3")]


def test_dialogue_pairs_hold_all_turns_before(spark):
    turns = spark.createDataFrame([(c, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for c in (1, 2) for i in range(40)] + [(3, 0, "user", None), (3, 1, "assistant", "x")],
                                  "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.context for r in prepare.dialogue_pairs(turns).collect()}
    assert len(got) == 41 and got[3, 0] == "" and got[2, 0] == ""
    assert got[1, 38] == "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}: t{i}" for i in range(38))
    assert prepare.dialogue_pairs(turns.limit(0)).count() == 0


def test_block_hosts(spark, no_broadcast):
    """Without broadcasts; one host holds most pages and is blocked by its parent."""
    urls = ["http://a.bad.org/x", "https://bad.org", "http://notbad.org/", "http://www.good.com", None, "no host", "http://BAD.org:80/y", "http://org/", "http://x.co.uk/"]
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls + ["http://hot.bad.org/"] * 300 + ["http://hot.good.com/"] * 300)],
                                  "page_id long, url string, html string, domain string")
    blocked = spark.createDataFrame([("Bad.org.",), (".co.uk",), ("bad.org",), (None,), ("",), ("d.com",), *[(f"site{i}.net",) for i in range(500)]], "domain string")
    got = prepare.block_hosts(pages, blocked)
    assert got.columns == pages.columns
    kept = {r.page_id for r in got.collect()}
    assert {i for i in kept if i < len(urls)} == {2, 3, 4, 5, 7} and len(kept) == 305
    assert prepare.block_hosts(pages, blocked.limit(0)).count() == len(urls) + 600
    assert prepare.block_hosts(pages.limit(0), blocked).count() == 0


def test_funnel(spark):
    docs = _docs(spark, "abc", "de", None)
    got = prepare.funnel([("all", docs), ("long", docs.filter("length(text) > 2")), ("none", docs.limit(0))])
    assert rows(got, "step", "n_docs", "n_chars", "n_docs_lost", "n_chars_lost") == [(0, 3, 5, 0, 0), (1, 1, 3, 2, 2), (2, 0, 0, 1, 3)]
