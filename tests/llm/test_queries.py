"""Registered queries against their SQL, and what the SQL tables do not hold."""

import sys
from pathlib import Path

import pytest
from conftest import SMALL, rows

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import oracle  # noqa: E402
from passagecraft.llm import url_graph  # noqa: E402
from passagecraft.llm.oracles import ORACLES  # noqa: E402
from passagecraft.llm.queries import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    count, extra, missing = oracle.differences(QUERIES[name](spark, SMALL), oracle.connect(SMALL), ORACLES[name])
    assert count and not extra and not missing


def test_every_operator_is_registered():
    import __spark_entry__ as contract

    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_url_filter_with_links(spark, tmp_path):
    """The tables hold no link between hosts, so the graph is tested on pages that do."""
    def link(*hosts):
        return "".join(f'<a class=x href="http://{h}/p">x</a>' for h in hosts)

    pages = [
        ("http://good.example.net/en/1", link("friend.example.com", "friend.example.com")),
        ("http://bad.net/1", link("friend.example.com")),
        ("http://farm.example.com/x", link("bad.net", "Other.com") + '<a href="//bad.net/q">y</a><a href="/own">z</a>'),
        ("http://farm2.example.com/x", link("farm.example.com")),
        ("http://friend.example.com/x", link("lonely.org")),
        ("http://other.com", None), ("http://lonely.org/de/", ""), ("no-scheme.net/en/", link("bad.net")), (None, "x"),
        ("HTTP://A.EXAMPLE.NET/en/?q", ""), ("http://a.example.net?x/en/", ""), ("x://y://z.net/#/", ""), ("http://x.example.com/de/a#b", ""),
    ]
    spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = oracle.connect(str(tmp_path / "none"))
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = url_graph.filter_urls(spark.read.parquet(str(tmp_path / "pages.parquet")))
    count, extra, missing = oracle.differences(got, con, ORACLES["op6_url_filter"])
    assert count == len(pages) and not extra and not missing
    verdict = {r.host: r.verdict for r in got.collect()}
    assert verdict["farm.example.com"] == verdict["farm2.example.com"] == "block"
    assert verdict["friend.example.com"] == verdict["lonely.org"] == verdict["other.com"] == "allow"
    assert rows(got.filter("page_id in (9, 10, 11)"), "page_id", "host", "path", "rule") == [
        (9, "a.example.net", "/en/", "example.net/en/"), (10, "a.example.net", "", None), (11, "y:", "//z.net/", None)]


def test_a_rule_on_a_part_leaves_the_rest(spark, no_broadcast, monkeypatch):
    """Pages outside a blocked path are judged by links; hosts with many links or pages are spread."""
    monkeypatch.setattr("passagecraft.functions.sizing.HOT_KEY_ROWS", 5)
    links = "".join(f'<a href="http://t{i}.org/">x</a>' for i in range(40)) + '<a href="http://bad.net/">x</a>'
    pages = [("http://example.com/de/1", ""), ("http://example.com/en/1", ""), ("http://friend.org/", '<a href="http://example.com/">x</a>')]
    pages += [(f"http://hub.com/{i}", links if i == 0 else "") for i in range(30)] + [("http://bad.net/", "")]
    table = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = rows(url_graph.filter_urls(table), "page_id", "verdict")
    assert got == [(0, "block"), (1, "allow"), (2, "allow"), *((i, "block") for i in range(3, 34))]


def test_trust_reaches_the_end_of_a_chain(spark):
    """Distrust goes 30 links back and settles, also where a circle keeps it moving."""
    n, d = 30, url_graph.DAMPING
    chain = [(f"h{i}", f"h{i + 1}") for i in range(n)] + [("x", "y"), ("y", "x"), ("x", "h0")]
    links = spark.createDataFrame(chain, "src string, dst string")
    seeds = spark.createDataFrame([(f"h{n}", False, True), ("good", True, False)], "host string, trusted boolean, blocked boolean")
    got = {r.host: r for r in url_graph.propagate(seeds, links).collect()}
    hosts = sorted({h for link in chain for h in link} | {"good"})
    want = dict.fromkeys(hosts, 0.0)
    for _ in range(3000):
        new = {h: (1 - d if h == f"h{n}" else 0.0) for h in hosts}
        for a, b in chain:
            new[a] += d * want[b] / sum(y == b for _, y in chain)
        want = new
    assert set(got) == set(hosts)
    assert all(got[h].distrust == pytest.approx(want[h], rel=1e-4) for h in hosts)
    page = lambda i, to: (i, f"http://h{i}.com/", f'<a href="http://{to}/">x</a>')
    pages = [page(i, f"h{i + 1}.com") for i in range(n)] + [page(n, "bad.net"), (n + 1, "http://bad.net/", "")]
    judged = url_graph.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r.verdict for r in judged.collect()} == {"block"}
