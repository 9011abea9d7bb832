import re

import pytest
from conftest import rows

from passagecraft.operators.relevance import qrels
from passagecraft.sources.tables import read_documents, read_items


def _tables(spark):
    items = ["b c", "a a a", "one two three four five six seven eight nine", "x", "", "not there"]
    docs = ["A, b? C d", "a a a a b", "zero one two three four five six seven eight nine ten",
            "one two three four five six seven eight ten nine", "b x c", "bc"]
    return (spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
            spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))


WANT = [(0, 0), (1, 1), (2, 2), (3, 4)]


def test_whole_runs_of_tokens(spark):
    for n in (1, 2, 3, 8):
        assert rows(qrels(*_tables(spark), n=n), "query_id", "doc_id") == WANT


def test_without_broadcast(spark, no_broadcast):
    assert rows(qrels(*_tables(spark), n=3), "query_id", "doc_id") == WANT


@pytest.mark.parametrize("sf, n_items, n_docs", [("0.01", 20, 26), ("0.1", 139, 244)])
def test_planted_items(spark, sf, n_items, n_docs):
    d = f"/root/testdata/sf{sf}"
    items, docs = read_items(spark, f"{d}/benchmark.parquet"), read_documents(spark, f"{d}/documents.parquet")
    found = set(rows(qrels(items, docs), "query_id", "doc_id"))
    texts, passages = dict(rows(docs, "doc_id", "text")), dict(rows(items, "item_id", "text"))
    verbatim = {(q, i) for q, t in passages.items() for i, text in texts.items() if t in text}
    assert (len({q for q, _ in verbatim}), len({i for _, i in verbatim})) == (n_items, n_docs)
    assert verbatim <= found
    for q, i in found - verbatim:  # the same words with other capitals, marks or line breaks
        assert " ".join(_words(passages[q])) in " ".join(_words(texts[i]))


def _words(text):
    return re.findall(r"[^\W_]+", text.lower())


def test_runs_of_documents_that_no_item_holds_are_left_out_where_they_lie(spark):
    from passagecraft.functions.text import tokens
    from passagecraft.operators import relevance

    items, docs = (df.withColumn("_t", tokens("text")) for df in _tables(spark))
    wanted = relevance._grams(items, ["item_id"], 3)
    assert wanted.count() == 1 + 7 + 0  # "a a a", nine words
    held = rows(relevance._grams(docs, ["doc_id"], 3, relevance._marks(wanted)), "doc_id", "at")
    assert held == [(1, 0), (1, 1), *[(2, i) for i in range(1, 8)], *[(3, i) for i in range(6)]]


def test_runs_across_slices_and_long_documents(spark, monkeypatch):
    import pyarrow as pa

    from passagecraft.functions import runs

    lists = pa.array([[], ["a", "b", "a", "b"], None, ["b"], ["a", "b", "c", "a", "b"]])
    whole = [tuple(map(int, g)) for parts in runs.grams(lists, 2) for g in zip(*parts)]
    assert [g[:2] for g in whole] == [(1, 0), (1, 1), (1, 2), (4, 0), (4, 1), (4, 2), (4, 3)]
    assert len({g[2:] for g in whole}) == 4
    monkeypatch.setattr(runs, "GRAM_TOKENS", 3)
    assert whole == [tuple(map(int, g)) for parts in runs.grams(lists, 2) for g in zip(*parts)]
