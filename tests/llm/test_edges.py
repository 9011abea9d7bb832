"""Nulls, empty and very long texts, repeated rows, empty tables, and columns that bear internal names."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from passagecraft.llm import (
    byte_cnn, html_crf, latent_search, licence_scan, line_dedup, order_minhash, packing, quality_rules, substring_dedup, url_graph,
)
from passagecraft.llm.labelled_pages import pages as labelled
from passagecraft.llm.queries import tokenizer_path

rng = random.Random(4)
WORDS = ["".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(2, 8))) for _ in range(3000)]
PLAIN = " ".join(rng.choices(WORDS, k=60)) + "\n" + " ".join(rng.choices(WORDS, k=40))
LONG = " ".join(rng.choices(WORDS, k=60_000))
ROWS = [(1, PLAIN), (1, PLAIN), (2, None), (3, ""), (None, PLAIN), (None, None), (4, LONG), (5, PLAIN), (6, " \t\n "), (7, "ü€😀 é"), (7, "other text")]
CLASHES = ["row", "text_key", "h1", "h2", "at", "gone", "runs", "band", "class_id", "n", "kept", "lang", "quality", "n_chars", "line", "family"]
SCHEMA = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *CLASHES) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, None), (5, 1, 0), (7, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    part = " ".join(PLAIN.split()[10:40])
    return spark.createDataFrame([(1, part, "x"), (2, None, "x"), (3, "", "x"), (None, "nowhere to be found", "x"), (5, "!!", "x")], "item_id long, text string, at string")


OPERATORS = {
    "lines": lambda d, lab, it: line_dedup.drop_repeated_lines(d),
    "packing": lambda d, lab, it: packing.pack(d, tokenizer_path(), with_ids=True),
    "substrings": lambda d, lab, it: substring_dedup.remove_repeated(d),
    "rules": lambda d, lab, it: quality_rules.judge(d, lab),
    "near": lambda d, lab, it: order_minhash.classes(d),
    "cnn": lambda d, lab, it: byte_cnn.score(d, byte_cnn.train(d, lab)),
    "licences": lambda d, lab, it: licence_scan.scan(d, licence_scan.known_digests(d.sparkSession)),
    "search": lambda d, lab, it: latent_search.search(d, it),
}
PER_ROW = ["lines", "substrings", "rules", "near", "cnn", "licences"]


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(docs, labels, items, name):
    got = OPERATORS[name](docs, labels, items)
    found = got.collect()
    if name in PER_ROW:
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)
    none = OPERATORS[name](docs.limit(0), labels.limit(0), items.limit(0))
    assert none.count() == 0 and none.columns == got.columns
    assert OPERATORS[name](docs, labels.limit(0), items.limit(0)).count() == (0 if name == "search" else len(found))


def test_defined_results(docs, labels, items):
    lines = {(r.doc_id, r.n_lines): r for r in line_dedup.drop_repeated_lines(docs).collect()}
    # The null id comes first, so its lines stay; repeated rows are cut alike.
    assert lines[None, 2].n_removed == 0 and lines[1, 2].n_removed == 2 and lines[1, 2].kept_text == ""
    assert lines[2, 0].kept_text is None and lines[3, 1].kept_text == ""
    cut = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.remove_repeated(docs).collect()}
    assert cut[1, 100] == 0 and cut[5, 100] == 100 and cut[None, 100] == 0 and cut[2, 0] == cut[3, 0] == cut[6, 0] == 0
    near = {(r.doc_id, r.class_id) for r in order_minhash.classes(docs).collect()}
    assert {(1, 1), (5, 1), (None, 1), (2, 2), (3, 2), (None, 2), (4, 4), (6, 6)} <= near
    judged = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect() if r.doc_id is not None}
    assert judged[2].base_failed and judged[3].base_failed and not judged[1].base_failed and judged[4].kept
    found = latent_search.search(docs, items).filter("leaked")
    assert rows(found.filter("doc_id is not null").select("doc_id", "item_id").distinct(), "doc_id", "item_id") == [(1, 1), (5, 1)]
    assert found.filter("doc_id is null").count() == 1


def test_stages_keep_all_columns(docs, labels, items):
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "6", "7", "7"]
    assert quality_rules.keep_good(docs, labels).columns == docs.columns
    assert latent_search.drop_leaked(docs, items).columns == docs.columns
    lines = line_dedup.without_repeated_lines(docs)
    assert lines.columns == docs.columns and lines.filter("doc_id = 5").count() == 0 and lines.filter("doc_id = 3").count() == 1
    assert {r["class_id"] for r in lines.collect()} == {"class_id"}


def test_pages(spark):
    page = labelled(1, seed=5)[0]
    odd = [(1, "http://a.b/c", page), (1, "http://a.b/c", page), (2, None, None), (None, "x", ""), (3, "u", "<p>" * 3000 + "deep"), (4, "u", "no markup & more"),
           (5, "u", "<a " + '"' * 999), (6, "u", "<article>" + "<p>word</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in odd], "page_id long, url string, html string, text string, host string")
    got = html_crf.extract(pages)
    assert got.count() == len(odd) and got.filter("page_id = 2").first().text == "" and got.filter("page_id = 6").first().n_kept == 20_000
    assert got.filter("n_chars != length(text)").count() == 0
    assert html_crf.extract(pages.limit(0)).count() == 0
    judged = url_graph.filter_urls(pages)
    assert judged.count() == len(odd) and judged.filter("page_id = 2").first().verdict == "allow"
    assert url_graph.filter_urls(pages.limit(0)).count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, docs, labels, items, tmp_path):
    plain = docs.select("doc_id", "text", "lang", F.col("row").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for name, table in (("odd", plain), ("none", plain.limit(0))):
        folder = str(tmp_path / name)
        table.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        items.write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder)
        # The documents that hold the item go with their copies; the long one is left.
        assert {r.doc_id for r in got.collect()} == ({4} if name == "odd" else set())
