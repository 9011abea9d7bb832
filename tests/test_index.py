import math
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from passagecraft.functions.sizing import split_join
from passagecraft.functions import sizing
from passagecraft.operators import index as index_module
from passagecraft.operators.chunk import chunk
from passagecraft.operators.index import build_index, changes, load_index, save_index, update_index
from passagecraft.operators.lexical import bm25
from passagecraft.operators.ranking import filtered_topk
from passagecraft.registry import _replies

TEXTS = ["the cat sat on the mat", "the dog sat", "a cat and a dog and a cat", "the the the", "", "zebra"]


def _docs(spark, texts=TEXTS):
    return spark.createDataFrame(
        [(i, t, "en" if i % 2 == 0 else "de", "s") for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string")


def _queries(spark):
    return spark.createDataFrame([(1, "the cat"), (2, "dog dog zebra"), (3, "none here")], "query_id long, question string")


def brute_bm25(texts, question):
    cut = {i: t.split() for i, t in enumerate(texts) if t}
    mean = sum(map(len, cut.values())) / len(cut)
    df = Counter(w for t in cut.values() for w in set(t))
    scores = {}
    for i, t in cut.items():
        s = sum(math.log(1 + (len(cut) - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.2
                / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / mean)) for w in question.split() if w in t)
        if s:
            scores[i] = round(s, 6)
    return [(i, pytest.approx(s, abs=2e-6)) for i, s in sorted(scores.items(), key=lambda x: (-x[1], x[0]))]


def _check(spark, hits):
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert got == {q: brute_bm25(TEXTS, t) for q, t in [(1, "the cat"), (2, "dog dog zebra")]}


def test_bm25_equals_brute_force(spark):
    _check(spark, bm25(build_index(chunk(_docs(spark))), _queries(spark), 10))


def test_bm25_without_broadcast_and_in_blocks(spark, no_broadcast, one_query_a_block):
    _check(spark, bm25(build_index(chunk(_docs(spark))), _queries(spark), 10))


def test_split_join_spreads_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(sizing, "HOT_KEY_ROWS", 100)
    big = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (2, "d")], "k int, v string")
    got = split_join(big, small, ["k"], ["id"])
    assert rows(got.groupBy("k", "v").count(), "k", "v", "count") == [(0, "a", 2000), (1, "b", 1000), (1, "c", 1000)]


def test_k_and_ties(spark):
    texts = ["same words"] * 40 + ["other"]
    hits = bm25(build_index(chunk(_docs(spark, texts))), spark.createDataFrame([(1, "words")], "query_id long, question string"), 5)
    assert rows(hits, "rank", "doc_id") == [(i + 1, i) for i in range(5)]


def test_filter_limits_results_not_statistics(spark):
    index = build_index(chunk(_docs(spark)), keep=("lang",))
    every = {(r.query_id, r.doc_id): r.score for r in bm25(index, _queries(spark), 10).collect()}
    some = filtered_topk(index, _queries(spark), F.col("lang") == "en", 10).collect()
    assert {(r.query_id, r.doc_id): r.score for r in some} == {k: s for k, s in every.items() if k[1] % 2 == 0}


def test_saved_index_is_scored_without_moving_passages(spark, tmp_path):
    save_index(build_index(chunk(_docs(spark))), str(tmp_path))
    hits = bm25(load_index(spark, str(tmp_path)), _queries(spark), 10)
    _check(spark, hits)
    plan = hits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 2 and "WindowGroupLimit" in plan


def test_passages_cut_by_one_task_are_ranked_by_many(spark, monkeypatch):
    monkeypatch.setattr(index_module, "FILE_PASSAGES", 2)
    index = build_index(chunk(_docs(spark).coalesce(1)))
    assert len(index.passages.inputFiles()) == 3
    _check(spark, bm25(index, _queries(spark), 10))


def test_replies_of_one_file_are_cut_by_many_tasks(spark, tmp_path):
    turns = [(i, 0, "assistant" if i % 2 else "user", f"text {i}") for i in range(100)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(
        f"{tmp_path}/conversations.parquet")
    dealt = spark.conf.get("spark.passagecraft.readPartitions")
    spark.conf.set("spark.passagecraft.readPartitions", "0")
    try:
        held = _replies(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.passagecraft.readPartitions", dealt)
    assert len(held) > 4 and sum(r["count"] for r in held) == 50


def test_string_document_ids(spark, one_query_a_block):
    docs = _docs(spark).withColumn("doc_id", F.concat(F.lit("d-"), "doc_id"))
    hits = bm25(build_index(chunk(docs)), _queries(spark), 10)
    assert hits.schema["doc_id"].dataType.simpleString() == "string"
    _check(spark, hits.withColumn("doc_id", F.substring("doc_id", 3, 9).cast("long")))


def test_update_with_changed_columns_nulls_and_variants(spark):
    schema = "doc_id long, text string, lang string, v string"
    old = spark.createDataFrame([(1, "a b", "en", "x"), (2, None, "en", "x"), (3, "c d", "en", "y"), (4, "e", "en", "y")], schema)
    new = spark.createDataFrame([(1, "a b", "de", "x"), (2, None, "en", "x"), (3, None, "en", "y"), (4, "e", "en", "y"), (5, None, "de", "x")], schema)
    status = changes(old, new, ("lang", "v"))
    assert rows(status, "doc_id", "status") == [(1, "changed"), (2, "same"), (3, "changed"), (4, "same"), (5, "new")]
    cut = lambda docs: chunk(docs, keep=("lang", "v"))
    build = lambda docs: build_index(cut(docs), keep=("lang",), by=("v",))
    got, want = update_index(build(old), status, new, cut), build(new)
    assert rows(got.terms, "v", "term", "df") == rows(want.terms, "v", "term", "df")
    assert rows(got.totals, "v", "n_chunks", "n_words") == rows(want.totals, "v", "n_chunks", "n_words")
    columns = ["v", "doc_id", "lang", "term", "tf"]
    assert rows(got.postings(), *columns) == rows(want.postings(), *columns)
    assert got.by == ("v",) and got.keep == ("lang",)


def test_string_query_ids_and_no_known_term(spark):
    index = build_index(chunk(_docs(spark)))
    asked = spark.createDataFrame([("a-1", "zebra"), ("b", "unknown")], "query_id string, question string")
    assert [(r.query_id, r.doc_id, r.rank) for r in bm25(index, asked).collect()] == [("a-1", 5, 1)]
    assert bm25(index, asked.filter("query_id = 'b'")).count() == 0


def test_index_in_characters_for_text_without_spaces(spark):
    docs = _docs(spark, ["日本の首都は東京です", "京都は古い都です", "大阪の食べ物"])
    hits = bm25(build_index(chunk(docs, 100, 0, "char"), "pair"),
                spark.createDataFrame([(1, "首都はどこ")], "query_id long, question string"), 3, "pair")
    assert hits.orderBy("rank").first().doc_id == 0


def test_update_equals_rebuild(spark):
    old = _docs(spark)
    new = _docs(spark, ["the cat sat on the mat", "the dog ran", "", "the the the", "now filled", "zebra", "added cat"])
    new = new.filter("doc_id <> 3")
    status = changes(old, new)
    assert rows(status, "doc_id", "status") == [
        (0, "same"), (1, "changed"), (2, "changed"), (3, "deleted"), (4, "changed"), (5, "same"), (6, "new")]
    got = update_index(build_index(chunk(old)), status, new, chunk)
    want = build_index(chunk(new))
    assert rows(got.terms, "term", "df") == rows(want.terms, "term", "df")
    assert rows(got.totals, "n_chunks", "n_words") == rows(want.totals, "n_chunks", "n_words")
    columns = ["doc_id", "chunk_no", "term", "tf", "n_words"]
    assert rows(got.postings(), *columns) == rows(want.postings(), *columns)
    assert rows(bm25(got, _queries(spark)), "query_id", "doc_id", "score") == rows(
        bm25(want, _queries(spark)), "query_id", "doc_id", "score")
