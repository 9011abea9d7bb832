import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from passagecraft.operators import dense
from passagecraft.operators.dense import hash_embed, ivf_topk, search_cells, store_cells, vector_topk
from passagecraft.operators.ranking import filtered_vector_topk
from passagecraft.sources.tables import read_vectors

COLUMNS = ("query_id", "rank", "vec_id", "score")


def _table(spark, name, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)],
                                 f"{name} long, embedding array<float>")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8))
    base[100:200] = base[0]  # a third of all rows are copies
    base[5] = 0
    return base.astype(np.float32), rng.normal(size=(7, 8)).astype(np.float32)


def brute(base, asked, k, metric):
    base, asked = base.astype(float), asked.astype(float)
    out = []
    for q, v in enumerate(asked):
        if metric == "l2":
            s = -np.linalg.norm(base - v, axis=1)
        else:
            s = base @ v
            if metric == "cosine":
                n = np.linalg.norm(base, axis=1) * np.linalg.norm(v)
                s = np.divide(s, n, out=np.zeros_like(s), where=n > 0)
        s = np.round(s, 6)
        best = sorted(range(len(base)), key=lambda i: (-s[i], i))[:k]
        out += [(q, r + 1, i, pytest.approx(s[i], abs=2e-6)) for r, i in enumerate(best)]
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_exact_with_copies(spark, vectors, metric):
    base, asked = vectors
    got = vector_topk(_table(spark, "vec_id", base).repartition(5), _table(spark, "query_id", asked), 20, metric)
    assert rows(got, *COLUMNS) == brute(base, asked, 20, metric)


def test_exact_in_blocks(spark, vectors, one_query_a_block):
    base, asked = vectors
    got = vector_topk(_table(spark, "vec_id", base[:120]), _table(spark, "query_id", asked), 9)
    assert rows(got, *COLUMNS) == brute(base[:120], asked, 9, "cosine")


def test_string_keys_and_null_vectors(spark):
    v = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("z", None), ("c", [0.0, 1.0])], "vec_id string, embedding array<float>")
    q = spark.createDataFrame([("x", [1.0, 0.0]), ("none", None)], "query_id string, embedding array<float>")
    want = [("x", 1, "a", 1.0), ("x", 2, "b", 1.0), ("x", 3, "c", 0.0)]
    assert rows(vector_topk(v, q, 5), *COLUMNS) == want
    assert rows(ivf_topk(v, q, 5, cells=2, probes=2), *COLUMNS) == want


def test_kernel_keeps_the_best_of_many_queries():
    from passagecraft.functions.kernel import Best, add_vectors

    rng = np.random.default_rng(2)
    rows_, queries = rng.normal(size=(900, 4)).round(2), rng.normal(size=(700, 4)).round(2)
    best = Best(700, 3, 1)
    for low in (0, 400):
        add_vectors(best, queries, np.arange(700), rows_[low : low + 500 if low else 400], [np.arange(900)[low : low + 500 if low else 400]], "dot")
    q, key, score = (c.to_pylist() for c in best.columns(pa.array(np.arange(700)), [pa.int64()]))
    exact = np.round(rows_ @ queries.T, 6)
    for i in (0, 255, 256, 699):
        want = sorted(range(900), key=lambda r: (-exact[r, i], r))[:3]
        assert [k for a, k in zip(q, key) if a == i] == want


def test_all_cells_are_exact_with_a_hot_cell(spark, vectors):
    base, asked = vectors
    got = ivf_topk(_table(spark, "vec_id", base), _table(spark, "query_id", asked), 12, cells=4, probes=4)
    assert rows(got, *COLUMNS) == brute(base, asked, 12, "cosine")


def test_few_cells_find_planted_copies(spark):
    rng = np.random.default_rng(3)
    base = np.array([r.embedding for r in read_vectors(spark, f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()])
    asked = base[:60] + rng.normal(scale=0.02, size=(60, base.shape[1]))
    v, q = _table(spark, "vec_id", base), _table(spark, "query_id", asked)
    exact = {(r.query_id, r.vec_id) for r in vector_topk(v, q, 1).collect()}
    near = {(r.query_id, r.vec_id) for r in ivf_topk(v, q, 1, cells=10, probes=3).collect()}
    assert len(exact & near) >= 0.9 * len(exact)


def test_stored_cells_are_pruned_and_found_again(spark, tmp_path):
    """Recall of the best ten against exact search, and what is read for it."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(40, 16))
    base = middles[rng.integers(0, 40, 2000)] + rng.normal(scale=0.3, size=(2000, 16))
    asked = base[:50] + rng.normal(scale=0.1, size=(50, 16))
    v, q = _table(spark, "vec_id", base), _table(spark, "query_id", asked)
    store_cells(v, f"{tmp_path}/cells", 20)
    got = search_cells(spark, f"{tmp_path}/cells", q, 10, probes=4)
    exact = {(r.query_id, r.vec_id) for r in vector_topk(v, q, 10).collect()}
    assert len(exact & {(r.query_id, r.vec_id) for r in got.collect()}) >= 0.95 * len(exact)
    assert rows(got, *COLUMNS) == rows(ivf_topk(v, q, 10, cells=20, probes=4), *COLUMNS)
    one = search_cells(spark, f"{tmp_path}/cells", q.filter("query_id = 3"), 10, probes=2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan.replace("isnotnull(cell#", "cell") and one.count() == 10


def test_stored_cells_of_no_vectors_and_null_ones(spark, tmp_path):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("d", None)], "vec_id string, embedding array<float>")
    q = spark.createDataFrame([("x", [1.0, 0.0]), ("none", None)], "query_id string, embedding array<float>")
    store_cells(v, f"{tmp_path}/some", 2)
    assert rows(search_cells(spark, f"{tmp_path}/some", q, 5, probes=2), *COLUMNS) == [("x", 1, "a", 1.0), ("x", 2, "b", 1.0)]
    assert search_cells(spark, f"{tmp_path}/some", q.limit(0), 5).count() == 0
    store_cells(v.limit(0), f"{tmp_path}/none", 2)
    assert search_cells(spark, f"{tmp_path}/none", q, 5).count() == 0


def test_fewer_vectors_than_k_and_none(spark, vectors):
    base, asked = vectors
    v, q = _table(spark, "vec_id", base[:3]), _table(spark, "query_id", asked)
    assert vector_topk(v, q, 10).count() == 21
    assert vector_topk(v.filter("vec_id < 0"), q, 10).count() == 0
    assert vector_topk(v, q.filter("query_id < 0"), 10).count() == 0


def test_filter(spark, vectors):
    base, asked = vectors
    got = filtered_vector_topk(_table(spark, "vec_id", base), _table(spark, "query_id", asked), F.col("vec_id") >= 290, 50)
    assert {r.vec_id for r in got.collect()} == set(range(290, 300))


def test_hashed_vectors(spark):
    chunks = spark.createDataFrame([(1, 0, "red blue blue"), (2, 0, "green"), (3, 0, "?!")], "doc_id long, chunk_no int, chunk string")
    asked = spark.createDataFrame([(9, "blue red blue")], "query_id long, question string")
    v, q = hash_embed(chunks, asked, 64)
    for r in v.collect():
        assert len(set(r.vector.indices)) == len(r.vector.indices)
        assert sum(w * w for w in r.vector.weights) == pytest.approx(1 if r.doc_id < 3 else 0)
    best = vector_topk(v, q, 1, keys=("doc_id", "chunk_no"), vector="vector", dim=64).collect()
    assert [(r.query_id, r.doc_id, r.score) for r in best] == [(9, 1, 1.0)]


def test_bucket_counts_and_weights_are_counted_by_the_batch(spark):
    """Against a count by hand, with null, empty and repeated words, in batches of one row and of all."""
    from collections import Counter
    from hashlib import md5

    texts = ["Ä b b c", None, "", "b, Ä! ß", "x " * 40, "東京 b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, chunk string").repartition(2)
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    want = [Counter(int(md5(w.encode()).hexdigest()[:7], 16) % 16 for w in ws) for ws in words]
    idf = [np.log((len(texts) + 1) / (sum(i in c for c in want) + 1)) + 1 for i in range(16)]
    for batch in ("1", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        counts = dense.bucket_counts(docs, ["doc_id"], "chunk", 16)
        assert {r.doc_id: [(x.item, x.n) for x in r._runs] for r in counts.collect()} == {i: sorted(c.items()) for i, c in enumerate(want)}
        vectors, _ = dense.hash_embed(docs, dim=16, keys=("doc_id",))
        for r in vectors.collect():
            raw = np.array([n * idf[i] for i, n in sorted(want[r.doc_id].items())])
            assert r.vector.indices == sorted(want[r.doc_id])
            np.testing.assert_allclose(r.vector.weights, raw / np.sqrt((raw**2).sum()) if len(raw) else [])
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
