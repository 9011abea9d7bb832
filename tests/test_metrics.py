import math

import pytest
from conftest import rows

from passagecraft.operators.compare import compare, poisson_steps, report, sweep
from passagecraft.operators.metrics import mrr, ndcg, ndcg_per_query, per_query, recall_at


def _run(spark, data):
    return spark.createDataFrame(data, "query_id long, doc_id long, rank int")


def _qrels(spark, data):
    return spark.createDataFrame(data, "query_id long, doc_id long, rel int")


@pytest.fixture
def case(spark):
    run = _run(spark, [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 20, 1), (2, 21, 2), (9, 1, 1)])
    judged = _qrels(spark, [(1, 11, 1), (1, 99, 2), (1, 10, 0), (2, 21, 3), (3, 30, 1)])
    return run, judged


def test_recall_by_hand(case):
    got = rows(recall_at(*case, [1, 2, 10]), "k", "recall", "precision", "hit_rate", "n_queries")
    third = lambda x: round(x / 3, 6)
    assert got == [(1, 0.0, 0.0, 0.0, 3), (2, third(1.5), third(1.0), third(2), 3), (10, third(1.5), third(0.2), third(2), 3)]
    recalls = [r[1] for r in got]
    assert recalls == sorted(recalls)


def test_mrr_by_hand(case):
    assert rows(mrr(*case), "mrr", "n_queries") == [(round((1 / 2 + 1 / 2) / 3, 6), 3)]


def test_ndcg_by_hand(case):
    one = (1 / math.log2(3)) / (3 + 1 / math.log2(3))
    two = 1 / math.log2(3)
    want = {1: round(one, 6), 2: round(two, 6), 3: 0.0}
    assert dict(rows(ndcg_per_query(*case, 10), "query_id", "ndcg")) == want
    assert ndcg(*case, 10).first().ndcg == pytest.approx(sum(want.values()) / 3, abs=1e-6)
    assert {r.query_id: (r.recall, r.rr) for r in per_query(*case, 10).collect()} == {
        1: (0.5, 0.5), 2: (1.0, 0.5), 3: (0.0, 0.0)}


def test_perfect_run_scores_one(spark):
    judged = _qrels(spark, [(q, d, 1 + d % 2) for q in range(3) for d in range(4)])
    run = _run(spark, [(q, d, r + 1) for q in range(3) for r, d in enumerate([1, 3, 0, 2])])
    assert ndcg(run, judged, 4).first().ndcg == 1.0 and mrr(run, judged).first().mrr == 1.0


def test_no_judged_query(spark, case):
    none = case[1].filter("rel > 5")
    assert rows(recall_at(case[0], none, [1]), "recall", "n_queries") == [(None, 0)]
    assert mrr(case[0], none).first().mrr is None


def test_report_totals(spark):
    scores = spark.createDataFrame([("en", "a", 1.0), ("en", "b", 0.0), ("de", "a", 0.5)], "lang string, source string, m double")
    got = {(r.lang, r.source): (r.value, r.n) for r in report(scores, ["lang", "source"], ["m"]).collect()}
    assert got[("all", "all")] == (0.5, 3) and got[("en", "all")] == (0.5, 2) and got[("all", "a")] == (0.75, 2)
    assert len(got) == 8


def test_compare(spark):
    a = spark.createDataFrame([(i, 0.5) for i in range(40)], "query_id long, value double")
    b = spark.createDataFrame([(i, 0.5 + (0.2 if i < 30 else -0.1)) for i in range(35)], "query_id long, value double")
    got = compare(a, b).first()
    assert (got.n_queries, got.wins, got.ties, got.losses) == (40, 30, 0, 10)
    assert got.low < got.mean_delta < got.high and got.mean_delta == pytest.approx((30 * 0.2 - 5 * 0.1 - 5 * 0.5) / 40)
    assert compare(a.repartition(7), b.repartition(3)).first() == got
    same = compare(a, a).first()
    assert (same.low, same.high, same.ties) == (0.0, 0.0, 40)


def test_poisson_steps_reach_the_last_hash():
    steps = poisson_steps()
    assert 1 - steps[-1] < 2**-28 <= 1 - steps[-2] and len(steps) == 12


def test_sweep_names_every_point(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "zzz")], "query_id long, question string")
    got = sweep(docs, asked, _qrels(spark, [(1, 1, 1)]), [(2, 0), (3, 1)], [1])
    assert rows(got, "size", "k", "recall", "n_queries") == [(2, 1, 0.0, 1), (3, 1, 0.0, 1)]


def test_sweep_equals_single_settings(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 17}" for j in range(30))) for i in range(12)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "w3 w6 w9"), (2, "w5 w10")], "query_id long, question string")
    judged = _qrels(spark, [(1, 3, 1), (2, 5, 1)])
    grid = [(5, 0), (10, 2), (30, 5)]
    both = rows(sweep(docs, asked, judged, grid, [1, 3]), "size", "overlap", "k", "recall")
    single = [r for point in grid for r in rows(sweep(docs, asked, judged, [point], [1, 3]), "size", "overlap", "k", "recall")]
    assert both == sorted(single) and len(both) == 6
