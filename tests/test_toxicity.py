"""The toxicity classifier on rows it was not fitted on, and on other partitionings."""

import pytest
from pyspark.sql import functions as F

from passagecraft.operators.toxicity import fit_toxicity, held_out, score_toxicity

FOLDER = "/root/testdata/sf0.1"


def area(rows):
    """The chance that a toxic text scores over another one."""
    scores = sorted((s, y) for s, y in rows)
    below, wins = 0.0, 0.0
    for s in sorted({s for s, _ in scores}):
        tied = [y for t, y in scores if t == s]
        wins += sum(tied) * (below + 0.5 * (len(tied) - sum(tied)))
        below += len(tied) - sum(tied)
    good = sum(y for _, y in scores)
    return wins / (good * (len(scores) - good))


def test_held_out_rows_and_partitions(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    first = fit_toxicity(docs, labels)
    told = score_toxicity(docs, first).join(labels, "doc_id").filter("held_out").select("score", "toxic").collect()
    assert len(told) > 900 and area(told) > 0.97
    kept = [r.toxic for r in told if r.score >= 0.5]
    assert sum(kept) >= 0.6 * sum(r.toxic for r in told) and sum(kept) >= 0.95 * len(kept)
    second = fit_toxicity(docs.repartition(13), labels.repartition(3))
    both = score_toxicity(docs, first).join(score_toxicity(docs, second).withColumnRenamed("score", "other"), "doc_id")
    assert both.agg(F.max(F.abs(F.col("score") - F.col("other")))).first()[0] < 1e-3


def test_odd_rows(spark):
    docs = [(i, "nice words here" if i % 2 else "awful words here", "x") for i in range(40)] + [(None, None, "x"), (100, None, "x"), (101, "", "x"), (1, "nice", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)] + [(100, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = fit_toxicity(frame, labels)
    got = score_toxicity(frame, model)
    assert got.columns == ["doc_id", "held_out", "score"] and got.count() == len(docs)
    by = {r.doc_id: r.score for r in got.collect()}
    assert by[2] > 0.9 and by[3] < 0.1 and by[100] == by[101] == by[None]
    assert score_toxicity(frame.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        fit_toxicity(frame, labels.limit(0))


def test_held_out_is_one_fold(spark):
    share = spark.range(10_000).agg(F.avg(held_out("id").cast("int"))).first()[0]
    assert 0.23 < share < 0.27
