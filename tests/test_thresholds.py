import random

from conftest import rows

from passagecraft.operators.thresholds import threshold_sweep

rng = random.Random(14)


def brute(pairs):
    out, total = [], sum(y for _, y in pairs)
    for t in {s for s, _ in pairs}:
        kept = [y for s, y in pairs if s >= t]
        out.append((t, len(kept), sum(kept), round(sum(kept) / len(kept), 6), round(sum(kept) / total, 6) if total else 0.0, round(2 * sum(kept) / (len(kept) + total), 6)))
    return sorted(out)


def sweep(spark, scores, labels):
    got = threshold_sweep(
        spark.createDataFrame(scores, "doc_id long, score double").repartition(5), spark.createDataFrame(labels, "doc_id long, label int"))
    return got, rows(got, "threshold", "n_kept", "n_right", "precision", "recall", "f1")


def test_against_plain_counts(spark):
    scores = [(i, rng.choice([0.5, rng.random(), round(rng.random(), 1)])) for i in range(600)]
    labels = [(i, rng.randint(0, 1)) for i in range(0, 600, 2)]
    known = dict(labels)
    got, held = sweep(spark, [*scores, (1000, None), (1001, float("nan"))], [*labels, (1, None), (1000, 1), (1001, 1), (9999, 1)])
    assert held == brute([(s, known[i]) for i, s in scores if i in known])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan


def test_one_score_holds_most_rows(spark):
    scores = [(i, 0.5 if i % 10 else i / 5000) for i in range(5000)]
    _, held = sweep(spark, scores, [(i, i % 2) for i in range(5000)])
    assert held == brute([(s, i % 2) for i, s in scores])


def test_nothing_to_count(spark):
    assert sweep(spark, [], [(1, 1)])[1] == [] and sweep(spark, [(1, 0.5)], [])[1] == []
    assert sweep(spark, [(1, 0.5), (2, 0.7)], [(1, 0), (2, 0)])[1] == [(0.5, 2, 0, 0.0, 0.0, 0.0), (0.7, 1, 0, 0.0, 0.0, 0.0)]
