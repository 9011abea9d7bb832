import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from passagecraft.functions.ordering import with_rank, with_running

rng = random.Random(3)
VALUES = [(i, rng.randint(0, 40), rng.randint(-5, 5)) for i in range(5000)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(VALUES, "id long, score long, x long").repartition(7)


def test_rank_over_the_whole_table(table):
    want = [(i, n) for n, (i, _, _) in enumerate(sorted(VALUES, key=lambda v: (-v[1], v[0])), 1)]
    assert rows(with_rank(table, F.desc("score"), "id"), "id", "rank") == sorted(want)
    assert with_rank(table.limit(0), "id").count() == 0


def test_running_totals(table):
    total, want = 0, []
    for i, s, x in sorted(VALUES, key=lambda v: (v[1], v[0])):
        total += x
        want.append((i, total))
    got = with_running(table, ["x"], "score", "id")
    assert rows(got, "id", "cum_x") == sorted(want) and got.columns == ["id", "score", "x", "cum_x"]


def test_one_key_holds_nearly_all_rows(spark):
    """Equal keys share a range, told apart ones do not."""
    hot = spark.range(20_000).withColumn("score", F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")))
    ranked = with_rank(hot, "score", "id").select("id", "rank")
    assert ranked.agg(F.max("rank"), F.countDistinct("rank")).first()[:] == (20_000, 20_000)
