import hashlib
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from passagecraft.operators.mixture import mixture

rng = random.Random(3)


def brute(docs, budgets):
    kept = []
    for lang, budget in budgets.items():
        mine = [(int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:7], 16), i is not None, i or 0, len((t or "").split())) for i, t, g in docs if g == lang]
        for h, real, i, _ in mine:
            if sum(n for a, b, c, n in mine if (a, b, c) <= (h, real, i)) <= budget:
                kept.append((lang, i if real else -1))
    return sorted(kept)


def found(df):
    return sorted((lang, -1 if i is None else i) for i, lang in df.select("doc_id", "lang").collect())


@pytest.mark.parametrize("budget", [0, 1, 57, 3000, 10**6])
def test_against_a_plain_running_sum(spark, budget):
    """One group holds 90 % of the rows; ids repeat, some are null, some texts are empty."""
    docs = [(rng.choice([i, i, i, 7, None]) if i % 3 == 0 else i, rng.choice(["a b c", "word " * rng.randint(0, 20), "", None]), "en" if rng.random() < 0.9 else rng.choice(["de", "fr", None]))
            for i in range(500)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, n long, at string").repartition(4)
    budgets = {"en": budget, "de": budget // 2, "xx": 5}
    got = mixture(frame, budgets)
    assert got.columns == frame.columns and found(got) == brute(docs, budgets)


def test_without_broadcasts_and_by_other_weights(spark, no_broadcast):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    got = mixture(docs, {"s": 1000}, by="source", words=F.lit(10))
    want = sorted(range(3000), key=lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:7], 16), i))[:100]
    assert rows(got, "doc_id") == sorted((i,) for i in want)
    assert mixture(docs.limit(0), {"s": 5}, by="source").count() == 0
