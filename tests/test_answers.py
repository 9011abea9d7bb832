import pytest
from conftest import rows

from passagecraft.functions import sizing
from passagecraft.operators.answers import answer_f1, exact_match, support


def _pred(spark, data):
    return spark.createDataFrame(data, "id string, answer string")


def _gold(spark, data):
    return spark.createDataFrame(data, "id string, gold string")


def test_exact_match_best_of_several(spark):
    pred = _pred(spark, [("a", "The Cat."), ("b", "no"), ("d", "x")])
    gold = _gold(spark, [("a", "dog"), ("a", "the cat"), ("b", "yes"), ("c", "unanswered")])
    assert rows(exact_match(pred, gold), "id", "em") == [("a", 1), ("b", 0), ("c", 0)]


def test_japanese(spark):
    pred = _pred(spark, [("a", "東京 都。"), ("b", "大阪府")])
    gold = _gold(spark, [("a", "東京都"), ("b", "大阪市")])
    assert rows(exact_match(pred, gold, "char"), "id", "em") == [("a", 1), ("b", 0)]
    assert rows(answer_f1(pred, gold, "char"), "id", "f1") == [("a", 1.0), ("b", round(2 / 3, 6))]


@pytest.mark.parametrize("hot", [False, True])
def test_f1_counts_repeats(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(sizing, "HOT_KEY_ROWS", 1)
    pred = _pred(spark, [("a", "b b b c"), ("e", "..."), ("z", "q")])
    gold = _gold(spark, [("a", "b b d"), ("a", "zzz"), ("e", "!"), ("z", "r"), ("n", "x")])
    assert rows(answer_f1(pred, gold), "id", "f1") == [("a", round(2 * 2 / 7, 6)), ("e", 1.0), ("n", 0.0), ("z", 0.0)]


def test_support(spark):
    pred = _pred(spark, [("a", "red blue red"), ("b", "x"), ("c", "")])
    told = spark.createDataFrame([("a", "Blue sky"), ("c", "y")], "id string, context string")
    assert rows(support(pred, told), "id", "support") == [("a", 0.5), ("b", 0.0), ("c", 0.0)]
