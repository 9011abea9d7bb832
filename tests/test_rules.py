from conftest import rows

from passagecraft.operators.rules import apply_rules


def test_reasons_and_odd_rows(spark):
    good = "\n".join(f"A plain sentence number {i} with enough words." for i in range(5))
    docs = spark.createDataFrame(
        [(1, good, 9, "x"), (2, "FEW WORDS", 9, "x"), (3, None, 9, "x"), (4, "", 9, "x"), (None, good + "\n" + "\n".join(["Same line again."] * 9), 9, "x")],
        "doc_id long, text string, n_words long, reasons string")
    got = apply_rules(docs)
    assert got.columns == ["doc_id", "text", "n_words", "reasons"] and rows(got.select("n_words").distinct(), "n_words") == [(9,)]
    held = {r.doc_id: r.reasons for r in got.collect()}
    assert held[1] == [] and held[2] == ["few words", "capitals", "no sentence ends"] and held[None] == ["repeated lines"]
    assert held[3] == held[4] == ["few words", "odd word length", "no sentence ends"]
    assert rows(apply_rules(docs, {"null": "null > 1", "all": "true"}).select("doc_id", "reasons").filter("size(reasons) != 1"), "doc_id") == []
    assert apply_rules(docs.limit(0)).count() == 0
