from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from passagecraft.functions.text import normal_answer, numbered, sentences, tokens, unnest, with_runs
from passagecraft.operators.chunk import chunk, chunk_sentences


def _docs(spark, *texts):
    return spark.createDataFrame(
        [(i, t, "xx", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")


def _one(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first().x


def test_units(spark):
    assert _one(spark, tokens("text"), "Über-Größe, 3x!") == ["über", "größe", "3x"]
    assert _one(spark, tokens("text", "char"), "日本 語　A𠮷") == ["日", "本", "語", "a", "𠮷"]
    assert _one(spark, tokens("text", "pair"), "日本語 A𠮷b") == ["日本", "本語", "a𠮷", "𠮷b"]
    assert _one(spark, tokens("text"), "!?") == []


def test_sentences(spark):
    assert _one(spark, sentences("text"), "One. Two!  Three?\n\nFour 3.5") == ["One.", "Two!", "Three?", "Four 3.5"]
    assert _one(spark, sentences("text"), "東京です。京都です。") == ["東京です。", "京都です。"]


def test_normal_answer(spark):
    assert _one(spark, normal_answer("text"), " The  “Cat”, sat. ") == "the cat sat"
    assert _one(spark, normal_answer("text", "char"), "東 京。") == "東京"


def test_runs_count_items(spark):
    @settings(max_examples=6, deadline=None)
    @given(st.lists(st.lists(st.sampled_from("abcd"), max_size=12), min_size=1, max_size=6))
    def check(lists):
        df = with_runs(spark.createDataFrame(list(enumerate(lists)), "i int, xs array<string>"), "xs", "runs")
        for r in df.select("i", "runs", numbered("runs").alias("n")).collect():
            assert {x.item: x.n for x in r.runs} == Counter(lists[r.i])
            assert len(set(r.n)) == len(r.n) == len(lists[r.i])

    check()


def test_unnest_drops_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, xs array<string>")
    assert [tuple(r) for r in unnest(df, ["i"], "xs", "x", "at").collect()] == [(1, 0, "a"), (1, 1, "b")]


def test_word_passages_cover_the_text(spark):
    @settings(max_examples=6, deadline=None)
    @given(st.integers(0, 40), st.integers(1, 9), st.integers(0, 8))
    def check(n, size, overlap):
        overlap = min(overlap, size - 1)
        words = [f"w{i}" for i in range(n)]
        got = chunk(_docs(spark, " ".join(words)), size, overlap).orderBy("chunk_no").collect()
        seen = []
        for i, r in enumerate(got):
            part = r.chunk.split(" ")
            assert r.chunk_no == i and len(part) <= size and r.start == i * (size - overlap)
            assert part == words[r.start : r.start + len(part)]
            seen += part if not seen else part[overlap:]
        assert seen == words

    check()


def test_character_passages(spark):
    got = chunk(_docs(spark, "日本語の文章です", ""), 4, 1, "char").orderBy("chunk_no").collect()
    assert [r.chunk for r in got] == ["日本語の", "の文章で", "です"]


def test_sentence_passages_hold_whole_sentences(spark):
    text = "Aaaa. Bb. Cccccc. " + "D" * 30 + ". E."
    got = [r.chunk for r in chunk_sentences(_docs(spark, text, " "), 12).orderBy("chunk_no").collect()]
    assert got == ["Aaaa. Bb.", "Cccccc.", "D" * 30 + ".", "E."]


def test_passages_need_no_shuffle(spark):
    for df in (chunk(_docs(spark, "a b")), chunk_sentences(_docs(spark, "a b"))):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.filter(F.col("chunk").isNull()).count() == 0


def test_runs_are_sorted_and_counted_in_place(spark):
    """By the bytes of items, the length of the array beside them; a null array has no runs and no length."""
    given = [(0, ["b", "é", "a", "b", "z"]), (1, []), (2, None), (3, ["東", "z", "東"])]
    df = with_runs(spark.createDataFrame(given, "i int, xs array<string>"), "xs", "runs", "n")
    got = {r.i: (r.n, [(x.item, x.n) for x in r.runs]) for r in df.collect()}
    assert got == {0: (5, [("a", 1), ("b", 2), ("z", 1), ("é", 1)]), 1: (0, []), 2: (None, []), 3: (3, [("z", 1), ("東", 2)])}
    assert df.schema["runs"].dataType.simpleString() == "array<struct<item:string,n:int>>"
