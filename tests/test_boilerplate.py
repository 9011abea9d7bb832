import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from passagecraft.operators import boilerplate
from passagecraft.operators.boilerplate import drop_common_lines

rng = random.Random(4)
LINES = [f"line {i}" for i in range(60)] + ["", "  ", "shared by all", "é ü"]


def brute(texts, least):
    held = Counter(line for t in texts if t is not None for line in {x.strip(" ") for x in t.split("\n")} if line)
    out = []
    for i, t in enumerate(texts):
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if held.get(x.strip(" "), 0) < least]
        out.append((i, None if t is None else "\n".join(kept), len(lines) - len(kept)))
    return out


@pytest.fixture(params=["broadcast", "join"])
def way(request, spark):
    if request.param == "join":
        spark.conf.set("spark.passagecraft.broadcastBytes", "0")
    yield
    spark.conf.unset("spark.passagecraft.broadcastBytes")


@pytest.mark.parametrize("least", [1, 2, 9, 10**6])
def test_against_plain_counts(spark, way, least):
    """One line is in every document, also twice in some and with spaces around it."""
    texts = ["\n".join(["shared by all", *rng.choices(LINES, k=rng.randint(0, 12)), " shared by all "]) for _ in range(200)]
    texts += [None, "", "\n", "only here", "\n".join(f"long {i}" for i in range(20_000)) + "\nshared by all", " \nline 1"]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, line string, n int").repartition(4)
    got = drop_common_lines(frame, least, "n_removed")
    assert got.columns == [*frame.columns, "n_removed"]
    assert sorted((r.doc_id, r.text, r.n_removed) for r in got.collect()) == brute(texts, least)
    assert rows(got.select("line", "n").distinct(), "line", "n") == [("x", 5)]


def test_repeated_rows_and_empty_tables(spark, way):
    frame = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (None, "a\nc"), (None, None)], "doc_id long, text string")
    got = drop_common_lines(frame, 2)
    assert sorted(str(r.text) for r in got.collect()) == ["", "", "None", "c"] and got.columns == frame.columns
    assert drop_common_lines(frame.limit(0), 2).count() == 0


def test_hashes_are_looked_up_without_a_copy_of_the_known_ones():
    """Pairs that share one hash are told apart, and a lookup takes memory by the batch."""
    rng = np.random.default_rng(3)
    known_a, known_b = rng.integers(-(2**62), 2**62, 200_000), rng.integers(0, 5, 200_000)
    known_a[:6], known_b[:6] = 7, [9, 8, 1, 2, 3, 4]
    order = np.argsort(known_a)
    known = known_a[order], known_b[order]
    a, b = np.array([7, 7, 7, known[0][-1], 2**62, -(2**62)]), np.array([9, 1, 5, known[1][-1], 0, 0])
    tracemalloc.start()
    assert boilerplate._among(a, b, known).tolist() == [True, True, False, True, False, False]
    assert tracemalloc.get_traced_memory()[1] < known[0].nbytes / 10
    tracemalloc.stop()
    assert not boilerplate._among(a, b, (known[0][:0], known[1][:0])).any()
