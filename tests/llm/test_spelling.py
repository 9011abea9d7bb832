"""Spelling variants against all pairs of words in plain Python, and the index against plain search."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from passagecraft.llm import spelling

rng = random.Random(13)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def judged(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else -1) for w in counts)


def counted(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def found(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def words(n, letters="abÀ", most=9):
    return sorted({"".join(rng.choices(letters, k=rng.randint(5, most))) for _ in range(n)})


@pytest.mark.parametrize("letters, most", [("ab", 9), ("abcÿ", 8), ("aaaaaaab", 40)])
@pytest.mark.parametrize("from_both", [True, False])
def test_near_words_are_all_pairs_one_edit_apart(letters, most, from_both):
    held = words(400, letters, most)
    every = np.arange(len(held))
    asked, kept = (every, every) if from_both else (every[::3], every[::2])
    pairs = [p for way in (True, False) for p in zip(*(x.tolist() for x in spelling.near_words(held, kept, asked, way)))]
    want = {(a, b) for a in asked.tolist() for b in kept.tolist() if one_edit(held[a], held[b])}
    assert want and len(pairs) == len(set(pairs)) and set(pairs) == want


def test_index_orders_suffixes_and_steps():
    held = words(60, "abc", 12)
    symbols, starts, lengths = spelling._coded(held)
    index = spelling.Index(symbols, starts, lengths)
    text = "".join(w + "\0" for w in held)
    suffixes = sorted((text[i : text.index("\0", i) + 1], i) for i in range(len(text)))
    for pattern in ("a\0", "bc", "abca", "cc\0", "aaaaaa"):
        low, high = np.array([0]), np.array([index.n])
        for c in reversed(pattern):
            low, high = index.step(np.array(["\0abc".index(c)]), low, high)
        assert suffixes[low[0] : high[0]] == [s for s in suffixes if s[0].startswith(pattern)]


def test_checksums():
    data = bytes(rng.randrange(256) for _ in range(3000))
    lengths = np.array([0, 1, 5, 64, 65, 900, 3, 63])
    starts = np.cumsum(lengths) - lengths
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(len(lengths))], np.uint32)
    got = spelling.checksums(np.frombuffer(data, np.uint8), starts, lengths, before)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + data[s : s + n]) for i, (s, n) in enumerate(zip(starts, lengths))]


POOL = words(300, "abé", 7)
TEXTS = [" ".join(rng.choices(POOL, [9 / (i % 40 + 1) for i in range(len(POOL))], k=60)) for _ in range(60)] + [
    None, "", "four 12345", "Straße straße STRASSEÉtéÉté", "x×y÷z ×××××× " * 3, "eaúxeaux " * 3, "a" * 5000 + " " + "a" * 4999, "ﬁ œuvre ÀÀÀÀÀ_ÀÀÀÀÀ-ÀÀÀÀÀ"]


@pytest.mark.parametrize("index_words", [50_000, 7])
def test_against_plain_python(spark, index_words):
    """With 7 words an index, halves that many words share are cut into parts."""
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (1, TEXTS[1]), (1, TEXTS[1])] + [(900 + i, "a" * 5000 + " " + "a" * 4999) for i in range(2)]
    frame = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], "doc_id long, text string, word string, form string, n long").repartition(4)
    got = spelling.group_variants(frame, index_words=index_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == judged(counted(docs)) and got.filter("form is not null").count() > 20


def test_roots_follow_forms_to_the_end(spark, no_broadcast):
    """A long chain, and a form that very many words share, without broadcasts."""
    chain = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [(f"v{i}", "w3") for i in range(500)]
    got = dict(rows(spelling.roots(spark.createDataFrame(chain, "word string, form string")), "word", "root"))
    assert len(got) == 540 and set(got.values()) == {"w40"}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(empty).count() == 0
    assert spelling.group_variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0
