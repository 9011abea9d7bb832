"""Importance resampling against a version in plain Python, and its table against dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import rows

from passagecraft.llm import importance

rng = random.Random(12)
TEXTS = ["", "A b-c  a", "é\x00É1 Ünïcode_x", "word", " ", "one\ntwo", "x" * 500 + " " + "x" * 500 + " " + "y" * 40, "𝔘😀 😀𝔘"]
TEXTS += [" ".join("".join(rng.choices("abcé", k=rng.randint(1, 40))) for _ in range(rng.randint(0, 60))) for _ in range(80)]


def features(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, target, most, buckets, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    source = Counter(bucket(f) for _, t in docs for f in features(t, most)[0])
    wanted = Counter(bucket(f) for t in target for f in features(t, most)[0])
    s, t = sum(source.values()), sum(wanted.values())
    out = []
    for doc_id, text in docs:
        held, n_words = features(text, most)
        gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in map(bucket, held)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n_words, len(held), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = i
    return sorted(map(tuple, out))


@pytest.mark.parametrize("most, percent", [(1, 10), (3, 55)])
def test_against_plain_python(spark, most, percent):
    docs = list(enumerate(TEXTS))
    target = [*TEXTS[8:30], None, "b a"]
    got = importance.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"),
        most, 97, percent, 20, 7)
    held = sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=lambda r: r[0])
    assert held == brute(docs, target, most, 97, percent, 20, 7)


def test_hashes_are_xxhash64():
    pieces = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(40), 100, 1000]]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces])
    got = importance.hashes(data, importance._lanes(data), np.cumsum(lengths) - lengths, lengths)
    assert got.tolist() == [xxhash.xxh64_intdigest(p) for p in pieces]


@pytest.mark.parametrize("hash_of", [importance.hashes, lambda d, x, s, n: np.full(len(s), 5, np.uint64)])
def test_interning_compares_bytes(hash_of):
    """Slots are right even if all hashes are equal."""
    pieces = [rng.choice(["a", "ab", "abcdefgh", "abcdefghi", "abcdefgh" * 9 + "x", "abcdefgh" * 9 + "y", ""]).encode() for _ in range(300)]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces])
    slot, owner = importance.intern(data, np.cumsum(lengths) - lengths, lengths, hash_of)
    assert len(set(zip(pieces, slot.tolist()))) == len(set(pieces)) == len(set(slot.tolist()))
    assert [pieces[o] for o in owner[slot]] == pieces


def test_words_end_with_their_text():
    data, starts, lengths, counts = importance.words_of(pa.array(["x", "aB", "c", "", "dé", "", "é e"])[1:])
    assert [bytes(data[a : a + n]).decode() for a, n in zip(starts, lengths)] == ["ab", "c", "dé", "é", "e"]
    assert counts.tolist() == [1, 1, 0, 1, 0, 2] and bytes(data) == "ab c dé é e ".encode()


def test_odd_rows(spark):
    text = " ".join(["word"] * 30)
    docs = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "few words"), (5, " ".join(f"w{i}" for i in range(100_000)))]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], "doc_id long, text string, rank string, score string, n string")
    target = spark.createDataFrame([(None, "a"), ("", "b")], "text string, bucket string")
    got = importance.resample(frame, target, percent=100)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    ranks = {r.doc_id: r["rank"] for r in got.collect()}
    assert got.count() == len(docs) and ranks[2] is ranks[3] is ranks[4] is None and ranks[5]
    assert sorted(r["rank"] for r in got.filter("rank is not null").collect()) == [1, 2, 3, 4]
    assert rows(got.filter("n_words = 0"), "weight", "n_features") == [(0, 0), (0, 0)]
    assert importance.resample(frame.limit(0), target).count() == 0
    assert importance.resample(frame, target.limit(0)).count() == len(docs)


def test_the_draw_favours_the_target(spark):
    """Documents in the target's words are drawn far more often than others."""
    mine, other = [f"m{i}" for i in range(50)], [f"o{i}" for i in range(50)]
    docs = [(i, " ".join(rng.choices(mine if i % 10 == 0 else other, k=40))) for i in range(1000)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(" ".join(mine),)] * 200, "text string"))
    drawn = [r.doc_id for r in got.filter("rank is not null").collect()]
    assert len(drawn) == 100 and sum(d % 10 == 0 for d in drawn) >= 95
