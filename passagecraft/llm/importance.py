"""Importance resampling towards a target: n-gram counts in buckets, gains, and a Gumbel draw.

Inside a task the n-grams of a batch are interned in an open-addressed numpy table, so that
the bucket of each distinct n-gram is computed once and each occurrence is a slot number.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.ordering import with_rank
from passagecraft.llm.tables import stage
from passagecraft.llm.words import slices

BUCKETS, GRAMS = 10_000, 1
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024

# The primes of xxHash64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = ((_LOWER >= 48) & (_LOWER <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_BYTES >= 128)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text starts, with the end."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held and len(texts) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of all texts, one space after each: the bytes, starts and lengths, and how many words each text has.

    A word is a run of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased.
    """
    data, cuts = text_bytes(texts)
    data = _LOWER[data]
    inside = _IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # A word ends with its text, also where the next text goes on at once.
    heads = cuts[:-1][cuts[:-1] < cuts[1:]]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    rank = np.concatenate([[0], np.cumsum(inside)])
    lengths = np.diff(np.append(rank[starts], rank[-1]))
    counts = np.diff(np.searchsorted(starts, cuts))
    out = np.full(int(lengths.sum()) + len(starts), 32, np.uint8)
    new = np.cumsum(lengths + 1) - (lengths + 1)
    out[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = data[inside]
    return out, new, lengths, counts


def grams_of(starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of 1 to ``most`` words of one text: where each starts in the bytes, how long it is, and its text."""
    ends, text = starts + lengths, np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(starts))
    found = []
    for n in range(1, most + 1):
        at = np.flatnonzero(left >= n)
        found.append((starts[at], ends[at + n - 1] - starts[at], text[at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _rolled(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    return np.ndarray(len(data) + 8, "<u8", padded.tobytes(), strides=(1,))


def hashes(data: np.ndarray, lanes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxHash64 with seed 0 of each piece of ``data``; those of 32 bytes or more go through the library."""
    out = P5 + lengths.astype(np.uint64)
    at, left = starts.copy(), lengths.copy()
    short = lengths < 32
    for _ in range(3):
        i = np.flatnonzero(short & (left >= 8))
        if not len(i):
            break
        k = _rolled(lanes[at[i]] * P2, 31) * P1
        out[i] = _rolled(out[i] ^ k, 27) * P1 + P4
        at[i] += 8
        left[i] -= 8
    i = np.flatnonzero(short & (left >= 4))
    if len(i):
        out[i] = _rolled(out[i] ^ ((lanes[at[i]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[i] += 4
        left[i] -= 4
    for _ in range(3):
        i = np.flatnonzero(short & (left >= 1))
        if not len(i):
            break
        out[i] = _rolled(out[i] ^ ((lanes[at[i]] & np.uint64(0xFF)) * P5), 11) * P1
        at[i] += 1
        left[i] -= 1
    out = (out ^ (out >> np.uint64(33))) * P2
    out = (out ^ (out >> np.uint64(29))) * P3
    out ^= out >> np.uint64(32)
    view = memoryview(data)
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxhash.xxh64_intdigest(view[starts[i] : starts[i] + lengths[i]])
    return out


def same_bytes(data: np.ndarray, lanes: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the pieces of equal ``lengths`` that start at ``a`` and at ``b`` hold the same bytes."""
    same = np.ones(len(a), bool)
    at = np.flatnonzero((a != b) & (lengths > 0))
    for done in range(0, 64, 8):
        if not len(at):
            return same
        here = np.minimum(lengths[at] - done, 8)
        mask = np.uint64(2**64 - 1) >> ((8 - here) * 8).astype(np.uint64)
        equal = ((lanes[a[at] + done] ^ lanes[b[at] + done]) & mask) == 0
        same[at] = equal
        at = at[equal & (lengths[at] > done + 8)]
    for i in at.tolist():
        n = lengths[i]
        same[i] = bytes(data[a[i] : a[i] + n]) == bytes(data[b[i] : b[i] + n])
    return same


def intern(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hash_of=hashes) -> tuple[np.ndarray, np.ndarray]:
    """A slot for each n-gram, equal ones sharing it: slot by occurrence, and the first occurrence met in each slot, else -1.

    Linear probing, all occurrences a step at a time: those on an empty slot claim it, one of
    them wins; those whose bytes equal the owner's stay, the others go on to the next slot.
    """
    lanes = _lanes(data)
    size = 1 << max(4, int(2 * len(starts) - 1).bit_length())
    owner = np.full(size, -1, np.int64)
    keys = hash_of(data, lanes, starts, lengths)
    slots = (keys & np.uint64(size - 1)).astype(np.int64)
    todo = np.arange(len(starts))
    while len(todo):
        at = slots[todo]
        free = owner[at] < 0
        owner[at[free]] = todo[free]
        held = owner[at]
        equal = (keys[held] == keys[todo]) & (lengths[held] == lengths[todo])
        like = np.flatnonzero(equal)
        equal[like] = same_bytes(data, lanes, starts[todo[like]], starts[held[like]], lengths[todo[like]])
        todo = todo[~equal]
        slots[todo] = (slots[todo] + 1) & (size - 1)
    return slots, owner


class Interned:
    """The n-grams of a batch of texts: ``slot`` and ``text`` by occurrence, ``bucket`` and ``count`` by slot."""

    def __init__(self, texts: pa.Array, most: int, buckets: int):
        data, starts, lengths, self.n_words = words_of(texts)
        starts, lengths, self.text = grams_of(starts, lengths, self.n_words, most)
        self.slot, owner = intern(data, starts, lengths)
        self.count = np.bincount(self.slot, minlength=len(owner))
        self.bucket = np.zeros(len(owner), np.int64)
        view = memoryview(data)
        used = np.flatnonzero(owner >= 0)
        low, high = starts[owner[used]], (starts + lengths)[owner[used]]
        self.bucket[used] = [zlib.crc32(view[a:b]) % buckets for a, b in zip(low.tolist(), high.tolist())]


def _counted(batches: Iterator[pa.RecordBatch], most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in slices(batches):
        held = Interned(batch["text"], most, buckets)
        np.add.at(total, held.bucket, held.count)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(at), "n": pa.array(total[at])})


def bucket_counts(texts: DataFrame, most: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket. Each task sums up first; a row per bucket reaches the driver."""
    counted = texts.select("text").mapInArrow(lambda b: _counted(b, most, buckets), "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares in target and source, by bucket, rounded down."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    ratio = (t + 1) * (float(source.sum()) + n) / ((s + 1) * (float(target.sum()) + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gains, most: int) -> Iterator[pa.RecordBatch]:
    gain = gains.value
    for batch in slices(batches):
        held = Interned(batch["text"], most, len(gain))
        n = np.bincount(held.text, minlength=batch.num_rows).astype(np.int64)
        # Sums of whole numbers; doubles would round beyond 2**53.
        total = np.zeros(batch.num_rows, np.int64)
        np.add.at(total, held.text, gain[held.bucket[held.slot]])
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "n_words": pa.array(held.n_words.astype(np.int64)), "n_features": pa.array(n), "weight": pa.array(weight)})


def weigh(docs: DataFrame, target: DataFrame, most: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of each document's features, 0 without any.

    Features are all runs of 1 to ``most`` words, repeats counted. ``target`` has a column
    ``text``. Reads ``docs`` twice; what passes between is a number per bucket.
    """
    gains = docs.sparkSession.sparkContext.broadcast(gains_of(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets)))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _weighed(b, gains, most), "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, most: int = GRAMS, buckets: int = BUCKETS,
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """Every document with its weight, noisy ``score`` and, if drawn, its ``rank``; else a null rank.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred (rounded
    down) are drawn: the highest scores, equal ones by smaller ``doc_id``. A score is the
    weight plus Gumbel noise that depends on seed and ``doc_id`` alone. A null text has no
    words; a null ``doc_id`` counts as an empty one for the noise and comes first among
    equals. Rows with the same ``doc_id`` and text are separate documents of the same score,
    in any order among themselves. Without target texts, all gains come from the documents.
    Columns: ``doc_id, n_words, n_features, weight, score, rank``.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stage(weigh(docs, target, most, buckets).withColumn("score", F.col("weight") + noise), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    n = able.agg(F.count(F.lit(1))).first()[0]
    ranked = with_rank(able, F.desc("score"), F.asc_nulls_first("doc_id"), name="_rank")
    drawn = ranked.withColumn("rank", F.when(F.col("_rank") <= percent * n // 100, F.col("_rank"))).drop("_rank")
    return drawn.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
