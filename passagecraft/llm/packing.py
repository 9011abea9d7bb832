"""Packing of tokenised documents into sequences of a fixed length by bin completion.

Only the lengths of pieces matter to the search, and there are at most ``capacity`` of
them. So the search runs on how often each length occurs, a table whose size does not
depend on the corpus. It yields patterns (which lengths share a sequence) and how often
each is used; pieces then take their places in them by rank within their length.
"""

from __future__ import annotations

import ctypes
import sys
import types
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from passagecraft.llm.tables import stage
from passagecraft.llm.words import coded_words, slices

CAPACITY = 2048
END_ID = 0
# Words whose ids a worker remembers, about 200 bytes each.
REMEMBERED_WORDS = 1_000_000
# Fillings tried per sequence, steps spent on finding them, and nodes of the whole search.
FILLINGS, FILLING_STEPS, SEARCH_NODES = 4, 400, 60_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class WordIds:
    """Token ids by words between ASCII white space.

    For tokenizers that drop white space and never join across it the ids of a text are
    those of its words in a row, so that each distinct word is encoded once. Up to
    ``most`` words are remembered, their ids in one array; others are encoded when they come.
    """

    def __init__(self, definition: str, most: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.rows = Tokenizer.from_str(definition), most, {}
        self.pool, self.used = np.zeros(1 << 16, np.uint16), 0
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = []
        for low in range(0, len(words), 10_000):
            ids.extend(x.ids for x in self.tokenizer.encode_batch_fast(words[low : low + 10_000], add_special_tokens=False))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))

    def _remember(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        low, first = len(self.rows), self.used
        while first + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while low + len(words) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.pool[first : first + len(ids)] = ids
        self.used += len(ids)
        self.starts[low : low + len(words)] = first + np.cumsum(sizes) - sizes
        self.sizes[low : low + len(words)] = sizes
        self.rows.update(zip(words, range(low, low + len(words))))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each word start in the array that comes third, and how many there are."""
        rows = np.fromiter((self.rows.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(rows < 0)
        if not len(new):
            return self.starts[rows], self.sizes[rows], self.pool
        strange = [words[i] for i in new.tolist()]
        sizes, ids = self._encoded(strange)
        if len(self.rows) + len(strange) <= self.most and (not len(ids) or ids.max() < 1 << 16):
            rows[new] = np.arange(len(self.rows), len(self.rows) + len(strange))
            self._remember(strange, sizes, ids)
            return self.starts[rows], self.sizes[rows], self.pool
        starts, counts = self.starts[rows], self.sizes[rows]
        starts[new], counts[new] = self.used + np.cumsum(sizes) - sizes, sizes
        return starts, counts, np.concatenate([self.pool[: self.used], ids])


def _encoder(definition: str, most: int) -> WordIds:
    """The encoder of this worker process, kept from task to task."""
    held = sys.modules.setdefault("_passagecraft_word_ids", types.ModuleType("_passagecraft_word_ids"))
    if getattr(held, "made_for", None) != (definition, most):
        held.made_for, held.encoder = (definition, most), WordIds(definition, most)
    return held.encoder


def _trim() -> None:
    """What the tokenizer's threads have freed goes back to the system, as the JVM beside needs room too."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def token_ids(texts: pa.Array, encoder: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each text has with the closing one, and all ids in a row."""
    counts, codes, words = coded_words(texts)
    starts, sizes, pool = encoder.of(words.to_pylist())
    each, ends = sizes[codes].astype(np.int64), np.cumsum(counts)
    last = np.cumsum(each)
    total = np.diff(np.concatenate([[0], np.concatenate([[0], last])[ends]]))
    flat = pool[np.repeat(starts[codes] - (last - each), each) + np.arange(int(last[-1]) if len(last) else 0)]
    return total + 1, np.insert(flat.astype(np.uint32), np.cumsum(total), END_ID)


def _pieces(batches: Iterator[pa.RecordBatch], definition, capacity: int, with_ids: bool, remembered: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(definition.value, remembered)
    for batch in slices(batches):
        sizes, flat = token_ids(batch["text"], encoder)
        _trim()
        flat = np.ascontiguousarray(flat.astype("<u4"))
        n = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * capacity
        length = np.minimum(capacity, sizes[doc] - start)
        low = (np.cumsum(sizes) - sizes)[doc] + start
        view = memoryview(flat).cast("B")
        crc = [zlib.crc32(view[4 * a : 4 * (a + k)]) for a, k in zip(low.tolist(), length.tolist())]
        out = {
            "doc_id": batch["doc_id"].take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
            "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
        }
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))
        yield pa.RecordBatch.from_pydict(out)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, remembered: int = REMEMBERED_WORDS) -> DataFrame:
    """Token counts and checksums of documents, those over ``capacity`` in pieces; ``ids`` on request."""
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _pieces(b, definition, capacity, with_ids, remembered), schema)


def fillings(lengths: list[int], left: Counter, room: int, most: int = FILLINGS, steps: int = FILLING_STEPS) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with pieces that are left, the fullest first.

    Larger pieces are tried first. A filling to which another piece that is left could be
    added, or of the same sum as one with larger pieces found before, is dominated and not
    returned. The search ends at the first full one, or after ``steps`` steps.
    """
    found: dict[int, tuple[int, ...]] = {}
    spent = 0

    def search(high: int, room: int, taken: tuple[int, ...]) -> bool:
        nonlocal spent
        at = bisect_right(lengths, min(high, room)) - 1
        fits = False
        used = Counter(taken)
        while at >= 0:
            spent += 1
            size = lengths[at]
            if left[size] > used[size]:
                fits = True
                if search(size, room - size, (*taken, size)):
                    return True
            if spent > steps:
                break
            at -= 1
        if not fits:
            found.setdefault(room, taken)
        return room == 0 or spent > steps

    search(room, room, ())
    return [found[r] for r in sorted(found)[:most]]


def best_fit(counts: Counter, capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Each largest piece with the largest ones that still fit: the first incumbent."""
    left, plan, bins = Counter(counts), [], 0
    lengths = sorted(left)
    while lengths:
        taken, used = (lengths[-1],), Counter([lengths[-1]])
        room = capacity - lengths[-1]
        while (at := bisect_right(lengths, room) - 1) >= 0:
            while at >= 0 and left[lengths[at]] <= used[lengths[at]]:
                at -= 1
            if at < 0:
                break
            taken, room = (*taken, lengths[at]), room - lengths[at]
            used[lengths[at]] += 1
        times = min(left[s] // n for s, n in used.items())
        plan.append((taken, times))
        bins += times
        left.subtract({s: n * times for s, n in used.items()})
        lengths = [s for s in lengths if left[s] > 0]
    return plan, bins


def complete(counts: Counter, capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used, over all pieces of the given lengths.

    Depth-first branch and bound: the largest piece left gets each of its undominated
    fillings in turn, used as often as the counts allow. A branch whose waste so far leaves
    no hope of fewer sequences than the incumbent is cut. Ends when the bound
    ceil(sum / capacity) is met or after ``nodes`` nodes, with the best plan found.
    """
    counts = Counter({s: n for s, n in counts.items() if n > 0})
    total = sum(s * n for s, n in counts.items())
    least = -(-total // capacity)
    best, most = best_fit(counts, capacity)
    if most <= least:
        return best

    def branches(left: Counter, lengths: list[int]):
        size = lengths[-1]
        left[size] -= 1
        options = fillings(lengths, left, capacity - size)
        left[size] += 1
        return iter([(size, *option) for option in options])

    left, lengths, plan, bins, waste = Counter(counts), sorted(counts), [], 0, 0
    stack = [branches(left, lengths)]
    while stack and nodes and most > least:
        nodes -= 1
        pattern = next(stack[-1], None)
        if pattern is None:
            stack.pop()
            if plan:
                undone, times = plan.pop()
                for s in undone:
                    left[s] += times
                bins, waste = bins - times, waste - times * (capacity - sum(undone))
                lengths = sorted(s for s, n in left.items() if n > 0)
            continue
        used = Counter(pattern)
        times = min(left[s] // n for s, n in used.items())
        lost = times * (capacity - sum(pattern))
        if waste + lost > (most - 1) * capacity - total:
            continue
        left.subtract({s: n * times for s, n in used.items()})
        plan.append((pattern, times))
        bins, waste = bins + times, waste + lost
        lengths = [s for s in lengths if left[s] > 0]
        if lengths:
            stack.append(branches(left, lengths))
        else:
            if bins < most:
                best, most = list(plan), bins
            stack.append(iter(()))
    return best


def _places(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length the ranges of ranks that a pattern takes, sorted by length and rank."""
    rows, taken, base = [], Counter(), 0
    for pattern, times in plan:
        offset = 0
        for size, n in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, taken[size], n, base, offset))
            taken[size] += n * times
            offset += n * size
        base += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(["length", "rank", "each", "sequence", "offset"], columns))


def _placed(batches: Iterator[pa.RecordBatch], places) -> Iterator[pa.RecordBatch]:
    at = places.value
    if len(at["rank"]):
        keys = (at["length"] << 44) + at["rank"]
    for batch in batches:
        length, rank = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        k = np.searchsorted(keys, (length << 44) + rank, side="right") - 1 if batch.num_rows else np.zeros(0, np.int64)
        past = rank - at["rank"][k]
        keep = [c for c in batch.schema.names if c != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in keep), pa.array(at["sequence"][k] + past // at["each"][k]),
             pa.array(at["offset"][k] + past % at["each"][k] * length)],
            [*keep, "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, remembered: int = REMEMBERED_WORDS) -> DataFrame:
    """Pieces of all documents with the sequence each lies in and its offset there.

    Columns: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and ``ids``
    on request. A null or empty text is its closing id alone. Rows with equal or null
    ``doc_id`` are packed as separate documents. Other columns are not looked at. A worker
    remembers the ids of ``remembered`` words; fewer take less memory and more time.
    """
    spark = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, capacity, with_ids, remembered), "pieces")
    # Ranks within a length are taken per bucket, as many documents may have one length.
    buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = stage(cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # One row per length, at most ``capacity`` of them.
    lengths = Counter({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()})
    places = spark.sparkContext.broadcast(_places(complete(lengths, capacity)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        cut.withColumn("place", F.row_number().over(within))
        .join(base, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("place") - 1)
    )
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return ranked.select(*keep, "rank").mapInArrow(
        lambda b: _placed(b, places), schema + ", sequence_id long, offset long")
