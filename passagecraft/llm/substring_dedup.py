"""Removal of word windows that an earlier document has, with a count-min sketch before the exact pass.

Pass 1 fills count-min sketches, one per task, merged block by block. A window is counted
under the smallest hash of the shorter runs of words in it, which neighbouring windows
mostly share, so that a sketch holds a quarter of the keys. A window that two documents
have gives both this key, and a sketch never counts too low: what it has seen in one
document only is not repeated. Pass 2 groups exactly, by a 96-bit key, the windows whose
estimate is two or more. Only these are shuffled; nothing repeated is lost.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from passagecraft.functions.sizing import broadcast_if
from passagecraft.llm.tables import stage
from passagecraft.llm.words import coded_words, mixed, slices, split_words, window_hashes, window_starts, word_hashes

WORDS = 13
SKETCH_ROWS = 2
# Cells per sketch row: one to two per window, four or more per key, within these powers of
# two. Beyond the upper one (32 MB a row) the estimates get looser and more windows go to
# the exact pass; none is lost. Executors with more memory can take a larger one.
LEAST_BITS, MOST_BITS = 16, 28
BLOCK_BITS = 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _keys(texts: pa.Array, size: int):
    """Of each window two hashes, the smallest hash of the runs in it, its text and its first word."""
    counts, codes, words = coded_words(texts)
    hashes = word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
    at, text, within = window_starts(counts, size)
    short = (size + 1) // 2
    runs = window_hashes(hashes, short, 4)
    least = runs[: max(0, len(hashes) - size + 1)].copy()
    for j in range(1, size - short + 1):
        np.minimum(least, runs[j : j + len(least)], out=least)
    return window_hashes(hashes, size, 1)[at], window_hashes(hashes, size, 2)[at], mixed(least[at]), text, within


def _cells(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mixed(key + np.uint64(row * 0x9E3779B9)) >> np.uint64(64 - bits)).astype(np.uint32)


def _bits_of(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct cells as the bytes that hold them and their bits in those."""
    byte = cells >> 3
    start = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
    bit = np.left_shift(1, cells & 7).astype(np.uint8)
    return byte[start], np.bitwise_or.reduceat(bit, start)


class Sketch:
    """Counters of 0, 1 and "2 or more" as two bit sets a row."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros((SKETCH_ROWS, 1 << (bits - 3)), np.uint8)
        self.twice = np.zeros_like(self.once)

    def add(self, key: np.ndarray) -> None:
        if not len(key):
            return
        for row in range(SKETCH_ROWS):
            cells = np.sort(_cells(key, row, self.bits))
            again = cells[1:][cells[1:] == cells[:-1]]
            byte, bit = _bits_of(cells[np.concatenate([[True], cells[1:] != cells[:-1]])])
            self.twice[row, byte] |= self.once[row, byte] & bit
            self.once[row, byte] |= bit
            if len(again):
                byte, bit = _bits_of(np.unique(again))
                self.twice[row, byte] |= bit


def _sketch_blocks(batches: Iterator[pa.RecordBatch], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    sketch = Sketch(bits)
    for batch in slices(batches):
        _, _, least, text, _ = _keys(batch["text"], size)
        # Once for neighbouring windows: what counts is in how many documents a key is.
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        sketch.add(least[new])
    pack = zstandard.ZstdCompressor(level=1)
    step = min(1 << (BLOCK_BITS - 3), sketch.once.shape[1])
    for row in range(SKETCH_ROWS):
        for k, low in enumerate(range(0, sketch.once.shape[1], step)):
            once, twice = sketch.once[row, low : low + step], sketch.twice[row, low : low + step]
            if once.any():
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row], pa.int32()), "block": pa.array([k], pa.int32()),
                    "once": [pack.compress(once.tobytes())], "twice": [pack.compress(twice.tobytes())],
                })


def _merged_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted; one block is held at a time, however many tasks sent it."""
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    at, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_pydict({
            "row": pa.array([at[0]], pa.int32()), "block": pa.array([at[1]], pa.int32()),
            "twice": [pack.compress(twice.tobytes())],
        })

    for batch in batches:
        for r in range(batch.num_rows):
            here = batch["row"][r].as_py(), batch["block"][r].as_py()
            one = np.frombuffer(unpack.decompress(batch["once"][r].as_py()), np.uint8)
            two = np.frombuffer(unpack.decompress(batch["twice"][r].as_py()), np.uint8)
            if here != at:
                if at is not None:
                    yield done()
                at, once, twice = here, one.copy(), two.copy()
            else:
                twice |= two | (once & one)
                once |= one
    if at is not None:
        yield done()


def _sketch(texts: DataFrame, size: int) -> tuple[int, object]:
    """Cells per row as a power of two, and the broadcast bit sets of cells counted twice or more."""
    spark = texts.sparkSession
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(chars / 6 + 1))))
    blocks = texts.mapInArrow(lambda b: _sketch_blocks(b, size, bits), "row int, block int, once binary, twice binary")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    merged = stage(
        blocks.repartition(parts, "row", "block").sortWithinPartitions("row", "block")
        .mapInArrow(_merged_blocks, "row int, block int, twice binary"), "sketch")
    # At most SKETCH_ROWS * 2 ** MOST_BITS bits reach the driver, whatever the corpus holds.
    filled = np.zeros((SKETCH_ROWS, 1 << (bits - 3)), np.uint8)
    step = min(1 << (BLOCK_BITS - 3), filled.shape[1])
    for r in merged.toLocalIterator():
        filled[r["row"], r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(bytes(r["twice"])), np.uint8)
    return bits, spark.sparkContext.broadcast(filled)


def _candidates(batches: Iterator[pa.RecordBatch], size: int, bits: int, filled) -> Iterator[pa.RecordBatch]:
    """Windows estimated to occur twice or more.

    Of equal windows within a slice only the first of the smallest document is sent under
    its key, with its further places there (``more``). In larger documents the window is
    known to be repeated; such rows get a key of their document, as nothing is to be
    compared. So a hot window gives one row per slice.
    """
    table = filled.value
    for batch in slices(batches):
        key, check, least, text, within = _keys(batch["text"], size)
        maybe = np.ones(len(key), bool)
        for row in range(SKETCH_ROWS):
            cells = _cells(least, row, bits)
            maybe &= (table[row, cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
        key, check, text, within = (x[maybe] for x in (key, check, text, within))
        doc = batch["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)[text]
        check = (check >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((within, text, doc, check, key))
        key, check, doc, within, text = (x[order] for x in (key, check, doc, within, text))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        group = np.cumsum(new) - 1
        known = doc > doc[np.flatnonzero(new)][group] if len(doc) else new
        first = new.copy()
        first[1:] |= text[1:] != text[:-1]
        # Places after the first follow it directly, as rows are sorted.
        sent = known | first
        lead = np.flatnonzero(sent)
        n_more = np.diff(np.append(lead, len(sent))) - 1
        ends = np.concatenate([[0], np.cumsum(n_more)]).astype(np.int32)
        more = pa.ListArray.from_arrays(pa.array(ends), pa.array(within[~sent].astype(np.int32)))
        key = np.where(known, mixed(doc.astype(np.uint64)), key)[lead]
        check = np.where(known, 0, check)[lead]
        doc, within, text, known = (x[lead] for x in (doc, within, text, known))
        # Back to the order of the texts: rows of one document side by side take less room in the shuffle.
        back = np.lexsort((within, text))
        digest = batch["text_key"].to_numpy(zero_copy_only=False)[text]
        yield pa.RecordBatch.from_arrays([
            pa.array(key[back].view(np.int64)), pa.array(check[back].astype(np.uint32).view(np.int32)), pa.array(doc[back]),
            pa.array(digest[back].astype(np.int64)), pa.array(within[back].astype(np.int32)), pa.array(known[back]),
            more.take(pa.array(back)),
        ], ["key", "check", "doc_id", "text_key", "at", "known", "more"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a document to runs of places that follow each other."""
    for batch in batches:
        out = []
        for row in batch["at"]:
            at = np.unique(row.values.to_numpy(zero_copy_only=False))
            edge = np.flatnonzero(np.diff(at) != 1)
            low, high = at[np.concatenate([[0], edge + 1])], at[np.append(edge, len(at) - 1)]
            out.append([{"start": int(x), "n": int(y - x + 1)} for x, y in zip(low, high)])
        runs = pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], runs], ["gone_id", "gone_key", "runs"])


def repeated_starts(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """First words of windows that a document with a smaller id has too.

    ``gone_id``, ``gone_key`` (hash of the text) and ``runs`` (``start``, ``n``).
    """
    texts = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    bits, filled = _sketch(texts.select("text"), size)
    schema = "key long, check int, doc_id long, text_key long, at int, known boolean, more array<int>"
    found = texts.mapInArrow(lambda b: _candidates(b, size, bits, filled), schema)
    first = F.min("doc_id").over(Window.partitionBy("key", "check"))
    gone = found.withColumn("first", first).filter("doc_id > first or known")
    places = gone.select("doc_id", "text_key", F.explode(F.concat(F.array("at"), "more")).alias("at"))
    each = places.groupBy("doc_id", "text_key").agg(F.collect_list("at").alias("at"))
    return stage(each.mapInArrow(_runs, "gone_id long, gone_key long, runs array<struct<start: int, n: int>>"), "repeated")


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Texts and the runs of their repeated windows to what is kept of them."""
    for batch in slices(batches):
        counts, flat = split_words(batch["text"])
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        lengths = pc.fill_null(pc.list_value_length(batch["runs"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        runs = batch["runs"].flatten()
        place = np.repeat(ends - counts, lengths) + runs.field("start").to_numpy(zero_copy_only=False)
        step = np.zeros(total + 1, np.int64)
        np.add.at(step, place, 1)
        np.add.at(step, place + runs.field("n").to_numpy(zero_copy_only=False) + size - 1, -1)
        gone = np.cumsum(step)[:total] > 0
        bounds = np.concatenate([[0], np.cumsum(gone)])
        removed = bounds[ends] - bounds[ends - counts]
        left = flat.filter(pa.array(~gone))
        cuts = np.concatenate([[0], np.cumsum(counts - removed)]).astype(np.int32)
        kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), left), " ")
        spans = []
        for low, n in zip(ends - counts, counts):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[low : low + n], [False]]).astype(np.int8)))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts), pa.array(removed.astype(np.int64)), kept,
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            ["doc_id", "n_words", "n_removed", "kept_text", "removed"],
        )


def remove_repeated(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """One row per document with what is left of its text.

    Every word that a repeated window covers goes: a window of ``size`` words repeats if its
    words also start somewhere in a document with a smaller ``doc_id``. Returns ``doc_id``,
    ``n_words``, ``n_removed``, ``kept_text`` (words joined by one space) and ``removed``
    (word spans, end exclusive).

    A null text has no words. A null ``doc_id`` is neither smaller nor larger than others:
    such a row is returned whole and takes nothing from others. Rows with equal ``doc_id``
    take nothing from each other. Other columns are not looked at.
    """
    gone = repeated_starts(docs, size)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    on = (F.col("doc_id") == F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_key"))
    return texts.join(broadcast_if(gone), on, "left").select("doc_id", "text", "runs").mapInArrow(
        lambda b: _cut(b, size),
        "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start: int, end: int>>",
    )
