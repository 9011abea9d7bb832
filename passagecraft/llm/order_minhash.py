"""Near-duplicate documents by order MinHash, verified by banded alignment.

A text is the sequence of its k-mers (runs of five words), each labelled with how often it
occurred before, so that all are distinct. A sketch takes the few k-mers of smallest hash
and keeps them in the order of the text: two texts share a sketch if the same k-mers are
smallest and in the same order, which follows their edit similarity. Texts that share a
sketch, directly or through others, form a family; within a family, blocks of texts are
compared and pairs that share a sketch are verified.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.sizing import broadcast_if, match
from passagecraft.llm.components import components
from passagecraft.llm.tables import stage
from passagecraft.llm.words import coded_words, mixed, odd_factors, slices, window_hashes, window_starts, word_hashes

WORDS, SIMILARITY = 5, 0.8
# Sketches per text and k-mers per sketch. A pair of long texts of similarity s shares one
# sketch with probability s ** 5, and at 0.8 none of 24 with probability 7e-5.
SKETCHES, LEAST = 24, 5
# For short texts sketches take fewer k-mers: (k-mers per sketch, fewest and most k-mers of a
# text). The ranges overlap so that two texts at 0.8 or more always have a kind in common.
KINDS = ((1, 1, 12), (2, 10, 25), (LEAST, 20, None))
# Texts and words in a block of a family; larger families are compared block by block.
BLOCK_TEXTS, BLOCK_WORDS = 500, 1_000_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def labelled_kmers(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and k-mers per text, and the hashes of all k-mers in order, labelled by occurrence.

    A text of fewer than ``size`` words, but one at least, is one k-mer.
    """
    counts, codes, words = coded_words(texts)
    hashes = word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
    at, text, _ = window_starts(counts, size)
    kmer, n = window_hashes(hashes, size, 7)[at], np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.cumsum(counts) - counts
        whole = [mixed(np.add.reduce(hashes[first[t] : first[t] + counts[t]] * odd_factors(size, 7)[: counts[t]])[None])[0] for t in short]
        place = np.searchsorted(text, short)
        kmer, text = np.insert(kmer, place, np.array(whole, np.uint64)), np.insert(text, place, short)
        n[short] = 1
    order = np.lexsort((kmer, text))
    new = np.ones(len(kmer), bool)
    new[1:] = (kmer[order][1:] != kmer[order][:-1]) | (text[order][1:] != text[order][:-1])
    run = np.arange(len(kmer))
    before = np.empty(len(kmer), np.int64)
    before[order] = run - np.maximum.accumulate(np.where(new, run, 0))
    return counts, n, mixed(kmer + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(kmers: np.ndarray, n: int = SKETCHES) -> np.ndarray:
    """The sketches of one text of each of the ``KINDS`` that its length asks for, each hashed to one number."""
    found = [_one_kind(kmers, n, least) for _, least in _kinds(len(kmers))]
    return np.concatenate(found) if found else np.arange(n, dtype=np.int64)


def _kinds(n: int) -> list[tuple[int, int]]:
    """Place (0 or 1) and k-mers of each kind of sketch of a text of ``n`` k-mers, by place.

    Kinds take turns in the places; the first and the third never meet in a text.
    """
    return sorted((k % 2, least) for k, (least, low, high) in enumerate(KINDS) if low <= n <= (high or n))


def _one_kind(kmers: np.ndarray, n: int, least: int) -> np.ndarray:
    seeds, factors = odd_factors(n, 11), odd_factors(LEAST, 13)
    value = (kmers[None, :] ^ seeds[:, None]) * np.uint64(0x9FB21C651E98DF25)
    value ^= value >> np.uint64(28)
    value *= np.uint64(0xD6E8FEB86659FD93)
    take = min(least, len(kmers))
    place = np.argpartition(value, take - 1, axis=1)[:, :take] if take < len(kmers) else np.tile(np.arange(take), (n, 1))
    chosen = kmers[np.sort(place, axis=1)]
    return mixed((chosen * factors[:take]).sum(1, dtype=np.uint64) + seeds + np.uint64(least)).view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the k-mers that an alignment in order can match make up ``similarity`` of all.

    The longest common subsequence over (len(a) + len(b) - it). Pairs that similar have few
    k-mers without a partner, so only matches within that many places of the diagonal can
    count. Of the band only the cells that match are visited, row by row: the alignment is
    the longest run of them that rises in both texts. As k-mers are labelled, a row has one
    match at most, and the work grows with the length, not with its square.
    """
    total = len(a) + len(b)
    band = int(total * (1 - similarity) / (1 + similarity)) + 1
    if abs(len(a) - len(b)) > band:
        return False
    top = min(len(a), len(b))
    differ = np.flatnonzero(a[:top] != b[:top])
    low = int(differ[0]) if len(differ) else top
    a, b = a[low:], b[low:]
    top = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:top] != b[::-1][:top]) if top else differ[:0]
    high = int(differ[0]) if len(differ) else top
    a, b = a[: len(a) - high], b[: len(b) - high]
    same = low + high + (_longest_rise(a, b, band) if len(a) and len(b) else 0)
    return same >= similarity * (total - same)


def _longest_rise(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Most matches, within ``band`` places of the diagonal, that rise in both sequences."""
    order = np.argsort(b, kind="stable")
    first, end = (np.searchsorted(b[order], a, side) for side in ("left", "right"))
    n = end - first
    row = np.repeat(np.arange(len(a)), n)
    column = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
    near = np.abs(row - column) <= band
    row, column = row[near], column[near]
    # From right to left within a row, so that no two matches of a row follow each other.
    column = column[np.lexsort((-column, row))]
    lowest: list[int] = []
    for j in column.tolist():
        at = bisect_left(lowest, j)
        lowest[at : at + 1] = [j]
    return len(lowest)


def _sketched(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts, n, kmers = labelled_kmers(batch["text"], size)
        ends = np.cumsum(n)
        rows = [sketches(kmers[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        edges = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["h1"], batch["h2"], pa.array(counts), bands], ["doc_id", "h1", "h2", "n_words", "bands"])


def _named(docs: DataFrame) -> DataFrame:
    """Documents with two hashes that name their text; a null text is an empty one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"), text.alias("text"))


def _compare(rows: list[dict], texts: pa.Array, lo: int, hi: int, size: int, similarity: float) -> list[tuple]:
    """Links between texts of two blocks, or within one: as many as it takes to connect what is connected."""
    _, n, kmers = labelled_kmers(texts, size)
    _, codes = np.unique(kmers, return_inverse=True)
    ends = np.cumsum(n)
    parts = [codes[a:b] for a, b in zip(ends - n, ends)]
    # A kind has the same place in every row; a place without one holds a number of its own.
    bands = np.repeat(np.arange(len(rows))[:, None], 2 * SKETCHES, axis=1)
    for i, r in enumerate(rows):
        places = [place for place, _ in _kinds(int(n[i]))]
        bands[i, SKETCHES * places[0] : SKETCHES * (places[-1] + 1)] = r["bands"]
    block = np.array([r["block"] for r in rows])
    right = np.flatnonzero(block == hi)
    owner, out = list(range(len(rows))), []

    def root(i):
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    mark = np.zeros(len(codes) + 1, bool)
    for i in np.flatnonzero(block == lo).tolist():
        others = right[right > i] if lo == hi else right
        others = others[(bands[others] == bands[i]).any(1)]
        others = others[np.minimum(n[others], n[i]) >= similarity * np.maximum(n[others], n[i])]
        mark[parts[i]] = True
        for j in others.tolist():
            if root(i) == root(j):
                continue
            # No alignment matches more k-mers than the texts have in common.
            common = int(np.count_nonzero(mark[parts[j]]))
            if common >= similarity * (n[i] + n[j] - common) and aligned(parts[i], parts[j], similarity):
                owner[root(j)] = root(i)
                out.append((rows[i]["h1"], rows[i]["h2"], rows[j]["h1"], rows[j]["h2"]))
        mark[parts[i]] = False
    return out


def _family_links(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by family and pair of blocks; one such group is held at a time."""
    at, rows, texts = None, [], []

    def done():
        links = _compare(rows, pa.array(texts, pa.string()), at[1], at[2], size, similarity) if len(rows) > 1 else []
        columns = list(zip(*links)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a1", "a2", "b1", "b2"])

    for batch in slices(batches):
        for r in batch.to_pylist():
            key = r["family"], r["lo"], r["hi"]
            if key != at:
                if rows:
                    yield done()
                at, rows, texts = key, [], []
            texts.append(r.pop("text"))
            rows.append(r)
    if rows:
        yield done()


def classes(docs: DataFrame, size: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``h1``, ``h2`` (hashes of the text), ``root`` (the class) and ``class_id`` for every row.

    ``class_id`` is the smallest ``doc_id`` of the documents that are connected by equal
    texts or by pairs of an aligned similarity of ``similarity`` or more; classes of rows that
    share an id share it too, but not their ``root``. A null text is an
    empty one, and empty texts equal each other; texts without words have no other
    neighbours. A null ``doc_id`` never is a ``class_id``, unless no document of the class has an id.
    Repeated rows get a row each. Other columns are not looked at.
    """
    named = _named(docs)
    sketched = stage(named.mapInArrow(
        lambda b: _sketched(b, size), "doc_id long, h1 long, h2 long, n_words long, bands array<long>"), "sketches")
    texts = stage(
        sketched.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands")), "texts")
    sketch = texts.filter("n_words > 0").select("h1", F.explode("bands").alias("band"))
    shared = stage(sketch.groupBy("band").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low != high").select("band", "low"), "shared")
    meet = sketch.join(broadcast_if(shared), "band").select(F.col("h1").alias("a"), F.col("low").alias("b"))
    families = stage(components(meet.distinct()).select(F.col("id").alias("h1"), F.col("root").alias("family")), "families")
    member = texts.join(families, "h1")
    sizes = member.groupBy("family").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_words") / BLOCK_WORDS)).cast("int").alias("blocks"))
    block = F.pmod(F.col("h2"), F.col("blocks")).cast("int")
    placed = member.join(sizes, "family").select("h1", "h2", "doc_id", "bands", "family", block.alias("block"), "blocks")
    placed = stage(placed, "members")
    # One row with the text for each block that its own is compared with.
    # Of the copies of a text only the first is joined, so that they don't meet in one task.
    of = placed.withColumnsRenamed({"doc_id": "of", "h1": "of1", "h2": "of2"})
    first = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h1") == F.col("of1")) & (F.col("h2") == F.col("of2"))
    held = named.join(broadcast_if(of), first).drop("of", "of1", "of2", "doc_id")
    paired = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "h1", "h2", "bands", "text")
    keys = ["family", "lo", "hi"]
    links = paired.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        lambda b: _family_links(b, size, similarity), "a1 long, a2 long, b1 long, b2 long")
    pairs = links.select(F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2")).alias("a"), F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2")).alias("b"))
    linked = components(stage(pairs, "near-texts"))
    roots = texts.select("h1", "h2", "doc_id").join(linked.select("id.*", "root"), ["h1", "h2"]).select("h1", "h2", "root", "doc_id")
    roots = stage(roots, "roots")
    ids = roots.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    near = stage(roots.join(ids, "root").select("h1", "h2", "root", "class_id"), "near-classes")
    alone = texts.join(near, ["h1", "h2"], "left_anti").select("h1", "h2", F.struct("h1", "h2").alias("root"), F.col("doc_id").alias("class_id"))
    every = stage(near.union(alone), "text-classes")
    return match(sketched.select("doc_id", "h1", "h2"), every, ["h1", "h2"], ["doc_id"])


def keep_one(docs: DataFrame, size: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest ``doc_id``, all its columns kept.

    Among rows that share this id the one with the smallest hashes of the text stays, and
    of wholly repeated ones one. A class without any id keeps one row.
    """
    marks = stage(classes(docs, size, similarity), "classes")
    best = marks.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root", "class_id", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    first = best.groupBy("root").agg(F.min(F.struct("h1", "h2", "class_id", "n")).alias("m"))
    stays = stage(first.select("m.*"), "stays")
    text = F.coalesce("row.text", F.lit(""))
    on = F.col("row.doc_id").cast("long").eqNullSafe(F.col("class_id")) & (F.xxhash64(text) == F.col("h1")) & (F.xxhash64(F.lit(7), text) == F.col("h2"))
    kept = docs.select(F.struct("*").alias("row")).join(broadcast_if(stays), on)
    repeated = kept.filter("n > 1").dropDuplicates(["class_id", "h1", "h2"])
    return kept.filter("n = 1").union(repeated).select("row.*")
