"""Benchmark decontamination by latent semantic retrieval.

The benchmark items span a term space. TF-IDF passages of all documents are projected
from it onto the leading singular directions of the passage matrix, found by a randomised
SVD in one distributed pass. Passages near an item by cosine are candidates. What the two
texts have in common in order, and whether the item's answer is there, decides.

The items are made part of the space, so the cosine is in effect that of plain TF-IDF on
their words: paraphrases whose rare words are replaced may not become candidates.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.sizing import broadcast_if
from passagecraft.llm.tables import stage
from passagecraft.llm.words import coded_words, slices, word_hashes

# Words per passage and between the starts of passages.
WINDOW, STRIDE = 64, 32
# Passages of items searched for at once (an item of up to WINDOW words is one); their number
# bounds the space. Larger benchmarks take more rounds.
ITEMS_PER_ROUND = 200
# Directions kept beyond one per item, and drawn beyond those kept.
MORE_DIRECTIONS, MORE_DRAWN = 32, 16
# Terms in more than this share of documents have no weight, unless an item has few others.
COMMON, FEW_TERMS, LEAST_WEIGHT = 0.05, 5, 0.05
COSINE = 0.45
# Share of an item's words found in order from which on it counts as leaked, and as
# paraphrased if the answer is there too.
LEAKED, PARAPHRASED, ANSWERED = 0.8, 0.5, 0.8
# What is cut from both ends of a word, and what ends a sentence.
EDGES = ".,;:!?\"'`()[]{}<>#$%&*|~^_=+/\\-–—…«»“”‘’¿¡"
SENTENCE_ENDS = ".!?"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def plain(words: pa.Array) -> pa.Array:
    """Words in lower case without punctuation at the ends."""
    return pc.utf8_trim(pc.utf8_lower(words), EDGES)


def terms_of(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per text and all words as places in the sorted hashes ``vocabulary``, -1 if not there."""
    counts, codes, words = coded_words(texts)
    words = plain(words)
    hashes = word_hashes(words)
    place = np.searchsorted(vocabulary, hashes)
    known = vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
    place = np.where(known, place, -1).astype(np.int32)
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[codes] if len(words) else np.zeros(0, bool)
    held = np.concatenate([[0], np.cumsum(full)])
    ends = np.cumsum(counts)
    return held[ends] - held[ends - counts], place[codes[full]]


@dataclass
class Items:
    """One round's items: their words as terms, their answers, what is searched for, and the term space."""

    ids: list
    vocabulary: np.ndarray
    words: list[np.ndarray]
    answers: list[np.ndarray]
    # The passages of the items, and the item of each.
    parts: list[np.ndarray]
    owner: np.ndarray
    weights: np.ndarray | None = None
    matrix: np.ndarray | None = None
    space: np.ndarray | None = None

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        texts = pa.array([t or "" for _, t in rows], pa.string())
        _, _, words = coded_words(texts)
        words = plain(words)
        vocabulary = np.unique(word_hashes(words.filter(pc.not_equal(words, ""))))
        found = _per_text(texts, vocabulary)
        cuts = [(k, words[at : at + WINDOW]) for k, words in enumerate(found) for at in passage_starts(len(words))]
        return Items([i for i, _ in rows], vocabulary, found,
                     _per_text(pa.array([answer_of(t or "") for _, t in rows], pa.string()), vocabulary),
                     [part for _, part in cuts], np.array([k for k, _ in cuts], np.int64))

    def weigh(self, frequency: np.ndarray, documents: int) -> None:
        """IDF weights from document frequencies, and the items' passages as rows of unit length."""
        idf = np.log((1 + documents) / (1 + frequency))
        self.weights = np.where(frequency > COMMON * documents, 0, idf)
        for words in self.parts:
            if len(words) and np.count_nonzero(self.weights[np.unique(words)]) < FEW_TERMS:
                self.weights[words] = np.maximum(idf[words], LEAST_WEIGHT)
        self.matrix = np.zeros((len(self.parts), len(self.vocabulary)))
        for k, words in enumerate(self.parts):
            np.add.at(self.matrix[k], words, self.weights[words])
        self.matrix /= np.maximum(np.linalg.norm(self.matrix, axis=1, keepdims=True), 1e-12)


def passage_starts(n: int) -> list[int]:
    """Where the passages of an item of ``n`` words start: as in documents, the last one at its end.

    A document's passage out of a copy of the item is half a stride off one of them at most.
    """
    last = n - WINDOW
    return [*range(0, last, STRIDE), last] if last > 0 else [0]


def answer_of(text: str) -> str:
    """The last sentence that has words: what a question's answer stands in."""
    parts, start = [], 0
    for at, c in enumerate(text):
        if c in SENTENCE_ENDS:
            parts.append(text[start : at + 1])
            start = at + 1
    parts.append(text[start:])
    return next((p for p in reversed(parts) if any(c.isalnum() for c in p)), "")


def _per_text(texts: pa.Array, vocabulary: np.ndarray) -> list[np.ndarray]:
    counts, terms = terms_of(texts, vocabulary)
    return np.split(terms, np.cumsum(counts)[:-1]) if len(counts) else []


def _kind(vocabulary: np.ndarray) -> type:
    return np.int16 if len(vocabulary) < 1 << 15 else np.int32


def _coded(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    """Texts as the terms of their words, packed into bytes: they are split once and read three times."""
    vocabulary = items.value.vocabulary
    for batch in slices(batches):
        counts, terms = terms_of(batch["text"], vocabulary)
        data = np.ascontiguousarray(terms.astype(_kind(vocabulary)))
        ends = (np.concatenate([[0], np.cumsum(counts)]) * data.itemsize).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], packed], ["doc_id", "text_key", "terms"])


def _unpacked(packed: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per text and the terms of all in a row."""
    kind = np.dtype(_kind(vocabulary))
    sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64)
    total, buffers = int(sizes.sum()), packed.buffers()
    if not total:
        return sizes, np.zeros(0, kind)
    low = int(np.frombuffer(buffers[1], np.int32)[packed.offset])
    return sizes // kind.itemsize, np.frombuffer(buffers[2], np.uint8)[low : low + total].copy().view(kind)


def _frequencies(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    vocabulary = items.value.vocabulary
    n = np.zeros(len(vocabulary), np.int64)
    for batch in slices(batches, "terms"):
        counts, terms = _unpacked(batch["terms"], vocabulary)
        doc = np.repeat(np.arange(len(counts)), counts)
        # A slice holds few documents, or many short ones: some at a time bounds the table.
        step = max(1, (8 << 20) // max(1, len(vocabulary)))
        for low in range(0, len(counts), step):
            here = (terms >= 0) & (doc >= low) & (doc < low + step)
            held = np.zeros((min(step, len(counts) - low), len(vocabulary)), bool)
            held[doc[here] - low, terms[here]] = True
            n += held.sum(0)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["term", "n"])


def _weighted(counts: np.ndarray, terms: np.ndarray, weights: np.ndarray, step: int):
    """Words with weight: their terms and the block of ``step`` words they lie in; blocks per text."""
    blocks = -(-counts // step)
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(terms >= 0)
    at = at[weights[terms[at]] > 0]
    block = (np.cumsum(blocks) - blocks)[doc[at]] + (at - first[doc[at]]) // step
    return terms[at], block, blocks


def _range_sketch(batches: Iterator[pa.RecordBatch], items, drawn) -> Iterator[pa.RecordBatch]:
    """This task's share of A' A G: A the weighted passages, G the random directions."""
    it, g = items.value, drawn.value
    scaled = (it.weights[:, None] * g).astype(np.float32)
    total = np.zeros(g.shape)
    for batch in slices(batches, "terms", 1 << 20):
        counts, terms = _unpacked(batch["terms"], it.vocabulary)
        term, passage, _ = _weighted(counts, terms, it.weights, WINDOW)
        for low in range(0, len(term), 1 << 11):
            # A passage cut in two by this step counts as two.
            t, p = term[low : low + (1 << 11)], passage[low : low + (1 << 11)]
            start = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            y = np.add.reduceat(scaled[t], start, axis=0)
            row = np.cumsum(np.concatenate([[0], p[1:] != p[:-1]]))
            order = np.argsort(t, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], t[order][1:] != t[order][:-1]]))
            total[t[order][first]] += np.add.reduceat(y[row[order]], first, axis=0)
    total *= it.weights[:, None]
    for term in np.flatnonzero(total.any(1)):
        yield pa.RecordBatch.from_arrays([pa.array([term], pa.int32()), pa.array([total[term].tobytes()], pa.binary())], ["term", "part"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts come sorted by term; one sum is held at a time."""
    at, total = None, None
    for batch in batches:
        for term, part in zip(batch["term"].to_pylist(), batch["part"]):
            part = np.frombuffer(part.as_py())
            if term != at:
                if at is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["term", "part"])
                at, total = term, part.copy()
            else:
                total += part
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["term", "part"])


def latent_space(texts: DataFrame, items: Items, seed: int = 10) -> np.ndarray:
    """Leading right singular vectors of the passages and items, one column each.

    One pass gives ``M G`` for ``M = A'A`` and random ``G``; its Nystroem approximation gives
    the directions. The items' passages are rows of the matrix too, with as much weight as all passages
    have together, so that the space holds them. What is collected has one row per term of
    the items, whatever the corpus holds.
    """
    spark, size = texts.sparkSession, len(items.vocabulary)
    keep = min(size, len(items.parts) + MORE_DIRECTIONS)
    g = np.random.default_rng(seed).standard_normal((size, min(size, keep + MORE_DRAWN)))
    if not size:
        return np.zeros((0, 0), np.float32)
    shared, drawn = spark.sparkContext.broadcast(items), spark.sparkContext.broadcast(g)
    parts = texts.mapInArrow(lambda b: _range_sketch(b, shared, drawn), "term int, part binary")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = stage(parts.repartition(tasks, "term").sortWithinPartitions("term").mapInArrow(_summed, "term int, part binary"), "range-sketch")
    y = np.zeros(g.shape)
    for r in found.toLocalIterator():
        y[r["term"]] = np.frombuffer(bytes(r["part"]))
    energy = max(float((g * y).sum() / g.shape[1]), 1.0)
    y += energy / len(items.parts) * (items.matrix.T @ (items.matrix @ g))
    shift = 1e-7 * np.linalg.norm(y)
    y += shift * g
    low = np.linalg.cholesky((g.T @ y + y.T @ g) / 2 + 1e-9 * shift * np.eye(g.shape[1]))
    return np.linalg.svd(np.linalg.solve(low, y.T).T, full_matrices=False)[0][:, :keep].astype(np.float32)


def common_in_order(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence; the rows of the table are bits of one integer."""
    where: dict[int, int] = {}
    for j, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = where.get(x)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


def judged(item: np.ndarray, answer: np.ndarray, words: np.ndarray) -> tuple[float, bool, bool]:
    """Share of the item found in order, whether its answer is there, and the verdict."""
    overlap = common_in_order(item, words) / max(1, len(item))
    answered = bool(len(answer)) and common_in_order(answer, words) >= ANSWERED * len(answer)
    return overlap, answered, overlap >= LEAKED or (overlap >= PARAPHRASED and answered)


def _found(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    it = items.value
    w, space = it.weights, it.space
    scaled = (w[:, None] * space).astype(np.float32)
    queries = (it.matrix @ space).astype(np.float32)
    # No cosine of a passage exceeds the sum over its words of the most any item gives them.
    most = w * it.matrix.max(0) if len(it.ids) else w
    side = WINDOW // STRIDE
    for batch in slices(batches, "terms", 1 << 20):
        counts, terms = _unpacked(batch["terms"], it.vocabulary)
        ends = np.cumsum(counts)
        term, block, blocks = _weighted(counts, terms, w, STRIDE)
        n = int(blocks.sum())
        square, bound = np.bincount(block, w[term] ** 2, n), np.bincount(block, most[term], n)
        start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, int)
        rows = {}
        owner = np.repeat(np.arange(len(blocks)), blocks)
        # A passage is a block and those after it within the text.
        later = [np.minimum(np.arange(n) + s, np.maximum(n - 1, 0)) for s in range(side)]
        inside = [(owner[x] == owner) & (np.arange(n) + s < n) for s, x in enumerate(later)] if n else []
        norm = np.sqrt(sum(np.where(ok, square[x], 0) for x, ok in zip(later, inside))) if n else square
        limit = sum(np.where(ok, bound[x], 0) for x, ok in zip(later, inside)) if n else bound
        likely = np.flatnonzero((norm > 0) & (limit >= COSINE * norm))
        place = np.full(n + 1, -1)
        place[block[start]] = np.arange(len(start))
        for low in range(0, len(likely), 512):
            some = likely[low : low + 512]
            first, last = int(some[0]), int(min(n - 1, some[-1] + side - 1))
            a, b = np.searchsorted(block, [first, last + 1])
            part = np.zeros((last - first + 2, space.shape[1]), np.float32)
            if b > a:
                edge = np.flatnonzero(np.concatenate([[True], block[a:b][1:] != block[a:b][:-1]]))
                part[block[a:b][edge] - first] = np.add.reduceat(scaled[term[a:b]], edge, axis=0)
            z = sum(part[np.where(ok[some], x[some] - first, len(part) - 1)] for x, ok in zip(later, inside))
            near, q = np.nonzero(z @ queries.T >= COSINE * norm[some][:, None])
            cosine = (z[near] * queries[q]).sum(1) / norm[some][near]
            seen = None
            for k, item, c in zip(some[near].tolist(), it.owner[q].tolist(), cosine.tolist()):
                doc = int(owner[k])
                # Passages of one item come one after the other; the verdict is on the whole item.
                if seen != (k, item):
                    seen = k, item
                    words = it.words[item]
                    begin = int(ends[doc] - counts[doc])
                    at = (k - int((np.cumsum(blocks) - blocks)[doc])) * STRIDE
                    region = terms[max(begin, begin + at - len(words)) : min(int(ends[doc]), begin + at + WINDOW + len(words))]
                    overlap, answered, leaked = judged(words, it.answers[item], region[region >= 0])
                held = rows.get((doc, item))
                if held is None or (leaked, overlap, c) > (held[4], held[2], held[1]):
                    rows[doc, item] = at, c, overlap, answered, leaked
        keys = sorted(rows)
        docs = pa.array([d for d, _ in keys], pa.int64())
        values = list(zip(*(rows[k] for k in keys))) or [()] * 5
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"].take(docs), batch["text_key"].take(docs), pa.array([it.ids[i] for _, i in keys], pa.int64()),
            pa.array(values[0], pa.int64()), pa.array(values[1], pa.float64()), pa.array(values[2], pa.float64()),
            pa.array(values[3], pa.bool_()), pa.array(values[4], pa.bool_()),
        ], ["doc_id", "text_key", "item_id", "at", "cosine", "overlap", "answered", "leaked"])


FOUND = "doc_id long, text_key long, item_id long, at long, cosine double, overlap double, answered boolean, leaked boolean"


def search(docs: DataFrame, items: DataFrame, per_round: int = ITEMS_PER_ROUND) -> DataFrame:
    """Candidate pairs of documents and benchmark items with their verdict.

    One row per pair of which a passage reached ``COSINE``: ``doc_id``, ``text_key`` (hash of
    the text), ``item_id``, ``at`` (word at which the best passage starts), ``cosine``,
    ``overlap`` (share of the item's words found in order), ``answered`` and ``leaked``.

    Items are the stated query set. Those longer than a passage are searched for by all their
    passages and judged whole. Rounds take items of ``per_round`` passages together, or one
    longer item, and search all passages of the documents. Null or empty texts, of documents or items, are in no pair. Repeated rows and
    null ids count like any other. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.filter("text is not null and text != ''").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    documents = texts.count()
    rows = items.filter("text is not null and text != ''").select(F.col("item_id").cast("long"), "text").distinct()
    out, batch, held = [], [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        more = len(passage_starts(len(r["text"].split())))
        if batch and held + more > per_round:
            out.append(_round(spark, texts, batch, documents))
            batch, held = [], 0
        batch.append((r["item_id"], r["text"]))
        held += more
    if batch:
        out.append(_round(spark, texts, batch, documents))
    result = spark.createDataFrame([], FOUND)
    for df in out:
        result = result.union(df)
    return result


def _round(spark, texts: DataFrame, rows: list[tuple], documents: int) -> DataFrame:
    items = Items.of(rows)
    shared = spark.sparkContext.broadcast(items)
    texts = stage(texts.mapInArrow(lambda b: _coded(b, shared), "doc_id long, text_key long, terms binary"), "terms")
    counted = texts.select("terms").mapInArrow(lambda b: _frequencies(b, shared), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = np.zeros(len(items.vocabulary))
    for r in counted.collect():
        frequency[r["term"]] = r["n"]
    items.weigh(frequency, documents)
    items.space = latent_space(texts.select("terms"), items)
    ready = spark.sparkContext.broadcast(items)
    return stage(texts.mapInArrow(lambda b: _found(b, ready), FOUND), "latent-search")


def drop_leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those in which a benchmark item is leaked, all columns kept."""
    leaked = search(docs, items).filter("leaked").select("doc_id", "text_key").distinct()
    on = F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_key"))
    return docs.select(F.struct("*").alias("row")).join(broadcast_if(leaked), on, "left_anti").select("row.*")
