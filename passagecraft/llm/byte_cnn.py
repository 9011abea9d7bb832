"""Quality classifier: a convolutional network over bytes, trained and applied in numpy.

The bytes of the whole text are cut into overlapping chunks. Filters slide over each
chunk, their largest answer in a chunk is kept, the mean of these over all chunks
describes the document, and a logistic layer turns that into one probability.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from passagecraft.llm.words import slices

CHUNK, OVERLAP = 256, 64
EMBED, WIDTH, STRIDE, FILTERS = 8, 8, 2, 32
# Bound on the labelled rows the network is fitted on, and on the length of one of them.
FIT_ROWS, FIT_BYTES = 4000, 32_768
# Epochs at least, and steps at least: few labelled rows are gone through more often. The rate falls to
# LAST_RATE along half a cosine, so that the result hardly depends on how the network starts.
EPOCHS, STEPS, BATCH_CHUNKS, RATE, LAST_RATE = 6, 450, 512, 0.01, 0.0001
# Chunks handled at once when scoring.
CHUNKS_AT_ONCE = 128

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chunk_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each chunk within its text, and the text; every byte lies in a chunk, an empty text has one."""
    step = CHUNK - OVERLAP
    n = 1 + np.maximum(0, -(-(sizes - CHUNK) // step))
    text = np.repeat(np.arange(len(sizes)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return within * step, text


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All chunks as rows of byte values plus one, zero where the text has ended, and their texts."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    buffers, total = texts.buffers(), int(sizes.sum())
    low = int(np.frombuffer(buffers[1], np.int32)[texts.offset]) if len(sizes) else 0
    data = np.frombuffer(buffers[2], np.uint8)[low : low + total] if total else np.zeros(0, np.uint8)
    padded = np.concatenate([data.astype(np.int16) + 1, np.zeros(CHUNK, np.int16)])
    start, text = chunk_starts(sizes)
    base = np.cumsum(sizes) - sizes
    at = (base[text] + start)[:, None] + np.arange(CHUNK)
    rows = padded[np.minimum(at, len(padded) - 1)]
    rows[start[:, None] + np.arange(CHUNK) >= sizes[text][:, None]] = 0
    return rows, text


class Network:
    """Parameters and passes. ``embed`` maps bytes to numbers, ``filters`` answer on windows of them."""

    def __init__(self, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
        self.filters = rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(FILTERS + 1, np.float32)

    def pooled(self, rows: np.ndarray, with_places: bool = False):
        """Largest answer of each filter in each chunk, zero at least."""
        n = len(rows)
        flat = self.embed[rows].reshape(n, -1)
        windows = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]
        answers = windows.reshape(-1, WIDTH * EMBED) @ self.filters
        answers = answers.reshape(n, -1, FILTERS)
        if with_places:
            return np.maximum(answers.max(1) + self.bias, 0), answers.argmax(1)
        return np.maximum(answers.max(1) + self.bias, 0)

    def scores(self, rows: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
        total, count = np.zeros((n_texts, FILTERS)), np.bincount(text, minlength=n_texts)
        for low in range(0, len(rows), CHUNKS_AT_ONCE):
            here = text[low : low + CHUNKS_AT_ONCE]
            # Chunks come text by text, so each text's are a run.
            first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
            total[here[first]] += np.add.reduceat(self.pooled(rows[low : low + CHUNKS_AT_ONCE]), first, axis=0)
        logit = total / np.maximum(count, 1)[:, None] @ self.out[:-1] + self.out[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def fit(self, texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS, steps: int = STEPS, seed: int = 3) -> None:
        """Minimise the log loss with Adam, for ``epochs`` and ``steps`` at least; both labels weigh alike."""
        rows, text = chunks_of(texts)
        sizes = np.bincount(text, minlength=len(labels))
        first = np.cumsum(sizes) - sizes
        share = np.array([max(1, (labels == k).sum()) for k in (0, 1)]) / len(labels)
        weight = 0.5 / share[labels]
        rng, batches = np.random.default_rng(seed), []
        while epochs > 0 or len(batches) < steps:
            epochs -= 1
            order = rng.permutation(len(labels))
            # A batch ends with the text that fills it.
            full = np.cumsum(sizes[order]) // BATCH_CHUNKS
            batches.extend(np.split(order, np.flatnonzero(full[1:] > full[:-1]) + 1))
        moments = {}
        for step, batch in enumerate(batches, 1):
            rate = LAST_RATE + (RATE - LAST_RATE) * (1 + np.cos(np.pi * step / len(batches))) / 2
            for name, d in self.gradients(rows, batch, first, sizes, labels, weight).items():
                m, v = moments.get(name, (0, 0))
                m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
                moments[name] = m, v
                move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                setattr(self, name, (getattr(self, name) - move).astype(np.float32))

    def gradients(self, rows, batch, first, sizes, labels, weight) -> dict[str, np.ndarray]:
        """Gradient of the mean weighted log loss of the texts ``batch`` by each parameter."""
        each = sizes[batch]
        at = np.repeat(first[batch] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        chunk, starts = rows[at], np.cumsum(each) - each
        pooled, place = self.pooled(chunk, with_places=True)
        mean = np.add.reduceat(pooled, starts, axis=0) / each[:, None]
        p = 1 / (1 + np.exp(-np.clip(mean @ self.out[:-1] + self.out[-1], -30, 30)))
        error = ((p - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
        d_out = np.append(mean.T @ error, error.sum())
        d_pooled = np.repeat(error / each, each)[:, None] * self.out[:-1] * (pooled > 0)
        # Only the window with a filter's largest answer has a share in the error.
        bytes_at = place[:, :, None] * STRIDE + np.arange(WIDTH)
        codes = chunk[np.arange(len(chunk))[:, None, None], bytes_at]
        window = self.embed[codes].reshape(len(chunk), FILTERS, -1)
        d_filters = np.einsum("nf,nfw->wf", d_pooled, window)
        d_window = (d_pooled[:, :, None] * self.filters.T[None]).reshape(-1, EMBED)
        d_embed = np.stack([np.bincount(codes.ravel(), d_window[:, e], 257) for e in range(EMBED)], axis=1)
        return {"out": d_out, "filters": d_filters, "bias": d_pooled.sum(0), "embed": d_embed}


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> Network:
    """A network fitted on at most ``rows`` labelled documents of at most ``most_bytes``.

    They are drawn by a hash of the id from the rows that are not held out. With no
    labelled rows every score is one half.
    """
    marked = (
        labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
        .filter(~held_out(F.col("doc_id")))
    )
    total = marked.count()
    part = 1_000_000 if total <= rows else int(950_000 * rows / total)
    drawn = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1_000_000)) < part)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") <= most_bytes)
    got = texts.join(drawn, "doc_id").limit(rows).collect()
    network = Network()
    if got:
        got = sorted(got, key=lambda r: (r["doc_id"], r["text"]))
        network.fit(pa.array([r["text"] for r in got], pa.string()), np.array([r["quality"] for r in got]))
    return network


def _scored(batches: Iterator[pa.RecordBatch], network) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=1 << 20):
        rows, text = chunks_of(batch["text"])
        score = network.value.scores(rows, text, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1, from the whole text.

    A null text counts as empty, and an empty text has the score of an empty chunk.
    Repeated rows and null ids get a row each. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _scored(b, shared), "doc_id long, score double")
