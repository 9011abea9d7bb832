"""Quality rules: statistics of whole texts, judged by an isolation forest.

The forest's trees split random features at random values; a document that few splits
set apart is unlike the others. The score above which a document goes is calibrated on
labelled rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.sizing import broadcast_if
from passagecraft.llm.tables import stage
from passagecraft.llm.words import coded_words, mixed, slices, window_hashes, window_starts, word_hashes

REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
TREES, SAMPLE_PER_TREE = 100, 256
# Share of labelled good rows that the threshold must keep, and steps in which scores are counted.
KEEP_GOOD = 0.995
SCORE_STEPS = 4096
# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_distinct_words", "n_upper", "n_lower"]
# What the forest sees. Repeated lines and windows are left to the base rules: ordinary texts
# with a few of them stand apart as well. So do short texts by their share of capitals.
RATES = ["symbols_per_char", "word_length", "distinct_power", "letter_share", "lower_share"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(characters.encode())] = 1
    return out


_TABLES = {
    "n_symbols": _table(SYMBOLS), "n_upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "n_lower": _table("abcdefghijklmnopqrstuvwxyz"),
}


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over runs of the given sizes."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def _repeats(key: np.ndarray) -> np.ndarray:
    """For each value whether it occurs more than once."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(key) else False
    return out


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text."""
    counts, codes, words = coded_words(texts)
    n = len(counts)
    text = np.repeat(np.arange(n), counts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int64)
    out = {"n_words": counts, "word_chars": _sums(chars[codes] if len(words) else np.zeros(0), counts)}

    raw = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    buffers = texts.buffers()
    low = np.frombuffer(buffers[1], np.int32)[texts.offset] if n else 0
    data = np.frombuffer(buffers[2], np.uint8)[low : low + raw.sum()] if n and raw.sum() else np.zeros(0, np.uint8)
    for name, table in _TABLES.items():
        out[name] = _sums(table[data], raw)

    lines = pc.split_pattern(texts, "\n")
    each = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    line = lines.flatten()
    full = pc.not_equal(pc.ascii_trim_whitespace(line), "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(n), each)[full]
    code = line.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[full]
    pairs = np.unique(owner * (len(line) + 1) + code)
    out["n_dup_lines"] = np.bincount(owner, minlength=n) - np.bincount(pairs // (len(line) + 1), minlength=n)

    distinct = np.unique(text * (len(words) + 1) + codes)
    out["n_distinct_words"] = np.bincount(distinct // (len(words) + 1), minlength=n)

    hashes = word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
    at, owner, _ = window_starts(counts, REPEAT_WORDS)
    key = mixed(window_hashes(hashes, REPEAT_WORDS, 3)[at] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = np.zeros(len(codes) + REPEAT_WORDS + 1, np.int64)
    twice = at[_repeats(key)]
    step[twice] += 1
    step[twice + REPEAT_WORDS] -= 1
    out["n_repeat_words"] = _sums(np.cumsum(step)[: len(codes)] > 0, counts)
    return {k: out[k].astype(np.int64) for k in [*COUNTS, *MORE]}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = text_counts(batch["text"])
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in names), *(pa.array(x) for x in found.values())], [*names, *found])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, a hash of the text and its statistics, one row per document; null texts count as empty."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        _counted, "doc_id long, text_key long, " + ", ".join(f"{c} long" for c in [*COUNTS, *MORE]))


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """``RATES`` from counts: one row per document, one column per rate, none of them cut off."""
    c = {k: v.astype(np.float64) for k, v in columns.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    # Distinct words grow as a power of all words; this is the power less one.
    power = np.log(np.maximum(c["n_distinct_words"], 1) / words) / np.log(np.maximum(words, 2))
    return np.stack([c["n_symbols"] / chars, c["word_chars"] / words, power, (c["n_upper"] + c["n_lower"]) / chars, c["n_lower"] / chars], axis=1)


class Forest:
    """Isolation trees as arrays: per node a feature, a value, two children and the path length so far.

    Splits are drawn on the squared distance from each feature's median, with its sign: so
    they fall where values are rare more often than where they crowd.
    """

    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE_PER_TREE, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.middle = np.median(rows, axis=0) if len(rows) else np.zeros(rows.shape[1])
        rows = self._stretched(rows)
        self.feature, self.value, self.child, self.path = [], [], [], []
        self.usual = _average_path(min(sample, max(len(rows), 1)))
        depth = int(np.ceil(np.log2(max(2, sample))))
        self.roots = [self._grow(rows[rng.permutation(len(rows))[:sample]], 0, depth, rng) for _ in range(trees)] if len(rows) else []
        self.depth = depth
        self.feature, self.value = np.array(self.feature, int), np.array(self.value)
        self.child, self.path = np.array(self.child, int).reshape(-1, 2), np.array(self.path)

    def _stretched(self, rows: np.ndarray) -> np.ndarray:
        away = rows - self.middle
        return away * np.abs(away)

    def _grow(self, rows: np.ndarray, depth: int, limit: int, rng) -> int:
        at = len(self.feature)
        for column, x in ((self.feature, 0), (self.value, np.inf), (self.child, (at, at)), (self.path, depth + _average_path(len(rows)))):
            column.append(x)
        low, high = rows.min(0), rows.max(0)
        varied = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and len(varied):
            f = int(rng.choice(varied))
            value = rng.uniform(low[f], high[f])
            right = rows[:, f] > value
            self.feature[at], self.value[at] = f, value
            self.child[at] = (self._grow(rows[~right], depth + 1, limit, rng), self._grow(rows[right], depth + 1, limit, rng))
        return at

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1 for rows that few splits isolate, 0.5 and below for usual ones."""
        rows, total = self._stretched(rows), np.zeros(len(rows))
        each = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                node = self.child[node, (rows[each, self.feature[node]] > self.value[node]).astype(int)]
            total += self.path[node]
        return 2.0 ** (-total / max(1, len(self.roots)) / max(self.usual, 1e-9))


def _average_path(n: int) -> float:
    """Average depth of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def _scored(batches: Iterator[pa.RecordBatch], forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = features({c: batch[c].to_numpy(zero_copy_only=False) for c in [*COUNTS, *MORE]})
        score = forest.value.score(rows)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "anomaly"])


def fit_forest(stats: DataFrame, trees: int = TREES, sample: int = SAMPLE_PER_TREE) -> Forest:
    """A forest grown on ``trees * sample`` documents at most, drawn by a hash from all that stand the base rules."""
    usable = stats.filter(~_failed())
    n = usable.count()
    want = trees * sample
    # The share aims below the bound, and the limit holds it.
    share = min(1.0, 0.9 * want / max(n, 1))
    drawn = usable.filter(F.pmod(F.xxhash64("doc_id", "text_key", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000) + (share >= 1))
    columns = [*COUNTS, *MORE]
    got = np.array([tuple(r) for r in drawn.select("doc_id", *columns).limit(want).collect()], dtype=object)
    if not len(got):
        return Forest(np.zeros((0, len(RATES))))
    got = got[np.lexsort([got[:, k + 1].astype(np.int64) for k in range(len(columns))])]
    return Forest(features({c: got[:, k + 1].astype(np.int64) for k, c in enumerate(columns)}), trees, sample)


def _failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def calibrate(scored: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> float:
    """Score above which a document goes.

    Of all thresholds that keep ``keep_good`` of the labelled good rows, the one with the
    best mean of kept good and rejected bad rows. Scores are counted in ``SCORE_STEPS``
    steps, so all labelled rows count and a table of fixed size is collected. Without
    labels of both kinds nothing is rejected.
    """
    marked = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    steps = (
        scored.filter(~_failed()).select("doc_id", F.floor(F.col("anomaly") * SCORE_STEPS).cast("int").alias("step"))
        .join(marked, "doc_id").groupBy("step", "quality").count().collect()
    )
    held = np.zeros((2, SCORE_STEPS + 2))
    for r in steps:
        held[r["quality"], min(r["step"], SCORE_STEPS)] += r["count"]
    bad, good = held.sum(1)
    if not bad or not good:
        return 2.0
    # Kept at threshold t: all steps below t.
    kept_good, kept_bad = (np.concatenate([[0], np.cumsum(x)])[:-1] for x in (held[1], held[0]))
    worth = np.where(kept_good >= keep_good * good, kept_good / good + 1 - kept_bad / bad, -1)
    best = np.flatnonzero(worth >= worth.max() - 1e-12)
    return float(best[len(best) // 2]) / SCORE_STEPS


def judge(docs: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> DataFrame:
    """Statistics, anomaly score and verdict per document.

    Columns: ``doc_id, text_key``, the counts, ``anomaly``, ``base_failed``, ``kept``. A null
    or empty text fails the base rules. Repeated rows and null ids get a row each; a null
    id has no label. Labels other than 0 and 1 are left out; of several for one document
    the lowest counts. Other columns are not looked at.
    """
    stats = stage(rule_statistics(docs), "rule-statistics")
    forest = docs.sparkSession.sparkContext.broadcast(fit_forest(stats))
    scored = stats.mapInArrow(lambda b: _scored(b, forest), stats.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", anomaly double")
    threshold = calibrate(scored, labels, keep_good)
    return scored.withColumn("base_failed", _failed()).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))


def keep_good(docs: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> DataFrame:
    """``docs`` without those that the rules reject, all columns kept."""
    rejected = judge(docs, labels, keep_good).filter("not kept").select("doc_id", "text_key").distinct()
    on = F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_key"))
    return docs.select(F.struct("*").alias("row")).join(broadcast_if(rejected), on, "left_anti").select("row.*")
