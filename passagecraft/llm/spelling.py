"""Spelling variants: words one edit apart, found by search schemes on an FM-index in both directions.

One edit lies in one half of a word, so the other half is matched exactly. The scheme for an
edit in the back half walks a word from its start to its end on the index of the reversed
words; the one for an edit in the front half walks from the end on the index of the words as
they are. Both start at the delimiter around words, so each keeps the interval of suffix
ranks of its own direction. Spark deals the vocabulary to tasks by the halves, so that a
task's index holds every word that can share a half with the words it searches for.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from passagecraft.functions.sizing import match
from passagecraft.llm.importance import text_bytes
from passagecraft.llm.tables import stage
from passagecraft.llm.words import slices

LEAST_LENGTH, LEAST_COUNT, TIMES, SLIP_ONE_IN = 5, 3, 2, 97
# Words in one index, and words searched for at a time.
INDEX_WORDS, SEARCHED_WORDS = 50_000, 4096
# Bytes of a run up to which its checksum is taken for many runs at once.
SHORT_RUN = 64

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_ASCII_LETTER = (_LOWER >= 97) & (_LOWER <= 122)
_LEAD = 0xC3  # of U+00C0 to U+00FF, whatever byte follows


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each piece of ``data``, carried on from the checksum ``before`` it."""
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    low = int(np.searchsorted(-size, -SHORT_RUN, side="left"))
    for j in range(int(size[low]) if low < len(size) else 0):
        high = int(np.searchsorted(-size, -j, side="left"))
        now = state[low:high]
        state[low:high] = _CRC[(now ^ data[begin[low:high] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    view = memoryview(np.ascontiguousarray(data))
    for i in range(low):
        state[i] = zlib.crc32(view[begin[i] : begin[i] + size[i]], int(before[order[i]]))
    out = np.empty_like(state)
    out[order] = state
    return out


def runs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters with A-Z lower-cased: all bytes, where each run starts, its bytes, its code points and its text."""
    data, cuts = text_bytes(texts)
    data = _LOWER[data]
    inside = _ASCII_LETTER[data] | (data == _LEAD)
    inside[1:] |= data[:-1] == _LEAD
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = cuts[:-1][cuts[:-1] < cuts[1:]]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    held = np.concatenate([[0], np.cumsum(inside)])
    sizes = np.diff(np.append(held[starts], held[-1]))
    points = np.concatenate([[0], np.cumsum(inside & ((data & 0xC0) != 0x80))])
    return data, starts, sizes, points[starts + sizes] - points[starts], np.searchsorted(cuts, starts, side="right") - 1


def _words(batches: Iterator[pa.RecordBatch], least: int, one_in: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, starts, sizes, points, text = runs_of(batch["text"])
        if not len(starts):
            continue
        ids = batch["doc_id"].to_pylist()
        prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        # A run with fewer code points never becomes a word.
        at = np.flatnonzero(points >= least)
        starts, sizes, points, text = starts[at], sizes[at], points[at], text[at]
        h = checksums(data, starts, sizes, prefix[text])
        slips = h % np.uint32(one_in) == 0
        found = []
        for i in np.flatnonzero(slips & (points > least)).tolist():
            run = bytes(data[starts[i] : starts[i] + sizes[i]]).decode()
            k = int(h[i]) % len(run)
            found.append(run[:k] + run[k + 1 :])
        starts, sizes = starts[~slips], sizes[~slips]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = data[np.arange(int(ends[-1])) + np.repeat(starts - ends[:-1], sizes)]
        words = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())
        counted = pc.value_counts(pa.concat_arrays([words, pa.array(found, pa.string())]))
        yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "n"])


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = SLIP_ONE_IN) -> DataFrame:
    """``word, n``: runs of letters of all texts, counted, in which one in ``one_in`` has lost a letter.

    Which run loses which letter is decided by the checksum of ``<doc_id>:<run>``. Words of
    fewer than ``least`` code points or ``least_count`` occurrences are left out.
    """
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _words(b, least, one_in), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Index:
    """FM-index of delimited words: suffixes end with their word's delimiter, equal ones are in the order of the words.

    ``symbols`` holds each word's symbols (1 and above) and its delimiter 0, word after word.
    Ranks are looked up in one sorted array of (symbol before the suffix, rank of the suffix).
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.n, self.words = len(symbols), len(starts)
        self.most = int(symbols.max(initial=0))
        word = np.repeat(np.arange(self.words), lengths + 1)
        order = _suffix_order(symbols, (starts + lengths)[word] if self.n else word)
        before = np.concatenate([[0], symbols[:-1]]) if self.n else symbols
        self.before = before[order]
        self.word = word[order]
        self.sorted = np.sort(self.before * self.n + np.arange(self.n))
        self.back = np.empty(self.n, np.int64)
        self.back[self.sorted % self.n if self.n else []] = np.arange(self.n)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that ``symbol`` makes of those in the given intervals."""
        out_low, out_high = np.zeros_like(low), np.zeros_like(high)
        one = high - low == 1
        i = np.flatnonzero(one)
        i = i[self.before[low[i]] == symbol[i]]
        out_low[i] = self.back[low[i]]
        out_high[i] = out_low[i] + 1
        i = np.flatnonzero(~one)
        base = symbol[i] * self.n
        out_low[i] = np.searchsorted(self.sorted, base + low[i])
        out_high[i] = np.searchsorted(self.sorted, base + high[i])
        return out_low, out_high

    def each(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ways to go on by one symbol from the given intervals: which of them, the symbol, the new interval."""
        small = np.flatnonzero(high - low <= self.most)
        size = high[small] - low[small]
        rows = np.arange(int(size.sum())) + np.repeat(low[small] - (np.cumsum(size) - size), size)
        of, symbol = np.repeat(small, size), self.before[rows]
        new = self.back[rows]
        keep = symbol > 0
        of, symbol, new = of[keep], symbol[keep], new[keep]
        large = np.flatnonzero(high - low > self.most)
        if not len(large):
            return of, symbol, new, new + 1
        wide, tried = np.repeat(large, self.most), np.tile(np.arange(1, self.most + 1), len(large))
        a, b = self.step(tried, low[wide], high[wide])
        keep = a < b
        return (np.concatenate([of, wide[keep]]), np.concatenate([symbol, tried[keep]]),
                np.concatenate([new, a[keep]]), np.concatenate([new + 1, b[keep]]))

    def whole(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals in which a suffix is a whole word, and that word; words are distinct, so there is one at most."""
        ends = self.sorted[: self.words]
        at = np.searchsorted(ends, low)
        hit = np.flatnonzero(at < np.searchsorted(ends, high))
        return hit, self.word[ends[at[hit]]]


def _suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in the order of what stands there up to the delimiter, by doubling the length compared."""
    n = len(symbols)
    bits = int(symbols.max(initial=0)).bit_length() or 1
    step, place = 62 // bits, np.arange(n)
    rank = np.zeros(n, np.int64)
    for j in range(step):
        rank = (rank << bits) | np.where(place + j <= ends, symbols[np.minimum(place + j, n - 1)], 0)
    longest = int((ends - place).max(initial=0)) + 1
    while True:
        order = np.argsort(rank, kind="stable")
        if step >= longest:
            return order
        new = np.concatenate([[0], np.cumsum(np.diff(rank[order]) != 0)])
        rank[order] = new
        rank = rank * (n + 1) + np.where(place + step <= ends, rank[np.minimum(place + step, n - 1)] + 1, 0)
        step *= 2


def search(index: Index, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the index one edit away from the patterns, the first ``exact`` symbols of which must agree: pattern and word.

    Symbols are given in the order in which the index takes them. Of edits that give the same
    word (a letter more or less in a run of it) only the one at the run's end is tried.
    """
    empty = np.zeros(0, np.int64)
    who, low = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    high = np.full(len(starts), index.words)
    pool, found = [empty, empty, empty, empty], []

    def advance(q, j, a, b):
        done = j == lengths[q]
        i = np.flatnonzero(done)
        hit, word = index.whole(a[i], b[i])
        found.append((q[i[hit]], word))
        q, j, a, b = q[~done], j[~done], a[~done], b[~done]
        a, b = index.step(symbols[starts[q] + j], a, b)
        keep = a < b
        return [q[keep], j[keep] + 1, a[keep], b[keep]]

    for t in range(int(lengths.max(initial=0)) + 1):
        i = np.flatnonzero(t >= exact[who])
        q, a, b = who[i], low[i], high[i]
        inner = t < lengths[q]
        here = np.where(inner, symbols[np.minimum(starts[q] + t, len(symbols) - 1)], -1)
        of, symbol, x, y = index.each(a, b)
        other = symbol != here[of]
        of, x, y = of[other], x[other], y[other]
        replaced = inner[of]
        after = np.where(t + 1 < lengths[q], symbols[np.minimum(starts[q] + t + 1, len(symbols) - 1)], -1)
        less = inner & (after != here)
        at = lambda rows, j: np.full(len(rows), j)
        new = [  # a symbol more, another symbol, a symbol less
            (q[of], at(of, t), x, y), (q[of[replaced]], at(of[replaced], t + 1), x[replaced], y[replaced]),
            (q[less], at(q[less], t + 1), a[less], b[less])]
        pool = advance(*[np.concatenate(c) for c in zip(pool, *new)])
        i = np.flatnonzero(t < lengths[who])
        who = who[i]
        low, high = index.step(symbols[starts[who] + t], low[i], high[i])
        i = np.flatnonzero(low < high)
        who, low, high = who[i], low[i], high[i]
    while len(pool[0]):
        pool = advance(*pool)
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (empty, empty)


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the words from 1 in code-point order with delimiters 0, starts and lengths."""
    points = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    inside = np.ones(len(points), bool)
    inside[starts + lengths] = False
    symbols = np.zeros(len(points), np.int64)
    symbols[inside] = np.unique(points[inside], return_inverse=True)[1] + 1
    return symbols, starts, lengths


def near_words(words: list[str], held: np.ndarray, asked: np.ndarray, from_start: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place of a word ``asked`` for, place of a ``held`` word one edit away) among distinct ``words``.

    ``from_start``: the edit lies in the back half; else in the front half, and the pair is not one of the others.
    """
    symbols, starts, lengths = _coded(words)
    turned = symbols.copy()
    place = np.arange(len(symbols)) - np.repeat(starts, lengths + 1)
    size = np.repeat(lengths, lengths + 1)
    turned[np.repeat(starts, lengths + 1) + np.where(place < size, size - 1 - place, size)] = symbols
    front = lengths // 2
    # The index takes symbols from the end of its words on.
    new = np.cumsum(lengths[held] + 1) - (lengths[held] + 1)
    rows = np.arange(int((lengths[held] + 1).sum())) + np.repeat(starts[held] - new, lengths[held] + 1)
    index = Index((turned if from_start else symbols)[rows], new, lengths[held])
    taken, exact = (symbols, front) if from_start else (turned, lengths - front)
    found = []
    for i in range(0, len(asked), SEARCHED_WORDS):
        part = asked[i : i + SEARCHED_WORDS]
        q, word = search(index, taken, starts[part], lengths[part], exact[part])
        found.append((part[q], held[word]))
    a, b = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    if from_start:
        return a, b
    same, left = np.ones(len(a), bool), np.arange(len(a))
    j = 0
    while len(left := left[front[a[left]] > j]):
        same[left] = symbols[starts[a[left]] + j] == symbols[starts[b[left]] + j]
        left, j = left[same[left]], j + 1
    return a[~same], b[~same]


def _grouped(table: pa.Table) -> pa.Table:
    table = table.combine_chunks().sort_by("word")
    words = table["word"].to_pylist()
    first = np.array([i == 0 or words[i] != words[i - 1] for i in range(len(words))])
    at = np.cumsum(first) - 1
    held, asked = (np.unique(at[table[flag].to_numpy()]) for flag in ("held", "asked"))
    distinct = [w for w, f in zip(words, first) if f]
    n = table["n"].to_numpy()[first]
    a, b = near_words(distinct, held, asked, table["from_start"][0].as_py())
    order = np.lexsort((b, -n[b], a))
    a, b = a[order], b[order]
    who, start, count = np.unique(a, return_index=True, return_counts=True)
    best = b[start]
    return pa.table({
        "word": pa.array([distinct[i] for i in who.tolist()], pa.string()), "n_near": pa.array(count.astype(np.int64)),
        "form": pa.array([distinct[i] for i in best.tolist()], pa.string()), "form_n": pa.array(n[best].astype(np.int64))})


def nearest(words: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """``word, n_near, form, form_n`` for each of the distinct ``words`` (``word, n``) with a near one: how many, and the most frequent.

    Each word is searched for in the group of its front half and in that of its back half;
    it is held by the groups of its own length and of those one off. Groups hold some
    ``index_words`` words. A half that more words share is cut into parts: each part of the
    words held meets each part of those asked for. Among equally frequent ones the first in
    code-point order counts.
    """
    rows = []
    for from_start in (True, False):
        for off in (-1, 0, 1):
            size = F.length("word") + off
            front = F.floor(size / 2).cast("int")
            half = F.left("word", front) if from_start else F.right("word", size - front)
            rows.append(F.struct(F.lit(from_start).alias("from_start"), F.lit(off == 0).alias("own"), F.xxhash64(F.lit(from_start), size, half).alias("key")))
    dealt = words.select("word", "n", F.explode(F.array(*rows)).alias("r")).select("word", "n", "r.*")
    groups = max(1, -(-3 * words.count() // index_words))
    counts = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("total"))
    # Of 6 rows per word, at most 6 in ``index_words`` are a hot key.
    hot = counts.filter(F.col("total") > index_words).select("key", F.ceil(F.col("total") / index_words).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")

    def cell(row: Column, column: Column, asked: Column, held: Column) -> Column:
        return F.struct(row.alias("row"), column.alias("column"), asked.alias("asked"), held.alias("held"))

    every = F.sequence(F.lit(0), F.col("parts") - 1)
    held = F.transform(every, lambda i: cell(i, mine, F.col("own") & (i == mine), F.lit(True)))
    asked = F.transform(F.filter(every, lambda i: F.col("own") & (i != mine)), lambda i: cell(mine, i, F.lit(True), F.lit(False)))
    whole = F.array(cell(F.lit(-1), F.lit(-1), F.col("own"), F.lit(True)))
    cells = F.when(F.col("parts").isNull(), whole).otherwise(F.concat(held, asked))
    spread = dealt.join(F.broadcast(hot), "key", "left").withColumn("c", F.explode(cells))
    group = F.when(F.col("parts").isNull(), F.pmod("key", F.lit(groups))).otherwise(F.col("key"))
    placed = spread.select("from_start", group.alias("group"), "word", "n", "c.*")
    found = placed.groupBy("from_start", "group", "row", "column").applyInArrow(_grouped, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.form").alias("form"), (-F.col("b.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``: where following forms ends. Paths double in each round."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(match(now, onward, ["root"], ["word"]).select("word", F.col("next").alias("root")), "moved")
        if moved.isEmpty():
            return now
        both = now.withColumn("step", F.lit(0)).unionByName(moved.withColumn("step", F.lit(1)))
        now = stage(both.groupBy("word").agg(F.max_by("root", "step").alias("root")), "roots")


def group_variants(
    docs: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
    one_in: int = SLIP_ONE_IN, index_words: int = INDEX_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: each frequent word, its near words and the form it is a variant of.

    Two words are near if they differ by one inserted, deleted or replaced code point. A
    word's form is its most frequent near word (the first in code-point order among equals)
    if that occurs at least ``times`` as often, else null; its root is where forms lead, the
    word itself without one. ``n_near`` is 0 without near words. A null text holds no words;
    a null ``doc_id`` counts as an empty one for the checksum; repeated rows count again.
    An empty table gives no rows. Other columns are not looked at.
    """
    words = stage(vocabulary(docs, least, least_count, one_in), "vocabulary")
    near = words.join(nearest(words, index_words), "word", "left")
    formed = F.col("form_n") >= times * F.col("n")
    judged = stage(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("form")).alias("form"),
        F.when(formed, F.col("form_n")).alias("form_n")), "forms")
    ended = roots(judged.filter("form is not null"))
    return judged.join(ended, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
