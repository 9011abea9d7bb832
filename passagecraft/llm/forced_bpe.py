"""Byte-pair encoding by forced boundaries, and decoding.

Two bytes that no merge ever brings together inside one token never meet in one, so between
them is a certain cut. The fragments between cuts are merged each by itself, equal ones
once, and their ids are laid end to end.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from passagecraft.llm.words import coded_words, slices

# Ids and fragments that a task remembers before it starts anew, and ids decoded at a time.
REMEMBERED_IDS, REMEMBERED_FRAGMENTS, DECODED_IDS = 2_000_000, 200_000, 500_000
# Symbols of a fragment from which on merges are kept in a heap.
LONG_FRAGMENT = 48
ID_BITS = 32
WHITE_SPACE = " \t\n\v\f\r"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible Latin-1 ones for themselves, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """What a tokenizer definition (JSON) says, checked for what this module relies on.

    A symbol is a byte, or 256 and a byte at the end of a word. ``joins[a, b]`` tells
    whether any token holds symbol ``a`` and then ``b``.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        told, tokenizer = json.loads(definition), Tokenizer.from_str(definition)
        model = told["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-pair models are encoded")
        if told.get("decoder") is not None:
            raise ValueError("only tokenizers that decode to tokens and spaces are decoded")
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        if any(self.words(f"a{c}b") != self.words("a") + self.words("b") or self.words(c) for c in WHITE_SPACE):
            raise ValueError("the tokenizer must drop white space and cut words at it")
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or set(t["content"]) & set(WHITE_SPACE) for t in told["added_tokens"]):
            raise ValueError("added tokens must be taken as they are written")
        ids, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.n = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [None] * self.n
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.first = np.full(self.n, -1, np.int32)
        self.base = np.full(512, -1, np.int32)
        for char, byte in byte_of_character().items():
            self.base[[byte, 256 + byte]] = ids[char], ids[char + self.suffix]
        self.first[self.base[256:]] = np.arange(256, 512)
        self.first[self.base[:256]] = np.arange(256)
        last = self.first.copy()
        last[self.base[256:]] = np.arange(256, 512)
        self.joins = np.zeros((512, 512), bool)
        self.merges = []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, new = ids[a], ids[b], ids[a + b]
            self.merges.append((left, right, new))
            self.joins[last[left], self.first[right]] = True
            self.first[new], last[new] = self.first[left], last[right]
        if not self.suffix:
            # Without a suffix the last byte of a word is like any other.
            self.joins[:, 256:] = self.joins[:, :256]

    def words(self, text: str) -> list[str]:
        """The words of a text, bytes as characters."""
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        return [w for w, _ in self.pre_tokenizer.pre_tokenize_str(text)]


class Encoder:
    """Ids of pieces of text without white space; remembers pieces and fragments until there are too many."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # The rank of a pair, and the token it makes in the low bits.
        self.rank = {(a, b): (i << ID_BITS) | new for i, (a, b, new) in reversed(list(enumerate(vocabulary.merges)))}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.byte = np.zeros(512, np.uint16)
        for char, byte in byte_of_character().items():
            self.byte[ord(char)] = byte
        self.forget()

    def forget(self) -> None:
        self.fragments: dict[bytes, list[int]] = {}
        self.rows: dict[str, int] = {}
        self.pool, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merged(self, ids: list[int]) -> list[int]:
        """The pair of lowest rank is merged, the first one among equals, until none is left."""
        if len(ids) >= LONG_FRAGMENT:
            return self._merged_long(ids)
        get, none = self.rank.get, len(self.rank) << ID_BITS
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at : at + 2] = [best & ((1 << ID_BITS) - 1)]
            del ranks[at]
            # Only the pairs on both sides of the merged one are new.
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), none)
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        found = ((i, p, self.rank.get(p)) for i, p in enumerate(zip(ids, ids[1:])))
        heap = [(r >> ID_BITS, i, r & ((1 << ID_BITS) - 1), p) for i, p, r in found if r is not None]
        heapq.heapify(heap)
        while heap:
            _, i, new, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0 and (p := (ids[a], ids[b])) in self.rank:
                    r = self.rank[p]
                    heapq.heappush(heap, (r >> ID_BITS, a, r & ((1 << ID_BITS) - 1), p))
        return [x for x in ids if x >= 0]

    def fragments_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words laid end to end, and where each fragment starts, with the end."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte[np.frombuffer("".join(words).encode("utf-16-le"), "<u2")]
        symbols[np.cumsum(sizes) - 1] += 256
        cut = ~self.vocabulary.joins[symbols[:-1], symbols[1:]]
        cut |= symbols[:-1] >= 256
        return symbols, np.concatenate([[0], np.flatnonzero(cut) + 1, [len(symbols)]])

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all ids in a row; no piece holds an added token."""
        cut = [self.vocabulary.words(p) for p in pieces]
        words = [w for ws in cut for w in ws]
        if not words:
            return np.zeros(len(pieces), np.int64), np.zeros(0, np.int32)
        symbols, at = self.fragments_of(words)
        view, held, base = symbols.tobytes(), self.fragments, self.vocabulary.base
        out, n = [], np.zeros(len(at) - 1, np.int64)
        bounds = (2 * at).tolist()
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            key = view[a:b]
            ids = held.get(key)
            if ids is None:
                ids = held[key] = self.merged(base[symbols[a // 2 : b // 2]].tolist())
            out += ids
            n[i] = len(ids)
        ends = np.concatenate([[0], np.cumsum([sum(map(len, ws)) for ws in cut])])
        upto = np.concatenate([[0], np.cumsum(n)])
        return np.diff(upto[np.searchsorted(at, ends)]), np.array(out, np.int32)

    def _with_special(self, piece: str) -> list[int]:
        out = []
        for part in filter(None, self.special.split(piece)):
            out += [self.vocabulary.special[part]] if part in self.vocabulary.special else self._encoded([part])[1].tolist()
        return out

    def of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each of the distinct pieces start in the pool that comes third, and how many there are."""
        if len(self.pool) > REMEMBERED_IDS or len(self.fragments) > REMEMBERED_FRAGMENTS:
            self.forget()
        new = [p for p in pieces if p not in self.rows]
        marked = [p for p in new if self.special and self.special.search(p)]
        plain = [p for p in new if not (self.special and self.special.search(p))] if marked else new
        sizes, ids = self._encoded(plain)
        for p in marked:
            more = np.array(self._with_special(p), np.int32)
            sizes, ids = np.append(sizes, len(more)), np.concatenate([ids, more])
        self.rows.update(zip(plain + marked, range(len(self.rows), len(self.rows) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes, self.pool = np.concatenate([self.sizes, sizes]), np.concatenate([self.pool, ids])
        rows = np.fromiter((self.rows[p] for p in pieces), np.int64, len(pieces))
        return self.starts[rows], self.sizes[rows], self.pool

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each text start and end, and all ids in a row."""
        counts, codes, pieces = coded_words(texts)
        starts, sizes, pool = self.of(pieces.to_pylist())
        each = sizes[codes]
        last = np.cumsum(each)
        flat = pool[np.repeat(starts[codes] - (last - each), each) + np.arange(int(last[-1]) if len(last) else 0)]
        return np.concatenate([[0], last])[np.concatenate([[0], np.cumsum(counts)])], flat


def _definition(docs: DataFrame, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(Vocabulary(f.read()))


def _encode(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary.value)
    for batch in slices(batches):
        offsets, ids = encoder.texts(batch["text"])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids``: token ids of every whole text, as the tokenizers library gives them without special tokens.

    ``tokenizer`` is the path of a byte-level BPE definition that drops white space; the
    driver reads it. Strings of added tokens in a text become those tokens. A null or empty
    text, or white space alone, has no ids (an empty array). Rows with equal or null
    ``doc_id`` are encoded each by itself; other columns are not looked at.
    """
    vocabulary = _definition(docs, tokenizer)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _encode(b, vocabulary), "doc_id long, ids array<int>")


def _decode(batches: Iterator[pa.RecordBatch], tokens) -> Iterator[pa.RecordBatch]:
    known = pa.array(tokens.value, pa.string())
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        low = 0
        while low < len(ends):
            start = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, start + DECODED_IDS, side="right")))
            part = batch.slice(low, high - low)
            flat = part.column(at).flatten()
            inside = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(known))), False)
            words = known.take(pc.if_else(inside, flat, None))
            # Ids that stand for nothing are left out, as the library does.
            held = np.concatenate([[0], np.cumsum(words.is_valid().to_numpy(zero_copy_only=False))])
            offsets = held[np.concatenate([[0], ends[low:high] - start])]
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words.drop_null())
            yield pa.RecordBatch.from_arrays([*part.columns, pc.binary_join(lists, " ")], [*part.schema.names, "text"])
            low = high


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, text``: the tokens of ``ids`` with a space between, as the library gives them without a decoder.

    Special tokens are written out. A null array gives an empty text; null ids and ids that
    the vocabulary does not know give nothing.
    """
    spark = coded.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        tokens = spark.sparkContext.broadcast(Vocabulary(f.read()).tokens)
    return coded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        lambda b: _decode(b, tokens), "doc_id long, ids array<int>, text string")
