"""How often items occur in the lists of an Arrow column, for a whole batch at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks receive this module with the function that uses it, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def owners(column: pa.Array) -> np.ndarray:
    """For every item of a list column the row it is in; null lists have none."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes)


def counted(row: np.ndarray, code: np.ndarray, n_rows: int, names: pa.Array) -> pa.Array:
    """Lists of (item, n) of ``n_rows`` rows, by code; items are ``names`` of their codes."""
    key = np.sort(row * max(1, len(names)) + code)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(first, append=len(key)).astype(np.int32)
    held, item = np.divmod(key[first], max(1, len(names)))
    ends = np.cumsum(np.bincount(held, minlength=n_rows))
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([names.take(pa.array(item)), pa.array(n)], names=["item", "n"]))


def runs(column: pa.Array) -> pa.Array:
    """Lists of (item, n) for lists of items, sorted by item; empty for a null list."""
    coded = column.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return counted(owners(column), rank[coded.indices.to_numpy()], len(column), coded.dictionary.take(pa.array(order)))


# Tokens whose runs are hashed at a time.
GRAM_TOKENS = 500_000
# Odd numbers, one for each of the two hashes of a run.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _joined(words: np.ndarray, at: np.ndarray, n: int, factor: int) -> np.ndarray:
    """A hash of the ``n`` words from each of the places ``at`` on, in their order."""
    out = np.full(len(at), n, np.uint64)
    for j in range(n):
        out = (out ^ words[at + j]) * np.uint64(factor)
        out ^= out >> np.uint64(29)
    return out


def grams(column: pa.Array, n: int, bits: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, place in it and two 64-bit hashes of each run of ``n`` tokens in a list column.

    With ``bits``, packed marks by the top bits of the first hash, runs without a mark are left out.
    """
    coded = column.flatten().dictionary_encode()
    known = np.frombuffer(b"".join(md5(w).digest() for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64).reshape(-1, 2)
    code, row = coded.indices.to_numpy(), owners(column)
    first = np.searchsorted(row, np.arange(len(column)))
    shift = np.uint64(64 - int(np.log2(8 * len(bits)))) if bits is not None else None
    for low in range(0, len(code), GRAM_TOKENS):
        words, of = known[code[low : low + GRAM_TOKENS + n - 1]], row[low : low + GRAM_TOKENS + n - 1]
        at = np.flatnonzero(of[n - 1 :] == of[: max(0, len(of) - n + 1)])
        a = _joined(np.ascontiguousarray(words[:, 0]), at, n, FACTORS[0])
        if bits is not None:
            spot = (a >> shift).astype(np.int64)
            some = (bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0
            at, a = at[some], a[some]
        b = _joined(np.ascontiguousarray(words[:, 1]), at, n, FACTORS[1])
        yield of[at], low + at - first[of[at]], a.view(np.int64), b.view(np.int64)
