"""Words and word hashes of Arrow batches, shared by the operators that work inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Text bytes handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

# Tasks receive this module with the function that uses it, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each piece holds about ``most`` bytes of text, null texts made empty."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        if batch.column(at).null_count:
            batch = batch.set_column(at, text, batch.column(at).fill_null(""))
        ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < len(ends):
            start = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, start + most, side="right")))
            yield batch.slice(low, high - low)
            low = high
            # What Arrow has freed goes back to the system, as the JVM beside needs room too.
            pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space: how many each text has, and all of them in a row."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(flat, "")
    held = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(sizes)
    counts = held[ends] - held[ends - sizes] if len(sizes) else np.zeros(0, np.int64)
    return counts, flat.filter(full)


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As :func:`split_words`, the words as codes into their distinct values."""
    counts, flat = split_words(texts)
    coded = flat.dictionary_encode()
    return counts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array, key: str = "passagecraft-key") -> np.ndarray:
    """A 64-bit hash for each word, the same in every task; ``key`` has 16 characters."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), hash_key=key, categorize=False) if len(words) else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a finaliser with the usual two odd factors)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def odd_factors(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, one per position that has so many after it."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(odd_factors(size, seed)):
        out += hashes[j : j + n] * factor
    return mixed(out)


def window_starts(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: place of each window, its text, and its first word within the text."""
    each = np.maximum(counts - size + 1, 0)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), each)
    within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return first[text] + within, text, within
