"""Scoring of one Arrow batch of vectors against a block of query vectors."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

TILE_CELLS = 4_000_000

# Tasks receive this module with the function that uses it, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix(column, dim: int | None) -> np.ndarray:
    """Rows of a list column, or of a struct of indices and weights, as a dense matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if pa.types.is_struct(column.type):
        indices, weights = column.field("indices"), column.field("weights")
        lengths = pc.list_value_length(indices).to_numpy(zero_copy_only=False)
        out = np.zeros((n, dim))
        rows = np.repeat(np.arange(n), lengths)
        out[rows, indices.flatten().to_numpy(zero_copy_only=False)] = weights.flatten().to_numpy(
            zero_copy_only=False
        )
        return out
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else np.zeros((0, dim or 0))


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1, norms)


def similarity(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """One row per vector, one column per query; larger is nearer. For cosine both are unit vectors."""
    product = rows @ queries.T
    if metric == "l2":
        squares = (rows**2).sum(1)[:, None] + (queries**2).sum(1)[None, :] - 2 * product
        product = -np.sqrt(np.maximum(squares, 0))
    return np.round(product, 6) + 0.0


def ranks(values: np.ndarray) -> np.ndarray:
    """Numbers that sort as ``values`` do, which may be strings."""
    return np.unique(values.astype(str), return_inverse=True)[1] if values.dtype == object else values


class Best:
    """The k best rows per query seen so far; memory is k rows per query.

    Queries are kept in tiles, so that a batch of scores is merged only with the rows of
    the queries it is for.
    """

    TILE = 256

    def __init__(self, n_queries: int, k: int, n_keys: int):
        self.k, self.n_keys = k, n_keys
        self.tiles: dict[int, tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = {}
        self.floor = np.full(n_queries, -np.inf)

    def add(self, scores: np.ndarray, keys: list[np.ndarray], queries: np.ndarray) -> None:
        """Scores of some rows for ``queries``, ascending numbers; minus infinity means no match."""
        edges = np.flatnonzero(np.diff(queries // self.TILE)) + 1
        for columns in np.split(np.arange(len(queries)), edges):
            if len(columns):
                self._add(scores[:, columns[0] : columns[-1] + 1], keys, queries[columns])

    def _add(self, scores, keys, queries) -> None:
        seen = (scores >= self.floor[queries]) & (scores > -np.inf)
        cut = len(scores) - self.k
        if cut > 0 and seen.sum() > 2 * self.k * scores.shape[1]:
            seen &= scores >= np.partition(scores, cut, axis=0)[cut]
        at, column = np.nonzero(seen)
        if len(at):
            self._merge(queries[0] // self.TILE, queries[column], scores[at, column], [key[at] for key in keys])

    def add_pairs(self, queries: np.ndarray, scores: np.ndarray, at: np.ndarray, keys: list[np.ndarray]) -> None:
        """Scores of single rows ``at`` for ``queries``, ascending numbers."""
        good = scores >= self.floor[queries]
        queries, scores, at = queries[good], scores[good], at[good]
        edges = np.flatnonzero(np.diff(queries // self.TILE)) + 1
        for low, high in zip([0, *edges], [*edges, len(queries)]):
            if high > low:
                part = slice(low, high)
                self._merge(queries[low] // self.TILE, queries[part], scores[part], [key[at[part]] for key in keys])

    def _merge(self, tile, q, score, keys) -> None:
        if tile in self.tiles:
            old_q, old_score, old_keys = self.tiles[tile]
            q, score = np.concatenate([old_q, q]), np.concatenate([old_score, score])
            keys = [np.concatenate(pair) for pair in zip(old_keys, keys)]
        order = np.lexsort((*[ranks(key) for key in keys[::-1]], -score, q))
        q, score = q[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        keep = place < self.k
        self.tiles[tile] = q[keep], score[keep], [key[order][keep] for key in keys]
        last = place[keep] == self.k - 1
        self.floor[q[keep][last]] = score[keep][last]

    def columns(self, query_ids: pa.Array, types: list[pa.DataType]) -> list[pa.Array]:
        """Query ids, keys of the given types, and scores."""
        found = list(self.tiles.values()) or [(np.zeros(0, np.int64), np.zeros(0), [np.zeros(0, object)] * self.n_keys)]
        q, score = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        keys = [pa.array(np.concatenate([f[2][i] for f in found]), kind) for i, kind in enumerate(types)]
        return [query_ids.take(pa.array(q)), *keys, pa.array(score)]


def add_vectors(best: Best, queries: np.ndarray, numbers: np.ndarray, rows: np.ndarray, keys: list[np.ndarray], metric: str) -> None:
    """Score ``rows`` for the queries of the given numbers, a tile of both at a time."""
    if not len(rows) or not len(queries):
        return
    height = max(1, TILE_CELLS // Best.TILE)
    for top in range(0, len(rows), height):
        part = [key[top : top + height] for key in keys]
        for low in range(0, len(queries), Best.TILE):
            scores = similarity(rows[top : top + height], queries[low : low + Best.TILE], metric)
            best.add(scores, part, numbers[low : low + Best.TILE])


def of_variant(table: pa.Table, by: list[str], variant: tuple) -> pa.Table:
    """Rows whose columns ``by`` hold the values of ``variant``."""
    for name, value in zip(by, variant):
        table = table.filter(pc.equal(table[name], value))
    return table


class TermWeights:
    """Weights of query terms: which queries hold a term and with what weight.

    Most terms that a passage and a query share are a few frequent ones. Weights of those are
    kept as a matrix, so that one product sums them up for many pairs; the others are kept
    term by term for tiles of queries. The product is in single precision and tells which
    pairs may be among the best; only these are scored in full.
    """

    TILE_CELLS = 1_000_000
    MOST_TILES = 16
    # A term shared by this many of all pairs costs less in the product than term by term.
    DENSE_SHARE = 0.0005
    MOST_DENSE = 512
    # Far above the relative error of a sum in single precision, and the error of rounded scores.
    SLACK, ROUNDED = 1e-4, 1e-5

    def __init__(self, query_id: pa.Array, term: pa.Array, weight: np.ndarray, mean: float, share: np.ndarray):
        """``share``: which part of the passages holds the term."""
        queries, terms = query_id.dictionary_encode(), term.dictionary_encode()
        self.ids, self.terms, self.mean = queries.dictionary, terms.dictionary, mean
        code, query = terms.indices.to_numpy(), queries.indices.to_numpy()
        n, n_terms = len(self.ids), len(self.terms)
        pairs = np.bincount(code, share, n_terms) / max(1, n)
        most = int(np.clip(TILE_CELLS // max(1, n), 0, self.MOST_DENSE))
        dense = np.sort(np.argsort(-pairs, kind="stable")[:most])
        dense = dense[pairs[dense] >= self.DENSE_SHARE]
        self.slot = np.full(n_terms, -1, np.int64)
        self.slot[dense] = np.arange(len(dense))
        held = self.slot[code] >= 0
        self.n_dense, self.dense = len(dense), (query[held], self.slot[code[held]], weight[held])
        # Tiles begin where tiles of ``Best`` do.
        width = max(1024, -(-n // self.MOST_TILES))
        self.width = -(-width // Best.TILE) * Best.TILE
        self.height = max(64, self.TILE_CELLS // min(max(1, n), self.width))
        tile = query[~held] // self.width
        order = np.lexsort((code[~held], tile))
        self.query, self.weight = query[~held][order], weight[~held][order]
        spots = np.arange(-(-n // self.width) * n_terms + 1)
        self.first = np.searchsorted((tile * n_terms + code[~held])[order], spots).astype(np.int32)

    def matrix(self) -> np.ndarray:
        """Weights of frequent terms, a row for each query."""
        out = np.zeros((len(self.ids), self.n_dense))
        query, slot, weight = self.dense
        np.add.at(out, (query, slot), weight)
        return out

    def scorer(self, best: Best, k1: float, b: float):
        """A function that adds the passages of a batch to ``best``: their runs, lengths and keys."""
        weights = self.matrix()
        narrow = weights.astype(np.float32)

        def add(runs: pa.Array, lengths: np.ndarray, keys: list[np.ndarray]) -> None:
            flat = runs.flatten()
            row = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).to_numpy(zero_copy_only=False))
            term = pc.index_in(flat.field("item"), value_set=self.terms).fill_null(-1).to_numpy()
            known = term >= 0
            row, term, tf = row[known], term[known], flat.field("n").to_numpy()[known].astype(np.float64)
            part = tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[row] / self.mean))
            for top in range(0, len(runs), self.height):
                n = min(self.height, len(runs) - top)
                low, high = np.searchsorted(row, [top, top + n])
                at, slot, what, value = row[low:high] - top, self.slot[term[low:high]], term[low:high], part[low:high]
                often = slot >= 0
                passages = np.zeros((n, self.n_dense))
                np.add.at(passages, (at[often], slot[often]), value[often])
                rest = at[~often], what[~often], value[~often]
                self._add_tiles(best, passages, weights, narrow, rest, [key[top : top + n] for key in keys])

        return add

    def _add_tiles(self, best, passages, weights, narrow, rest, keys) -> None:
        n, across = len(passages), passages.astype(np.float32).T
        for number, left in enumerate(range(0, len(weights), self.width)):
            near = narrow[left : left + self.width] @ across
            cell, more = self._rest(number, left, n, *rest)
            np.add.at(near.reshape(-1), cell, more.astype(np.float32))
            floor = best.floor[left : left + len(near)]
            least = np.maximum(self._below(floor), np.finfo(np.float32).tiny).astype(np.float32)
            seen = near >= least[:, None]
            if 0 < best.k < n and np.count_nonzero(seen) > 2 * best.k * len(near):
                reached = self._below(np.partition(near, n - best.k, axis=1)[:, n - best.k])
                seen &= near >= reached[:, None]
            found = np.flatnonzero(seen)
            if not len(found):
                continue
            kept = seen.reshape(-1)[cell]
            # Without anything to count bincount gives whole numbers.
            scores = np.bincount(np.searchsorted(found, cell[kept]), more[kept], len(found)).astype(np.float64)
            query, at = np.divmod(found, n)
            for i in range(0, len(found) if self.n_dense else 0, 10_000):
                part = slice(i, i + 10_000)
                scores[part] += (passages[at[part]] * weights[left + query[part]]).sum(axis=1)
            good = scores > 0
            query, at, scores = query[good], at[good], np.round(scores[good], 6)
            best.add_pairs(left + query, scores, at, keys)

    def _rest(self, number, left, n, at, term, value):
        """Cells of one tile of queries that the terms outside the matrix add to, and what they add."""
        spot = number * len(self.terms) + term
        start, held = self.first[spot], self.first[spot + 1] - self.first[spot]
        some = held > 0
        at, value, start, held = at[some], value[some], start[some], held[some]
        place = np.arange(held.sum()) + np.repeat(start - (np.cumsum(held) - held), held)
        return (self.query[place] - left) * n + np.repeat(at, held), np.repeat(value, held) * self.weight[place]

    def _below(self, score: np.ndarray) -> np.ndarray:
        """What a sum in single precision reaches if the score reaches ``score``."""
        return score - np.abs(score) * self.SLACK - self.ROUNDED
