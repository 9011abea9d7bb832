"""BM25 ranking of passages for a batch of queries."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from passagecraft.functions.kernel import Best, TermWeights, of_variant
from passagecraft.functions.sizing import blocks, broadcast_if, query_block_bytes, stage, top_k
from passagecraft.functions.text import tokens, unnest, with_runs
from passagecraft.operators.index import PASSAGE, Index


def query_terms(queries: DataFrame, unit: str = "word") -> DataFrame:
    """query_id, term and its count in the query, from query_id and question."""
    cut = queries.select("query_id", tokens("question", unit).alias("_tokens"))
    return unnest(with_runs(cut, "_tokens", "_runs"), ["query_id"], "_runs", "r").select(
        "query_id", F.col("r.item").alias("term"), F.col("r.n").alias("qtf")
    )


def bm25(
    index: Index,
    queries: DataFrame,
    k: int = 10,
    unit: str = "word",
    where: Column | None = None,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """Best k passages per query. ``where`` limits the passages ranked, not the statistics.

    The filter stands on columns kept in the index, so it reaches the scan. Query weights
    are cut into blocks of bounded size; for each block every task scores its passages in
    place and keeps k rows per query, so neither passages nor scores are shuffled.
    """
    by = list(index.by)
    asked = stage(query_terms(queries, unit), "query-terms")
    # The semi-join is moved below the count per term, so only asked terms are shuffled.
    known = index.terms.join(broadcast_if(asked.select("term").distinct()), "term", "left_semi").join(broadcast_if(asked), "term")
    if by:
        known = known.join(broadcast_if(index.totals), by)
        n, words = F.col("n_chunks"), F.col("n_words")
    else:
        both = index.totals.select(F.struct("n_chunks", "n_words")).scalar()
        n, words = both["n_chunks"], both["n_words"]
    weights = known.select(
        *by, "query_id", "term",
        (F.col("qtf") * F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))).alias("_idf"),
        (words / n).alias("_mean"), (F.col("df") / n).alias("_share"),
    )
    weights = stage(weights, "query-weights")
    if where is not None:
        index = replace(index, passages=index.passages.filter(where))
    parts = [_scored_in_place(index, part, k, k1, b) for part in blocks(weights, "query_id", query_block_bytes(weights.sparkSession))]
    return top_k(reduce(DataFrame.union, parts), [*by, "query_id"], k, PASSAGE)


def _scored_in_place(index: Index, weights: DataFrame, k: int, k1: float, b: float) -> DataFrame:
    """Best k passages per query and task, for one block of query weights.

    A join would give every query a row for nearly every passage, through common
    words, and hold them all to sum and sort. Here a task scores a batch of passages at a
    time and keeps k rows per query.
    """
    by, table = list(index.by), weights.toArrow().combine_chunks()
    variants, kinds = {}, [table.schema.field(name).type for name in by]
    for variant in sorted(set(zip(*[table[name].to_pylist() for name in by]))) if by else [()]:
        rows = of_variant(table, by, variant)
        if rows.num_rows:
            columns = [rows[name].combine_chunks() for name in ("query_id", "term", "_idf", "_mean", "_share")]
            variants[variant] = TermWeights(*columns[:2], columns[2].to_numpy(), columns[3][0].as_py(), columns[4].to_numpy())

    types = {f.name: f.dataType for f in index.passages.schema}
    key_types = [to_arrow_type(types[key]) for key in PASSAGE]

    def score(batches):
        best = {v: Best(len(t.ids), k, len(PASSAGE)) for v, t in variants.items()}
        add = {v: t.scorer(best[v], k1, b) for v, t in variants.items()}
        for batch in batches:
            for variant in variants:
                rows = of_variant(pa.Table.from_batches([batch]), by, variant)
                for part in rows.combine_chunks().to_batches():
                    keys = [part[key].to_numpy(zero_copy_only=False) for key in PASSAGE]
                    add[variant](part["runs"], part["n_words"].to_numpy(), keys)
        for variant, asked in variants.items():
            found = best[variant].columns(asked.ids, key_types)
            fixed = [pa.array([v] * len(found[0]), kind) for v, kind in zip(variant, kinds)]
            yield pa.RecordBatch.from_arrays([*fixed, *found], names=[*by, "query_id", *PASSAGE, "score"])

    fields = [*[f"{name} {types[name].simpleString()}" for name in by], f"query_id {weights.schema['query_id'].dataType.simpleString()}"]
    schema = ", ".join([*fields, *[f"{key} {types[key].simpleString()}" for key in PASSAGE], "score double"])
    return index.passages.select(*by, *PASSAGE, "n_words", "runs").mapInArrow(score, schema)
