"""Operations on ranked result lists: query_id, doc_id, chunk_no, score, rank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagecraft.functions.sizing import broadcast_if, stage, top_k
from passagecraft.operators.dense import vector_topk
from passagecraft.operators.index import PASSAGE, Index
from passagecraft.operators.lexical import bm25


def filtered_topk(index: Index, queries: DataFrame, predicate: Column, k: int = 10) -> DataFrame:
    """Keyword ranking among passages whose kept columns meet the predicate."""
    return bm25(index, queries, k, where=predicate)


def filtered_vector_topk(vectors: DataFrame, queries: DataFrame, predicate: Column, k: int = 10, **how) -> DataFrame:
    """Vector ranking among rows that meet the predicate."""
    return vector_topk(vectors.filter(predicate), queries, k, **how)


def rrf(rankings: list[DataFrame], k0: int = 60, k: int = 10, keys: list[str] = PASSAGE) -> DataFrame:
    """Reciprocal-rank fusion. Each ranking adds 1 / (k0 + rank) to its items."""
    parts = [r.select("query_id", *keys, "rank") for r in rankings]
    scored = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("query_id", *keys)
        .agg(F.round(F.sum(1 / (k0 + F.col("rank"))), 9).alias("score"))
    )
    return top_k(scored, ["query_id"], k, keys)


def expand(hits: DataFrame, chunks: DataFrame, width: int = 1) -> DataFrame:
    """Each hit with its neighbours up to ``width`` passages away, each passage once per query.

    Neighbour numbers are spelled out first, so the join is a plain equality on
    the passage and one long document spreads over many tasks. The hits are staged and
    measured; if small enough they are broadcast and the passages are not shuffled.
    """
    wanted = (
        hits.select(
            "query_id", "doc_id", "rank",
            F.explode(F.sequence(F.col("chunk_no") - width, F.col("chunk_no") + width)).alias("chunk_no"),
        )
        .groupBy("query_id", *PASSAGE)
        .agg(F.min("rank").alias("rank"))
    )
    wanted = broadcast_if(stage(wanted, "wanted"))
    return chunks.select(*PASSAGE, "chunk").join(wanted, PASSAGE).select("query_id", *PASSAGE, "rank", "chunk")


def with_text(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits with the text of their passages."""
    return expand(hits, chunks, 0)


def best_per_doc(hits: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Best passage of each document, ranked anew."""
    best = F.max(F.struct("score", (-F.col("chunk_no")).alias("_at")))
    docs = hits.groupBy(*by, "query_id", "doc_id").agg(best.alias("_b"))
    flat = docs.select(
        *by, "query_id", "doc_id", (-F.col("_b._at")).alias("chunk_no"), F.col("_b.score").alias("score")
    )
    w = Window.partitionBy(*by, "query_id").orderBy(F.desc("score"), "doc_id")
    return flat.withColumn("rank", F.row_number().over(w))


def context(hits: DataFrame, budget: int = 2000, gap: str = "\n\n", queries: DataFrame | None = None) -> DataFrame:
    """Passages in rank order up to ``budget`` characters, joined into one text per query.

    A passage that no longer fits is skipped and the next ones are tried; ``n_skipped``
    counts such passages. A query of which nothing fits has an empty context, and so has
    each one of ``queries`` without a hit. A query's hits number k times the passages each
    hit was expanded to, so its list is short.
    """
    order = ["rank", "doc_id", "chunk_no"]
    listed = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(*order, "chunk"))).alias("_h"))
    if queries is not None:
        listed = queries.select("query_id").distinct().join(listed, "query_id", "left")
    none = F.array().cast("array<string>")

    def take(state, hit):
        size = state["used"] + F.length(hit["chunk"]) + F.when(F.size(state["kept"]) > 0, len(gap)).otherwise(0)
        fits = size <= budget
        return F.struct(
            F.when(fits, size).otherwise(state["used"]).alias("used"),
            F.when(fits, F.array_append(state["kept"], hit["chunk"])).otherwise(state["kept"]).alias("kept"),
        )

    filled = F.aggregate(F.col("_h"), F.struct(F.lit(0).alias("used"), none.alias("kept")), take)
    held = listed.withColumn("_f", F.coalesce(filled, F.struct(F.lit(0).alias("used"), none.alias("kept"))))
    n = F.size("_f.kept").cast("long")
    return held.select(
        "query_id", n.alias("n_passages"), (F.greatest(F.coalesce(F.size("_h"), F.lit(0)), F.lit(0)) - n).alias("n_skipped"),
        F.col("_f.used").cast("long").alias("n_chars"), F.array_join("_f.kept", gap).alias("context"),
    )


def rank_diff(a: DataFrame, b: DataFrame, k: int = 10, keys: list[str] = ["doc_id"]) -> DataFrame:
    """Where each result of either top k appears: only_a, only_b or both; one join for all three."""
    def head(df, name):
        return df.filter(F.col("rank") <= k).select("query_id", *keys, F.col("rank").alias(name))

    found = F.when(F.col("rank_b").isNull(), "only_a").when(F.col("rank_a").isNull(), "only_b").otherwise("both")
    joined = head(a, "rank_a").join(head(b, "rank_b"), ["query_id", *keys], "full_outer")
    return joined.select("query_id", *keys, "rank_a", "rank_b", found.alias("found"))
