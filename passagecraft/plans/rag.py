"""Retrieval and its evaluation, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.sizing import broadcast_if, stage
from passagecraft.operators.chunk import chunk
from passagecraft.operators.compare import report
from passagecraft.operators.dense import hash_embed, vector_topk
from passagecraft.operators.index import PASSAGE, build_index
from passagecraft.operators.lexical import bm25
from passagecraft.operators.metrics import per_query
from passagecraft.operators.ranking import best_per_doc, context, expand, rrf


def hybrid(chunks: DataFrame, queries: DataFrame, k: int = 10, depth: int = 50, dim: int = 256) -> DataFrame:
    """Passages ranked by keywords and by vectors, fused."""
    words = bm25(build_index(chunks), queries, depth)
    vectors, asked = hash_embed(chunks, queries, dim)
    near = vector_topk(vectors, asked, depth, keys=tuple(PASSAGE), vector="vector", dim=dim)
    return rrf([words, near], k=k)


def retrieve(
    docs: DataFrame, queries: DataFrame, k: int = 10, budget: int = 2000, width: int = 1, unit: str = "word"
) -> DataFrame:
    """Context for each query: rank passages, add neighbours, fill the budget.

    ``unit`` is how text is cut for ranking. Only documents with a hit are cut
    again for their text.
    """
    cut = "word" if unit == "word" else "char"
    hits = stage(bm25(build_index(chunk(docs, unit=cut), unit), queries, k, unit), "hits")
    found = docs.join(broadcast_if(hits.select("doc_id").distinct()), "doc_id", "left_semi")
    return context(expand(hits, chunk(found, unit=cut), width), budget, queries=queries)


def evaluate(hits: DataFrame, qrels: DataFrame, docs: DataFrame, k: int = 10) -> DataFrame:
    """Metrics of passage hits by language and source, with totals.

    A query counts for the language and source of its relevant document of smallest id.
    """
    scores = per_query(stage(best_per_doc(hits), "run"), qrels, k)
    wanted = qrels.groupBy("query_id").agg(F.min("doc_id").alias("doc_id"))
    sliced = scores.join(wanted, "query_id").join(docs.select("doc_id", "lang", "source"), "doc_id")
    return report(sliced, ["lang", "source"], ["recall", "rr", "ndcg"])
