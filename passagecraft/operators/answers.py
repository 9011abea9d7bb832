"""Answer metrics. ``pred``: id, answer, one row per id; ``gold``: id, gold, any number per id.

A question without a prediction scores zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.sizing import split_join
from passagecraft.functions.text import normal_answer, numbered, tokens, with_runs


def _scored(gold: DataFrame, best: DataFrame) -> DataFrame:
    """A score for every question, best answer or none."""
    return gold.select("id").distinct().join(best, "id", "left").fillna(0, [best.columns[1]])


def exact_match(pred: DataFrame, gold: DataFrame, unit: str = "word") -> DataFrame:
    """1 where the normalised answer equals any accepted one."""
    right = gold.select("id", normal_answer("gold", unit).alias("_g"))
    left = pred.select("id", normal_answer("answer", unit).alias("_p"))
    both = split_join(right, left, ["id"], ["_g"])
    return _scored(gold, both.groupBy("id").agg(F.max(F.when(F.col("_p") == F.col("_g"), 1).otherwise(0)).alias("em")))


def _numbered_tokens(df: DataFrame, text: str, out: str, unit: str) -> DataFrame:
    cut = df.select("id", tokens(normal_answer(text, unit), unit).alias("_t"))
    runs = with_runs(cut, "_t", "_r")
    return runs.select("id", numbered("_r").alias(out))


def answer_f1(pred: DataFrame, gold: DataFrame, unit: str = "word") -> DataFrame:
    """Best F1 of shared tokens over the accepted answers; ``char`` counts characters.

    Repeated tokens count as often as both sides hold them: each occurrence is
    numbered, so that a set intersection of the two sides is the multiset overlap.
    """
    both = split_join(
        _numbered_tokens(gold, "gold", "_g", unit), _numbered_tokens(pred, "answer", "_p", unit), ["id"], ["_g"]
    )
    shared = F.size(F.array_intersect("_p", "_g"))
    total = F.size("_p") + F.size("_g")
    f1 = F.when(total == 0, 1.0).otherwise(2 * shared / total)
    return _scored(gold, both.groupBy("id").agg(F.round(F.max(f1), 6).alias("f1")))


def support(pred: DataFrame, contexts: DataFrame, unit: str = "word") -> DataFrame:
    """Share of the answer's distinct tokens that its context (id, context) holds."""
    left = pred.select("id", F.array_distinct(tokens("answer", unit)).alias("_p"))
    right = contexts.select("id", F.array_distinct(tokens("context", unit)).alias("_c"))
    found = F.size(F.array_intersect("_p", F.coalesce("_c", F.array().cast("array<string>"))))
    share = F.when(F.size("_p") == 0, 0.0).otherwise(found / F.size("_p"))
    return left.join(right, "id", "left").select("id", F.round(share, 6).alias("support"))
