"""Corpus profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.text import tokens


def corpus_profile(docs: DataFrame) -> DataFrame:
    """Counts and length quantiles per language and source, with subtotals.

    ``level`` is 0 for a language and source, 1 for a language, 3 for the corpus.
    Documents are first counted per length, so that the exact quantiles work on
    (length, count) pairs and no group's documents meet in one task.
    """
    counted = docs.groupBy("lang", "source", "n_chars").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size(tokens("text")).cast("long")).alias("words")
    )
    quantile = F.expr("percentile(n_chars, array(0.5, 0.9), n)")
    return (
        counted.rollup("lang", "source")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("n").alias("n_docs"),
            F.sum(F.col("n") * F.col("n_chars")).alias("n_chars_total"),
            F.sum("words").alias("n_words_total"),
            F.min("n_chars").alias("chars_min"),
            F.max("n_chars").alias("chars_max"),
            quantile.alias("q"),
        )
        .select(
            "lang", "source", "level", "n_docs", "n_chars_total", "n_words_total", "chars_min",
            F.round(F.col("q")[0], 4).alias("chars_p50"),
            F.round(F.col("q")[1], 4).alias("chars_p90"),
            "chars_max",
        )
    )


def distinct_texts(docs: DataFrame, error: float = 0.02) -> DataFrame:
    """Approximate number of distinct texts per language."""
    return docs.groupBy("lang").agg(F.approx_count_distinct("text", error).alias("n_texts"))
