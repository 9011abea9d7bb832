"""Stored pages to a written corpus and its profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passagecraft.operators.extract import documents
from passagecraft.operators.profile import corpus_profile
from passagecraft.sources.tables import read_corpus, read_pages, write_corpus


def build_corpus(spark: SparkSession, pages_path: str, out_path: str, fmt: str = "parquet") -> DataFrame:
    """Write the documents of all pages and return their profile, read from what was written."""
    write_corpus(documents(read_pages(spark, pages_path)), out_path, fmt)
    return corpus_profile(read_corpus(spark, out_path, fmt))


def profile_pages(spark: SparkSession, pages_path: str) -> DataFrame:
    return corpus_profile(documents(read_pages(spark, pages_path)))
