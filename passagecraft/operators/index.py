"""Inverted index over passages: build, save, load, update."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from passagecraft.functions.sizing import broadcast_if, stage
from passagecraft.functions.text import tokens, unnest, with_runs

PASSAGE = ["doc_id", "chunk_no"]
# Ranking works long on few bytes, so passages cut by one task are still ranked by many.
FILE_PASSAGES = 10_000


@dataclass
class Index:
    """A passage-wise inverted index.

    passages: by, doc_id, chunk_no, kept columns, n_words and ``runs``, the
    passage's distinct terms with their counts. terms: by, term, df. totals: by,
    n_chunks, n_words.
    """

    passages: DataFrame
    terms: DataFrame
    totals: DataFrame
    by: tuple[str, ...] = ()
    unit: str = "word"
    keep: tuple[str, ...] = ()

    def postings(self) -> DataFrame:
        """One row per passage and term: by, doc_id, chunk_no, kept columns, n_words, term, tf."""
        held = [c for c in self.passages.columns if c != "runs"]
        rows = unnest(self.passages, held, "runs", "_r")
        return rows.select(*held, F.col("_r.item").alias("term"), F.col("_r.n").alias("tf"))


def build_index(
    chunks: DataFrame, unit: str = "word", keep: tuple[str, ...] = (), by: tuple[str, ...] = ()
) -> Index:
    """Index passages. ``by`` keeps separate statistics for variants of a corpus.

    Text is cut once, without a shuffle, and the result staged; counts per term
    are partly summed before terms are shuffled.
    """
    cut = chunks.select(*by, *PASSAGE, *keep, tokens("chunk", unit).alias("_tokens"))
    passages = stage(with_runs(cut, "_tokens", "runs", "n_words"), "index", FILE_PASSAGES)
    return _counted(passages, by, unit, keep)


def _counted(passages: DataFrame, by: tuple[str, ...] = (), unit: str = "word", keep: tuple[str, ...] = ()) -> Index:
    index = Index(passages, None, None, by, unit, keep)
    index.terms = document_frequency(index.postings(), by)
    index.totals = passages.filter("n_words > 0").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("n_words")
    )
    return index


def document_frequency(postings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return postings.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("df"))


def save_index(index: Index, path: str) -> None:
    for part in ("passages", "terms", "totals"):
        getattr(index, part).write.parquet(f"{path}/{part}")


def load_index(
    spark: SparkSession, path: str, by: tuple[str, ...] = (), unit: str = "word", keep: tuple[str, ...] = ()
) -> Index:
    return Index(*(spark.read.parquet(f"{path}/{part}") for part in ("passages", "terms", "totals")), by, unit, keep)


def changes(old: DataFrame, new: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and status of each document in either snapshot; only hashes are shuffled.

    A document has changed if its text or one of the columns ``keep`` has; a null equals
    only a null.
    """
    def marked(df, name):
        return df.select("doc_id", F.lit(True).alias(f"_in_{name}"), F.md5(F.to_json(F.struct("text", *keep))).alias(f"_{name}"))

    status = (
        F.when(F.col("_in_old").isNull(), "new")
        .when(F.col("_in_new").isNull(), "deleted")
        .when(F.col("_old") != F.col("_new"), "changed")
        .otherwise("same")
    )
    joined = marked(old, "old").join(marked(new, "new"), "doc_id", "full_outer")
    return joined.select("doc_id", status.alias("status"))


def update_index(index: Index, changed: DataFrame, new_docs: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> Index:
    """Index after a refresh, from the old index and the touched documents only.

    ``changed`` comes from :func:`changes`, with the columns the index keeps; ``new_docs`` is
    the new snapshot, of which ``cut`` makes passages once the untouched documents are
    left out. Unit, kept columns and variants are those of the index. Term counts change by
    what left and what came, so untouched postings are not counted again; while few
    documents change, their ids are broadcast and the index is not shuffled.
    """
    by = index.by
    touched = stage(changed.filter("status <> 'same'"), "changes")
    out_ids = broadcast_if(touched.filter("status <> 'new'").select("doc_id"))
    in_ids = broadcast_if(touched.filter("status <> 'deleted'").select("doc_id"))
    fresh = build_index(cut(new_docs.join(in_ids, "doc_id", "left_semi")), index.unit, index.keep, by)
    gone = index.passages.join(out_ids, "doc_id", "left_semi")
    kept = index.passages.join(out_ids, "doc_id", "left_anti")
    lost = _counted(gone, by)
    terms = (
        index.terms.unionByName(lost.terms.withColumn("df", -F.col("df"))).unionByName(fresh.terms)
        .groupBy(*by, "term").agg(F.sum("df").alias("df")).filter("df > 0")
    )
    left = lost.totals.select(*by, (-F.col("n_chunks")).alias("n_chunks"), (-F.col("n_words")).alias("n_words"))
    totals = (
        index.totals.unionByName(left).unionByName(fresh.totals)
        .groupBy(*by).agg(F.sum("n_chunks").alias("n_chunks"), F.sum("n_words").alias("n_words"))
    )
    totals = totals.filter("n_chunks > 0") if by else totals
    passages = kept.select(index.passages.columns).unionByName(fresh.passages)
    return Index(passages, stage(terms, "terms"), totals, by, index.unit, index.keep)
