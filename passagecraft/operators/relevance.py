"""Which documents hold a query's passage."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from passagecraft.functions.runs import grams
from passagecraft.functions.sizing import match, stage
from passagecraft.functions.text import tokens


# Marks of wanted runs that every task has: 2^22 bits, half a megabyte.
MARK_BITS = 22


def _grams(df: DataFrame, keep: list[str], n: int, marks: np.ndarray | None = None) -> DataFrame:
    """``keep``, position and two hashes of each run of n tokens of column ``_t``, with ``marks`` only of those that are marked."""
    names = [*keep, "at", "_size", "_a", "_b"]
    added = [T.StructField("at", T.IntegerType()), T.StructField("_size", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("_a", "_b")]]

    def cut(batches):
        for batch in batches:
            for row, at, a, b in grams(batch["_t"], n, marks):
                kept = [batch[c].take(pa.array(row)) for c in keep]
                size = np.full(len(row), n, np.int32)
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c) for c in (at.astype(np.int32), size, a, b)]], names=names)

    return df.select(*keep, "_t").mapInArrow(cut, T.StructType([*[df.schema[c] for c in keep], *added]))


def _marks(wanted: DataFrame) -> np.ndarray:
    """Packed marks of the first hashes' top bits; the driver reads a number for each mark, 2^22 at most."""
    found = wanted.select(F.shiftrightunsigned("_a", 64 - MARK_BITS).alias("m")).distinct().toArrow()["m"].to_numpy()
    marks = np.zeros(1 << MARK_BITS, bool)
    marks[found] = True
    return np.packbits(marks, bitorder="little")


def qrels(items: DataFrame, docs: DataFrame, n: int = 8, unit: str = "word") -> DataFrame:
    """query_id, doc_id, rel = 1 where a document holds all of an item's tokens in a row.

    Runs of n tokens, or of an item's own length if it is shorter, are joined by two 64-bit
    hashes. Runs of documents are hashed where they lie, and only those go on whose hash
    shares its first bits with a wanted one. Each match says where in the document the item would have to start; it is there
    if every one of its runs agrees on that start. No text is joined back and no pair is
    tested by scanning.
    """
    cut_items = stage(items.select(F.col("item_id").alias("query_id"), tokens("text", unit).alias("_t")).filter(F.size("_t") > 0), "items")
    cut_docs = docs.select("doc_id", tokens("text", unit).alias("_t"))
    # At most n lengths, whatever the number of items.
    lengths = [r["n"] for r in cut_items.select(F.least(F.size("_t"), F.lit(n)).alias("n")).distinct().collect()]
    if not lengths:
        return cut_items.join(docs.select("doc_id").limit(0), F.lit(True)).select("query_id", "doc_id", F.lit(1).alias("rel"))
    own = cut_items.withColumn("_l", F.least(F.size("_t"), F.lit(n))).withColumn("_need", F.size("_t") - F.col("_l") + 1)
    wanted = stage(reduce(DataFrame.union, [_grams(own.filter(F.col("_l") == k), ["query_id", "_need"], k) for k in lengths]), "wanted")
    marks = _marks(wanted)
    held = reduce(DataFrame.union, [_grams(cut_docs, ["doc_id"], k, marks) for k in lengths])
    hits = match(held, wanted.withColumnRenamed("at", "_j"), ["_size", "_a", "_b"], ["doc_id", "at"])
    starts = hits.groupBy("query_id", "doc_id", (F.col("at") - F.col("_j")).alias("start")).agg(
        F.count(F.lit(1)).alias("_found"), F.first("_need").alias("_need")
    )
    pairs = starts.filter("_found = _need").select("query_id", "doc_id").distinct()
    return stage(pairs.withColumn("rel", F.lit(1)), "qrels")
