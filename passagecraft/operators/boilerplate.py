"""Lines that many documents share."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from passagecraft.functions.sizing import broadcast_bytes, split_join, stage
from passagecraft.functions.text import unnest

# Parts that the rows of one text are dealt to, where very many rows may be copies of it.
COPIES = 8
# Bytes of the hash of a line.
PAIR_BYTES = 16

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lines(text: str = "text") -> Column:
    return F.split(text, "\n")


def _hash(line: Column) -> Column:
    """128 bits of a trimmed line, null for a blank one: they stand for the line in every shuffle."""
    bare = F.trim(line)
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(bare, F.lit(1)).alias("b")))


def _hashes() -> Column:
    return F.transform(_lines(), _hash)


def common_lines(docs: DataFrame, least: int) -> DataFrame:
    """``a, b, n_docs``: hashes of the lines that ``least`` rows of ``docs`` or more hold, each counted once a row.

    A task sums up before the shuffle, so a line that every document holds sends one row per task.
    """
    # Distinct as strings: structs would be compared pair by pair.
    bare = F.array_distinct(F.transform(_lines(), lambda s: F.trim(s)))
    return unnest(docs, [], F.transform(bare, _hash), "h").groupBy("h.a", "h.b").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= least)


def _among(a: np.ndarray, b: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For pairs of hashes whether they are in ``known``, pairs sorted by ``a``, which are neither copied nor sorted again."""
    known_a, known_b = known
    found, at = np.zeros(len(a), bool), np.searchsorted(known_a, a)
    left = np.arange(len(a))
    while len(left):
        left = left[at[left] < len(known_a)]
        left = left[known_a[at[left]] == a[left]]
        found[left] |= known_b[at[left]] == b[left]
        at[left] += 1
        left = left[~found[left]]
    return found


def _marked(batch: pa.RecordBatch, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For lines of all texts in a row whether they are common, and how many lines each text has."""
    hashed = batch.column(batch.schema.get_field_index("_h"))
    flat = hashed.flatten()
    a, b = (flat.field(name).fill_null(0).to_numpy(zero_copy_only=False) for name in ("a", "b"))
    sizes = hashed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return _among(a, b, known) & flat.is_valid().to_numpy(zero_copy_only=False), sizes


def _without(text: str, gone: set[int]) -> str:
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)


def _rebuilt(batches: Iterator[pa.RecordBatch], common) -> Iterator[pa.RecordBatch]:
    """Texts without the lines marked by hashes in ``_h``, or at the places in ``_gone`` if no hashes are given."""
    for batch in batches:
        texts = batch["text"].to_pylist()
        if common is not None:
            gone, sizes = _marked(batch, common.value)
            ends = np.cumsum(sizes)
            places = [np.flatnonzero(gone[e - k : e]).tolist() for e, k in zip(ends.tolist(), sizes.tolist())]
        else:
            places = [p or [] for p in batch["_gone"].to_pylist()]
        texts = [_without(t, set(p)) if p else t for t, p in zip(texts, places)]
        yield pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "row": batch["row"], "_n": pa.array(list(map(len, places)), pa.int64())})


def drop_common_lines(docs: DataFrame, least: int, count: str | None = None) -> DataFrame:
    """``docs`` without the lines that ``least`` rows or more hold; what is left keeps its order.

    Lines are compared without spaces at their ends; blank ones stay. ``count`` names a column for how many lines
    went. Null texts stay null, other columns pass through; repeated rows count as documents
    of their own. If the common lines are few enough to broadcast (16 bytes each), every text
    is rebuilt in the task that reads it and no text is shuffled; else places of lines meet
    the common ones by a join that splits hot lines, and texts meet the places that go.
    """
    spark = docs.sparkSession
    common = stage(common_lines(docs, least).select("a", "b"), "common-lines")
    rows = docs.select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    schema = T.StructType([*rows.schema, T.StructField("_n", T.LongType())])
    if common.count() * PAIR_BYTES <= broadcast_bytes(spark):
        table = common.toArrow()
        order = np.argsort(table["a"].to_numpy())
        held = spark.sparkContext.broadcast((table["a"].to_numpy()[order], table["b"].to_numpy()[order]))
        done = rows.withColumn("_h", _hashes()).mapInArrow(lambda b: _rebuilt(b, held), schema)
    else:
        keyed = rows.withColumn("_key", F.sha2(F.col("text"), 256))
        placed = unnest(keyed.dropDuplicates(["_key"]), ["_key"], _hashes(), "h", "at").select("_key", "at", "h.a", "h.b")
        gone = split_join(placed, common, ["a", "b"], ["_key", "at"]).groupBy("_key").agg(F.collect_list("at").alias("_gone"))
        parts = F.pmod(F.xxhash64("row"), F.lit(COPIES)).cast("int")
        spread = gone.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        done = keyed.withColumn("_part", parts).join(spread, ["_key", "_part"], "left").drop("_key", "_part").mapInArrow(lambda b: _rebuilt(b, None), schema)
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return done.select(*columns, *([F.col("_n").alias(count)] if count else []))
