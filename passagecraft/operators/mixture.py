"""A corpus mixed to a budget of words per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagecraft.functions.sizing import match, stage
from passagecraft.functions.text import hash28, pieces

# Bits of the hash that are still open after each step: the first leaves 2**10 sums a group, so do the next.
STEPS = (18, 8, 0)


def _cut(sums: DataFrame, by: str, order: str) -> DataFrame:
    """The first ``order`` of each group at which the running sum goes over the budget, and the sum before it."""
    upto = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sums.withColumn("upto", F.col("before") + F.sum("n").over(upto)).filter(F.col("upto") > F.col("budget"))
    return run.groupBy(by, "budget").agg(F.min(F.struct(F.col(order).alias("at"), (F.col("upto") - F.col("n")).alias("before"))).alias("c")).select(
        by, "budget", "c.at", "c.before")


def mixture(docs: DataFrame, budgets: dict[str, int], by: str = "lang", words: Column | None = None) -> DataFrame:
    """``docs`` in the order of their hashed ids while the words of their group stay within its budget.

    A document is kept if it and all before it in its group (by hash of ``doc_id``, then
    ``doc_id``) hold at most ``budgets[group]`` words, counted as pieces between spaces or
    by ``words``. Groups without a budget are left out, as are null ones; null texts hold
    no words. Rows of one id stand or fall together; a null id comes first.

    No group is sorted: sums per hash bucket show which bucket holds the cut, that bucket is
    summed more finely, down to one hash, whose few ids are put in order. Tasks sum up before
    each shuffle, and the verdict is one row per group.
    """
    spark = docs.sparkSession
    n = F.coalesce(F.size(pieces("text")) if words is None else words, F.lit(0)).cast("long")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = stage(docs.select(F.col(by).alias("_by"), key.alias("_key"), "doc_id", hash28(key).alias("_h"), F.greatest(n, F.lit(0)).alias("n")), "words")
    state = spark.createDataFrame([(g, int(b), None, 0) for g, b in budgets.items()], f"_by {docs.schema[by].dataType.simpleString()}, budget long, at long, before long")
    above = None
    # One row per group with a budget, given by the caller.
    for open_bits in STEPS:
        held = rows.join(F.broadcast(state), "_by")
        if above is not None:
            held = held.filter(F.shiftright("_h", above) == F.col("at"))
        sums = held.withColumn("at", F.shiftright("_h", open_bits)).groupBy("_by", "budget", "before", "at").agg(F.sum("n").alias("n"))
        state, above = stage(_cut(sums, "_by", "at"), "cut"), open_bits
    last = rows.join(F.broadcast(state), "_by").filter(F.col("_h") == F.col("at")).groupBy("_by", "budget", "before", "_key", "doc_id").agg(F.sum("n").alias("n"))
    first_out = last.withColumn("upto", F.col("before") + F.sum("n").over(
        Window.partitionBy("_by").orderBy(F.asc_nulls_first("doc_id")))).filter(F.col("upto") > F.col("budget"))
    ends = first_out.groupBy("_by").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("x"), "doc_id")).alias("e"))
    ids = state.select("_by", F.col("at").alias("_at")).join(ends.select("_by", F.lit(True).alias("_cut"), F.col("e.doc_id").alias("_end")), "_by", "left")
    verdict = spark.createDataFrame([(g,) for g in budgets], f"_by {docs.schema[by].dataType.simpleString()}").join(ids, "_by", "left")
    inside = F.col("_at").isNull() | (F.col("_h") < F.col("_at")) | ((F.col("_h") == F.col("_at")) & F.coalesce(F.col("doc_id") < F.col("_end"), F.col("doc_id").isNull() & F.col("_end").isNotNull()))
    kept = match(docs.withColumn("_by", F.col(by)).withColumn("_h", hash28(key)), verdict, ["_by"], ["doc_id"]).filter(inside)
    return kept.select(*docs.columns)
