"""Ranks and running totals over a whole table, without a task that holds all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagecraft.functions.sizing import stage

# A row's number holds its partition above this many bits, its place in it below.
PLACE_BITS = 33


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` as a staged table in ``order``, dealt by range: ``_part`` in order, ``_pos`` from 0 in each.

    ``order`` should tell rows apart; rows that it does not tell apart share a range.
    The table is written because ranges come from a sample and would differ when taken again.
    """
    number = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_n", number)
    parts = dealt.withColumn("_part", F.shiftright("_n", PLACE_BITS).cast("int"))
    return stage(parts.withColumn("_pos", F.col("_n").bitwiseAND((1 << PLACE_BITS) - 1)).drop("_n"), "ordered")


def offsets(parts: DataFrame, sums: list[str]) -> DataFrame:
    """``_part`` and ``_before_<sum>``: totals of all earlier ranges, a row for each range.

    The driver reads one row of totals per range, as many as there are shuffle partitions.
    """
    spark = parts.sparkSession
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sums]).collect()
    rows, running = [], [0] * len(sums)
    for row in sorted(totals, key=lambda r: r["_part"]):
        rows.append((row["_part"], *running))
        running = [a + (row[c] or 0) for a, c in zip(running, sums)]
    return spark.createDataFrame(rows, ", ".join(["_part int", *[f"_before_{c} long" for c in sums]]))


def with_rank(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """``df`` with its row number from 1 in ``order``."""
    parts = ordered(df, *order)
    before = offsets(parts.withColumn("_rows", F.lit(1)), ["_rows"])
    return parts.join(F.broadcast(before), "_part").withColumn(
        name, F.col("_before__rows") + F.col("_pos") + 1).drop("_part", "_pos", "_before__rows")


def with_running(df: DataFrame, sums: list[str], *order: Column | str, prefix: str = "cum_") -> DataFrame:
    """``df`` with ``cum_<sum>``: the total of each of the whole-number columns ``sums`` up to and with the row.

    Each range is summed up by itself, then moved by the totals of the ranges before it.
    """
    parts = ordered(df, *order)
    within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moved = parts.withColumns({f"_in_{c}": F.sum(c).over(within) for c in sums}).join(F.broadcast(offsets(parts, sums)), "_part")
    return moved.withColumns({f"{prefix}{c}": F.col(f"_in_{c}") + F.col(f"_before_{c}") for c in sums}).drop(
        "_part", "_pos", *[f"_in_{c}" for c in sums], *[f"_before_{c}" for c in sums])
