"""Reports over per-query metrics."""

from __future__ import annotations

from functools import reduce
from math import exp

from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.text import hash28
from passagecraft.operators.chunk import chunk
from passagecraft.operators.index import build_index
from passagecraft.operators.lexical import bm25
from passagecraft.operators.metrics import recall_at
from passagecraft.operators.ranking import best_per_doc

# Draws of the bootstrap come from 28-bit hashes.
HASH_BITS = 28


def poisson_steps(bits: int = HASH_BITS) -> list[float]:
    """Cumulative Poisson(1) probabilities, for weights 0, 1, 2, ..., until what is left is below one hash value."""
    steps, term, k = [exp(-1)], exp(-1), 0
    while 1 - steps[-1] >= 2.0**-bits:
        k += 1
        term /= k
        steps.append(steps[-1] + term)
    return steps


def report(per_query: DataFrame, dims: list[str], metrics: list[str]) -> DataFrame:
    """Mean of each metric for every combination of ``dims`` and every total; ``all`` marks a total."""
    cubed = per_query.cube(*dims).agg(
        *[F.grouping(d).alias(f"_all_{d}") for d in dims],
        *[F.round(F.avg(m), 6).alias(m) for m in metrics],
        F.count(F.lit(1)).alias("n"),
    )
    named = [F.when(F.col(f"_all_{d}") == 1, "all").otherwise(F.col(d)).alias(d) for d in dims]
    long = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    return cubed.select(*named, long.alias("m"), "n").select(*dims, "m.metric", "m.value", "n")


def compare(a: DataFrame, b: DataFrame, replicates: int = 200, level: float = 0.95) -> DataFrame:
    """One row: mean difference b - a of query_id, value; wins, ties, losses; bootstrap interval.

    Each query draws its own Poisson weight per replicate from a hash, so replicates
    are sums that combine before the shuffle and come out the same on any partitioning.
    """
    joined = a.select("query_id", F.col("value").alias("_a")).join(
        b.select("query_id", F.col("value").alias("_b")), "query_id", "full_outer"
    )
    delta = joined.select(
        "query_id", F.round(F.coalesce("_b", F.lit(0.0)) - F.coalesce("_a", F.lit(0.0)), 6).alias("d")
    )
    drawn = delta.select("query_id", "d", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("r"))
    u = hash28(F.concat_ws("-", "query_id", "r")) / F.lit(float(2**HASH_BITS))
    weight = reduce(lambda w, p: w + F.when(u >= p, 1).otherwise(0), poisson_steps(), F.lit(0))
    means = (
        drawn.select("r", "d", weight.alias("w")).groupBy("r")
        .agg(F.round(F.try_divide(F.sum(F.col("w") * F.col("d")), F.sum("w")), 9).alias("m"))
        .filter("m is not null")
    )
    tail = (1 - level) / 2
    ends = means.agg(F.percentile("m", F.array(F.lit(tail), F.lit(1 - tail))).alias("q"))
    interval = ends.select("q").scalar()
    return delta.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.avg("d"), 6).alias("mean_delta"),
        *[F.count(F.when(cond, 1)).alias(name) for name, cond in
          [("wins", F.col("d") > 0), ("ties", F.col("d") == 0), ("losses", F.col("d") < 0)]],
    ).withColumn("low", F.round(interval[0], 6)).withColumn("high", F.round(interval[1], 6))


def sweep(
    docs: DataFrame, queries: DataFrame, qrels: DataFrame, grid: list[tuple[int, int]], ks: list[int], depth: int = 50
) -> DataFrame:
    """Recall, precision and hit rate for each passage size and overlap of ``grid``, in one job.

    A point at which no judged query has a result is there too, with zeros.
    """
    points = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(o).alias("overlap")) for s, o in grid])
    cut = chunk(
        docs.withColumn("_p", F.explode(points)).select("doc_id", "text", "_p.size", "_p.overlap"),
        F.col("size"), F.col("overlap"), keep=("size", "overlap"),
    )
    by = ("size", "overlap")
    ranked = best_per_doc(bm25(build_index(cut, by=by), queries, depth), by)
    every = docs.sparkSession.createDataFrame(grid, "size int, overlap int")
    return recall_at(ranked, qrels, ks, by, every)
