"""What each cut of a score keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagecraft.functions.ordering import with_running
from passagecraft.functions.sizing import stage


def threshold_sweep(scored: DataFrame, labels: DataFrame, score: str = "score", label: str = "label", key: str = "doc_id") -> DataFrame:
    """One row per distinct score: what is kept if rows of that score or a higher one are.

    ``threshold, n_kept, n_right, precision, recall, f1`` over the rows with a score and a
    label (1 right, else wrong), joined on ``key``. Rows of one score stand or fall together
    and are counted before anything is put in order, so a score that most rows share is one
    row. Counts run on over ranges of scores: no task sees all of them. Shares are 0 where
    there is nothing to share.
    """
    known = scored.select(key, F.col(score).alias("threshold")).filter("threshold is not null and not isnan(threshold)")
    marks = labels.select(key, (F.col(label) == 1).cast("long").alias("right")).filter("right is not null")
    counts = stage(known.join(marks, key).groupBy("threshold").agg(F.count(F.lit(1)).alias("n_kept"), F.sum("right").alias("n_right")), "scores")
    total = counts.agg(F.sum("n_right")).first()[0] or 0
    run = with_running(counts, ["n_kept", "n_right"], F.desc("threshold")).select(
        "threshold", F.col("cum_n_kept").alias("n_kept"), F.col("cum_n_right").alias("n_right"))
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)), 6)
    right, kept = F.col("n_right"), F.col("n_kept")
    return run.select(
        "threshold", "n_kept", "n_right", share(right, kept).alias("precision"), share(right, F.lit(total)).alias("recall"),
        share(2 * right, kept + total).alias("f1"))
