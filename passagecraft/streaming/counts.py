"""Pages per host and time window as they land, with those too late counted apart."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagecraft.operators.prepare import host_of

HOUR = 3600
COUNTS, LATE = "host string, start timestamp, n long", "host string, start timestamp"


def _timed(pages: DataFrame, time: str, landed: Column, window: int, delay: int) -> DataFrame:
    """``host, at, start, late``: a page fetched after it landed counts as fetched then."""
    at = F.when(F.col(time).isNotNull(), F.least(F.col(time), landed))
    start = F.timestamp_seconds(F.floor(F.unix_seconds(at) / window) * window)
    late = F.unix_seconds(start) + window + delay <= F.unix_seconds(landed)
    return pages.select(F.coalesce(host_of("url"), F.lit("")).alias("host"), at.alias("at"), start.alias("start"), late.alias("late")).filter("at is not null")


def stream_counts(
    spark: SparkSession, landing: str, out_path: str, checkpoint: str, window: int = HOUR, delay: int = 2 * HOUR,
    time: str = "fetched", landed: str | None = None, name: str = "*.parquet", files: int = 1000,
) -> None:
    """Count every page file in folder ``landing`` not yet seen by host and window of ``window`` seconds, then stop.

    ``time`` is the timestamp column of when a page was fetched; it landed with its file, or
    at the timestamp in ``landed`` (which may name the subfolders). A page that lands
    ``delay`` seconds or more after its window ended is late: it is not counted in
    the window but kept apart. Whether a page is late thus depends on the page alone, not on
    what else is read at the time; the watermark, ``delay`` behind the newest page, never
    drops one that is not. A window is written once, when the watermark has passed its end;
    until then it is state, which holds the hosts of the open windows only. Hosts are summed
    up in each task first. Pages without a time are left out; those without a host count
    under an empty one. Restarts repeat and lose nothing.
    """
    schema = f"url string, {time} timestamp" + (f", {landed} timestamp" if landed else "")
    source = spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).option("maxFileAge", "3650d")
    rows = _timed(source.parquet(landing), time, F.col(landed or "_metadata.file_modification_time"), window, delay)
    # The watermark is taken over all rows, late ones too: they are older than it anyway.
    marked = rows.withWatermark("at", f"{delay} seconds")
    counted = marked.filter("not late").groupBy("host", F.window("at", f"{window} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    closed = counted.select("host", F.col("w.start").alias("start"), "n")
    for label, part in (("counts", closed), ("late", rows.filter("late").select("host", "start"))):
        query = part.writeStream.format("parquet").option("path", os.path.join(out_path, label)).option(
            "checkpointLocation", os.path.join(checkpoint, label)).trigger(availableNow=True).start()
        query.awaitTermination()


def window_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """``host, start, n, n_late`` of what :func:`stream_counts` wrote: closed windows, and late pages by theirs."""
    counts = spark.read.schema(COUNTS).parquet(os.path.join(out_path, "counts"))
    late = spark.read.schema(LATE).parquet(os.path.join(out_path, "late"))
    both = counts.withColumn("n_late", F.lit(0).cast("long")).unionByName(
        late.groupBy("host", "start").agg(F.count(F.lit(1)).alias("n_late")).withColumn("n", F.lit(0).cast("long")))
    return both.groupBy("host", "start").agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))
