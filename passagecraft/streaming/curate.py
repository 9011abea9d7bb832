"""Newly landed pages to a curated corpus, a little at a time, with duplicates known across landings.

Two streaming queries run one after the other, each with its own checkpoint: pages become
documents, one per canonical address; documents that pass the rules are kept once per text.
What was seen is keyed state that expires, so it grows with what lands within the horizon
and not with the age of the corpus.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from passagecraft.operators.extract import documents
from passagecraft.operators.prepare import canonical_address
from passagecraft.operators.rules import RULES, apply_rules
from passagecraft.sources.tables import DOCUMENT_SCHEMA, PAGE_SCHEMA

HOUR = 3600
HORIZON, DELAY = 30 * 24 * HOUR, 7 * 24 * HOUR


@dataclass
class Landed:
    """What one run of a streaming query did: batches, rows read, rows too late, keys remembered at its end and dropped."""

    batches: int = 0
    rows_in: int = 0
    too_late: int = 0
    remembered: int = 0
    forgotten: int = 0


def _earliest(key: str):
    """Of the rows of one key and time in a batch of Arrow rows only the one with the smallest id matters."""

    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values("doc_id", kind="stable").drop_duplicates([key, "at"])

    return reduced


def _first_seen(horizon: int):
    """Keep a key's first row, and its next ones that come more than ``horizon`` milliseconds after the one before.

    A frame is made for every key and most hold one row, so each is handed on as it came where
    it can be. ``_packed`` begins with the row's time and id.
    """

    def kept(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        # One row for each time, that is for each file read at once, at most.
        rows: dict[int, tuple[bool, int, pd.DataFrame, int]] = {}
        for frame in frames:
            for i, packed in enumerate(frame["_packed"].array):
                at, doc = math.nan if packed[0] is None else int(packed[0]), packed[1]
                # A row without an id comes after those with one.
                order = doc is None, int(doc or 0)
                if at not in rows or order < rows[at][:2]:
                    rows[at] = *order, frame, i
        for at in sorted(rows):
            if last is None or at - last > horizon:
                frame, i = rows[at][2:]
                yield frame if len(frame) == 1 else frame.iloc[i : i + 1]
            last = at if last is None else max(last, at)
        if last + horizon > state.getCurrentWatermarkMs():
            state.update((last,))
            state.setTimeoutTimestamp(last + horizon)
        elif state.exists:
            state.remove()

    return kept


def first_in_horizon(rows: DataFrame, key: str, time: str, horizon: int = HORIZON, delay: int = DELAY) -> DataFrame:
    """Streaming ``rows`` (``doc_id`` and more) without those whose ``key`` came at most ``horizon`` seconds before.

    Among rows of one time the smallest ``doc_id`` stays. A key's state is one number; it is
    dropped once the watermark, ``delay`` seconds behind the newest ``time``, is ``horizon``
    past its last row. Rows older than the watermark are left out as too late, so ``delay`` is
    how far out of order files may land; it may not exceed ``horizon``. Null keys are left out.
    Repeats within an Arrow batch are dropped before the shuffle, so a key that holds
    most rows sends few of them to its task. Python gets a frame for each key, which costs by
    its columns; so texts and whole numbers go through it as one array of strings.
    """
    if delay > horizon:
        raise ValueError("rows may not come later than keys are remembered")
    timed = rows.filter(F.col(key).isNotNull()).withColumn("at", F.unix_millis(time))
    few = timed.mapInPandas(_earliest(key), timed.schema)
    plain = (T.StringType, T.LongType, T.IntegerType)
    parts = ["at", "doc_id", *[c for c in rows.columns if c not in (key, time, "at", "doc_id") and type(rows.schema[c].dataType) in plain]]
    others = [c for c in few.columns if c not in parts]
    bare = few.select(*others, F.array(*[F.col(c).cast("string") for c in parts]).alias("_packed"))
    marked = bare.withWatermark(time, f"{delay} seconds")
    first = marked.groupBy(key).applyInPandasWithState(
        _first_seen(1000 * horizon), bare.schema, "last long", "append", GroupStateTimeout.EventTimeTimeout)
    whole = {c: F.col("_packed")[i].cast(few.schema[c].dataType) for i, c in enumerate(parts)}
    return first.select(*[whole[c].alias(c) if c in whole else c for c in rows.columns if c != "at"])


def _run(rows: DataFrame, path: str, checkpoint: str, by: str | None) -> Landed:
    out = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    query = (out.partitionBy(by) if by else out).trigger(availableNow=True).start()
    query.awaitTermination()
    done = Landed()
    for progress in query.recentProgress:
        done.batches += 1
        done.rows_in += progress.numInputRows
        for state in progress.stateOperators:
            done.too_late += state.numRowsDroppedByWatermark
            done.forgotten += state.numRowsRemoved
            done.remembered = state.numRowsTotal
    return done


def stream_curate(
    spark: SparkSession, landing: str, out_path: str, checkpoint: str, rules: dict[str, str] = RULES,
    horizon: int = HORIZON, delay: int = DELAY, name: str = "*.parquet", files: int = 1000, time: str | None = None,
) -> tuple[Landed, Landed]:
    """Curate every page file in folder ``landing`` not yet seen, then stop; what each of the two queries did.

    A page's time is that of its file, or the timestamp in column ``time``, which may be the
    one that names the subfolders (``time=2024-01-31 00:00:00``). Of the pages of one canonical address (scheme, mirror
    prefix, query and endings do not count) only the first counts, even if the rules reject
    it; of equal texts the first that passes. First is by landing time, then by page id among
    the up to ``files`` files read at a time; a later one counts again if it comes more than
    ``horizon`` seconds after the one before it. Pages without a host are left out. The result in ``out_path`` has the columns of documents, by language.
    Checkpoints record files, state and what was written: a restart repeats and loses nothing.
    For states beyond the executors' memory set Spark's RocksDB state store.
    """
    kept = f"{DOCUMENT_SCHEMA}, landed timestamp"
    source = spark.readStream.schema(PAGE_SCHEMA + (f", {time} timestamp" if time else "")).option("maxFilesPerTrigger", files)
    source = source.option("pathGlobFilter", name).option("maxFileAge", f"{horizon + delay}s")
    landed = F.col(time or "_metadata.file_modification_time").alias("landed")
    pages = source.parquet(landing).select("page_id", "url", "html", landed)
    found = documents(pages, keep=(canonical_address("url").alias("canon"), "landed"))
    once = first_in_horizon(found, "canon", "landed", horizon, delay).drop("canon")
    stored = os.path.join(checkpoint, "documents")
    first = _run(once, stored, os.path.join(checkpoint, "addresses"), None)
    if not first.batches and not _written(spark, stored):
        return first, Landed()
    # All at once, as files of one landing would otherwise come in any order, and however long ago they were written.
    docs = spark.readStream.schema(kept).option("maxFileAge", "3650d").parquet(stored)
    passed = apply_rules(docs, rules).filter(F.size("reasons") == 0).withColumn("digest", F.sha2("text", 256))
    texts = first_in_horizon(passed.drop("reasons"), "digest", "landed", horizon, delay).drop("digest", "landed")
    return first, _run(texts, out_path, os.path.join(checkpoint, "texts"), "lang")


def _written(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
