"""Size checks: what may be broadcast, and how to join what may not."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024
QUERY_BLOCK_BYTES = 32 * 1024 * 1024
HOT_KEY_ROWS = 1_000_000
HOT_KEY_LIMIT = 10_000
MERGE_PARTS = 32
# What a hashed table has for a row besides the row and its key: lengths, a pointer and up to four slots.
HASHED_ROW_BYTES = 80
# Bytes of a number inside an array; other values there are as in a row.
ITEM_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def broadcast_bytes(spark: SparkSession) -> int:
    """Largest measured size that may be broadcast, in bytes."""
    return int(spark.conf.get("spark.passagecraft.broadcastBytes", str(BROADCAST_BYTES)))


def query_block_bytes(spark: SparkSession) -> int:
    """Bytes of query weights or vectors handed to every task at a time."""
    return int(spark.conf.get("spark.passagecraft.queryBlockBytes", str(QUERY_BLOCK_BYTES)))


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.greatest(F.size(c), F.lit(0)) * 8 + 16
    if isinstance(field.dataType, T.StructType):
        parts = [F.greatest(F.size(c[f.name]), F.lit(0)) * 8
                 for f in field.dataType.fields if isinstance(f.dataType, T.ArrayType)]
        return reduce(lambda a, b: a + b, parts, F.lit(16))
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes held by ``df``, from one aggregate job; only the sum reaches the driver."""
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])
    return int(df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])


def _beside(c: Column, kind: T.DataType) -> Column | int:
    """Bytes of a value that lie beside the eight of its field; a plain number if all values have as many."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.ceil(F.octet_length(c) / 8) * 8, F.lit(0))
    if isinstance(kind, T.StructType):
        return _fields({f.name: (c.getField(f.name), f.dataType) for f in kind.fields})
    if isinstance(kind, T.ArrayType):
        item, n = kind.elementType, F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
        inside = _beside(F.get(c, F.lit(0)), item)
        if isinstance(inside, int):
            inside = n * inside
        else:
            inside = F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda total, x: total + _beside(x, item)), F.lit(0))
        return F.lit(16) + n * ITEM_BYTES.get(item.simpleString(), 8) + F.ceil(n / 64) * 8 + inside
    if isinstance(kind, T.MapType):
        return _beside(F.map_keys(c), T.ArrayType(kind.keyType)) + _beside(F.map_values(c), T.ArrayType(kind.valueType)) + F.lit(8)
    return 16 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 0


def _fields(values: dict[str, tuple[Column, T.DataType]]) -> Column | int:
    """Bytes of a row, or of a struct, of such values."""
    return sum((_beside(c, kind) for c, kind in values.values()), 8 * len(values) + 8 * -(-len(values) // 64))


def hashed_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as a hashed table, which the driver builds and every executor holds; from one aggregate job.

    Rows are counted as Spark lays them out, structs in full, and the key as large as a row
    without its arrays and maps, since it is not known here: it is rather more than less.
    """
    values = {f.name: (F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields}
    key = {name: v for name, v in values.items() if not isinstance(v[1], (T.ArrayType, T.MapType))}
    width = F.lit(HASHED_ROW_BYTES) + _fields(values) + _fields(key)
    return int(df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])


def fits_broadcast(df: DataFrame) -> bool:
    return hashed_bytes(df) <= broadcast_bytes(df.sparkSession)


def broadcast_if(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if its measured size allows."""
    return F.broadcast(df) if fits_broadcast(df) else df


def match(big: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Inner equi-join of a large table with one that is normally small.

    The small side is broadcast when its measured size allows; see
    :func:`split_join` for the other case.
    """
    if fits_broadcast(small):
        return big.join(F.broadcast(small), keys)
    return split_join(big, small, keys, spread_by)


def split_join(big: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Inner equi-join by shuffle that splits the hot keys of ``big``.

    A key holding too many rows is spread over several tasks by a hash of
    ``spread_by``, and its rows of ``small`` are repeated once per part. At most
    ``HOT_KEY_LIMIT`` keys can pass the threshold, so that list is safe to broadcast.
    """
    total = big.agg(F.count(F.lit(1))).scalar()
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    threshold = F.greatest(F.lit(HOT_KEY_ROWS), F.ceil(total / HOT_KEY_LIMIT))
    hot = (
        counts.withColumn("_t", threshold)
        .filter("_n > _t")
        .select(*keys, F.ceil(F.col("_n") / F.col("_t")).cast("int").alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    left = (
        big.join(F.broadcast(hot), keys, "left")
        .withColumn("_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
        .drop("_parts")
    )
    right = (
        small.join(F.broadcast(hot), keys, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    return left.join(right, [*keys, "_part"]).drop("_part")


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Stands in for the shared folder on one machine; removed when Python exits."""
    return tempfile.TemporaryDirectory(prefix="passagecraft-", ignore_cleanup_errors=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder the session names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder().name
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several later steps read: each step then scans the columns it
    needs instead of computing everything again, and losing an executor loses no work.
    ``rows_per_file`` makes files small, for steps that work long on few bytes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def top_k(df: DataFrame, group: list[str], k: int, ties: list[str]) -> DataFrame:
    """Highest ``score`` first within ``group``; ``ties`` decide equal scores.

    Every task of a scan may send k rows per group. They are merged in two steps, first in
    ``MERGE_PARTS`` parts of each group, so that no group meets whole in one task. The
    filters on the rank let Spark cut each task's rows to k per group before each shuffle.
    """
    order = [F.desc("score"), *ties]
    part = F.pmod(F.xxhash64(*ties), F.lit(MERGE_PARTS))
    near = Window.partitionBy(*group, "_part").orderBy(*order)
    parts = df.withColumn("_part", part).withColumn("_rank", F.row_number().over(near)).filter(F.col("_rank") <= k)
    whole = Window.partitionBy(*group).orderBy(*order)
    return parts.drop("_part", "_rank").withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)


def blocks(df: DataFrame, key: str, most_bytes: int) -> list[DataFrame]:
    """``df`` in parts of about ``most_bytes``, all rows of one ``key`` in one part.

    Each part is for the driver to read and hand to every task, one after the other, so
    what it holds at a time does not depend on how many rows there are.
    """
    n = max(1, -(-measured_bytes(df) // most_bytes))
    place = F.pmod(F.xxhash64(key), F.lit(n))
    return [df] if n == 1 else [df.filter(place == i) for i in range(n)]
