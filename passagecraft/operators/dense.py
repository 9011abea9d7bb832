"""Vector ranking: hashed TF-IDF vectors, exact and approximate nearest neighbours."""

from __future__ import annotations

from functools import reduce
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from passagecraft.functions.kernel import Best, add_vectors, matrix, unit
from passagecraft.functions.runs import counted, owners
from passagecraft.functions.sizing import blocks, measured_bytes, query_block_bytes, stage, top_k
from passagecraft.functions.text import hash28, tokens, unnest


def bucket_counts(texts: DataFrame, keys: list[str], text: str, dim: int, unit: str = "word") -> DataFrame:
    """Feature hashing: how many tokens of each text fall in each of ``dim`` buckets."""
    cut = texts.select(*keys, tokens(text, unit).alias("_tokens"))
    buckets = pa.array(np.arange(dim, dtype=np.int32))

    def hashed(batches):
        for batch in batches:
            words = batch["_tokens"].flatten().dictionary_encode()
            # As :func:`hash28`, of every distinct word of a batch.
            held = [int(md5(w).hexdigest()[:7], 16) % dim for w in words.dictionary.cast(pa.binary()).to_pylist()]
            code = np.array(held, np.int64)[words.indices.to_numpy()]
            out = counted(owners(batch["_tokens"]), code, batch.num_rows, buckets)
            yield pa.RecordBatch.from_arrays([*[batch[key] for key in keys], out], names=[*keys, "_runs"])

    run = T.DataType.fromDDL("array<struct<item: int, n: int>>")
    return cut.mapInArrow(hashed, T.StructType([*[cut.schema[key] for key in keys], T.StructField("_runs", run)]))


def bucket_idf(counts: DataFrame, dim: int) -> DataFrame:
    """One row: the weight of every bucket, as an array of ``dim`` numbers."""
    n = counts.agg(F.count(F.lit(1))).scalar()
    df = unnest(counts, [], "_runs.item", "bucket").groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    pairs = df.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "df"))).alias("m"))
    weights = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.log((F.col("n") + 1) / (F.coalesce(F.col("m")[i], F.lit(0)) + 1)) + 1,
    )
    return pairs.withColumn("n", n).select(weights.alias("idf"))


def weigh(counts: DataFrame, idf: DataFrame | np.ndarray, keys: list[str]) -> DataFrame:
    """Unit-length vectors as a struct of bucket indices and weights; the driver reads the ``dim`` weights of buckets."""
    known = np.array(idf.first()[0]) if isinstance(idf, DataFrame) else idf

    def weighed(batches):
        for batch in batches:
            runs = batch["_runs"].flatten()
            row = owners(batch["_runs"])
            raw = runs.field("n").to_numpy() * known[runs.field("item").to_numpy()]
            norm = np.sqrt(np.bincount(row, raw * raw, batch.num_rows))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            offsets = pa.array(ends.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, values) for values in (runs.field("item"), pa.array(raw / norm[row]))]
            yield pa.RecordBatch.from_arrays([*[batch[key] for key in keys], pa.StructArray.from_arrays(lists, names=["indices", "weights"])], names=[*keys, "vector"])

    vector = T.DataType.fromDDL("struct<indices: array<int>, weights: array<double>>")
    return counts.select(*keys, "_runs").mapInArrow(weighed, T.StructType([*[counts.schema[key] for key in keys], T.StructField("vector", vector)]))


def hash_embed(
    chunks: DataFrame,
    queries: DataFrame | None = None,
    dim: int = 256,
    keys: tuple[str, ...] = ("doc_id", "chunk_no"),
    unit: str = "word",
) -> tuple[DataFrame, DataFrame | None]:
    """Vectors of passages, and of queries under the passages' weights.

    Weights belong to buckets, not to terms, so what has to be known everywhere
    is ``dim`` numbers however large the vocabulary is; passages are not shuffled.
    """
    counts = stage(bucket_counts(chunks, list(keys), "chunk", dim, unit), "buckets")
    idf = np.array(bucket_idf(counts, dim).first()[0])
    asked = None
    if queries is not None:
        asked = weigh(bucket_counts(queries, ["query_id"], "question", dim, unit), idf, ["query_id"])
    return weigh(counts, idf, list(keys)), asked


def vector_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    metric: str = "cosine",
    keys: tuple[str, ...] = ("vec_id",),
    vector: str = "embedding",
    dim: int | None = None,
) -> DataFrame:
    """Exact nearest vectors per query; cosine, dot or l2 (as negative distance).

    Query vectors are cut into blocks of bounded size. For each block every task scores
    batches of vectors in place and keeps k rows per query. Rows and queries with a null
    vector are left out; keys and query ids keep their type.
    """
    return _searched(vectors.select(*keys, vector), queries.select("query_id", vector), k, metric, keys, vector, dim)


def _searched(rows, asked, k, metric, keys, vector, dim) -> DataFrame:
    """``rows`` and ``asked`` hold keys and vectors; with ``cell`` and ``cells`` a query meets only vectors in its cells."""
    asked = stage(asked.filter(F.col(vector).isNotNull()), "query-vectors")
    wide = asked.withColumn(vector, F.array_repeat(F.lit(0.0), dim)) if dim else asked
    share = measured_bytes(wide) / max(1, measured_bytes(asked))
    size = int(query_block_bytes(asked.sparkSession) / max(1.0, share))
    parts = [_scored_in_place(rows, part, k, metric, keys, vector, dim) for part in blocks(asked, "query_id", max(1, size))]
    return top_k(reduce(DataFrame.union, parts), ["query_id"], k, list(keys))


def _scored_in_place(rows, asked, k, metric, keys, vector, dim) -> DataFrame:
    """Best k rows per query and task, for one block of query vectors."""
    table = asked.toArrow().combine_chunks()
    ids = table["query_id"].combine_chunks() if len(table) else pa.array([], table.schema.field("query_id").type)
    block = matrix(table[vector], dim)
    block = unit(block) if metric == "cosine" else block
    everyone, probing = np.arange(len(ids)), None
    if "cells" in table.column_names:
        flat = table["cells"].combine_chunks()
        owner = np.repeat(everyone, pc.list_value_length(flat).to_numpy(zero_copy_only=False)) if len(ids) else everyone
        cell = flat.flatten().to_numpy(zero_copy_only=False) if len(ids) else everyone
        probing = {c: owner[cell == c] for c in np.unique(cell).tolist()}
        # Where cells are folders of a stored table, the others are not read.
        rows = rows.filter(F.col("cell").isin(list(probing)))
    types = [to_arrow_type(rows.schema[key].dataType) for key in keys]

    def score(batches):
        best = Best(len(ids), k, len(keys))
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch[vector]))
            held = matrix(batch[vector], dim)
            held = unit(held) if metric == "cosine" else held
            found = [batch[key].to_numpy(zero_copy_only=False) for key in keys]
            if probing is None:
                add_vectors(best, block, everyone, held, found, metric)
                continue
            cells = batch["cell"].to_numpy(zero_copy_only=False)
            for c in np.unique(cells).tolist():
                at, who = np.flatnonzero(cells == c), probing.get(c, everyone[:0])
                add_vectors(best, block[who], who, held[at], [key[at] for key in found], metric)
        yield pa.RecordBatch.from_arrays(best.columns(ids, types), names=["query_id", *keys, "score"])

    named = [("query_id", asked.schema["query_id"].dataType), *[(key, rows.schema[key].dataType) for key in keys]]
    return rows.mapInArrow(score, ", ".join([*[f"{n} {t.simpleString()}" for n, t in named], "score double"]))


def cell_centers(vectors: DataFrame, cells: int = 16, rounds: int = 3, keys: tuple[str, ...] = ("vec_id",), vector: str = "embedding") -> np.ndarray:
    """Centres of ``cells`` groups of directions, the same on any partitioning.

    Starts from the vectors whose keys have the smallest hashes. In each round every
    vector goes to the centre of largest cosine and each centre becomes the mean of its
    vectors, both rounded to six digits. ``cells`` rows are collected per round.
    """
    rows = vectors.select(*keys, vector).filter(F.col(vector).isNotNull())
    first = rows.orderBy(hash28(F.concat_ws("-", *keys)), *keys).limit(cells).select(vector).toArrow()
    centers = np.round(unit(matrix(first[vector], None)), 6)
    for _ in range(rounds):
        placed = nearest_cells(rows, centers, 1, vector).select(F.element_at("cells", 1).alias("cell"), vector)
        length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        parts = placed.select("cell", length.alias("_l"), F.posexplode(vector).alias("at", "x"))
        means = parts.groupBy("cell", "at").agg(F.round(F.avg(F.try_divide(F.col("x").cast("double"), F.col("_l"))), 6).alias("x"))
        for r in means.collect():
            centers[r["cell"], r["at"]] = r["x"]
    return centers


def nearest_cells(df: DataFrame, centers: np.ndarray, probes: int, vector: str = "embedding") -> DataFrame:
    """``df`` with ``cells``: the ``probes`` nearest centres of each vector by cosine, ties by number."""
    held = unit(centers)

    @F.pandas_udf("array<int>")
    def nearest(column: pd.Series) -> pd.Series:
        rows = unit(np.vstack(column.to_numpy()).astype(np.float64))
        near = np.round(rows @ held.T, 6)
        return pd.Series(list(np.argsort(-near, axis=1, kind="stable")[:, :probes].astype(np.int32)))

    return df.withColumn("cells", nearest(vector))


def ivf_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    cells: int = 16,
    probes: int = 4,
    metric: str = "cosine",
    keys: tuple[str, ...] = ("vec_id",),
    vector: str = "embedding",
    centers: np.ndarray | None = None,
) -> DataFrame:
    """Approximate nearest vectors: each query searches only the ``probes`` cells nearest to it.

    Cells are formed over directions, whatever the metric, by :func:`cell_centers` or
    around given ``centers``; only which vectors are looked at is approximate, their scores
    are exact. Null vectors are left out.
    """
    if centers is None:
        centers = cell_centers(vectors, cells, keys=keys, vector=vector)
    rows = nearest_cells(vectors.select(*keys, vector).filter(F.col(vector).isNotNull()), centers, 1, vector)
    asked = nearest_cells(queries.select("query_id", vector).filter(F.col(vector).isNotNull()), centers, probes, vector)
    rows = rows.select(*keys, vector, F.element_at("cells", 1).alias("cell"))
    return _searched(rows, asked, k, metric, keys, vector, None)


def store_cells(
    vectors: DataFrame, path: str, cells: int = 16, keys: tuple[str, ...] = ("vec_id",), vector: str = "embedding", rounds: int = 3, rows_per_file: int = 1_000_000,
) -> None:
    """Write ``vectors`` under ``path``, a folder for each cell, for :func:`search_cells`; null vectors are left out.

    Cells are those of :func:`ivf_topk`. The rebalance hint splits a cell that holds most
    vectors over several files and tasks.
    """
    spark = vectors.sparkSession
    rows = vectors.select(*keys, vector).filter(F.col(vector).isNotNull())
    centers = cell_centers(rows, cells, rounds, keys, vector)
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cell int, center array<double>").write.parquet(f"{path}/centers")
    placed = nearest_cells(rows, centers, 1, vector).select(*keys, vector, F.element_at("cells", 1).alias("cell"))
    # Folders by cell tell no schema if there are no vectors.
    placed.limit(0).write.parquet(f"{path}/columns")
    placed.hint("rebalance", F.col("cell")).write.partitionBy("cell").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/vectors")


def search_cells(
    spark, path: str, queries: DataFrame, k: int = 10, probes: int = 4, metric: str = "cosine", keys: tuple[str, ...] = ("vec_id",), vector: str = "embedding",
) -> DataFrame:
    """As :func:`ivf_topk`, over vectors stored by :func:`store_cells`: each block of queries reads the cells it probes only."""
    held = spark.read.schema("cell int, center array<double>").parquet(f"{path}/centers").orderBy("cell").toPandas()
    stored = spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/vectors")
    asked = queries.select("query_id", vector).filter(F.col(vector).isNotNull())
    if not len(held):
        return _searched(stored, asked.limit(0), k, metric, keys, vector, None)
    return _searched(stored, nearest_cells(asked, np.vstack(held["center"].tolist()), probes, vector), k, metric, keys, vector, None)
