"""Ranking metrics. ``run``: query_id, doc_id, rank; ``qrels``: query_id, doc_id, rel.

Means are over all queries that have a relevant document; a query the run does
not answer counts as zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

KEYS = ["query_id", "doc_id"]


def _relevant(qrels: DataFrame) -> DataFrame:
    return qrels.filter("rel > 0")


def _judged(qrels: DataFrame) -> DataFrame:
    return _relevant(qrels).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))


def _matched(run: DataFrame, qrels: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The run with the relevance of each result, 0 where there is none."""
    rows = run.select(*by, *KEYS, "rank").join(_relevant(qrels).select(*KEYS, "rel"), KEYS, "left")
    return rows.withColumn("rel", F.coalesce("rel", F.lit(0)))


def recall_at(
    run: DataFrame, qrels: DataFrame, ks: list[int], by: tuple[str, ...] = (), variants: DataFrame | None = None
) -> DataFrame:
    """Mean recall, precision and hit rate at each k, per variant named by ``by``.

    Variants are those of the run, and those listed in ``variants``; one that answers no
    judged query has zeros.
    """
    judged = _judged(qrels)
    n = judged.agg(F.count(F.lit(1))).scalar()
    hits = _matched(run, qrels, by).groupBy(*by, "query_id").agg(
        *[F.sum(F.when((F.col("rank") <= k) & (F.col("rel") > 0), 1).otherwise(0)).alias(f"h{k}") for k in ks]
    )

    def at(k):
        h = F.col(f"h{k}")
        return F.struct(
            F.lit(k).alias("k"),
            F.sum(h / F.col("n_rel")).alias("recall"),
            F.sum(h / F.lit(k)).alias("precision"),
            F.sum(F.when(h > 0, 1.0).otherwise(0.0)).alias("hit_rate"),
        )

    sums = hits.join(judged, "query_id").groupBy(*by).agg(F.array(*[at(k) for k in ks]).alias("all"))
    if by:
        held = run.select(*by).distinct()
        held = held if variants is None else held.union(variants.select(*by)).distinct()
        sums = held.join(sums, list(by), "left")
    zero = F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(0.0).alias(m) for m in ("recall", "precision", "hit_rate")]) for k in ks])
    sums = sums.withColumn("all", F.coalesce("all", zero))
    mean = lambda name: F.round(F.try_divide(F.coalesce(F.col(f"m.{name}"), F.lit(0.0)), n), 6).alias(name)
    return sums.select(*by, F.explode("all").alias("m")).select(
        *by, "m.k", mean("recall"), mean("precision"), mean("hit_rate"), n.alias("n_queries")
    )


def mrr(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Mean reciprocal rank of the first relevant result."""
    n = _judged(qrels).agg(F.count(F.lit(1))).scalar()
    first = _matched(run, qrels).filter("rel > 0").groupBy("query_id").agg(F.min("rank").alias("r"))
    total = first.agg(F.coalesce(F.sum(1 / F.col("r")), F.lit(0.0)).alias("s"))
    return total.select(F.round(F.try_divide(F.col("s"), n), 6).alias("mrr"), n.alias("n_queries"))


def _gain(rel: str, rank: str):
    return (F.pow(F.lit(2.0), F.col(rel)) - 1) / F.log2(F.col(rank) + 1)


def ndcg_per_query(run: DataFrame, qrels: DataFrame, k: int = 10) -> DataFrame:
    """query_id and nDCG@k, binary or graded; 0 for judged queries without a hit."""
    w = Window.partitionBy("query_id").orderBy(F.desc("rel"), "doc_id")
    ideal = (
        _relevant(qrels).withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= k)
        .groupBy("query_id").agg(F.sum(_gain("rel", "_i")).alias("ideal"))
    )
    got = (
        _matched(run.filter(F.col("rank") <= k), qrels).groupBy("query_id")
        .agg(F.sum(_gain("rel", "rank")).alias("got"))
    )
    return ideal.join(got, "query_id", "left").select(
        "query_id", F.round(F.coalesce("got", F.lit(0.0)) / F.col("ideal"), 6).alias("ndcg")
    )


def ndcg(run: DataFrame, qrels: DataFrame, k: int = 10) -> DataFrame:
    return ndcg_per_query(run, qrels, k).agg(
        F.lit(k).alias("k"), F.round(F.avg("ndcg"), 6).alias("ndcg"), F.count(F.lit(1)).alias("n_queries")
    )


def per_query(run: DataFrame, qrels: DataFrame, k: int = 10) -> DataFrame:
    """Recall@k, reciprocal rank and nDCG@k of every judged query."""
    near = F.col("rank") <= k
    hits = _matched(run, qrels).filter("rel > 0").groupBy("query_id").agg(
        F.sum(F.when(near, 1).otherwise(0)).alias("hits"), F.min("rank").alias("first")
    )
    return (
        _judged(qrels).join(hits, "query_id", "left").join(ndcg_per_query(run, qrels, k), "query_id")
        .select(
            "query_id",
            F.round(F.coalesce("hits", F.lit(0)) / F.col("n_rel"), 6).alias("recall"),
            F.round(F.coalesce(1 / F.col("first"), F.lit(0.0)), 6).alias("rr"),
            "ndcg",
        )
    )
