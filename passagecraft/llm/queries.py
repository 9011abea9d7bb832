"""The operators of this subpackage as queries over the tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from passagecraft.llm import (
    byte_cnn, forced_bpe, html_crf, importance, latent_search, licence_scan, line_dedup, order_minhash, packing, quality_rules, spelling, substring_dedup, url_graph,
)

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark, folder):
    cut = line_dedup.drop_repeated_lines(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op2_html_text(spark, folder):
    return html_crf.extract(_table(spark, folder, "pages"))


def op3_packing(spark, folder):
    return packing.pack(_table(spark, folder, "documents"), tokenizer_path())


def op4_substring_dedup(spark, folder):
    cut = substring_dedup.remove_repeated(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_quality_rules(spark, folder):
    judged = quality_rules.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op6_url_filter(spark, folder):
    return url_graph.filter_urls(_table(spark, folder, "pages"))


def op7_near_dedup(spark, folder):
    return order_minhash.classes(_table(spark, folder, "documents")).select("doc_id", "class_id")


def op8_quality_classifier(spark, folder):
    docs = _table(spark, folder, "documents")
    scored = byte_cnn.score(docs, byte_cnn.train(docs, _table(spark, folder, "labels")))
    return scored.select(
        "doc_id", byte_cnn.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op9_licence_scan(spark, folder):
    found = licence_scan.scan(_table(spark, folder, "documents"), licence_scan.known_digests(spark))
    return found.select("doc_id", "digest", "text_licence", F.array_join("licences", ",").alias("licences"))


def op10_decontamination(spark, folder):
    found = latent_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.filter("leaked").select("doc_id", "item_id", "at", "overlap", "answered", "cosine")


def op11_bpe_round_trip(spark, folder):
    coded = forced_bpe.encode(_table(spark, folder, "documents"), tokenizer_path())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return forced_bpe.decode(coded, tokenizer_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_importance_resampling(spark, folder):
    drawn = importance.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling_variants(spark, folder):
    return spelling.group_variants(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in [
    op1_line_dedup, op2_html_text, op3_packing, op4_substring_dedup, op5_quality_rules, op6_url_filter, op7_near_dedup,
    op8_quality_classifier, op9_licence_scan, op10_decontamination, op11_bpe_round_trip, op12_importance_resampling,
    op13_spelling_variants,
]}
