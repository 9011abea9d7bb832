"""Every operator as a query over the tables of a folder: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from passagecraft.functions.sizing import scratch_path, stage
from passagecraft.functions.text import hash28
from passagecraft.operators import answers, boilerplate, chunk as chunks_, compare, dense, extract, index as index_, lexical
from passagecraft.operators import metrics, mixture as mixture_, prepare, profile, ranking, relevance, rules, semantic, spans, thresholds, toxicity
from passagecraft.plans import corpus as corpus_plan, rag
from passagecraft.sources import tables
from passagecraft.streaming import counts, curate
from passagecraft.streaming.ingest import stream_corpus

SIZE, OVERLAP, SENTENCE_SIZE, DIM = 120, 20, 400, 256
K, DEPTH, CELLS = 10, 50, 16
GRID = [(60, 0), (120, 20), (240, 40)]
KS = [1, 3, 5, 10]
PASSAGE = index_.PASSAGE


def _pages(spark, d):
    return tables.read_pages(spark, f"{d}/pages.parquet")


def _docs(spark, d):
    return tables.read_documents(spark, f"{d}/documents.parquet")


def _items(spark, d):
    return tables.read_items(spark, f"{d}/benchmark.parquet")


def _turns(spark, d):
    return tables.read_turns(spark, f"{d}/conversations.parquet")


def _vectors(spark, d):
    return tables.read_vectors(spark, f"{d}/embeddings.parquet")


def _asked(spark, d):
    return _items(spark, d).select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def _chunks(spark, d):
    return chunks_.chunk(_docs(spark, d), SIZE, OVERLAP)


def _bm25(spark, d, k=K):
    return lexical.bm25(index_.build_index(_chunks(spark, d)), _asked(spark, d), k)


def _near(spark, d, k=K):
    vectors, asked = dense.hash_embed(_chunks(spark, d), _asked(spark, d), DIM)
    return dense.vector_topk(vectors, asked, k, keys=tuple(PASSAGE), vector="vector", dim=DIM)


def _run_a(spark, d):
    return stage(ranking.best_per_doc(_bm25(spark, d, DEPTH)), "run")


def _run_b(spark, d):
    return stage(ranking.best_per_doc(_near(spark, d, DEPTH)), "run")


def _qrels(spark, d):
    return relevance.qrels(_items(spark, d), _docs(spark, d))


def _hits(df):
    return _long(df.select("query_id", "doc_id", "chunk_no", "score", "rank"), "rank")


def _long(df, *names):
    return df.withColumns({name: F.col(name).cast("long") for name in names})


# --- pages and corpus


def read_pages(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d)


def extract_text(spark, d):
    return extract.extract_text(_pages(spark, d))


def page_meta(spark, d):
    return extract.page_meta(_pages(spark, d))


def page_documents(spark, d):
    return extract.documents(_pages(spark, d))


def page_profile(spark, d):
    return corpus_plan.profile_pages(spark, f"{d}/pages.parquet")


def corpus_profile(spark, d):
    return profile.corpus_profile(_docs(spark, d))


def write_corpus(spark, d):
    path = scratch_path(spark, "corpus")
    tables.write_corpus(_docs(spark, d), path)
    return tables.read_corpus(spark, path)


def write_corpus_json(spark, d):
    path = scratch_path(spark, "corpus-json")
    tables.write_corpus(extract.documents(_pages(spark, d)), path, "json")
    return tables.read_corpus(spark, path, "json")


def incremental_corpus(spark, d):
    path = scratch_path(spark, "stream")
    stream_corpus(spark, d, path, scratch_path(spark, "stream-checkpoint"), "pages.parquet")
    return tables.read_corpus(spark, path)


def apply_rules(spark, d):
    return rules.apply_rules(_docs(spark, d)).select("doc_id", F.array_join("reasons", ", ").alias("reasons"))


def _landed(spark, d):
    """Pages in two landings, a day apart."""
    day = F.make_timestamp(F.lit(2024), F.lit(1), F.pmod(hash28(F.col("page_id").cast("string")), F.lit(2)) + 1, F.lit(0), F.lit(0), F.lit(0))
    return _pages(spark, d).withColumn("landed", day)


def stream_curate(spark, d):
    """Each landing curated when it has come."""
    landing, out, state = (scratch_path(spark, name) for name in ("landing", "curated", "curate-state"))
    for day in ("2024-01-01", "2024-01-02"):
        _landed(spark, d).filter(F.col("landed") == day).write.mode("append").partitionBy("landed").parquet(landing)
        curate.stream_curate(spark, landing, out, state, time="landed")
    return tables.read_corpus(spark, out)


def stream_counts(spark, d):
    """Pages fetched over a day that land at noon and at midnight, some at midnight only though fetched before noon."""
    number = lambda salt: hash28(F.concat(F.lit(salt), F.col("page_id").cast("string")))
    fetched = F.timestamp_seconds(F.lit(1704067200) + F.pmod(number("at"), F.lit(86_400)))
    slow = (F.hour("fetched") >= 12) | (F.pmod(number("slow"), F.lit(5)) == 0)
    pages = _pages(spark, d).withColumn("fetched", fetched).withColumn("landed", F.timestamp_seconds(F.when(slow, 1704153600).otherwise(1704110400)))
    landing, out, state = (scratch_path(spark, name) for name in ("landing", "counts", "counts-state"))
    for at in ("2024-01-01 12:00:00", "2024-01-02 00:00:00"):
        pages.filter(F.col("landed") == at).write.mode("append").partitionBy("landed").parquet(landing)
        counts.stream_counts(spark, landing, out, state, landed="landed")
    return counts.window_counts(spark, out).withColumn("start", F.unix_seconds("start"))


def read_qa(spark, d):
    path = scratch_path(spark, "qa")
    tables.turns_as_articles(_turns(spark, d)).write.json(path)
    qa = tables.read_qa(spark, path, "jsonl")
    return qa.select("title", "context", "id", "question", F.explode("answers").alias("a")).select(
        "title", "context", "id", "question", F.col("a.text").alias("gold"),
        F.col("a.answer_start").cast("long").alias("answer_start"),
    )


def read_qa_published(spark, d):
    """The set in its published form, one object with all articles."""
    path = scratch_path(spark, "qa-whole")
    articles = tables.turns_as_articles(_turns(spark, d)).withColumn("_part", F.pmod(F.xxhash64("title"), F.lit(16)))
    whole = articles.groupBy("_part").agg(F.collect_list(F.struct("title", "paragraphs")).alias("data"))
    whole.select("data").write.option("maxRecordsPerFile", 1).json(path)
    return tables.gold_answers(tables.read_qa(spark, path))


# --- preparation


def canonical_urls(spark, d):
    return prepare.canonical_urls(_pages(spark, d))


def outlinks(spark, d):
    return prepare.outlinks(_pages(spark, d))


def link_targets(spark, d):
    return prepare.in_degree(prepare.outlinks(_pages(spark, d)))


def normalize_text(spark, d):
    return prepare.normalize_text(_docs(spark, d)).select("doc_id", "text")


def drop_common_lines(spark, d):
    return boilerplate.drop_common_lines(_docs(spark, d), 5, "n_removed").select("doc_id", "text", "n_removed")


def detect_lang(spark, d):
    return prepare.detect_lang(_docs(spark, d))


def doc_stats(spark, d):
    return prepare.doc_stats(_docs(spark, d))


def find_pii(spark, d):
    return spans.find_pii(_docs(spark, d))


def redact(spark, d):
    return spans.redact(_docs(spark, d), count="n_findings").select("doc_id", "text", "n_findings")


def pii_report(spark, d):
    return spans.pii_report(spans.find_pii(_docs(spark, d)), _docs(spark, d)).drop("n_values")


def toxic_scores(spark, d):
    docs, labels = _docs(spark, d), spark.read.schema(tables.LABEL_SCHEMA).parquet(f"{d}/labels.parquet")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))


def threshold_sweep(spark, d):
    """How well the share of common words tells good documents."""
    labels = spark.read.schema(tables.LABEL_SCHEMA).parquet(f"{d}/labels.parquet")
    return thresholds.threshold_sweep(prepare.doc_stats(_docs(spark, d)), labels, "stop_word_share", "quality")


def top_terms(spark, d):
    return _long(prepare.top_terms(_docs(spark, d)), "rank")


def _split(spark, d):
    return prepare.split_by_hash(_docs(spark, d), {"train": 90, "valid": 5, "test": 5})


def split_by_hash(spark, d):
    return _split(spark, d).select("doc_id", "split")


BUDGETS = {"en": 60_000, "de": 25_000, "fr": 10_000, "es": 10**12}


def mixture(spark, d):
    return mixture_.mixture(_docs(spark, d), BUDGETS).select("doc_id", "lang")


def block_hosts(spark, d):
    """Without the sites of five pages or more, and all hosts below them."""
    listed = prepare.canonical_urls(_pages(spark, d)).groupBy("host").agg(F.sum("n_pages").alias("n")).filter("n >= 5")
    listed = listed.select(F.col("host").alias("domain"))
    return prepare.block_hosts(_pages(spark, d), listed).select("page_id", "url")


def dialogue_pairs(spark, d):
    return prepare.dialogue_pairs(_turns(spark, d))


def funnel(spark, d):
    known = _docs(spark, d).join(prepare.detect_lang(_docs(spark, d)).filter("guess = lang"), "doc_id", "left_semi")
    train = known.join(_split(spark, d).filter("split = 'train'").select("doc_id"), "doc_id", "left_semi")
    return prepare.funnel([("all", _docs(spark, d)), ("language agrees", known), ("training part", train)])


# --- passages and index


def chunk(spark, d):
    return _chunks(spark, d)


def chunk_chars(spark, d):
    return chunks_.chunk(_docs(spark, d), 500, 50, "char")


def chunk_sentences(spark, d):
    return chunks_.chunk_sentences(_docs(spark, d), SENTENCE_SIZE)


def index_postings(spark, d):
    return _long(index_.build_index(_chunks(spark, d)).postings(), "tf", "n_words")


def index_terms(spark, d):
    return index_.build_index(_chunks(spark, d)).terms


def _refreshed(spark, d):
    """A later snapshot of the documents: labelled ones withdrawn or revised, pages added."""
    labels = spark.read.schema(tables.LABEL_SCHEMA).parquet(f"{d}/labels.parquet")
    marked = _docs(spark, d).join(labels, "doc_id", "left").filter("quality is null or quality = 1")
    text = F.when(F.col("toxic") == 1, F.concat("text", F.lit(" revised"))).otherwise(F.col("text"))
    kept = marked.select("doc_id", text.alias("text"), "lang", "source")
    added = extract.documents(_pages(spark, d)).select((-1 - F.col("doc_id")).alias("doc_id"), "text", "lang", "source")
    return kept.unionByName(added)


def index_changes(spark, d):
    return index_.changes(_docs(spark, d), _refreshed(spark, d))


def update_index(spark, d):
    old, new = _docs(spark, d), _refreshed(spark, d)
    before = index_.build_index(chunks_.chunk(old, SIZE, OVERLAP))
    after = index_.update_index(before, index_.changes(old, new), new, lambda docs: chunks_.chunk(docs, SIZE, OVERLAP))
    held = after.postings().groupBy("term").agg(F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_tokens"))
    return after.terms.join(held, "term", "full_outer")


# --- ranking


def bm25(spark, d):
    return _hits(_bm25(spark, d))


def filtered_topk(spark, d):
    held = index_.build_index(_chunks(spark, d), keep=("lang",))
    return _hits(ranking.filtered_topk(held, _asked(spark, d), F.col("lang") == "en", K))


def hash_embed(spark, d):
    vectors, _ = dense.hash_embed(_chunks(spark, d), dim=DIM)
    flat = F.explode(F.arrays_zip("vector.indices", "vector.weights"))
    return vectors.select(*PASSAGE, flat.alias("v")).select(
        *PASSAGE, F.col("v.indices").alias("bucket"), F.round("v.weights", 6).alias("weight")
    )


def _centroids(spark, d):
    """Mean vector of each label: a batch of queries that reads the whole table."""
    cells = _vectors(spark, d).select("label", F.posexplode("embedding").alias("at", "x"))
    means = cells.groupBy("label", "at").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    vectors = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
    return vectors.select(F.col("label").cast("long").alias("query_id"), F.col("v.x").alias("embedding"))


def _vector_topk(metric):
    def query(spark, d):
        return _long(dense.vector_topk(_vectors(spark, d), _centroids(spark, d), K, metric), "rank")

    return query


def vector_filtered(spark, d):
    """Nearest vectors among those whose label is not the query batch's first five."""
    near = ranking.filtered_vector_topk(_vectors(spark, d), _centroids(spark, d), F.col("label") >= 5, K)
    return _long(near, "rank")


def ivf_topk(spark, d):
    return _long(dense.ivf_topk(_vectors(spark, d), _centroids(spark, d), K, CELLS, 4), "rank")


def cell_search(spark, d):
    """The same cells as a stored table, of which only the probed ones are read."""
    path = scratch_path(spark, "cells")
    dense.store_cells(_vectors(spark, d), path, CELLS)
    return _long(dense.search_cells(spark, path, _centroids(spark, d), K, 4), "rank")


def ivf_topk_all_cells(spark, d):
    return _long(dense.ivf_topk(_vectors(spark, d), _centroids(spark, d), K, 8, 8), "rank")


def semantic_dedup(spark, d):
    """The vectors of the tables are far apart, so the cosine asked for is low; cells small enough to be split."""
    return semantic.semantic_dedup(_vectors(spark, d), 0.4, cell_rows=400, cells=8, slack=None)


def vector_passages(spark, d):
    return _hits(_near(spark, d))


def rrf(spark, d):
    return _hits(rag.hybrid(_chunks(spark, d), _asked(spark, d), K, DEPTH, DIM))


def expand(spark, d):
    return _long(ranking.expand(_bm25(spark, d), _chunks(spark, d), 1), "chunk_no", "rank")


def best_per_doc(spark, d):
    return _hits(_run_a(spark, d))


def context(spark, d):
    return rag.retrieve(_docs(spark, d), _asked(spark, d), K)


# --- evaluation


def qrels(spark, d):
    return _qrels(spark, d)


def recall_at(spark, d):
    return metrics.recall_at(_run_a(spark, d), _qrels(spark, d), KS)


def mrr(spark, d):
    return metrics.mrr(_run_a(spark, d), _qrels(spark, d))


def ndcg(spark, d):
    return metrics.ndcg(_run_b(spark, d), _qrels(spark, d), K)


def metric_report(spark, d):
    return rag.evaluate(_near(spark, d, DEPTH), _qrels(spark, d), _docs(spark, d), K)


def _values(run, judged):
    return metrics.ndcg_per_query(run, judged, K).withColumnRenamed("ndcg", "value")


def compare_systems(spark, d):
    judged = _qrels(spark, d)
    return compare.compare(_values(_run_b(spark, d), judged), _values(_run_a(spark, d), judged))


def sweep(spark, d):
    return compare.sweep(_docs(spark, d), _asked(spark, d), _qrels(spark, d), GRID, [1, 10], DEPTH)


def rank_diff(spark, d):
    return _long(ranking.rank_diff(_run_a(spark, d), _run_b(spark, d), K), "rank_a", "rank_b")


def _qa(spark, d):
    return tables.questions(tables.turns_as_articles(_turns(spark, d)))


def _replies(spark, d):
    """Assistant turns as documents to answer from, dealt out: a file of one row group would keep one task busy."""
    replies = _turns(spark, d).filter("role = 'assistant'").select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("doc_id"), "text"
    )
    return replies.repartition(3 * spark.sparkContext.defaultParallelism)


def _qa_hits(spark, d, k):
    passages = chunks_.chunk_sentences(_replies(spark, d), SENTENCE_SIZE, keep=())
    asked = _qa(spark, d).select(F.col("id").alias("query_id"), "question")
    return ranking.with_text(lexical.bm25(index_.build_index(passages), asked, k), passages)


def _answers(spark, d):
    """The best passage stands in for a generated answer."""
    return _qa_hits(spark, d, 1).select(F.col("query_id").alias("id"), F.col("chunk").alias("answer"))


def exact_match(spark, d):
    return answers.exact_match(_answers(spark, d), tables.gold_answers(_qa(spark, d)))


def answer_f1(spark, d):
    return answers.answer_f1(_answers(spark, d), tables.gold_answers(_qa(spark, d)))


def answer_f1_chars(spark, d):
    return answers.answer_f1(_answers(spark, d), tables.gold_answers(_qa(spark, d)), "char")


def support(spark, d):
    told = _qa(spark, d).select("id", F.col("context").alias("answer"))
    found = ranking.context(_qa_hits(spark, d, 5)).select(F.col("query_id").alias("id"), "context")
    return answers.support(told, found)


QUERIES = {
    "read_pages": read_pages,
    "extract_text": extract_text,
    "page_meta": page_meta,
    "page_documents": page_documents,
    "page_profile": page_profile,
    "corpus_profile": corpus_profile,
    "write_corpus": write_corpus,
    "write_corpus_json": write_corpus_json,
    "incremental_corpus": incremental_corpus,
    "apply_rules": apply_rules,
    "stream_curate": stream_curate,
    "stream_counts": stream_counts,
    "read_qa": read_qa,
    "read_qa_published": read_qa_published,
    "canonical_urls": canonical_urls,
    "outlinks": outlinks,
    "link_targets": link_targets,
    "normalize_text": normalize_text,
    "drop_common_lines": drop_common_lines,
    "detect_lang": detect_lang,
    "doc_stats": doc_stats,
    "find_pii": find_pii,
    "redact": redact,
    "pii_report": pii_report,
    "toxic_scores": toxic_scores,
    "threshold_sweep": threshold_sweep,
    "top_terms": top_terms,
    "split_by_hash": split_by_hash,
    "dialogue_pairs": dialogue_pairs,
    "mixture": mixture,
    "block_hosts": block_hosts,
    "funnel": funnel,
    "chunk": chunk,
    "chunk_chars": chunk_chars,
    "chunk_sentences": chunk_sentences,
    "index_postings": index_postings,
    "index_terms": index_terms,
    "index_changes": index_changes,
    "update_index": update_index,
    "bm25": bm25,
    "filtered_topk": filtered_topk,
    "hash_embed": hash_embed,
    "vector_topk_cosine": _vector_topk("cosine"),
    "vector_topk_dot": _vector_topk("dot"),
    "vector_topk_l2": _vector_topk("l2"),
    "vector_filtered": vector_filtered,
    "semantic_dedup": semantic_dedup,
    "vector_passages": vector_passages,
    "ivf_topk": ivf_topk,
    "cell_search": cell_search,
    "ivf_topk_all_cells": ivf_topk_all_cells,
    "rrf": rrf,
    "expand": expand,
    "best_per_doc": best_per_doc,
    "context": context,
    "qrels": qrels,
    "recall_at": recall_at,
    "mrr": mrr,
    "ndcg": ndcg,
    "metric_report": metric_report,
    "compare_systems": compare_systems,
    "sweep": sweep,
    "rank_diff": rank_diff,
    "exact_match": exact_match,
    "answer_f1": answer_f1,
    "answer_f1_chars": answer_f1_chars,
    "support": support,
}
