"""Readers and writers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PAGE_SCHEMA = "page_id long, url string, html string"
DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM_SCHEMA = "item_id long, text string"
TURN_SCHEMA = "conv_id long, turn long, role string, text string"
VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int"
LABEL_SCHEMA = "doc_id long, quality int, toxic int"

# The question-answer layout of SQuAD-style sets.
ARTICLE_SCHEMA = (
    "title string, paragraphs array<struct<context string, qas array<struct<"
    "id string, question string, answers array<struct<text string, answer_start int>>>>>>"
)


def _read(spark: SparkSession, path: str, schema: str, partitions: int | None) -> DataFrame:
    df = spark.read.schema(schema).parquet(path)
    partitions = partitions or int(spark.conf.get("spark.passagecraft.readPartitions", "0"))
    return df.repartition(partitions) if partitions else df


def read_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Stored responses of a crawl, one row per fetched page.

    Rows are read where they lie. ``partitions``, or ``spark.passagecraft.readPartitions``
    where it is not given, deals them to so many tasks first, for one machine whose cores
    outnumber the files; both are unset by default.
    """
    return _read(spark, path, PAGE_SCHEMA, partitions)


def read_documents(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    return _read(spark, path, DOCUMENT_SCHEMA, partitions)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITEM_SCHEMA).parquet(path)


def read_turns(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    return _read(spark, path, TURN_SCHEMA, partitions)


def read_vectors(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    return _read(spark, path, VECTOR_SCHEMA, partitions)


def write_corpus(
    df: DataFrame, path: str, fmt: str = "parquet", by: str = "lang", rows_per_file: int = 1_000_000
) -> None:
    """Write documents partitioned by ``by``.

    The rebalance hint lets Spark size the files at run time: small values of
    ``by`` share a task, a value holding most of the corpus is split over many.
    """
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown format {fmt!r}")
    out = df.hint("rebalance", F.col(by)).write.partitionBy(by).option("maxRecordsPerFile", rows_per_file)
    out.format(fmt).save(path)


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).format(fmt).load(path)


def read_qa(spark: SparkSession, path: str, layout: str = "json") -> DataFrame:
    """One row per question from a nested question-answer set.

    ``json`` reads the published form, one object with a ``data`` array per file;
    Spark cannot split such a file. ``jsonl`` reads one article per line and splits.
    """
    if layout == "json":
        article = T.StructType.fromDDL(ARTICLE_SCHEMA)
        whole = T.StructType([T.StructField("data", T.ArrayType(article))])
        files = spark.read.schema(whole).option("multiLine", True).json(path)
        articles = files.select(F.explode("data").alias("a")).select("a.*")
    elif layout == "jsonl":
        articles = spark.read.schema(ARTICLE_SCHEMA).json(path)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return questions(articles)


def questions(articles: DataFrame) -> DataFrame:
    """One row per question of nested articles."""
    return (
        articles.select("title", F.explode("paragraphs").alias("p"))
        .select("title", "p.context", F.explode("p.qas").alias("qa"))
        .select("title", "context", "qa.id", "qa.question", "qa.answers")
    )


def gold_answers(qa: DataFrame) -> DataFrame:
    """One row per accepted answer."""
    return qa.select("id", F.explode("answers").alias("a")).select("id", F.col("a.text").alias("gold"))


def turns_as_articles(turns: DataFrame) -> DataFrame:
    """Dialogue turns in the nested question-answer layout.

    Each user turn followed by an assistant turn is a question; the reply is its
    context and each line of the reply an accepted answer. Joining turn to turn + 1
    spreads one long dialogue over many tasks, which a window per dialogue would not.
    """
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replies = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context")
    )
    lines = F.array_distinct(F.filter(F.split("context", r"\n"), lambda s: s != ""))
    answers = F.transform(
        lines,
        lambda s: F.struct(s.alias("text"), (F.position(s, F.col("context")) - 1).alias("answer_start")),
    )
    qa = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "question", answers.alias("answers")
    )
    return asked.join(replies, ["conv_id", "turn"]).select(
        F.col("conv_id").cast("string").alias("title"),
        F.array(F.struct("context", F.array(qa).alias("qas"))).alias("paragraphs"),
    )
