"""Documents to passages. Both operators are narrow: no shuffle, one row in, many out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from passagecraft.functions.text import pieces, sentences, unnest

DOC_COLUMNS = ("lang", "source")


def chunk(
    docs: DataFrame,
    size: int | Column = 120,
    overlap: int | Column = 20,
    unit: str = "word",
    keep: tuple[str, ...] = DOC_COLUMNS,
) -> DataFrame:
    """Passages of ``size`` pieces, each sharing ``overlap`` with the one before.

    The size may be a column, so that one job can cut the same text several ways.
    ``char`` counts code points instead of space-separated pieces.
    """
    size, overlap = (c if isinstance(c, Column) else F.lit(c) for c in (size, overlap))
    if unit == "word":
        cut, length = pieces("text"), F.size("_parts")
        passage = lambda s: F.array_join(F.slice(F.col("_parts"), s + 1, F.col("_size")), " ")
    elif unit == "char":
        cut, length = F.col("text"), F.char_length("_parts")
        passage = lambda s: F.substring(F.col("_parts"), s + 1, F.col("_size"))
    else:
        raise ValueError(f"unknown unit {unit!r}")
    parts = docs.select(
        "doc_id", *keep, cut.alias("_parts"), size.alias("_size"), (size - overlap).alias("_step")
    )
    last = F.greatest(length - (F.col("_size") - F.col("_step")) - 1, F.lit(0))
    cuts = F.when(
        length > 0,
        F.transform(
            F.sequence(F.lit(0), last, F.col("_step")),
            lambda s: F.struct(s.alias("start"), passage(s).alias("chunk")),
        ),
    )
    return unnest(parts, ["doc_id", *keep], cuts, "_c", "chunk_no").select(
        "doc_id", "chunk_no", *keep, F.col("_c.start").alias("start"), F.col("_c.chunk").alias("chunk")
    )


def chunk_sentences(docs: DataFrame, size: int = 400, keep: tuple[str, ...] = DOC_COLUMNS) -> DataFrame:
    """Whole sentences packed into passages of at most ``size`` characters.

    A sentence longer than ``size`` stands alone. The fold holds the passage
    being filled and the finished ones.
    """
    empty = F.struct(F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))

    def step(acc, s):
        joined = F.concat(acc["open"], F.lit(" "), s)
        return (
            F.when(acc["open"] == "", F.struct(s.alias("open"), acc["done"].alias("done")))
            .when(F.length(joined) <= size, F.struct(joined.alias("open"), acc["done"].alias("done")))
            .otherwise(
                F.struct(s.alias("open"), F.array_append(acc["done"], acc["open"]).alias("done"))
            )
        )

    packed = F.aggregate(sentences("text"), empty, step, lambda acc: F.array_append(acc["done"], acc["open"]))
    rows = unnest(docs, ["doc_id", *keep], packed, "chunk", "chunk_no").filter("chunk <> ''")
    return rows.select("doc_id", "chunk_no", *keep, "chunk")
