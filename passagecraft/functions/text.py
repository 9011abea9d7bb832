"""Text expressions shared by the operators. All but :func:`with_runs` run inside the JVM."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from passagecraft.functions.runs import runs

# Separators of words, characters kept by the character unit, and
# marks that end a sentence.
WORD_BREAK = r"[^\p{L}\p{N}]+"
CHARACTER = r"[^\s\p{Z}]"
CHARACTER_PAIR = r"(?=([^\s\p{Z}\p{Cs}]{2}))"
SPACE = r"[\s\p{Z}]+"
SENTENCE_END = r"([.!?])[\s\p{Z}]+"
WIDE_SENTENCE_END = r"([。！？])"
PUNCTUATION = r"[\p{P}\p{S}]+"


def tokens(text: Column | str, unit: str = "word") -> Column:
    """Lower-cased tokens: words, or for writing without spaces between words
    single characters (``char``) or overlapping pairs of them (``pair``)."""
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    if unit == "word":
        return F.array_remove(F.split(lowered, WORD_BREAK), "")
    if unit == "char":
        return F.regexp_extract_all(lowered, F.lit(CHARACTER), F.lit(0))
    if unit == "pair":
        return F.regexp_extract_all(lowered, F.lit(CHARACTER_PAIR), F.lit(1))
    raise ValueError(f"unknown unit {unit!r}")


def pieces(text: Column | str) -> Column:
    """Space-separated pieces of the text as written."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(c, SPACE), "")


def sentences(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    marked = F.regexp_replace(F.regexp_replace(c, SENTENCE_END, "$1\n"), WIDE_SENTENCE_END, "$1\n")
    return F.filter(F.transform(F.split(marked, r"\n+"), lambda s: F.trim(s)), lambda s: s != "")


def unnest(df: DataFrame, keep: list, items: Column | str, name: str, at: str | None = None) -> DataFrame:
    """``keep`` and one row per item of an array, its position as ``at`` if asked.

    The outer form is used because for a plain explode the optimizer adds a filter on
    the array's size, which would compute a costly array twice.
    """
    out = F.posexplode_outer(items).alias(at, name) if at else F.explode_outer(items).alias(name)
    return df.select(*keep, out).filter(F.col(name).isNotNull())


def with_runs(df: DataFrame, items: str, out: str, count: str | None = None) -> DataFrame:
    """``df`` with ``out`` in place of array ``items``: array of (item, n), how often each item occurs, by item.

    ``count`` names a column for the length of ``items``. Items are counted for a batch of
    rows at once, where the rows lie: no shuffle, unlike exploding the items and grouping
    them again.
    """
    kept = [c for c in df.columns if c != items]
    fields = [T.StructField(count, T.IntegerType())] if count else []
    run = T.StructType([T.StructField("item", df.schema[items].dataType.elementType), T.StructField("n", T.IntegerType())])
    schema = T.StructType([*[df.schema[c] for c in kept], *fields, T.StructField(out, T.ArrayType(run))])

    def cut(batches):
        for batch in batches:
            lists = batch[items]
            sizes = [lists.value_lengths().cast(pa.int32())] if count else []
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *sizes, runs(lists)], names=schema.names)

    return df.select(*kept, items).mapInArrow(cut, schema)


def numbered(runs: str) -> Column:
    """Runs back to items, each marked with its occurrence number, so all are distinct."""
    return F.flatten(
        F.transform(
            F.col(runs),
            lambda r: F.transform(F.sequence(F.lit(1), r["n"]), lambda j: F.concat_ws(" ", r["item"], j)),
        )
    )


def normal_answer(text: Column | str, unit: str = "word") -> Column:
    """Lower case, no punctuation; spaces collapsed, or removed for the char unit."""
    c = F.lower(F.col(text) if isinstance(text, str) else text)
    bare = F.regexp_replace(c, PUNCTUATION, "")
    return F.trim(F.regexp_replace(bare, SPACE, "" if unit == "char" else " "))


def hash28(text: Column) -> Column:
    """28-bit hash that any SQL engine with md5 can repeat."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")
