"""Licence scans: digests of texts in a canonical form, joined to those of known licences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagecraft.functions.sizing import broadcast_if
from passagecraft.functions.text import unnest
from passagecraft.llm.known_licences import KNOWN

# Lines that state whose the copyright is, what separates words, and
# spellings that count as the same word.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright(?: \(c\)|(?: ©)| [0-9])|\(c\) [0-9]|© ?[0-9]|all rights reserved)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}\n]+"
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licences": "licenses", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "wilfull", "http": "https",
}


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one space for each run of other than letters, digits and line ends,
    one spelling of each word. Lines stay apart."""
    bare = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    # Each word gets a space on either side, so that whole words can be replaced as plain strings.
    spaced = F.concat(F.lit(" "), F.replace(F.regexp_replace(bare, NOT_WORD, "  "), F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    return reduce(lambda c, s: F.replace(c, F.lit(f" {s[0]} "), F.lit(f" {s[1]} ")), SPELLINGS.items(), spaced)


def _tight(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str, str]] = KNOWN) -> DataFrame:
    """``licence``, ``kind`` and ``digest`` of the given (licence, kind, text) rows."""
    rows = spark.createDataFrame(known, "licence string, kind string, text string")
    return rows.select("licence", "kind", F.sha2(_tight(canonical(F.col("text"))), 256).alias("digest")).distinct()


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Licences of each document, found by the digests of its whole text and of each whole line.

    Returns ``doc_id``, ``digest`` (of the whole canonical text; null if it has no words),
    ``text_licence`` (the licence that the whole text is, else null) and ``licences``
    (sorted array of all licences named by the text or one of its lines).

    ``known`` has ``licence, kind, digest``; it may be of any size. A null or empty text has
    no digest. Repeated rows and null ids get a row each. Other columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), canonical(F.col("text")).alias("text"))
    whole = _tight(F.col("text"))
    digest = F.when(whole != "", F.sha2(whole, 256))
    lines = F.transform(F.filter(F.transform(F.split("text", "\n"), _tight), lambda x: x != ""), lambda x: F.sha2(x, 256))
    units = F.concat(F.array(F.struct(F.lit(True).alias("all"), digest.alias("digest"))), F.coalesce(F.transform(lines, lambda x: F.struct(F.lit(False).alias("all"), x.alias("digest"))), F.array()))
    parts = unnest(texts, ["doc_id", "text_key"], units, "u").select("doc_id", "text_key", F.col("u.all").alias("whole"), F.col("u.digest").alias("digest"))
    named = parts.join(broadcast_if(known), "digest", "left")
    found = named.filter("whole or licence is not null").groupBy("doc_id", "text_key").agg(
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"), F.min(F.when(F.col("whole"), F.col("licence"))).alias("text_licence"),
        F.array_sort(F.collect_set("licence")).alias("licences"),
        F.count_if(F.col("whole")).alias("n"),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return found.withColumn("each", each).select("doc_id", "digest", "text_licence", "licences")
