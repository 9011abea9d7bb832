"""Personal data and secrets as spans of a text: found, put apart where they overlap, and replaced."""

from __future__ import annotations

import re
import sys
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from passagecraft.functions.sizing import stage

# Stands in for what has been taken while the rest is searched again; in no pattern's characters.
TAKEN = "\0"
HEX_LENGTHS = (32, 40, 56, 64, 96, 128)

# Tasks receive this module with the function that uses it, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Kind:
    """What is looked for: candidates by a pattern, less what ``lead`` matches at their start, then a
    test of the candidate and the characters before and after it."""

    name: str
    pattern: str
    valid: Callable[[str, str, str], bool]
    lead: str = ""


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def passes_checksum(number: str) -> bool:
    """Every second digit from the right doubled, its digits added: the sum is a multiple of ten."""
    digits = [int(c) for c in reversed(_digits(number))]
    return (sum(digits[::2]) + sum(2 * d - 9 * (d > 4) for d in digits[1::2])) % 10 == 0


def _is_email(found: str, before: str, after: str) -> bool:
    name, _, domain = found.partition("@")
    return len(name) <= 64 and name[-1:] not in ("", ".") and all(
        not part.startswith("-") and not part.endswith("-") for part in domain.split("."))


def _is_address(found: str, before: str, after: str) -> bool:
    parts = found.split(".")
    inside = before[-1:] == "." and before[-2:-1].isdigit() or after[:1] == "." and after[1:2].isdigit()
    return not inside and all(int(p) <= 255 and (p == "0" or p[0] != "0") for p in parts)


def _is_card(found: str, before: str, after: str) -> bool:
    return found[0] in "23456" and passes_checksum(found)


def _is_phone(found: str, before: str, after: str) -> bool:
    return 8 <= len(_digits(found)) <= 15 and not re.match(r"[0-9A-Za-z_.+-]", before[-1:] or " ")


def _is_secret(found: str, before: str, after: str) -> bool:
    return len(found) in HEX_LENGTHS and any(c.isdigit() for c in found) and any(c.isalpha() for c in found)


# Kinds in the order in which equal spans go to them. The patterns mean the same in Python and in SQL engines.
KINDS = [
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _is_email, r".*\.\.|\."),
    Kind("secret", r"\b[0-9a-f]{32,128}\b", _is_secret),
    Kind("card", r"\b[0-9](?:[ -]?[0-9]){12,18}\b", _is_card),
    Kind("ip", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b", _is_address),
    Kind("phone", r"(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}\b", _is_phone),
    Kind("number", r"\b[0-9]{13,19}\b", lambda *_: True),
]


def candidates(text: str, kinds: list[Kind] = KINDS) -> list[tuple[int, int, int]]:
    """Start, end and place of the kind of every valid match; matches of one kind do not overlap."""
    found = []
    for i, kind in enumerate(kinds):
        # A run that can start an address of this kind is entered at its start only, or a long run takes quadratic time.
        guard = r"(?<![A-Za-z0-9._%+-])" if "@" in kind.pattern else ""
        for m in re.finditer(guard + kind.pattern, text, re.ASCII):
            a, b = m.span()
            if kind.lead and (lead := re.match(kind.lead, m[0])):
                a += lead.end()
            if kind.valid(text[a:b], text[max(0, a - 2) : a], text[b : b + 2]):
                found.append((a, b, i))
    return found


def chosen(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of spans that overlap the longest, then the leftmost, then the first kind; in text order."""
    kept: list[tuple[int, int, int]] = []
    for span in sorted(found, key=lambda s: (s[0] - s[1], s[0], s[2])):
        at = bisect_left(kept, span)
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
            insort(kept, span)
    return kept


def spans(text: str, kinds: list[Kind] = KINDS) -> list[tuple[int, int, int]]:
    """Spans chosen in the text, and again in what they leave, until nothing is found."""
    kept: list[tuple[int, int, int]] = []
    while new := chosen(candidates(text, kinds)):
        kept += new
        pieces, last = [], 0
        for a, b, _ in new:
            pieces += [text[last:a], TAKEN * (b - a)]
            last = b
        text = "".join([*pieces, text[last:]])
    return sorted(kept)


def replaced(text: str, found: list[tuple[int, int, int]], kinds: list[Kind] = KINDS) -> str:
    """The text with ``[KIND]`` in place of each span."""
    out, last = [], 0
    for a, b, i in found:
        out += [text[last:a], f"[{kinds[i].name.upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def _found(batches: Iterator[pa.RecordBatch], kinds: list[Kind]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            rows += [(doc_id, kinds[i].name, a, b - a, text[a:b]) for a, b, i in spans(text or "", kinds)]
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [batch["doc_id"].type, pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "kind", "start", "length", "value"])


def find_pii(docs: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """``doc_id, kind, start, length, value``: one row per finding, ``start`` in characters from 0.

    Findings do not overlap: the longest wins, then the leftmost, then the kind named first;
    what the losers leave is searched again. A card number must pass its checksum, an address
    must be in range, hexadecimal secrets have the length of a digest or key. A null text
    holds nothing; repeated rows give their findings again. Narrow: each text is searched in
    the task that reads it, patterns take linear time.
    """
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("kind string, start long, length long, value string")])
    return docs.select("doc_id", "text").mapInArrow(lambda b: _found(b, kinds), schema)


def _redacted(batches: Iterator[pa.RecordBatch], kinds: list[Kind]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).to_pylist()
        held = [spans(t or "", kinds) for t in texts]
        out = pa.array([t if not s else replaced(t, s, kinds) for t, s in zip(texts, held)], pa.string())
        yield pa.RecordBatch.from_arrays(
            [*(c if i != at else out for i, c in enumerate(batch.columns)), pa.array([len(s) for s in held], pa.int64())],
            [*batch.schema.names, "_n"])


def redact(docs: DataFrame, kinds: list[Kind] = KINDS, count: str | None = None) -> DataFrame:
    """``docs`` with every finding of :func:`find_pii` replaced by ``[KIND]``; no finding is left.

    ``count`` names a column for how many there were. Null texts stay null; all other columns
    pass through, whatever they are called, in a struct beside the text.
    """
    rows = docs.select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    schema = T.StructType([*rows.schema, T.StructField("_n", T.LongType())])
    done = rows.mapInArrow(lambda b: _redacted(b, kinds), schema)
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return done.select(*columns, *([F.col("_n").alias(count)] if count else []))


def pii_report(findings: DataFrame, docs: DataFrame, by: tuple[str, ...] = ("source", "lang"), precision: int = 12) -> DataFrame:
    """Findings summed up for every combination of ``by`` and ``kind``, with subtotals.

    ``*by, kind, level`` (grouping id: a bit for each column summed over, the last for the
    kind), ``n_findings`` and ``n_docs`` (exact), and ``n_values``: distinct values estimated
    with a standard error of 1.04 / sqrt(2 ** ``precision``), 1.6 % by default. Sketches are
    made once at the finest level and merged for subtotals. Documents are counted per
    (document, kind) and per document before grouping, so no set of ids meets in one task.
    Findings without a ``doc_id`` or without a document are left out.
    """
    owner = docs.groupBy("doc_id").agg(F.min(F.struct(*by)).alias("o")).select("doc_id", "o.*")
    held = findings.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n_findings"), F.hll_sketch_agg("value", F.lit(precision)).alias("sketch"))
    rows = stage(held.join(owner, "doc_id"), "findings")
    merged = F.hll_union_agg("sketch").alias("sketch")
    per_doc = rows.groupBy("doc_id", *by).agg(F.sum("n_findings").alias("n_findings"), merged).withColumn("kind", F.lit(None).cast("string"))
    sets = [list(c) for n in range(len(by) + 1) for c in combinations(by, n)]

    def summed(parts: DataFrame, sets: list[list[str]]) -> DataFrame:
        fine = parts.groupBy(*by, "kind").agg(F.sum("n_findings").alias("n_findings"), F.count(F.lit(1)).alias("n_docs"), merged)
        return fine.groupingSets(sets, *by, "kind").agg(
            F.grouping_id().cast("int").alias("level"), F.sum("n_findings").alias("n_findings"), F.sum("n_docs").alias("n_docs"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_values"))

    return summed(rows, [[*s, "kind"] for s in sets]).unionByName(summed(per_doc, sets))
