"""The pipeline against what its stages promise, told by brute force."""

import re

from conftest import SMALL, rows
from pyspark.sql import functions as F

import corpus_pipeline
from passagecraft.llm import order_minhash, quality_rules
from passagecraft.llm.tables import stage


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = {"start": docs}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), "test")
        held[name] = docs
    texts = {name: {r.doc_id: r.text for r in df.collect()} for name, df in held.items() if name != "packing"}
    for name in list(texts)[1:]:
        assert held[name].columns == held["start"].columns

    rules = quality_rules.judge(held["start"], spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert set(texts["quality rules"]) == {r.doc_id for r in rules.filter("kept").collect()}

    seen, want = [], {}
    for d, text in sorted(texts["quality rules"].items()):
        kept = []
        for line in text.split("\n"):
            near = len(line) >= 20 and any(abs(len(line) - len(s)) <= 1 and _one_edit(line, s) for s in seen)
            kept += [] if near else [line]
            seen += [line] if len(line) >= 20 and not near else []
        if kept:
            want[d] = "\n".join(kept)
    assert {d: t for d, t in want.items() if t} == texts["line dedup"]
    assert all(r.n_chars == len(r.text) for r in held["line dedup"].collect())

    classes = order_minhash.classes(held["line dedup"])
    assert set(texts["near dedup"]) == {r.doc_id for r in classes.filter("doc_id = class_id").collect()}

    items = [_plain(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, t in texts["near dedup"].items() if any(i in _plain(t) for i in items)}
    assert leaked.isdisjoint(texts["decontamination"]) and len(texts["near dedup"]) - len(texts["decontamination"]) <= len(leaked) + 1

    packed = held["packing"]
    assert {r.doc_id for r in packed.collect()} == set(texts["decontamination"])
    assert rows(packed, "doc_id", "piece", "length") == rows(corpus_pipeline.run(spark, SMALL), "doc_id", "piece", "length")
    bins = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert bins.agg(F.max("n")).first()[0] <= 2048


def _plain(text):
    return " ".join(re.sub(r"[^\w\s]", " ", text.lower()).split())


def _one_edit(a, b):
    if a == b:
        return True
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[n + 1 :] == b[n + 1 :] or a[n:] == b[n + 1 :] or a[n + 1 :] == b[n:]
