import json
import shutil

from conftest import SMALL, rows

from passagecraft.functions.sizing import scratch_path, stage
from passagecraft.sources.tables import gold_answers, read_corpus, read_documents, read_qa, write_corpus
from passagecraft.streaming.ingest import stream_corpus

QA = {"data": [
    {"title": "都市", "paragraphs": [
        {"context": "日本の首都は東京です。", "qas": [
            {"id": "q1", "question": "首都は?", "answers": [{"text": "東京", "answer_start": 6}, {"text": "東京です", "answer_start": 6}]},
            {"id": "q2", "question": "国は?", "answers": [{"text": "日本", "answer_start": 0}]}]},
        {"context": "大阪は大きい。", "qas": [{"id": "q3", "question": "どこ?", "answers": [{"text": "大阪", "answer_start": 0}]}]}]},
    {"title": "Rivers", "paragraphs": [{"context": "The Rhine flows.", "qas": [
        {"id": "q4", "question": "What flows?", "answers": [{"text": "The Rhine", "answer_start": 0}]},
        {"id": "q5", "question": "Why?", "answers": []}]}]}], "version": "1"}


def test_read_qa_both_layouts(spark, tmp_path):
    (tmp_path / "qa.json").write_text(json.dumps(QA, ensure_ascii=False, indent=1))
    (tmp_path / "qa.jsonl").write_text("\n".join(json.dumps(a) for a in QA["data"]))
    whole = read_qa(spark, str(tmp_path / "qa.json"))
    assert rows(whole, "id", "title", "question")[0] == ("q1", "都市", "首都は?") and whole.count() == 5
    assert rows(whole, "id", "context") == rows(read_qa(spark, str(tmp_path / "qa.jsonl"), "jsonl"), "id", "context")
    gold = rows(gold_answers(whole), "id", "gold")
    assert gold == [("q1", "東京"), ("q1", "東京です"), ("q2", "日本"), ("q3", "大阪"), ("q4", "The Rhine")]
    for r in whole.collect():
        for a in r.answers:
            assert r.context[a.answer_start :].startswith(a.text)


def test_write_corpus_partitions_and_prunes(spark, tmp_path):
    docs = read_documents(spark, f"{SMALL}/documents.parquet")
    write_corpus(docs, str(tmp_path / "c"), rows_per_file=20)
    back = read_corpus(spark, str(tmp_path / "c"))
    assert rows(back, *docs.columns) == rows(docs, *docs.columns)
    files = list((tmp_path / "c" / "lang=en").glob("*.parquet"))
    assert len(files) >= docs.filter("lang = 'en'").count() / 20
    plan = back.filter("lang = 'de'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lang" in plan


def test_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(f"{SMALL}/pages.parquet", landing / "a.parquet")
    args = (spark, str(landing), str(tmp_path / "out"), str(tmp_path / "state"))
    stream_corpus(*args)
    stream_corpus(*args)
    assert read_corpus(spark, str(tmp_path / "out")).count() == 50
    shutil.copy("/root/testdata/sf0.01/pages.parquet", landing / "b.parquet")
    stream_corpus(*args)
    assert read_corpus(spark, str(tmp_path / "out")).count() == 300


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared) and scratch_path(spark, "x") != scratch_path(spark, "x")
    df = spark.range(5)
    assert stage(df, "r").inputFiles()[0].removeprefix("file://").startswith(shared)


def test_inputs_are_not_shuffled_unless_asked(spark):
    path, name = f"{SMALL}/documents.parquet", "spark.passagecraft.readPartitions"
    held = spark.conf.get(name)
    spark.conf.unset(name)
    plan = read_documents(spark, path)._jdf.queryExecution().executedPlan().toString()
    dealt = read_documents(spark, path, 5).rdd.getNumPartitions()
    spark.conf.set(name, held)
    assert "Exchange" not in plan and dealt == 5
