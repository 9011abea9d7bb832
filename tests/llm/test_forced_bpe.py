"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import pyarrow as pa
import pytest
from conftest import SMALL, rows
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from passagecraft.llm import forced_bpe
from passagecraft.llm.queries import QUERIES, tokenizer_path

rng = random.Random(11)
LIBRARY = Tokenizer.from_file(tokenizer_path())
with open(tokenizer_path(), encoding="utf-8") as f:
    VOCABULARY = forced_bpe.Vocabulary(f.read())
ODD = [
    "", " ", "\t\n", "Hello's World'll 123 don't", "ΣΊΣΥΦΟΣ Σ", "İstanbul ǅ ß ﬁ Å Å", "á ́ ȩ́", " x y\u0085z\x1cw", "日本語 テキスト",
    "<|startoftext|>a<|endoftext|>", "x<|endoftext|><|endoftext|>y <|ENDOFTEXT|>", "<|endof text|>", "</w> a</w>b", "😀👩‍👩‍👧🏳️‍🌈", "\x00\x01\x7f", "qx" * 40, "a" * 3000,
    "the" * 500, "'s'S's", "ﷺ" * 20, "ﬀ́", "".join(chr(c) for c in range(0x20, 0x500)), "".join(chr(c) for c in range(0x4E00, 0x4F00)),
]


def ours(texts):
    offsets, ids = forced_bpe.Encoder(VOCABULARY).texts(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def library(texts):
    return [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts():
    mixed = ["".join(rng.choices([*"abcdefgh'st \n", "é", "ß", "<|endoftext|>", "😀", "q", "z"], k=rng.randint(0, 200))) for _ in range(300)]
    assert ours(ODD + mixed) == library(ODD + mixed)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text(texts):
    assert ours(texts) == library(texts)


def test_short_and_long_fragments_merge_alike():
    encoder = forced_bpe.Encoder(VOCABULARY)
    for _ in range(300):
        ids = [int(VOCABULARY.base[ord(c)]) for c in rng.choices("aeinrst", k=rng.randint(1, forced_bpe.LONG_FRAGMENT - 1))]
        assert encoder.merged(ids[:]) == encoder._merged_long(ids[:])


def test_cuts_are_certain():
    """No token of the vocabulary spans a cut, and there are cuts inside words."""
    encoder, inside = forced_bpe.Encoder(VOCABULARY), 0
    for word in ["qxzvj", "straßenbahnqzj", "日本語", "zzqqkkjjxx"]:
        word = VOCABULARY.words(word)[0]
        _, at = encoder.fragments_of([word])
        inside += len(at) - 2
        for i in at[1:-1]:
            assert not any(word[i - 1 : i + 1] in token for token in VOCABULARY.tokens[:2000])
    assert inside


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(forced_bpe, "REMEMBERED_IDS", 10)
    encoder = forced_bpe.Encoder(VOCABULARY)
    texts = ODD[3:9]
    for text in texts + texts:
        offsets, ids = encoder.texts(pa.array([text]))
        assert ids.tolist() == library([text])[0]


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = []
    for r in docs:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))))
    got = QUERIES["op11_bpe_round_trip"](spark, SMALL)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)


def test_odd_rows(spark):
    docs = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "c<|endoftext|>"), (4, " ".join(rng.choices(["word", "Other", "é"], k=200_000)))]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, ids string, n string")
    got = forced_bpe.decode(forced_bpe.encode(frame, tokenizer_path()), tokenizer_path())
    assert got.columns == ["doc_id", "ids", "text"] and got.count() == len(docs)
    held = {(r.doc_id, r.text): r.ids for r in got.collect()}
    for doc_id, text in docs:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert held[doc_id, LIBRARY.decode(ids, skip_special_tokens=False)] == ids
    assert forced_bpe.decode(forced_bpe.encode(frame.limit(0), tokenizer_path()), tokenizer_path()).count() == 0


def test_decoding_odd_ids(spark):
    coded = spark.createDataFrame([(1, [320, 49407, 10**6, -1, None, 320]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert rows(forced_bpe.decode(coded, tokenizer_path()), "doc_id", "text") == [(1, LIBRARY.decode([320, 49407, 320], skip_special_tokens=False)), (2, ""), (3, "")]


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        forced_bpe.Vocabulary(f.read())
