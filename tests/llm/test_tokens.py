"""Operators 8 and 10 against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docweave.llm import bpe, common, tokens

from .fixtures import DATA, frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXT = st.text(st.sampled_from(" \n\tab'sdDé ß 中文1234.,!<|endoftext|>\U0001f600́\x85﻿"), max_size=80)


@pytest.fixture(autouse=True)
def shipped(spark):
    common.ship(spark)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_counts_and_round_trip_are_the_librarys(spark):
    table = rows()
    text_of = {r[0]: r[1] for r in table}
    counted = tokens.token_counts(frame(spark, table), PATH).collect()
    assert len(counted) == len(table)
    for r in counted:
        if r.doc_id is not None:
            n = len(ids(text_of[r.doc_id]))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text_of[r.doc_id] or "").encode()), n, n > 1024)
    coded = bpe.round_trip(frame(spark, table), PATH).collect()
    assert len(coded) == len(table)
    for r in coded:
        if r.doc_id is not None:
            want = ids(text_of[r.doc_id])
            back = LIBRARY.decode(want, skip_special_tokens=False)
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_encode_then_decode_gives_the_text(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    back = bpe.decode(bpe.encode(docs, PATH), PATH).withColumnRenamed("text", "back")
    assert docs.join(back, "doc_id").where("text <> back").count() == 0
    few = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(few, PATH).collect()] == ["", ""]


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_codec_on_odd_texts(text):
    tool = bpe.codec(PATH)
    assert np.frombuffer(next(tool.encode([text])), "<u4").tolist() == ids(text)
    assert tool.decode(np.array(ids(text), "<u4").tobytes()) == LIBRARY.decode(ids(text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 12), st.integers(1, 6))
def test_spliced_chunks_on_odd_texts(text, chunk, overlap):
    tool = tokens.encoder(PATH)
    assert tool.counts([text]) == [len(ids(text))]
    assert tool.count_huge(text, chunk, overlap) == len(ids(text))


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 200_000, "ab " * 100_000, "a\n" * 90_000 + " b" * 50_000, "中" * 100_000])
def test_huge_texts(text):
    assert tokens.encoder(PATH).counts([text]) == [len(ids(text))]


def test_truncated_sequences_decode_as_in_the_library():
    tool = bpe.codec(PATH)
    for text in ["中文é", "\U0001f600", "aéb"]:
        whole = ids(text)
        for k in range(len(whole) + 1):
            assert tool.decode(np.array(whole[:k], "<u4").tobytes()) == LIBRARY.decode(whole[:k], skip_special_tokens=False)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_vocabularies_count_as_their_library(name):
    path = public_tokenizers.path(name)
    text = "The quick brown fox, naïve 中文 don't  stop."
    if name.endswith(".model"):
        import sentencepiece

        want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    else:
        want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    assert tokens.encoder(path).counts([text]) == [want]


def test_empty_tables(spark):
    docs = frame(spark, []).where("false")
    assert tokens.token_counts(docs, PATH).collect() == []
    assert bpe.round_trip(docs, PATH).collect() == []
    assert bpe.encode(docs, PATH).collect() == []
