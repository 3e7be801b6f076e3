"""The corpus pipeline's stages against plain versions."""

import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from docweave.llm import common, linelabel

from . import brute
from .fixtures import DATA, frame, rows


def test_stages_on_the_driver_documents(spark):
    common.ship(spark)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held, text = [], {r.doc_id: r.text for r in docs.collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = common.stored(stage(spark, now, DATA))
        held.append(now.collect())
        if name != "bpe_encoding":
            assert now.columns == docs.columns
    good, first, cut, mixed, coded = held
    field = linelabel.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert {r.doc_id for r in good} == {r.doc_id for r in linelabel.judge(docs, field).where("kept").collect()}
    similar = brute.similar([(r.doc_id, text[r.doc_id]) for r in good])
    assert {r.doc_id for r in first} == {i for i, (_, c) in similar.items() if i == c}
    plain = brute.dedup([(r.doc_id, r.text) for r in first])
    assert {r.doc_id: hashlib.sha256(" ".join(brute.words(r.text)).encode()).hexdigest() for r in cut} == {i: s for i, (n, gone, s) in plain.items() if n == 0 or gone < n}
    assert all(r.n_chars == len(r.text) for r in cut)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in cut}
    library, texts = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {r.doc_id: r.text for r in mixed}
    assert len(coded) == len(mixed)
    for r in coded:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.lossless


def test_stages_bear_odd_and_empty_tables(spark):
    for table in (rows(), []):
        docs = frame(spark, table).where("true" if table else "false")
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, DATA))
            if name != "bpe_encoding":
                assert docs.columns == frame(spark, []).columns
        assert (docs.count() > 0) == bool(table)
