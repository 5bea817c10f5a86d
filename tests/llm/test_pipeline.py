import hashlib

import numpy as np
import pytest

import corpus_pipeline as C
from sparkgate.llm import bpe, decontaminate, pii, quality
from tests.conftest import SF_SMALL
from tests.llm.test_dart_minhash import brute

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


def read(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def test_stages_against_brute_force(spark):
    docs = read(spark, "documents").cache()
    assert [n for n, _ in C.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "bpe"]
    text = {r.doc_id: r.text for r in docs.collect()}

    good = C.quality_filter(spark, docs, SF_SMALL).cache()
    assert good.columns == docs.columns
    verdict = quality.classify(docs, quality.fit(docs, read(spark, "labels"))).collect()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in verdict if r.quality_kept)

    single = C.near_dedup(spark, good, SF_SMALL).cache()
    classes = brute([(r.doc_id, r.text) for r in good.collect()])
    assert single.columns == docs.columns
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted(d for d, c in classes if d == c)

    fresh = C.decontamination(spark, single, SF_SMALL).cache()
    finder = decontaminate.Finder([(r.item_id, r.text) for r in read(spark, "benchmark").collect()])
    assert fresh.columns == docs.columns
    assert sorted(r.doc_id for r in fresh.collect()) == sorted(
        r.doc_id for r in single.collect() if not finder.hits(r.text))

    hidden = C.pseudonyms(spark, fresh, SF_SMALL).cache()
    assert hidden.columns == docs.columns and hidden.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert hidden.count() == fresh.count()
    for r in hidden.collect():
        found = pii.detect(text[r.doc_id])
        assert r.n_chars == len(r.text) and (found or r.text == text[r.doc_id])
        assert not any(w in r.text for *_, w in found)

    ranks = bpe.read_ranks(P.path(C.BPE_VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {(r.doc_id, hashlib.sha256(np.array(library.encode_ordinary(r.text), "<u4").tobytes()).hexdigest())
            for r in hidden.collect()}
    assert {(r.doc_id, r.ids_sha256) for r in C.tokens(spark, hidden, SF_SMALL).collect()} == want
    assert {(r.doc_id, r.ids_sha256) for r in C.run(spark, SF_SMALL).collect()} == want


def test_no_documents(spark):
    docs = read(spark, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.collect() == []
