import hashlib
import random

import numpy as np
import pytest

from sparkgate.llm import bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", None, "Hello world", "  spaces   and\n\nlines \t", "été ñandú größe 日本語 🙂🙂",
         "a" * 5000, "ab" * 300 + " " + "xyz" * 400, "it's we'll 123 4567 !!! $$$",
         "<|endoftext|> is text", "\x00\x01‍", "-" * 700, "the the the"]


def test_same_ids_as_the_library_and_round_trip(spark, ranks, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1), (2, TEXTS[2], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = bpe.decode(bpe.encode(docs, ranks, P.PATTERN), ranks).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    assert want == sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded))
                          for r in got)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_empty_table(spark, ranks):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.decode(bpe.encode(docs, ranks, P.PATTERN), ranks)).collect() == []


def test_merge_of_random_bytes(ranks, library):
    rnd = random.Random(3)
    for n in (1, 2, 7, 40, 49, 300):
        for alphabet in ("ab", "etaoin ", "é中z"):
            word = "".join(rnd.choice(alphabet) for _ in range(n)).encode()
            assert bpe.merge(word, ranks) == library._encode_single_piece(word)


def test_cache_generations_change_nothing(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    known = bpe._Ids(ranks)
    words = ["the", " cat", " sat", " on", " the", " mat", "the", " cat", "zzzz"] * 3
    assert [known[w] for w in words] == [
        np.array(bpe.merge(w.encode(), ranks), "<u4").tobytes() for w in words]


def test_query_matches_the_library(spark, ranks, library):
    from sparkgate.llm.queries import op6_bpe
    from tests.conftest import SF_SMALL
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op6_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
