import random

import pytest

from sparkgate.llm import bpe, tokencount
from tests.conftest import SF_SMALL

P = pytest.importorskip("public_tokenizers")
regex = pytest.importorskip("regex")


@pytest.fixture(scope="module")
def cost():
    return tokencount.costs(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))


def brute(word, cost):
    """Lowest (cost, tokens) over all segmentations of the bytes."""
    best = [(0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        best[end] = min((best[s][0] + cost[word[s:end]], best[s][1] + 1)
                        for s in range(end) if word[s:end] in cost)
    return best[-1][1]


def test_shared_prefixes_change_nothing(cost):
    rnd = random.Random(2)
    words = {"".join(rnd.choice(["th", "e", "ing", " ", "é", "日", "9"]) for _ in range(rnd.randrange(1, 9)))
             for _ in range(400)} | {"a" * 300}
    got = tokencount.count_words(words, tokencount.Forward(cost))
    assert got == {w: brute(w.encode(), cost) for w in words}


def test_ties_take_fewest_tokens():
    tied = {b"a": 5, b"b": 5, b"ab": 10, b"c": 1}
    assert tokencount.Forward(tied).count(b"abc") == 2


@pytest.mark.parametrize("kept", [3, 200_000])
def test_counts_of_texts(spark, cost, kept, monkeypatch):
    monkeypatch.setattr(tokencount, "WORDS_KEPT", kept)
    texts = [None, "", " ", "the cat sat", "the cat sat", "x" * 3000, "日本 été 123!!", "a\n\n b " * 500]
    rows = [(i, t, "n") for i, t in enumerate(texts)] + [(None, "the", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    want = sorted((str(i), len(regex.findall(P.PATTERN, t or "")),
                   sum(brute(w.encode(), cost) for w in regex.findall(P.PATTERN, t or ""))) for i, t, _ in rows)
    got = tokencount.count_tokens(docs, cost, P.PATTERN).collect()
    assert want == sorted((str(r.doc_id), r.n_pretokens, r.n_tokens) for r in got)
    assert tokencount.count_tokens(docs.limit(0), cost, P.PATTERN).collect() == []


def test_query_against_brute_force(spark, cost):
    from sparkgate.llm.queries import op10_token_counts
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    known = {}
    for r in op10_token_counts(spark, SF_SMALL).collect():
        words = regex.findall(P.PATTERN, texts[r.doc_id])
        for w in words:
            if w not in known:
                known[w] = brute(w.encode(), cost)
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(map(known.get, words)))
