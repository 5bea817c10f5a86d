import random
from collections import Counter

import numpy as np
import pytest

from sparkgate.llm import dart_minhash as D
from tests.conftest import SF_SMALL


def weighted_set(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 1.0


def brute(rows):
    """Class of each row by all pairs: the smallest id that links of 0.8 and more lead to."""
    sets = [weighted_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= D.SIMILAR:
                root[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in out.items()}
    return sorted((str(d), str(low[find(i)])) for i, (d, _) in enumerate(rows))


def corpus(rnd):
    word = lambda: rnd.choice("abcdefghijklmnop") + rnd.choice("aeiou") + rnd.choice("rstlnm")
    rows, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(rnd.choice([4, 8, 30, 120, 400]))]
        for _ in range(rnd.randrange(1, 9)):
            w = list(base)
            for _ in range(rnd.randrange(0, max(1, len(w) // 60) + 1)):
                w[rnd.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (None, "lone text of no id"), (None, "another text of no id here"),
             (n + 3, "one"), (n + 4, "ONE\n"), (n + 5, "w " * 20_000), (n + 6, "w " * 20_000), rows[3], rows[3]]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = corpus(random.Random(4))
    docs = spark.createDataFrame([(*r, b"x", 1) for r in rows], "doc_id long, text string, node binary, bucket int")
    got = D.classes(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == brute(rows)
    kept = D.first_of_each(docs)
    assert kept.columns == docs.columns
    n_classes = len({r.root for r in got})
    assert kept.count() == n_classes
    ids = {r.doc_id for r in got if r.doc_id == r.class_id and r.doc_id is not None}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == ids


def test_links_inside_a_family_around_one_passage(spark):
    """All share a passage (0.78) and so their buckets; only partners are more alike (0.88)."""
    passage = [f"p{i}" for i in range(74)]
    rows = [(2 * k + side, " ".join(passage + [f"x{k}y{i}" for i in range(5)] + [f"z{k}s{side}y{i}" for i in range(5)]))
            for k in range(200) for side in range(2)]
    want = brute(rows)
    assert len({c for _, c in want}) == 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.class_id)) for r in D.classes(docs).collect()) == want


def test_empty_and_shuffle_join(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g "), (3, "x y")], "doc_id long, text string")
    assert D.classes(docs.limit(0)).collect() == [] and D.first_of_each(docs.limit(0)).collect() == []
    monkeypatch.setattr(D, "NODES_BROADCAST", 0)
    assert sorted((r.doc_id, r.class_id) for r in D.classes(docs).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(7)
    for n in (1, 40, 3000):
        error = []
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            wa = rng.integers(1, 7, n)
            wb = np.where(rng.random(n) < 0.7, wa, rng.integers(1, 7, n))
            s = D.signatures([(a, wa), (a, wb)])
            error.append((s[0] == s[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
            assert D.similarity(D._pack(a, wa), D._pack(a, wb)) == pytest.approx(
                np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
        assert abs(np.mean(error)) < 0.04


def test_parities_bound_the_difference():
    rng = np.random.default_rng(9)
    for n in (1, 60, 3000):
        e = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        wa, wb = rng.integers(1, 4, n), rng.integers(1, 4, n)
        bits = [np.unpackbits(np.frombuffer(D.parities(e, w), np.uint8)) for w in (wa, wb)]
        assert (bits[0] != bits[1]).sum() <= np.abs(wa - wb).sum() and (D.parities(e, wa) == D.parities(e, wa.copy()))


def test_signature_depends_on_the_set_alone():
    rng = np.random.default_rng(8)
    sets = [(np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)), np.ones(n, np.int64)) for n in (1, 5, 300, 2000)]
    alone = np.concatenate([D.signatures([s]) for s in sets])
    assert (D.signatures(sets) == alone).all() and (D.signatures(sets[::-1])[::-1] == alone).all()


def test_components_of_chains_and_stars(spark):
    names = [b"%03d" % i for i in range(60)]
    links = [(names[i + 1], names[i]) for i in range(29)] + [(names[i], names[30]) for i in range(31, 50)] + [
        (names[59], names[55])]
    got = D.components(spark.createDataFrame(links, "u binary, v binary")).collect()
    root = {bytes(r.node): bytes(r.root) for r in got}
    assert all(root[names[i]] == names[0] for i in range(1, 30))
    assert all(root[names[i]] == names[30] for i in range(31, 50)) and root[names[59]] == names[55]


def test_query_equals_all_pairs(spark):
    from sparkgate.llm.queries import op8_near_duplicates
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = op8_near_duplicates(spark, SF_SMALL).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == brute(rows)
