import hashlib
import random

import numpy as np
import pytest

from sparkgate.llm import suffix_dedup as S
from tests.conftest import SF_SMALL


def brute(rows):
    """Counts and digest of each row from all strings of 100 bytes in order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0,
                                                    hashlib.md5((rows[i][1] or "").encode()).hexdigest()))
    seen, out = set(), []
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = np.zeros(len(text), bool)
        for q in range(len(text) - S.LENGTH + 1):
            w = text[q:q + S.LENGTH]
            if w in seen:
                gone[q:q + S.LENGTH] = True
            seen.add(w)
        runs = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((str(rows[i][0]), len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(rnd):
    words = ["".join(rnd.choice("abcdefé") for _ in range(rnd.randrange(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [say(n) for n in (15, 18, 25, 40, 90)] + ["z" * 100, "xy" * 60, "q" * 99]
    rows = [(n, say(rnd.randrange(0, 60))) for n in range(12)]
    for n in range(12, 70):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            parts += [say(rnd.randrange(0, 20)), rnd.choice(passages)]
        rows.append((n, rnd.choice(["", " "]).join(parts)))
    rows += [(70, "a" * 1000), (71, "ab" * 400), (72, "a" * 250), (73, None), (74, ""), (75, "a" * 99),
             (76, "\x00" * 300), (77, rows[20][1] + "\x00" * 150)]
    return rows


def collected(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digests(df).collect())


@pytest.mark.parametrize("hot", [S.HOT, 3])
def test_every_row_equals_brute_force(spark, hot, monkeypatch):
    rows = corpus(random.Random(6))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, copy int, spans binary")
    assert collected(S.remove_repeats(docs.repartition(5), hot=hot)) == brute(rows)
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(S, "HASH_BUCKET_BYTES", 5000)
    monkeypatch.setattr(S, "SUFFIX_BUCKET", 50)
    assert collected(S.remove_repeats(docs.repartition(7), hot=hot)) == brute(rows)


def test_null_and_repeated_ids(spark):
    rnd = random.Random(2)
    long = ["".join(rnd.choice("abc ") for _ in range(300)) for _ in range(3)]
    rows = [(5, long[0]), (5, long[0]), (5, long[1] + long[0]), (None, long[1]), (None, long[1]), (7, long[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(S.remove_repeats(docs)) == brute(rows)
    assert S.remove_repeats(docs.limit(0)).collect() == []


def test_loser_tree_merges_and_gives_common_prefixes():
    rnd = random.Random(3)
    for n in (1, 2, 3, 5, 8, 13):
        runs = []
        for _ in range(n):
            rows = sorted(bytes(rnd.choice(b"ab") if i > 3 else 97 for i in range(S.LENGTH - 6)) + b"\0" * 6
                          for _ in range(rnd.randrange(1, 40)))
            rows += [rows[-1]] * rnd.randrange(3)
            lcp, tails = S.front_coded(np.array([list(r) for r in rows], np.uint8))
            assert S.decoded(lcp, tails) == rows
            runs.append((lcp, rows))
        order, lcps = S.merge(runs)
        rest = [iter(r) for _, r in runs]
        merged = [next(rest[i]) for i in order]
        assert merged == sorted(x for _, r in runs for x in r)
        common = lambda a, b: next((i for i in range(S.LENGTH) if a[i] != b[i]), S.LENGTH)
        assert lcps == [0] + [common(a, b) for a, b in zip(merged, merged[1:])]


def test_known_prefixes_are_not_compared_again(monkeypatch):
    """The bytes looked at stay within the merged suffixes' distinguishing ones."""
    looked = []
    real = S.shared
    monkeypatch.setattr(S, "shared", lambda a, b, known: looked.append(real(a, b, known) - known) or looked[-1] + known)
    rows = sorted(b"p" * 60 + bytes([97 + i % 20, 97 + i // 20]) + b"\0" * 38 for i in range(200))
    runs = [(S.front_coded(np.array([list(r) for r in rows[k::8]], np.uint8))[0], rows[k::8]) for k in range(8)]
    S.merge(runs)
    assert sum(looked) < 60 * 8 + 200 * 4 * 3


def test_equal_strings_have_anchors_at_the_same_place():
    rnd = random.Random(4)
    for alphabet in ("ab", "abcdefgh"):
        common = "".join(rnd.choice(alphabet) for _ in range(S.LENGTH)).encode()
        found = []
        for _ in range(20):
            pad = lambda: "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))).encode()
            before = pad()
            at, h = S.anchors(before + common + pad())
            inside = {int(p) - len(before) for p in at if 0 <= p - len(before) <= S.LENGTH - S.K}
            found.append(inside)
        assert set.intersection(*found)


def test_long_texts_are_cut_in_parts(monkeypatch):
    rnd = random.Random(5)
    text = bytes(rnd.choice(b"abcd") for _ in range(3000))
    whole = S.anchors(text)
    monkeypatch.setattr(S, "PART", 700)
    parts = S.anchors(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_query_equals_brute_force(spark):
    from sparkgate.llm.queries import op4_suffix_dedup
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in op4_suffix_dedup(spark, SF_SMALL).collect())
    assert got == brute(rows)
