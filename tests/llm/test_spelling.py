import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from sparkgate.llm import spelling as sp
from sparkgate.llm.oracle import ORACLE
from sparkgate.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def edits_apart(a, b):
    """Whether exactly one insertion, deletion or replacement makes the words equal."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(n):
    near = {w: [v for v in n if edits_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def brute_counts(rows):
    n = Counter()
    lower = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def tuples(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def vocabulary(seed, n=900, letters="abé"):
    """Words of few letters and many single edits, with counts over several tens."""
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(7, 11))) for _ in range(n // 3)}
    while len(words) < n:
        w = rnd.choice(sorted(words))
        i = rnd.randrange(len(w) + 1)
        v = rnd.choice([w[:i] + rnd.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i + 1:]])
        if len(v) >= 7:
            words.add(v)
    return {w: rnd.choice([2, 3, 20, 200, 2_000, 20_000, 10**7]) for w in words}


def run(spark, n):
    return tuples(sp.group_variants(spark.createDataFrame(list(n.items()) or [], "word string, n long")))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_words_forms_and_roots_against_all_pairs(spark, seed):
    n = vocabulary(seed)
    assert run(spark, n) == brute(n)


def test_words_of_any_length(spark):
    rnd = random.Random(4)
    n = {}
    for letters in (7, 8, 63, 64, 65, 66, 67, 100, 129, 700, 5_000):
        w = "".join(rnd.choice("abc") for _ in range(letters))
        for i in {0, 1, letters // 3, letters // 2, letters - 2, letters - 1}:
            n[w[:i] + "é" + w[i:]] = n[w[:i] + "z" + w[i + 1:]] = 3
            n[w[:i] + "z" + w[i + 1:letters - 1] + "q"] = 4        # two edits, or one at the end
        n[w], n[w + "x"], n["x" + w] = 40, 3, 400
        if letters > 8:
            n[w[:-1]] = 50
    assert run(spark, n) == brute(n)


def test_batches_cut_anywhere_find_the_same_pairs(monkeypatch):
    n = vocabulary(3, 300)
    frame = pd.DataFrame({"word": list(n), "n": list(n.values())})
    dealt = pd.concat(sp._deal(iter([frame]))).sort_values(["slot", "block"])

    def totals(size):
        out = pd.concat(sp._near(iter([dealt.iloc[i:i + size] for i in range(0, len(dealt), size)])))
        return out.groupby("word")["n_near"].sum().to_dict()
    whole = totals(len(dealt))
    assert whole == {w: c for w, _, _, _, c, _ in brute(n) if c}
    monkeypatch.setattr(sp, "ROWS", 1)
    monkeypatch.setattr(sp, "BLOCK_CELLS", 60)
    assert totals(1) == totals(7) == whole


def test_equal_hashes_add_no_pairs(monkeypatch):
    """With one block for all words of a window, only the comparison decides."""
    monkeypatch.setattr(sp, "_mixed", lambda x: np.zeros_like(x))
    n = vocabulary(6, 60)
    frame = pd.DataFrame({"word": list(n), "n": list(n.values())})
    dealt = pd.concat(sp._deal(iter([frame])))
    dealt["block"] = 0
    out = pd.concat(sp._near(iter([dealt.sort_values(["slot", "block"])])))
    assert out.groupby("word")["n_near"].sum().to_dict() == {w: c for w, _, _, _, c, _ in brute(n) if c}


def test_words_of_texts(spark):
    rnd = random.Random(8)
    words = ["Éléphant", "elephant", "ELEPHANT", "großartig", "naïveté", "a×b÷cdefg", "straße", "Ünlikely", "x" * 3_000]
    rows = [(i, " ".join(rnd.choice(words) + rnd.choice(["", ",", "1"]) for _ in range(60)), 7, "n") for i in range(60)]
    rows += [(None, "elephant elephant Elephant", 7, "n"), (3, None, 7, "n"), (4, "", 7, "n"), (-5, "elephant " * 5_000, 0, "n")]
    rows += [rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, word string")
    got = {r.word: r.n for r in sp.word_counts(docs).collect()}
    want = brute_counts([r[:2] for r in rows])
    assert got == want and len(want) > 15
    plain = {r.word: r.n for r in sp.word_counts(docs, errors=None).collect()}
    assert set(plain) == {"Éléphant", "elephant", "großartig", "naïveté", "a×b÷cdefg", "Ünlikely", "x" * 3_000}


def test_empty_tables(spark):
    assert run(spark, {}) == []
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sp.word_counts(none).collect() == []


def test_a_word_is_sent_a_bounded_number_of_times():
    for letters in (7, 8, 64, 65, 66, 1_000, 20_000):
        frame = pd.DataFrame({"word": ["a" * letters], "n": [2]})
        assert len(pd.concat(sp._deal(iter([frame])))) <= 2 * sp.MOST_WINDOWS


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cur = con.execute(ORACLE["op12_spelling"])
    cols = [c[0] for c in cur.description]
    rows = QUERIES["op12_spelling"](spark, SF_SMALL).select(cols).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, cur.fetchall()))
