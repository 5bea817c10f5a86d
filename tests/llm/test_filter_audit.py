import random
import re
from collections import Counter
from itertools import permutations

import duckdb

from sparkgate.llm import filter_audit as fa
from sparkgate.llm.oracle import ORACLE
from sparkgate.llm.queries import QUERIES
from tests.conftest import SF_SMALL

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, mask string, n int"


def fails(rows, i):
    doc_id, text, *_ = rows[i]
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    earlier = doc_id is not None and any(
        r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)
    conditions = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                  100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                  bool(re.search(r"[#$%&*|]", text)), earlier)
    return {c for c, failed in zip("ABCDE", conditions) if failed}


def brute(rows, labels):
    """Every order of the filters, document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    failing = [fails(rows, i) for i in range(len(rows))]
    out, shapley = {}, Counter()
    for part in {r[2] or "" for r in rows}:
        own = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = set(own)
            for step, c in enumerate(order, 1):
                gone = {i for i in left if c in failing[i]}
                redundant = {i for i in own if c in failing[i]} - left
                left -= gone
                shapley[part, c] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), len(redundant), sum(failing[i] == {c} for i in own),
                    sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone))
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def as_dict(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley) for r in df.collect()}


def corpus(n=120):
    rnd = random.Random(5)
    long_clean = " ".join(f"w{i}" for i in range(250))
    kinds = [None, "", "a b", long_clean, long_clean + " # x", "same " * 300, ("ABC " * 4 + long_clean),
             " ".join(f"x{i}\t\x0b" for i in range(201)), "été\nHÉÀ " * 100, "AAAA $ " * 250, "B" * 40_000]
    rows = [(i, rnd.choice(kinds), rnd.choice(["en", "de", None, ""]), "clash", 3) for i in range(n)]
    rows += [(None, long_clean, "en", "clash", 1), (None, long_clean, "en", "clash", 1), (None, None, None, "c", 1)]
    rows += [rows[10], rows[10], (rows[11][0], rows[11][1], "fr", "x", 0)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, n, 2)]
    return rows, labels + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]


def test_every_order_against_brute_force(spark):
    rows, labels = corpus()
    got = as_dict(fa.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)))
    want = brute(rows, labels)
    assert len(want) == 600 * 4 and got == want


def test_an_outcome_of_a_mask_says_what_happens_at_each_step():
    fields = fa.unpack(fa.packed(0b10010))           # fails B and E
    at = {(o, s): fields[3 * (5 * i + s):3 * (5 * i + s) + 3]
          for i, o in enumerate(fa.ORDERS) for s in range(5)}
    assert at["ABCDE", 1] == [1, 0, 0] and at["ABCDE", 4] == [0, 1, 0] and at["EBACD", 0] == [1, 0, 0]
    assert at["ABCDE", 0] == [0, 0, 0] and sum(fields) == 240
    assert sum(fa.unpack(fa.packed(0b00100))) == 240   # removed and unique in each order
    assert fa.unpack(fa.packed(0)) == [0] * 1800


def test_full_fields_do_not_run_over():
    """Counts just below the width of a field stay apart, in all fields at once."""
    n = 2**63 - 1
    total = sum(n // 32 * fa.packed(m) for m in range(32))
    assert max(fa.unpack(total)) < 2**63
    rows = fa.audit_rows("x", n // 32 * 32, total, total, 0)
    assert all(r[3] >= 0 for r in rows) and {r[3] for r in rows if r[2] == 5} == {n // 32}


def test_large_counts_of_one_kind_are_summed_exactly(spark):
    import pandas as pd
    n = 2**61 + 1
    frame = pd.DataFrame({"part": ["p"] * 2, "good": [True, False], "toxic": [False] * 2,
                          "mask": [1, 1], "n": [n, n]})
    (out,) = fa._sum_parts(iter([frame.iloc[:1], frame.iloc[1:]]))
    first = out[(out.filter_order == "ABCDE") & (out.step == 1)].iloc[0]
    assert (first.removed, first.good_lost, first.kept) == (2 * n, n, 0)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert fa.audit(none, spark.createDataFrame([], LABELS)).collect() == []
    one = as_dict(fa.audit(spark.createDataFrame([(1, None, "en", "", 0)], DOCS), spark.createDataFrame([], LABELS)))
    assert len(one) == 600 and one["en", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_other_column_names(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "x")], "`my.id` long, `t t` string, `p.q` string")
    got = as_dict(fa.audit(docs, spark.createDataFrame([], LABELS), "my.id", "t t", "p.q"))
    assert got["x", "EABCD", 1][:2] == (1, 1)


def test_copies_of_one_text_are_counted_before_they_move(spark):
    """The rows that meet for one text do not grow with its copies."""
    docs = spark.range(5_000).selectExpr("id AS doc_id", "'same text' AS text", "'en' AS lang")
    got = as_dict(fa.audit(docs, spark.createDataFrame([], LABELS)))
    assert got["en", "EABCD", 1][:2] == (1, 4_999)


def test_query_matches_sql(spark):
    df = QUERIES["op11_filter_audit"](spark, SF_SMALL)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(ORACLE["op11_filter_audit"])
    cols = [c[0] for c in cur.description]
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(cur.fetchall())
