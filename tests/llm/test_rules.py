import random
import re
from collections import Counter

import duckdb

from sparkgate.llm import rules
from sparkgate.llm.oracle import ORACLE
from sparkgate.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {p for i, w in enumerate(windows) if n[w] > 1 for p in range(i, i + 5)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return (len(words), sum(map(len, words)), len(covered), len(re.findall(r"[#*$%&|<>]", text)),
            text.count("!"), len(lines), len(lines) - len(set(lines)))


def test_measurements_against_brute_force(spark):
    rnd = random.Random(1)
    texts = [None, "", " \n\t\x0b", "a b c d e a b c d e", "a b c d e", "a a a a a a a", "x\ny\nx\n\nx",
             "été   ñ　z", "# * $ % & | < >!", "w " * 30_000]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(40))) for _ in range(40)]
    texts += ["\n".join(rnd.choice(["a b", "c", " ", ""]) for _ in range(20)) for _ in range(5)]
    rows = [(i, t, 5, "n") for i, t in enumerate(texts)] + [(None, "a b", 5, "n"), (3, texts[3], 5, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, failed string")
    got = rules.ledger(docs).collect()
    want = sorted((str(i), *brute(t)) for i, t, *_ in rows)
    assert want == sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_repeat_words, r.n_symbols,
                           r.n_exclamations, r.n_lines, r.n_dup_lines) for r in got)


def test_policies_and_ablation_read_only_the_ledger(spark):
    b = rules.BIT
    rows = [(1, 0), (2, b["symbols"]), (3, b["symbols"] | b["too_short"]), (4, b["long_words"])]
    led = spark.createDataFrame(rows, "doc_id long, failed long")
    assert {r.doc_id: (r.base_failed, r.kept) for r in rules.apply_policy(led, "v1").collect()} == {
        1: (False, True), 2: (False, False), 3: (True, False), 4: (False, True)}
    assert {r.doc_id for r in rules.apply_policy(led, rules.mask("long_words")).collect() if r.kept} == {1, 2}
    got = {r.rule: (r.n_failed, r.n_only) for r in rules.ablate(led, "v2").collect()}
    assert got["symbols"] == (2, 1) and got["too_short"] == (1, 0) and got["long_words"] == (1, 1)
    assert {r.n_failed for r in rules.ablate(led.limit(0), "v2").collect()} == {0}


def test_empty_table(spark):
    assert rules.ledger(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_matches_sql_without_python(spark):
    df = QUERIES["op9_rules"](spark, SF_SMALL)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cur = con.execute(ORACLE["op9_rules"])
    cols = [c[0] for c in cur.description]
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(cur.fetchall())


def test_clean_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    kept = QUERIES["op9_rules"](spark, SF_SMALL.replace("0.001", "0.01")).join(labels, "doc_id")
    got = {(r.quality, r.kept): r["count"] for r in kept.groupBy("quality", "kept").count().collect()}
    print(got)
    assert got[1, True] > 0.9 * (got[1, True] + got.get((1, False), 0))
    assert got[0, False] > 0.5 * (got[0, False] + got.get((0, True), 0))
