import hashlib

import duckdb

from sparkgate.llm import chat
from sparkgate.llm.oracle import ORACLE
from sparkgate.llm.queries import HOSTILE, QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, seq long, message string, kind string, role string, text string, extra int"
MARKS = ["###", "####", "#", "##", "\\", "\\\\", "\\h", "\\\\h", "#\\h", "</turn>", "</turn>\n", "<\\eturn>",
         "<</turn>/turn>", "### user: hi", HOSTILE, "", "\n", "a\\", "\\e\\c:"]


def conversations(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    return chat.render(chat.fold(df))


def turns(spark, rows):
    return {r.conv_id: [(t.role, t.text) for t in r.turns]
            for r in chat.read_back(conversations(spark, rows)).collect()}


def test_events_fold_into_final_messages(spark):
    rows = [(1, 0, "u", "message", "user", "hi"), (1, 5, "a", "delta", "assistant", "wor"),
            (1, 2, "a", "delta", "assistant", "hel"), (1, 6, "a", "regenerate", "assistant", None),
            (1, 7, "a", "delta", "assistant", "by"), (1, 8, "a", "delta", "assistant", "e"),
            (1, 9, "u", "edit", "user", "hello"), (1, 10, "x", None, "user", None)]
    assert turns(spark, rows) == {1: [("user", "hello"), ("assistant", "bye"), ("user", "")]}


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, None, None, "message", None, None), (2, 1, "a", "message", "user", "b"),
            (2, 1, "a", "message", "user", "b"), (2, 1, "b", "message", "user", "a"),
            (2, None, "c", "edit", "assistant", "first")]
    assert turns(spark, rows) == {
        None: [("", "")], 2: [("assistant", "first"), ("user", "a"), ("user", "b"), ("user", "b")]}
    assert turns(spark, [(1, 1, "m", "message", "r", "t")][:0]) == {}


def test_every_text_and_role_reads_back(spark):
    rows = [(i, j, str(j), "message", role, text) for i, role in enumerate(MARKS)
            for j, text in enumerate(MARKS)] + [(99, 0, "l", "message", "assistant", "#\\</turn>" * 20_000)]
    out = conversations(spark, rows)
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    for i, role in enumerate(MARKS):
        assert [(t.role, t.text) for t in got[i].turns] == [(role, t) for t in MARKS]
    assert got[99].loss_text == "#\\</turn>" * 20_000
    for r in out.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count(chat.END) == len(r.segments) // 3


def test_query_matches_sql_without_python(spark):
    df = QUERIES["op1_chat"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "EvalPython" not in plan
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    cur = con.execute(ORACLE["op1_chat"])
    cols = [c[0] for c in cur.description]
    got = sorted(map(tuple, df.select(cols).collect()))
    assert got == sorted(cur.fetchall())
    row = dict(zip(cols, got[0]))
    assert row["conv_id"] == -7 and row["loss_sha256"] == hashlib.sha256(HOSTILE.encode()).hexdigest()
