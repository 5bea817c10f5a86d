import math
import random

import duckdb
import numpy as np
import pytest

from sparkgate.llm import exact_topk as et
from sparkgate.llm.oracle import ORACLE
from sparkgate.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, query_id int, score string"
INF = float("inf")


def brute(queries, rows, k):
    """Score every pair in Python integers, sort, cut."""
    held = lambda x: max(-2**63, min(2**63 - 1, x))

    def ints(rows):
        return [(r[0], [held(math.floor(64 * x)) for x in r[1]]) for r in rows
                if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    asked = {}
    for q, v in ints(queries):
        if q is not None:
            asked[q] = min(asked.get(q, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-held(sum(x * y for x, y in zip(v, w))), c is None, c or 0)
                        for c, w in ints(rows) if c is None or c != q)
        out += [(q, i, None if none else c, -s) for i, (s, none, c) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def run(spark, queries, rows, k, **kw):
    got = et.top_k(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(rows, SCHEMA), k, **kw).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=str)


def some(n, d, scale=1.0, seed=3):
    rnd = random.Random(seed)
    return [(i, [rnd.uniform(-scale, scale) for _ in range(d)], 0, "") for i in range(n)]


@pytest.mark.parametrize("bins", [2, 16, 4096])
def test_any_number_of_refinements_gives_the_same_rows(spark, bins, monkeypatch):
    if bins < 4096:
        monkeypatch.setattr(et, "SETTLED", 1)
    rows = some(90, 6)
    rounds = []
    narrowed = et._narrowed
    monkeypatch.setattr(et, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    assert run(spark, rows[::30], rows, 5, bins=bins) == brute(rows[::30], rows, 5)
    assert len(rounds) == 1 if bins == 4096 else len(rounds) > 1


def test_odd_rows(spark):
    rows = some(30, 3) + [
        (40, None, 0, ""), (45, [1.0, None, 0.0], 0, ""), (50, [1.0, INF, 0.0], 0, ""), (55, [float("nan")] * 3, 0, ""),
        (60, [], 0, ""), (65, [0.5], 0, ""), (70, [0.5, 0.5, 0.5, 9.0, 9.0], 0, ""),
        (None, [0.9, 0.9, 0.9], 0, ""), (None, [0.9, 0.9, 0.9], 0, ""), (75, [0.9, 0.9, 0.9], 0, ""),
        (2**60 + 1, [0.9, 0.9, 0.9], 0, ""), (-20, [0.9, 0.9, 0.9], 0, ""), (5, [0.1, 0.1, 0.1], 0, ""), (5, [0.2, 0.1, 0.1], 0, "")]
    queries = [r for r in rows if r[0] is None or r[0] % 5 == 0]
    assert run(spark, queries, rows, 6) == brute(queries, rows, 6)
    assert run(spark, queries, rows, 1_000) == brute(queries, rows, 1_000)     # all, if fewer


def test_ties_of_a_third_of_all_rows_go_to_small_ids(spark):
    rows = some(60, 4) + [(100 + i, [1.0, 1.0, 1.0, 1.0], 0, "") for i in range(40)]
    rows += [(100, [1.0, 1.0, 1.0, 1.0], 0, "")] * 3
    queries = [(0, [1.0, 1.0, 1.0, 1.0], 0, ""), (7, [0.0] * 4, 0, "")]
    assert run(spark, queries, rows, 20) == brute(queries, rows, 20)


@pytest.mark.parametrize("scale", [1e6, 1e10, 1e17, 1e30])
def test_scores_beyond_double_precision_are_exact(spark, scale):
    rows = some(40, 5, scale) + [(50, [scale] * 5, 0, ""), (51, [-scale] * 5, 0, ""), (52, [1 / 64] * 5, 0, "")]
    queries = rows[::10] + [rows[40]]
    assert run(spark, queries, rows, 7) == brute(queries, rows, 7)


def test_empty_tables(spark):
    assert run(spark, [], some(3, 2), 5) == [] and run(spark, some(3, 2), [], 5) == []
    with pytest.raises(ValueError):
        et.top_k(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA), 0)


def test_many_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(et, "TILE_BYTES", 8 * 6 * 10)    # ten vectors a tile
    monkeypatch.setattr(et, "LEAST_ROWS", 1)
    rows = some(70, 6)
    assert run(spark, rows[::3], rows, 4) == brute(rows[::3], rows, 4)


def test_a_task_sends_only_bins_that_can_hold_the_bound():
    import pandas as pd
    rng = np.random.default_rng(1)
    vectors = pd.DataFrame({"id": range(5_000), "no_id": False, "v": list(rng.integers(-60, 60, (5_000, 8)))})
    queries = pd.DataFrame({"id": [9_000], "v": [rng.integers(-60, 60, 8)], "lo": [-2**16], "shift": [5]})
    out = et._count(4096, 20)(queries, vectors)
    assert len(out) <= 20 and out["n"].sum() >= 20


def test_query_matches_sql(spark):
    df = QUERIES["op13_exact_topk"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    cur = con.execute(ORACLE["op13_exact_topk"])
    cols = [c[0] for c in cur.description]
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(cur.fetchall())
