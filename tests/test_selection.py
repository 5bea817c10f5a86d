"""Order statistics by band selection."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkgate.operators import selection as S

QS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def shuffled_bytes(df) -> int:
    """Bytes that the exchanges of a plan wrote, read from the plan after it has run."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("dataSize").value() if name == "ShuffleExchangeExec" else 0
        kids = node.children()
        return own + sum(walk(kids.apply(i)) for i in range(kids.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def tables():
    rng = np.random.default_rng(7)
    n = 6_000
    heavy = np.exp(rng.normal(0, 4, n))
    ties = rng.choice([1.0, 2.0, 2.0, 2.0, 5.0], n)
    mixed = np.where(rng.random(n) < 0.4, 42.0, rng.normal(0, 1e6, n))
    rows = [(g, float(v)) for g, vs in (("heavy", heavy), ("ties", ties), (None, mixed)) for v in vs]
    rows += [("heavy", None)] * 50 + [("one", 3.5), ("two", -1.0), ("two", 4.0), ("same", 7.0)] + [("same", 7.0)] * 999
    rows += [("none", None)] * 5 + [("ends", math.inf), ("ends", -math.inf), ("ends", 0.0)]
    random.Random(1).shuffle(rows)
    return rows


def want(rows):
    con = duckdb.connect()
    frame = pd.DataFrame({"g": [r[0] for r in rows], "v": pd.array([r[1] for r in rows], dtype="Float64")})
    con.register("t", frame)
    quantiles = ", ".join(f"quantile_cont(v, {q})" for q in QS)
    return {r[0]: r[1:] for r in con.execute(f"SELECT g, {quantiles} FROM t WHERE v IS NOT NULL GROUP BY g").fetchall()}


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12)


def check(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: tuple(r[1:]) for r in S.grouped_exact_quantiles(df, ["g"], "v", QS).collect()}
    expected = want(rows)
    assert got.keys() == expected.keys()
    for g in got:
        if g != "ends":     # infinite neighbours have no middle
            assert all(map(same, got[g], expected[g])), (g, got[g], expected[g])


@pytest.mark.parametrize("band, cells", [(100_000, 1_000), (40, 50), (40, 7)])
def test_equal_to_sql_quantiles(spark, monkeypatch, band, cells):
    monkeypatch.setattr(S, "BAND_ROWS", band)
    monkeypatch.setattr(S, "GRID", cells)
    check(spark, tables())


@pytest.mark.parametrize("limit", [0, 100_000])
def test_a_poor_sketch_costs_scans_not_exactness(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "MAX_BAND_ROWS", limit)     # bands by shuffle join, or broadcast
    narrowed = S._first_bands

    def off(base, keys, qs):
        """Brackets that all lie above their ranks."""
        return narrowed(base, keys, qs).withColumn("_bands", F.transform("_bands", lambda b: F.struct(
            b["i"], b["first"], b["last"], F.lit(1e300).alias("lo"), F.lit(None).cast("double"), b["size"]).cast(S.BAND)))
    monkeypatch.setattr(S, "_first_bands", off)
    monkeypatch.setattr(S, "BAND_ROWS", 500)
    check(spark, tables())


def test_no_values(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert S.grouped_exact_quantiles(none, ["g"], "v", [0.5]).collect() == []
    nulls = spark.createDataFrame([("a", None)], "g string, v double")
    assert S.grouped_exact_quantiles(nulls, ["g"], "v", [0.5]).collect() == []


def test_bytes_shuffled_do_not_grow_with_rows(spark, monkeypatch):
    """The counting scan moves the band, the sketch a summary: ten times the rows, the same bytes."""
    monkeypatch.setattr(S, "BAND_ROWS", 200)

    def moved(n):
        df = spark.range(n, numPartitions=4).select(F.lit("a").alias("g"), F.rand(1).alias("v"))
        base = df.select("g", F.col("v").alias("_v"))
        bands = S._first_bands(base, ["g"], [0.01, 0.99])
        while bands.where(F.exists("_bands", S._wide)).take(1):
            bands = S._narrowed(base, ["g"], bands, True, 2 / S.ACCURACY)
        assert bands.select(F.max(F.element_at("_bands", 1)["size"])).first()[0] <= 200
        return shuffled_bytes(S._cells(base, ["g"], bands, True).groupBy("g", "_i", "_x").count())
    small, large = moved(100_000), moved(1_000_000)
    plain = shuffled_bytes(spark.range(1_000_000, numPartitions=4).select(F.rand(1).alias("v")).groupBy("v").count())
    assert large < 1.5 * small + 20_000 and large < plain / 50
