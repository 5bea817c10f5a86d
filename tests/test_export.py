"""Read-back by a multiset fingerprint."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkgate.session import scratch_path
from sparkgate.sources import export as EX

SCHEMA = "customer_id string, total_spent double, last timestamp_ntz, `a.b` string"


def _rows(n=200):
    base = dt.datetime(2024, 1, 1)
    return [(f"c{i}", None if i == 3 else i * 0.1, base + dt.timedelta(hours=i), None if i % 5 else f"x{i}") for i in range(n)]


def _checks(spark, path):
    return {r.check: r.passed for r in EX.check_export(spark, path, "customer_id", "total_spent").collect()}


def _tampered(spark, df, change, fmt):
    """An export whose rows were changed after it was written."""
    path = scratch_path(spark, "export-test")
    EX.export(df, path, fmt)
    rows = change(df)
    w = rows.write.mode("overwrite")
    w.option("header", True).csv(path + "/rows") if fmt == "csv" else w.format(fmt).save(path + "/rows")
    return _checks(spark, path)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_changed_lost_doubled_and_swapped_rows_are_found(spark, fmt):
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5)
    same = _tampered(spark, df, lambda d: d.orderBy(F.desc("customer_id")).coalesce(1), fmt)
    assert same.pop("spend_not_null") is False and all(same.values())
    changed = _tampered(spark, df, lambda d: d.withColumn("total_spent", F.when(
        F.col("customer_id") == "c7", F.col("total_spent") + 1e-9).otherwise(F.col("total_spent"))), fmt)
    assert changed["row_count"] and not changed["same_rows"]
    lost = _tampered(spark, df, lambda d: d.where("customer_id != 'c9'"), fmt)
    assert not lost["row_count"] and not lost["same_rows"]
    doubled = _tampered(spark, df, lambda d: d.where("customer_id != 'c9'").unionByName(d.where("customer_id = 'c8'")), fmt)
    assert doubled["row_count"] and not doubled["same_rows"] and not doubled["unique_key"]
    nulled = _tampered(spark, df, lambda d: d.withColumn("a.b", F.lit(None).cast("string")), fmt)
    assert nulled["row_count"] and not nulled["same_rows"]


def test_a_value_cannot_move_to_a_null_neighbour(spark):
    a = spark.createDataFrame([("x", None), (None, "y")], "p string, q string")
    b = spark.createDataFrame([(None, "x"), ("y", None)], "p string, q string")
    assert EX.fingerprint(a) != EX.fingerprint(b)
    assert EX.fingerprint(a) == EX.fingerprint(a.orderBy("q"))
    assert EX.fingerprint(a.unionByName(a)) != EX.fingerprint(a)


def test_empty_export(spark):
    path = scratch_path(spark, "export-empty")
    assert EX.export(spark.createDataFrame([], SCHEMA), path)["rows"] == 0
    assert _checks(spark, path)["same_rows"] and EX.read_export(spark, path).count() == 0
