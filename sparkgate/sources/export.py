"""Exports that prove themselves when read back (S8, S9): a fingerprint of a multiset of rows.

The fingerprint is the number of rows and two sums of independent 64-bit hashes of each row. Sums
do not depend on order, files or tasks, and a row that changes, is lost or comes twice changes
them (each sum alone stays equal by chance once in 2**64). The rows are computed once, into a
scratch table from which both the fingerprint and the export are made; the fingerprint is stored
beside the export, and the check reads the export once. NULLs are hashed as themselves, so a value can't move to a neighbouring NULL column.
Every column counts, by position; the export is read with the schema it was written from, and
what a format can't hold exactly (a CSV timestamp's last digits) counts as a change.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .tables import write_table

SIDECAR = "_fingerprint"


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row."""
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit("a"), *cells), F.xxhash64(F.lit("b"), *reversed(cells))


def _metrics(df: DataFrame) -> list[Column]:
    wide = "decimal(20,0)"      # a sum of longs may pass a long
    a, b = row_hashes(df)
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(a.cast(wide)), F.lit(0)).cast("string").alias("a"),
            F.coalesce(F.sum(b.cast(wide)), F.lit(0)).cast("string").alias("b")]


def fingerprint(df: DataFrame) -> dict:
    return df.agg(*_metrics(df)).first().asDict()


def export(df: DataFrame, path: str, fmt: str = "parquet") -> dict:
    """Write ``df`` to ``path`` and its schema and fingerprint beside it; the fingerprint."""
    rows = materialize(df, "export-rows")
    print_of = fingerprint(rows)
    write_table(rows, os.path.join(path, "rows"), fmt=fmt)
    told = {**print_of, "schema": json.loads(df.schema.json()), "format": fmt}
    df.sparkSession.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, SIDECAR))
    return print_of


def _told(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(os.path.join(path, SIDECAR)).first()["value"])


def read_export(spark: SparkSession, path: str) -> DataFrame:
    told = _told(spark, path)
    reader = spark.read.schema(StructType.fromJson(told["schema"]))
    return reader.option("header", True).format(told["format"]).load(os.path.join(path, "rows"))


def check_export(spark: SparkSession, path: str, key: str | None = None, spend_col: str | None = None) -> DataFrame:
    """S9 rows (check, passed, observed) of one pass over the export: its rows are those that
    were written; the key is unique; the spend is there and not negative."""
    told, df = _told(spark, path), read_export(spark, path)
    aggs = _metrics(df)
    if key:
        aggs.append(F.countDistinct(key).alias("keys"))
    if spend_col:
        aggs += [F.count_if(F.col(spend_col).isNull()).alias("null"), F.count_if(F.col(spend_col) < 0).alias("negative")]
    got = df.agg(*aggs).first()
    rows = [("row_count", got["rows"] == told["rows"], got["rows"]),
            ("same_rows", (got["rows"], got["a"], got["b"]) == (told["rows"], told["a"], told["b"]), got["rows"])]
    if key:
        rows.append(("unique_key", got["rows"] == got["keys"], got["rows"] - got["keys"]))
    if spend_col:
        rows += [("spend_not_null", got["null"] == 0, got["null"]), ("spend_non_negative", got["negative"] == 0, got["negative"])]
    header = _header(spark, path, told)
    rows.append(("same_columns", header == df.columns, len(header)))
    return spark.createDataFrame(rows, "check string, passed boolean, observed long")


def _header(spark: SparkSession, path: str, told: dict) -> list[str]:
    """The columns that the files themselves name."""
    return spark.read.format(told["format"]).option("header", True).load(os.path.join(path, "rows")).columns
