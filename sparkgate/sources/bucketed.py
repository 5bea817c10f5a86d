"""Bucketed feature tables (S8, J1, J2): tables that share their buckets join without an exchange.

Tables of one key are written together, hashed into the same number of buckets and sorted by the
key inside each. Read back through their metadata, every per-key aggregate of them and every
join between them runs inside the buckets: the shuffle is paid once, at the write, for all jobs
that read them.

A bucket can't be split, so keys of many rows don't go into one: rows of a key that has more
than ``HOT_ROWS`` in any of the tables are stored apart, unbucketed, for all of them. The two
halves hold different keys, so whatever works key by key runs on each half and the results add
up (``per_key``); on the hot half Spark shuffles, combines and splits as usual. There are at
most rows / ``HOT_ROWS`` such keys; they are counted at the write and broadcast while few.

The metadata (key, buckets, columns) is a small JSON beside the data, because a session's
catalog ends with it: ``open_together`` registers the tables again wherever they are read. NULL
keys are rows like others; many of them are a hot key. An empty table has no files and reads
as empty.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import join_by_keys
from ..session import materialize

#: Rows of a key in one table from which its rows are stored apart.
HOT_ROWS = 1_000_000
#: Hot keys up to which their list is broadcast (counted).
MAX_HOT_KEYS = 100_000
BUCKETS = 64


def _hot_keys(tables: dict[str, DataFrame], key: str, hot_rows: int) -> DataFrame:
    """The keys that have more than ``hot_rows`` rows in one of the tables, each once."""
    counts = [df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select(key)
              for df in tables.values()]
    return materialize(reduce(DataFrame.unionByName, counts).distinct().withColumn("_hot", F.lit(True)), "hot-keys")


def write_together(tables: dict[str, DataFrame], key: str, path: str, buckets: int = BUCKETS,
                   hot_rows: int | None = None) -> None:
    """Write the tables into buckets of ``key`` under ``path``, overwriting what is there."""
    spark = next(iter(tables.values())).sparkSession
    hot = _hot_keys(tables, key, HOT_ROWS if hot_rows is None else hot_rows)
    n_hot = hot.count()
    spec = {"key": key, "buckets": buckets, "hot_keys": n_hot, "tables": {}}
    for name, df in tables.items():
        told = join_by_keys(df, hot, [key], "left", small=n_hot <= MAX_HOT_KEYS) if n_hot else df.withColumn(
            "_hot", F.lit(None).cast("boolean"))
        # hashed as the buckets are, so each bucket is one file
        cold = told.where("_hot IS NULL").drop("_hot").repartition(buckets, key)
        catalog_name = f"bucketed_{uuid.uuid4().hex}"
        cold.write.bucketBy(buckets, key).sortBy(key).option("path", os.path.join(path, name, "cold")).mode(
            "overwrite").format("parquet").saveAsTable(catalog_name)
        spark.sql(f"DROP TABLE {catalog_name}")     # its files stay: the table is external
        told.where("_hot").drop("_hot").write.mode("overwrite").parquet(os.path.join(path, name, "hot"))
        spec["tables"][name] = df._jdf.schema().toDDL()
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "_spec"))


def open_together(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The bucketed halves and the hot halves of the tables under ``path``, by name."""
    spec = json.loads(spark.read.text(os.path.join(path, "_spec")).first()["value"])
    key, cold, hot = spec["key"], {}, {}
    for name, ddl in spec["tables"].items():
        table = f"bucketed_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {spec['buckets']} BUCKETS LOCATION '{os.path.join(path, name, 'cold')}'")
        cold[name] = spark.table(table)
        hot[name] = spark.read.schema(cold[name].schema).parquet(os.path.join(path, name, "hot"))
    return cold, hot


def per_key(spark: SparkSession, path: str, fn: Callable[..., DataFrame]) -> DataFrame:
    """``fn(**tables)``, which works key by key, over both halves of the tables under ``path``."""
    cold, hot = open_together(spark, path)
    spec = json.loads(spark.read.text(os.path.join(path, "_spec")).first()["value"])
    out = fn(**cold)
    return out.unionByName(fn(**hot)) if spec["hot_keys"] else out
