"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whichever store ``sf_dir`` is in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch between Spark and Python.
BATCH_ROWS = 2_000


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short: a row holds a whole text, and Spark's 10,000 rows of them are
    held several times over by each Python worker and its task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null text: empty), so that extra columns can't clash."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    ``value`` becomes a lambda variable, so the optimizer can't copy its expression into
    every place (such as an inner lambda) that reads it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(frames: Iterator[pd.DataFrame], column: str, size: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """The frames cut so that ``column`` holds at most ``size`` characters or bytes in each
    (one row may hold more), which bounds what a task makes of one at a time."""
    for frame in frames:
        at = frame[column].str.len().cumsum().to_numpy() // size if len(frame) else []
        lo = 0
        for hi in [*(i for i in range(1, len(frame)) if at[i] != at[i - 1]), len(frame)]:
            if hi > lo:
                yield frame.iloc[lo:hi]
            lo = hi


def map_rows(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInPandas`` with ids as strings on the way: pandas would turn nullable integers into
    floats, which lose the last digits of large ids."""
    short_batches(rows.sparkSession)
    ids = [c for c, kind in rows.dtypes if kind == "bigint" and c.endswith("_id")]
    for c in ids:
        schema = schema.replace(f"{c} bigint", f"{c} string")
    out = rows.withColumns({c: F.col(c).cast("string") for c in ids}).mapInPandas(fn, schema)
    return out.withColumns({c: F.col(c).cast("bigint") for c in ids if c in out.columns})
