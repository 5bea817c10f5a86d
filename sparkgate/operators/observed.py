"""Q3/Q4: the metrics of a table, in one pass over what was written of it.

An expectation is an aggregate over the rows of a table. ``written`` writes a table once and
aggregates all its checks in one scan of the columns that they name; ``seen`` does so for a
table that nobody keeps. A metric is one number; unique keys need a grouped pass
(``quality.expect_unique``).

Spark's ``Observation``, which would collect them during the write, is not used: once a session
has made one, the session no longer serializes, and with it fails every fitted two-class model
in the session, whose training summary refers to it (found by the golden tests).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .quality import FINDINGS_SCHEMA


def written(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``df`` written once (``session.materialize``), with its metrics."""
    out = materialize(df, name)
    return out, seen(out, metrics)


def seen(df: DataFrame, metrics: dict[str, Column]) -> dict:
    """The metrics of ``df``, in one aggregate."""
    return df.agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict()


def rows() -> Column:
    return F.count(F.lit(1))


def null_cells(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in columns])


def findings(spark: SparkSession, bad: dict[str, int]) -> DataFrame:
    """Q3 rows (check, passed, observed) from numbers that must be 0."""
    return spark.createDataFrame([(k, v == 0, int(v)) for k, v in bad.items()], FINDINGS_SCHEMA)
