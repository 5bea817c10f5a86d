"""A5: global quantiles with linear interpolation, computed without a single-task merge.

``percentile(c, q)`` in Spark merges one map of every distinct value in a single
final task. Here the exact order statistics are found by band selection
(``selection``): a sketch brackets each wanted rank and only the rows of the narrow
bands between are counted by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .selection import grouped_exact_quantiles


def _stacked(df: DataFrame, cols: list[str], key: str = "k") -> DataFrame:
    parts = F.explode(F.array(*[
        F.struct(F.lit(c).alias(key), F.col(c).cast("double").alias("v")) for c in cols]))
    return df.select(parts.alias("kv")).select(f"kv.{key}", "kv.v").where(
        F.col("v").isNotNull())


def exact_quantiles(df: DataFrame, cols: list[str] | str, qs: list[float]) -> DataFrame:
    """One row per column: ``(k, q0, q1, ...)`` exact interpolated quantiles."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return grouped_exact_quantiles(_stacked(df, cols), ["k"], "v", qs)


def approx_quantiles(df: DataFrame, cols: list[str] | str, qs: list[float],
                     accuracy: int = 10000) -> DataFrame:
    """Mergeable-sketch variant (rank error <= n / accuracy); no interpolation."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    s = _stacked(df, cols).groupBy("k").agg(
        F.percentile_approx("v", [float(q) for q in qs], accuracy).alias("qs"))
    return s.select("k", *[F.col("qs")[i].alias(f"q{i}") for i in range(len(qs))])


def quantile_values(df: DataFrame, cols: list[str] | str, qs: list[float],
                    exact: bool = True) -> dict[str, list[float | None]]:
    """Bounded driver-side result: ``{column: [q0, q1, ...]}`` (one row per column)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    fn = exact_quantiles if exact else approx_quantiles
    rows = fn(df, cols, qs).collect()
    got = {r["k"]: [r[f"q{i}"] for i in range(len(qs))] for r in rows}
    return {c: got.get(c, [None] * len(qs)) for c in cols}
