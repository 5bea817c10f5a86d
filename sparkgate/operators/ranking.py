"""Rank of a value inside its group without sorting any group in one task.

``rows_before(df, keys, value, weight)`` adds ``_before``: the total weight of the
rows of the same group with a strictly smaller position in ``value`` order, plus
``_group_total``. It is the building block for exact quantiles, per-class
stratified sampling, round-robin fold assignment and mid-ranks.

Plan:

1. per group, one ``percentile_approx`` pass of a numeric order proxy gives a cut point for
   every bucket, so buckets are even whatever the distribution; the cut points are a small
   table (a row per group) written once;
2. every row gets a bucket from its value in two steps (the coarse segment, then the cut
   points inside it: about twice the square root of the number of buckets comparisons). It is
   a pure, monotone function of the row, so every consumer and every retried task sees the
   same layout, and a hot group is spread over all buckets;
3. per-(group, bucket) totals and their prefix sums plus a running sum inside each
   (group, bucket) give the global rank.

The two small tables are broadcast up to ``MAX_OFFSET_ROWS`` groups x buckets (the groups are
counted) and joined by shuffle beyond. A NULL key is a group of its own.
Values must be unique within a group (pre-aggregate repeated values into a weight, or add a unique tie-breaker).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MAX_BUCKETS = 8192          # buckets per group
MAX_OFFSET_ROWS = 1_000_000  # groups x buckets rows up to which the small tables are broadcast


def join_by_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                 small: bool = False) -> DataFrame:
    """Join in which NULL keys meet; the keys of ``left`` stay, those of ``right`` go."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = same if on is None else on & same
    return left.join(F.broadcast(r) if small else r, on, how).drop(*[f"_r_{k}" for k in keys])


def join_apart(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join with the unique ``key`` of a table, in one pass over ``left``: rows without a
    key match nothing and go by a hash of the row, or they would all meet in one task."""
    stand_in = F.when(F.col(key).isNull(), F.xxhash64(*left.columns)).otherwise(F.lit(0))
    # always 0, but not a literal, which the optimizer would take out of the keys
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("bigint")
    return left.withColumn("_apart", stand_in).join(right.withColumn("_apart", zero), [key, "_apart"], "left").drop(
        "_apart")


def _cut_points(base: DataFrame, keys: list[str], n: int, side: int) -> DataFrame:
    """Per group, of the cut points of ``n`` buckets: ``_coarse``, every ``side``-th, and
    ``_fine``, those between."""
    last = (n - 1) // side   # the last segment may be shorter
    cuts = base.groupBy(*keys).agg(F.percentile_approx(
        "_o", [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("_c"))
    fine = F.transform(F.sequence(F.lit(0), F.lit(last)),
                       lambda i: F.slice("_c", i * side + 1, side - 1))
    coarse = F.transform(F.slice(F.sequence(F.lit(0), F.lit(last)), 2, last + 1),
                         lambda i: F.get("_c", i * side - 1))
    return materialize(cuts.select(*keys, coarse.alias("_coarse"), fine.alias("_fine")), "rank-cuts")


def rows_before(df: DataFrame, keys: list[str], value: list[str] | str,
                weight: str | None = None, num_buckets: int | None = None,
                order_proxy: Column | None = None, keep_bucket: bool = False) -> DataFrame:
    values = [value] if isinstance(value, str) else list(value)
    b = num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = max(1, min(b, MAX_BUCKETS))
    side = math.isqrt(b - 1) + 1
    proxy = order_proxy if order_proxy is not None else F.col(values[0])
    w = F.col(weight) if weight else F.lit(1)
    base = df.withColumn("_w", w.cast("bigint")).withColumn("_o", proxy.cast("double"))
    small = True
    if b > 1:
        cuts = _cut_points(base, keys, b, side)
        small = cuts.count() * b <= MAX_OFFSET_ROWS
        base = join_by_keys(base, cuts, keys, small=small)
        below = lambda c: F.size(F.filter(c, lambda x: x < F.col("_o")))
        base = base.withColumn("_seg", F.coalesce(below(F.col("_coarse")), F.lit(0)))
        base = base.withColumn("_bucket", F.col("_seg") * side + F.coalesce(
            below(F.element_at("_fine", F.col("_seg") + 1)), F.lit(0))).drop("_seg", "_coarse", "_fine")
    else:
        base = base.withColumn("_bucket", F.lit(0))
    run = Window.partitionBy(*keys, "_bucket").orderBy(*values).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = base.withColumn("_cum", F.sum("_w").over(run))
    per = base.groupBy(*keys, "_bucket").agg(F.sum("_w").alias("_pc"))
    off = (per.withColumn("_off", F.coalesce(F.sum("_pc").over(
        Window.partitionBy(*keys).orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_group_total", F.sum("_pc").over(Window.partitionBy(*keys)))
        .select(*keys, "_bucket", "_off", "_group_total"))
    j = join_by_keys(local, off, [*keys, "_bucket"], small=small)
    out = j.withColumn("_before", F.col("_off") + F.col("_cum") - F.col("_w")).drop(
        "_cum", "_off", "_w", "_o")
    return out if keep_bucket else out.drop("_bucket")


def hex_order_proxy(col: str) -> Column:
    """Numeric proxy of a lowercase hex string's order: its first 15 digits (60 bits)."""
    return F.conv(F.substring(F.col(col), 1, 15), 16, 10).cast("bigint")
