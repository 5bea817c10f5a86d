"""Distributed selection: order statistics of every group without shuffling its values.

``order_statistics`` finds the values at given ranks. A mergeable sketch brackets each wanted
rank; then one scan counts what lies below the bracket and keeps, as (value, count), only what
lies inside. That scan is a single aggregate: rows below a bracket are one cell, rows above it
vanish, rows inside are cells by value, and partial sums in every task leave a few cells each.
So what moves is a sketch and a narrow band a task, whatever the number of rows.

A band that would hold more than ``BAND_ROWS`` rows is narrowed first: one more scan sketches
only the rows inside it on an even grid, until the band is small or a single value. Sketches
only choose brackets. The counts prove that a band covers its ranks; one that does not (a
sketch beyond its error) is opened wide and narrowed again, so the result is exact.

NULL values take no part; NaN is the largest value, as in Spark's order. A NULL key is a group
of its own. Ranks outside a group have no row; groups without values have none. The bands (a
row per group) are broadcast up to ``MAX_BAND_ROWS`` of them (counted) and joined by shuffle
beyond; they are written between scans, so a lost executor costs the tasks of one scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import join_by_keys

#: Rank error of a sketch is a group's rows over this (of the sketch, not of the result).
ACCURACY = 10_000
#: Rows a band may hold when its values are counted.
BAND_ROWS = 100_000
#: Groups up to which the bands are broadcast: a few hundred bytes each.
MAX_BAND_ROWS = 100_000
#: Cells of the even grid on which a wide band is narrowed.
GRID = 1_000

BAND = "struct<i: int, first: bigint, last: bigint, lo: double, hi: double, size: double>"


def _band(i: int, first: Column, last: Column, lo: Column, hi: Column, size: Column) -> Column:
    return F.struct(F.lit(i).alias("i"), first.alias("first"), last.alias("last"), lo.alias("lo"),
                    hi.alias("hi"), size.alias("size")).cast(BAND)


def quantile_ranks(q: float, n: Column) -> tuple[Column, Column]:
    """The two ranks (from 0) between which the quantile of ``n`` values is interpolated."""
    pos = F.lit(float(q)) * (n - 1)
    return F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint")


def _first_bands(base: DataFrame, keys: list[str], qs: list[float]) -> DataFrame:
    """``*keys, _n, _bands``: each quantile's ranks, bracketed by one sketch of all values."""
    off = 2 / ACCURACY
    ends = [min(1.0, max(0.0, e)) for q in qs for e in (q - off, q + off)]
    s = base.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_v", ends, ACCURACY).alias("_s"))
    none = F.lit(None).cast("double")
    bands = []
    for i, q in enumerate(qs):
        first, last = quantile_ranks(q, F.col("_n"))
        # a bracket that reaches past an end is open there
        lo = F.get("_s", F.lit(2 * i)) if q - off > 0 else none
        hi = F.get("_s", F.lit(2 * i + 1)) if q + off < 1 else none
        bands.append(_band(i, first, last, lo, hi, F.col("_n") * (2 * off)))
    return materialize(s.select(*keys, "_n", F.array(*bands).alias("_bands")), "selection-bands")


def _cells(base: DataFrame, keys: list[str], bands: DataFrame, small: bool, which=None) -> DataFrame:
    """``*keys, _i, _x``: the rows below a band (``_x`` NULL) and inside it (their value)."""
    wanted = F.col("_bands") if which is None else F.filter("_bands", lambda b: which(b))
    j = join_by_keys(base, bands.select(*keys, wanted.alias("_bands")), keys, small=small)
    v = F.col("_v")
    reach = F.filter("_bands", lambda b: b["hi"].isNull() | (v <= b["hi"]))
    inside = lambda b: b["lo"].isNull() | (v >= b["lo"])
    return j.select(*keys, F.inline(F.transform(reach, lambda b: F.struct(
        b["i"].alias("_i"), F.when(inside(b), v).alias("_x")))))


def _wide(b: Column) -> Column:
    """A band of too many rows that still holds different values."""
    return (b["size"] > BAND_ROWS) & ~F.coalesce(b["lo"] == b["hi"], F.lit(False))


def _narrowed(base: DataFrame, keys: list[str], bands: DataFrame, small: bool, slack: float) -> DataFrame:
    """The wide bands cut down to the grid cells that hold their ranks, and ``slack`` more."""
    grid = [g / GRID for g in range(GRID + 1)]
    s = _cells(base, keys, bands, small, _wide).groupBy(*keys, "_i").agg(
        F.count_if(F.col("_x").isNull()).alias("below"), F.count("_x").alias("n"),
        F.percentile_approx("_x", grid, ACCURACY).alias("grid"))
    found = s.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(
        "_i", F.struct("below", "n", "grid")))).alias("_found"))

    def cut(b: Column) -> Column:
        s = F.element_at("_found", b["i"])
        covered = (s["n"] > 0) & (b["first"] >= s["below"]) & (b["last"] < s["below"] + s["n"])
        lo = F.floor(((b["first"] - s["below"]) / s["n"] - slack) * GRID).cast("int")
        hi = F.ceil(((b["last"] + 1 - s["below"]) / s["n"] + slack) * GRID).cast("int")
        size = s["n"] * (F.least(hi, F.lit(GRID)) - F.greatest(lo, F.lit(0))) / GRID
        kept = F.struct(b["i"], b["first"], b["last"], F.when(lo <= 0, b["lo"]).otherwise(F.get(s["grid"], lo)),
                        F.when(hi >= GRID, b["hi"]).otherwise(F.get(s["grid"], hi)),
                        # a grid cell may be one value of many rows: no narrower band exists then
                        F.when(size < b["size"] / 2, size).otherwise(F.lit(0.0))).cast(BAND)
        none = F.lit(None).cast("double")
        opened = F.struct(b["i"], b["first"], b["last"], none, none, F.lit(math.inf)).cast(BAND)
        return F.when(s.isNull(), b).when(covered, kept).otherwise(opened)
    joined = join_by_keys(bands, found, keys, "left")
    cutting = F.when(F.col("_found").isNull(), F.col("_bands")).otherwise(F.transform("_bands", cut))
    return materialize(joined.select(*keys, "_n", cutting.alias("_bands")), "selection-bands")


def _found(base: DataFrame, keys: list[str], bands: DataFrame, small: bool) -> DataFrame:
    """``*keys, _n, _i, _a, _b``: the values at the ranks of every band, from its rows as
    sorted values, each with the rows up to it (at most a band's rows meet); NULL structs
    where a band does not hold its ranks."""
    cells = _cells(base, keys, bands, small).groupBy(*keys, "_i", "_x").agg(F.count("*").alias("_c"))
    up = Window.partitionBy(*keys, "_i").orderBy(F.asc_nulls_first("_x"))
    upto = cells.withColumn("_upto", F.sum("_c").over(up))
    every = bands.select(*keys, "_n", F.explode("_bands").alias("b")).select(
        *keys, "_n", F.col("b.i").alias("_i"), F.col("b.first").alias("_first"), F.col("b.last").alias("_last"))
    j = join_by_keys(every, upto, [*keys, "_i"], "left")
    at = lambda r: F.max(F.when(F.col("_x").isNotNull() & (F.col("_upto") - F.col("_c") <= r)
                                & (r < F.col("_upto")), F.struct("_x")))
    return materialize(j.groupBy(*keys, "_n", "_i").agg(
        at(F.col("_first")).alias("_a"), at(F.col("_last")).alias("_b")), "selection-found")


def _state_of(bands: DataFrame) -> tuple[bool, bool]:
    """Whether the bands are few enough to be broadcast, and whether one is wide."""
    s = bands.agg(F.count("*").alias("n"), F.max(F.exists("_bands", _wide)).alias("wide")).first()
    return s.n <= MAX_BAND_ROWS, bool(s.wide)


def order_statistics(df: DataFrame, keys: list[str], value: str, qs: list[float]) -> DataFrame:
    """``*keys, _n, _i, _a, _b``: per group and quantile, the two values it lies between."""
    base = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    bands = _first_bands(base, keys, qs)
    slack = 2 / ACCURACY
    while True:
        small, wide = _state_of(bands)
        while wide:
            bands = _narrowed(base, keys, bands, small, slack)
            wide = _state_of(bands)[1]
            slack *= 2      # a sketch that keeps missing its ranks is trusted less and less
        found = _found(base, keys, bands, small)
        if not found.where("_a IS NULL OR _b IS NULL").take(1):
            return found.select(*keys, "_n", "_i", F.col("_a._x").alias("_a"), F.col("_b._x").alias("_b"))
        bands = _opened(bands, found, keys)


def _opened(bands: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The bands with those opened on both sides that missed a rank."""
    right = found.where("_a IS NOT NULL AND _b IS NOT NULL").groupBy(*keys).agg(F.collect_set("_i").alias("_ok"))
    none = F.lit(None).cast("double")
    ok = lambda b: F.coalesce(F.array_contains("_ok", b["i"]), F.lit(False))
    return materialize(join_by_keys(bands, right, keys, "left").select(*keys, "_n", F.transform(
        "_bands", lambda b: F.when(ok(b), b).otherwise(F.struct(
            b["i"], b["first"], b["last"], none, none, F.col("_n").cast("double")).cast(BAND))).alias("_bands")),
        "selection-bands")


def grouped_exact_quantiles(df: DataFrame, keys: list[str], value: str, qs: list[float]) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per group: ``(*keys, q0, q1, ...)``.

    Equal to ``percentile`` and to SQL's ``quantile_cont``: with ``p = q * (n - 1)``,
    ``v[floor(p)] + (v[ceil(p)] - v[floor(p)]) * (p - floor(p))``.
    """
    s = order_statistics(df, keys, value, qs)
    a, b = F.col("_a"), F.col("_b")

    def at(i: int, q: float) -> Column:
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        return F.max(F.when(F.col("_i") == i, a + (b - a) * (pos - F.floor(pos)))).alias(f"q{i}")
    return s.groupBy(*keys).agg(*[at(i, q) for i, q in enumerate(qs)])
