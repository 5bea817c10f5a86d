"""Exact inner-product search by distributed histogram selection.

Every query is scored against every vector. The k-th highest score of a query is found without
moving the scores: each task counts its scores of a query in the bins of the query's current
range and sends the counts of its highest bins, down to the bin where it alone has k; the
counts are summed over all tasks, the bin that holds the k-th score becomes the query's new
range, and the scores are counted again in finer bins. A query is settled when its bin is one
score wide, or when no more than ``SETTLED`` times k scores reach it. A last pass keeps the
scores that reach the settled bound, at most k a task and query, and ranks them.

Queries and vectors meet in the tiles of a grid: each row goes to the tiles of its own row or
column of the grid, and a tile holds a bounded number of bytes, so no side is broadcast and no
task holds more than one tile of each. Scores are integers, exact at any size: in double
precision while sums stay below 2**53, in longs below 2**63, in Python integers beyond.

Each component becomes floor(64 * x), held at the ends of a long; scores likewise. Vectors of
different lengths are compared as if the shorter one ended in zeros. Vectors that are null or
hold a null or non-finite component take no part; empty vectors do, with scores of 0. A row
without an id is a candidate, after all ids in ties, but never a query. A query never meets
rows of its own id. Repeated rows are candidates each; an id that is a query more than once
counts once, with its first vector in array order. Ties go to the smaller id. Fewer candidates
than k are all returned; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkgate.session import materialize

SCALE = 64
#: Bins of a histogram; a power of two, so that bins are found by shifts.
BINS = 4_096
#: A query is settled when at most this many times k scores reach its bound.
SETTLED = 4
#: Bytes of the components of a tile's vectors, and of one block of scores.
TILE_BYTES, BLOCK_SCORES = 8_000_000, 1_000_000
#: Fewest vectors worth a tile of their own.
LEAST_ROWS = 1_024
LONG = np.iinfo(np.int64)

TILES = ["q_tile", "v_tile"]
COUNTS = "query_id bigint, bin int, n bigint"
FOUND = "query_id bigint, vec_id bigint, no_id boolean, score bigint"


def quantized(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, v``: the integer vectors that take part."""
    v = F.col(f"`{vec_col}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(v.isNotNull() & ~odd).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(rows: pd.Series, d: int) -> np.ndarray:
    """Vectors as the rows of a matrix of ``d`` columns, zeros at the ends of short ones."""
    if len(rows) and all(len(v) == d for v in rows):
        return np.concatenate(rows.to_list()).astype(np.int64).reshape(len(rows), d)
    out = np.zeros((len(rows), d), np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def _blocks(queries: pd.DataFrame, vectors: pd.DataFrame, bins: int = 1) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Blocks of a tile: the queries, their exact scores, and which of them count."""
    if not len(queries) or not len(vectors):
        return
    d = int(max(queries["v"].str.len().max(), vectors["v"].str.len().max()))
    a, b = _matrix(queries["v"], d), _matrix(vectors["v"], d)
    most = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (a, b)]
    bound = most[0] * most[1] * max(1, d)
    kind = np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object
    a, b = a.astype(kind), b.astype(kind).T
    ids, named = vectors["id"].to_numpy(np.int64), ~vectors["no_id"].to_numpy(bool)
    own = queries["id"].to_numpy(np.int64)
    step = max(1, BLOCK_SCORES // max(len(vectors), bins))
    for lo in range(0, len(queries), step):
        at = slice(lo, lo + step)
        scores = a[at] @ b
        if kind is object:
            scores = np.clip(scores, int(LONG.min), int(LONG.max))
        yield at, scores.astype(np.int64), (own[at, None] != ids) | ~named


def _count(bins: int, k: int) -> Callable:
    """Counts of the highest bins of each open query in a tile."""
    def count(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "bin": [], "n": []}, dtype="int64")]
        for at, scores, counted in _blocks(queries, vectors, bins):
            part = queries.iloc[at]
            lo, shift = part["lo"].to_numpy(np.int64)[:, None], part["shift"].to_numpy(np.uint64)[:, None]
            # differences of longs fit an unsigned long
            bin_of = (scores.astype(np.uint64) - lo.astype(np.uint64)) >> shift
            keep = counted & (scores >= lo) & (bin_of < bins)
            row, col = np.nonzero(keep)
            n = np.bincount(row * bins + bin_of[row, col].astype(np.int64),
                            minlength=len(part) * bins).reshape(len(part), bins)
            higher = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n
            q, b = np.nonzero((n > 0) & (higher < k))
            out.append(pd.DataFrame({"query_id": part["id"].to_numpy()[q], "bin": b, "n": n[q, b]}))
        return pd.concat(out)
    return count


def _reach(k: int) -> Callable:
    """The scores of a tile that reach their query's bound, at most the first k of each query."""
    def reach(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        kinds = {"query_id": "int64", "vec_id": "int64", "no_id": bool, "score": "int64"}
        out = [pd.DataFrame({c: np.empty(0, kind) for c, kind in kinds.items()})]
        ids, no_id = vectors["id"].to_numpy(np.int64), vectors["no_id"].to_numpy(bool)
        for at, scores, counted in _blocks(queries, vectors):
            part = queries.iloc[at]
            row, col = np.nonzero(counted & (scores >= part["lo"].to_numpy(np.int64)[:, None]))
            found = scores[row, col]
            # ~x reverses the order of longs without leaving them
            order = np.lexsort((ids[col], no_id[col], ~found, row))
            row, col, found = row[order], col[order], found[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            ok = place < k
            out.append(pd.DataFrame({"query_id": part["id"].to_numpy()[row[ok]], "vec_id": ids[col[ok]],
                                     "no_id": no_id[col[ok]], "score": found[ok]}))
        return pd.concat(out)
    return reach


def _tile(row: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(n)).cast("int")


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


class _Grid:
    """Queries and vectors dealt into tiles of at most about ``rows`` rows a side."""

    def __init__(self, queries: DataFrame, vectors: DataFrame):
        spark = vectors.sparkSession
        size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.max(_norm("v")).alias("norm")).first()
        q_size = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
        self.most = size.norm or 0.0
        rows = max(1, TILE_BYTES // (8 * max(1, size.d or 0, q_size.d or 0)))
        self.q_tiles = max(1, -(-q_size.n // rows))
        self.v_tiles = max(1, -(-size.n // rows), min(spark.sparkContext.defaultParallelism, size.n // LEAST_ROWS))
        self.vectors = vectors.withColumns({"v_tile": _tile(F.col("row"), self.v_tiles), "q_tile": _every(self.q_tiles)})
        self.queries = queries

    def map(self, state: DataFrame, fn: Callable, schema: str) -> DataFrame:
        """``fn`` over the tiles, for the queries of ``state``."""
        asked = self.queries.join(state, "id").withColumns(
            {"q_tile": _tile(F.col("id"), self.q_tiles), "v_tile": _every(self.v_tiles)})
        return asked.groupBy(*TILES).cogroup(self.vectors.groupBy(*TILES)).applyInPandas(fn, schema)


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0), lambda a, x: a + x))


def _first_ranges(queries: DataFrame, most: float, bins: int) -> DataFrame:
    """``id, lo, shift, above, open``: all scores a query can have, by lengths."""
    # rounding of the norms is far below one part in 10**6; the ends of a long hold every score
    reach = F.least(F.ceil(_norm("v") * F.lit(most * (1 + 1e-6))) + 1.0, F.lit(2.0**63))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(reach * 2 + 1)).cast("int") - (bins.bit_length() - 1))
    lo = F.when(reach >= 2.0**62, F.lit(int(LONG.min))).otherwise(-F.least(reach, F.lit(2.0**62)).cast("bigint"))
    return queries.select("id", lo.alias("lo"), F.when(reach >= 2.0**62, 64 - (bins.bit_length() - 1)).otherwise(
        bits).alias("shift"), F.lit(0).cast("bigint").alias("above"), F.lit(True).alias("open"))


def _narrowed(state: DataFrame, counts: DataFrame, k: int, bins: int) -> DataFrame:
    """The state with each open query's range narrowed to the bin of its k-th score."""
    up = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    total = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
    # ``above`` counts the scores over the range; with fewer than k in all, no bin is chosen
    reached = total.withColumn("upto", F.sum("n").over(up)).join(
        state.select(F.col("id").alias("query_id"), "above"), "query_id").where(F.col("above") + F.col("upto") >= k)
    chosen = reached.groupBy("query_id").agg(F.max_by(F.struct("bin", "n", "upto"), "bin").alias("c"))
    s, c = F.col("shift"), F.col("c")
    wide = "decimal(20,0)"   # a bin's offset can pass a long where the range is all longs
    at = (F.col("lo").cast(wide) + c["bin"].cast(wide) * F.expr("shiftleft(1L, shift)").cast(wide)).cast("bigint")
    done = (s == 0) | (F.col("above") + c["upto"] <= SETTLED * k)
    return state.join(chosen.withColumnRenamed("query_id", "id"), "id", "left").select(
        "id", F.when(c.isNull(), F.col("lo")).otherwise(at).alias("lo"),
        F.greatest(F.lit(0), s - (bins.bit_length() - 1)).alias("shift"),
        F.when(c.isNull(), F.col("above")).otherwise(F.col("above") + c["upto"] - c["n"]).alias("above"),
        (c.isNotNull() & ~done).alias("open"))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          bins: int = BINS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of each query."""
    if k < 1 or bins < 2 or bins & (bins - 1):
        raise ValueError("k is at least 1 and bins a power of two")
    # the row number makes tiles even where ids repeat; it is written, so it stays the same
    rows = materialize(quantized(vectors, id_col, vec_col).select(
        F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("no_id"), "v",
        F.monotonically_increasing_id().alias("row")), "topk-vectors")
    asked = materialize(quantized(queries, id_col, vec_col).where("id IS NOT NULL").groupBy("id").agg(
        F.min("v").alias("v")), "topk-queries")
    grid = _Grid(asked, rows)
    state = materialize(_first_ranges(asked, grid.most, bins), "topk-state")
    while state.where("open").take(1):
        open_ = state.where("open")
        counts = grid.map(open_.select("id", "lo", "shift"), _count(bins, k), COUNTS)
        state = materialize(state.where("NOT open").unionByName(_narrowed(open_, counts, k, bins)), "topk-state")
    found = grid.map(state.select("id", "lo"), _reach(k), FOUND).withColumn(
        "vec_id", F.when(~F.col("no_id"), F.col("vec_id")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
