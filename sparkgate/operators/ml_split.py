"""Leakage-safe splits: M9 (stratified holdout), M10 (stratified k-fold),
M11 (stratified group k-fold), Q7 (disjointness).

Membership is decided by the rank of ``md5(seed || id)`` inside each class,
computed with ``rows_before`` (bucketed by sketch cut points), so a class holding a large
share of the rows is never sorted in a single task. Rows without a label are kept: they are
a class of their own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import hex_order_proxy, join_by_keys, rows_before

SEED = "42"


def _hash(id_col: str, seed: str = SEED):
    return F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string")))


def holdout_sizes(df: DataFrame, label: str, test_frac: float = 0.2) -> DataFrame:
    """Per-class test size by largest remainder.

    n_test = ceil(test_frac * n); quota_c = n_test * n_c / n; floors first, the
    remaining seats to the largest remainders (ties -> class name). Integer
    arithmetic, one row per class (bounded)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    allw = Window.partitionBy()
    c = (c.withColumn("_n", F.sum("n_class").over(allw))
          .withColumn("_n_test", F.ceil(F.lit(float(test_frac)) * F.col("_n")).cast("bigint"))
          .withColumn("_floor", F.floor(F.col("_n_test") * F.col("n_class") / F.col("_n"))
                      .cast("bigint"))
          .withColumn("_rem", (F.col("_n_test") * F.col("n_class")) % F.col("_n")))
    c = c.withColumn("_seats", F.col("_n_test") - F.sum("_floor").over(allw))
    r = Window.orderBy(F.desc("_rem"), F.asc(label))
    c = c.withColumn("_order", F.row_number().over(r))
    return c.select(label, "n_class", (F.col("_floor") + F.when(
        F.col("_order") <= F.col("_seats"), 1).otherwise(0)).cast("bigint").alias("n_test"))


def class_rank(df: DataFrame, label: str, id_col: str, seed: str = SEED) -> DataFrame:
    """0-based rank of md5(seed || id) within the class (ties broken by id)."""
    h = df.withColumn("_h", _hash(id_col, seed)).withColumn("_tie", F.col(id_col).cast("string"))
    r = rows_before(h, [label], ["_h", "_tie"], order_proxy=hex_order_proxy("_h"))
    return r.withColumnRenamed("_before", "_rank").drop("_h", "_tie", "_group_total")


def stratified_holdout(df: DataFrame, label: str, id_col: str, test_frac: float = 0.2,
                       seed: str = SEED) -> DataFrame:
    """M9: adds ``split`` in {train, test}."""
    sizes = holdout_sizes(df, label, test_frac).select(label, "n_test")
    r = join_by_keys(class_rank(df, label, id_col, seed), sizes, [label])
    return r.withColumn("split", F.when(F.col("_rank") < F.col("n_test"), "test")
                        .otherwise("train")).drop("_rank", "n_test")


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 2,
                     seed: str = SEED) -> DataFrame:
    """fold = rank within class mod k."""
    r = class_rank(df, label, id_col, seed)
    return r.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank")


#: Distinct label-count vectors of mixed groups up to which their odd groups are dealt one by
#: one on the driver (a few hundred bytes each, counted before they are collected).
MAX_VECTORS = 20_000
#: Rounds in which dealt groups may move to a better fold.
PASSES = 4


def _label_counts(df: DataFrame, label: str, group: str) -> DataFrame:
    """``group, _labels``: the label-count vector of each group, as (label, n) by label."""
    per = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "n"))).alias("_labels"))


def _dealt_one_by_one(vectors: list, totals: dict, k: int) -> list[tuple[str, int, int]]:
    """``(vector, place, fold)`` of odd groups: the most uneven vectors first, each to the fold
    in which the classes' shares of the folds then differ least (ties: the smaller fold)."""
    names = sorted({c for v in vectors for c, _ in v[1]} | {c for c, _ in totals}, key=str)
    at = {c: i for i, c in enumerate(names)}
    of = np.zeros((k, len(names)))
    for (c, fold), n in totals.items():
        of[fold, at[c]] += n
    whole = of.sum(axis=0)
    rows = []
    for key, labels, odd in vectors:
        v = np.zeros(len(names))
        for c, n in labels:
            v[at[c]] += n
        whole += odd * v
        rows.append((-v.std(), key, v, odd))
    whole = np.maximum(whole, 1)
    def spreads() -> np.ndarray:
        """How far the classes' shares differ with one more ``v`` in each of the folds."""
        more = of[None] + v[None, None, :] * np.eye(k)[:, :, None]
        return np.round((more / whole).std(axis=1).mean(axis=1), 12)
    dealt = []
    for _, key, v, odd in sorted(rows, key=lambda r: r[:2]):
        for place in range(odd):
            fold = int(spreads().argmin())
            of[fold] += v
            dealt.append([key, place, fold, v])
    for _ in range(PASSES):      # then each group may move to where it fits better now
        moved = False
        for d in dealt:
            v = d[3]
            of[d[2]] -= v
            s = spreads()
            fold = int(s.argmin()) if s.min() < s[d[2]] else d[2]
            of[fold] += v
            moved, d[2] = moved or fold != d[2], fold
        if not moved:
            break
    return [(key, place, fold) for key, place, fold, _ in dealt]


def _mixed_folds(mixed: DataFrame, singles: DataFrame, group: str, k: int, seed: str) -> DataFrame:
    """Folds of groups with several labels. Groups of equal label-count vectors are alike:
    of every k, each fold gets one; the fewer than k left over of each vector are dealt one by
    one, given what the folds already hold."""
    key = mixed.withColumn("_vector", F.to_json("_labels"))
    ranked = materialize(class_rank(key, "_vector", group, seed), "fold-vectors")
    sizes = ranked.groupBy("_vector").agg(F.count("*").alias("_m"), F.first("_labels").alias("_labels")).withColumn(
        "_odd", (F.col("_m") % k).cast("int"))
    ranked = join_by_keys(ranked, sizes.select("_vector", "_m"), ["_vector"])
    place = F.col("_rank") - F.expr(f"(_m div {k}) * {k}")
    n = sizes.where("_odd > 0").count()
    if n > MAX_VECTORS:
        # so many different vectors balance by number: each starts at a fold of its own
        fold = F.pmod(F.xxhash64("_vector") + F.col("_rank"), F.lit(k))
        return ranked.select(group, F.when(place < 0, F.col("_rank") % k).otherwise(fold).cast("int").alias("fold"))
    held = singles.select("fold", F.inline("_labels")).groupBy("label", "fold").agg(F.sum("n").alias("n"))
    totals = {(r["label"], r["fold"]): r["n"] for r in held.collect()}       # classes x folds
    vectors = [(r["_vector"], [(c["label"], c["n"]) for c in r["_labels"]], r["_odd"])
               for r in sizes.where("_odd > 0").collect()]
    spark = mixed.sparkSession
    dealt = spark.createDataFrame(_dealt_one_by_one(vectors, totals, k), "_vector string, _place long, _fold int")
    out = ranked.withColumn("_place", F.when(place >= 0, place)).join(F.broadcast(dealt), ["_vector", "_place"], "left")
    return out.select(group, F.coalesce("_fold", (F.col("_rank") % k).cast("int")).alias("fold"))


def group_folds(df: DataFrame, label: str, group: str, k: int, seed: str = SEED) -> DataFrame:
    """Every row of a group in one fold. Groups of one label are dealt round-robin per
    label in md5 order; groups of several labels so that the classes' shares of the folds stay
    closest (``_mixed_folds``). Rows without a group have no fold."""
    g = materialize(_label_counts(df.where(F.col(group).isNotNull()), label, group), "fold-groups")
    single = g.where(F.size("_labels") == 1).withColumn(label, F.col("_labels")[0]["label"])
    folds = class_rank(single, label, group, seed).withColumn("fold", (F.col("_rank") % k).cast("int"))
    r = folds.select(group, "fold")
    mixed = g.where(F.size("_labels") > 1)
    if mixed.take(1):
        r = r.unionByName(_mixed_folds(mixed, folds.select("fold", "_labels"), group, k, seed))
    return df.join(r, group, "left")


def leaked_groups(df: DataFrame, group: str, fold_col: str = "fold") -> DataFrame:
    """Q7 per fold: groups of the held-out fold that also occur in the training folds."""
    per = df.groupBy(group).agg(F.collect_set(fold_col).alias("_folds"))
    e = per.select(group, F.size("_folds").alias("_nf"), F.explode("_folds").alias(fold_col))
    return e.groupBy(fold_col).agg(F.count_if(F.col("_nf") > 1).alias("n_leaked"))
