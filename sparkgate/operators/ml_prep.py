"""Model preparation: M1-M6, A8, A9, P16-P18."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import standardize
from .features import mode_smallest
from .selection import grouped_exact_quantiles

# The columns a recommendation model must never see (same-source leaks).
TRANSACTION_LEAK_COLS = ["total_spent", "average_spent", "purchase_count",
                         "days_since_last_purchase", "fraud_rate", "last_purchase"]
PRODUCT_FEATURES = ["engagement_score", "purchase_interest_score", "review_sentiment",
                    "average_engagement", "platform_count", "main_platform"]


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) from the training part only.

    The class table has one row per class (bounded); its window runs in one task."""
    c = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    all_ = Window.partitionBy()
    return c.select(label, "n_class", (F.sum("n_class").over(all_) / (
        F.count(F.lit(1)).over(all_) * F.col("n_class"))).alias("weight"))


def with_class_weights(train: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(train, label).select(label, F.col("weight").alias(out))
    return train.join(F.broadcast(w), label, "left")


def scaler_stats(df: DataFrame, vec_col: str) -> DataFrame:
    """Per-dimension mean and population std (0 -> 1), one row per position.

    ``posexplode`` is a map-side generator; the grouped average is partially
    aggregated, so only (partition x dims) rows are shuffled."""
    e = df.select(F.posexplode(vec_col).alias("pos", "x"))
    return e.groupBy("pos").agg(
        F.avg("x").alias("mean"),
        F.when(F.stddev_pop("x") == 0, F.lit(1.0)).otherwise(F.stddev_pop("x")).alias("std"))


def scaler_arrays(stats: DataFrame) -> tuple[list[float], list[float]]:
    """The fitted scaler as two bounded arrays (one value per dimension)."""
    rows = sorted(stats.collect(), key=lambda r: r["pos"])
    return [r["mean"] for r in rows], [r["std"] for r in rows]


def apply_scaler(df: DataFrame, vec_col: str, mean: list[float], std: list[float],
                 out: str = "scaled") -> DataFrame:
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in std])
    return df.withColumn(out, standardize(F.col(vec_col), m, s))


def index_labels(df: DataFrame, col: str, out: str, keep_unknown: bool = True):
    """M1: alphabetical label codes (``IndexToString`` inverts)."""
    si = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                       handleInvalid="keep" if keep_unknown else "error")
    model = si.fit(df)
    return model, model.transform(df)


def one_hot(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """M1 + M4: alphabetical index and one-hot. The indexer keeps an extra "unknown"
    index after the known values, and ``dropLast`` drops exactly that slot, so every
    known value has a live slot and an unseen value encodes to all zeros."""
    _, idx = index_labels(df, col, f"{prefix}_index")
    enc = OneHotEncoder(inputCols=[f"{prefix}_index"], outputCols=[f"{prefix}_vec"],
                        dropLast=True, handleInvalid="error").fit(idx)
    out = enc.transform(idx)
    arr = vector_to_array(f"{prefix}_vec")
    return out.withColumn(f"{prefix}_active", F.when(
        F.array_max(arr) > 0, F.array_position(arr, F.lit(1.0)) - 1).cast("int"))


def impute_stats(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """M2 + M3: medians (exact, interpolated) and most-frequent values (ties -> smallest)
    as rows ``(feature, statistic, value_num, value_str)``."""
    num = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
        for c in numeric])).alias("kv")).select("kv.*")
    med = grouped_exact_quantiles(num, ["feature"], "v", [0.5]).select(
        "feature", F.lit("median").alias("statistic"), F.col("q0").alias("value_num"),
        F.lit(None).cast("string").alias("value_str"))
    cat = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v"))
        for c in categorical])).alias("kv")).select("kv.*")
    mode = mode_smallest(cat, "feature", "v", out="value_str").select(
        "feature", F.lit("most_frequent").alias("statistic"),
        F.lit(None).cast("double").alias("value_num"), "value_str")
    return med.unionByName(mode)
