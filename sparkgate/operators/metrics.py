"""Evaluation metrics over ``(y_true, y_pred, proba)`` tables: E1-E9, A10.

Everything is a grouped aggregate: the confusion counts (one row per observed
(true, predicted) pair) are the only thing the per-class metrics need, and the
label list is a small given table. ROC-AUC ranks scores with ``rows_before``
instead of a per-class window (each class ranks *every* row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import rows_before

# Fixed value: probability clipping of the log loss (float64 machine epsilon).
LOG_LOSS_EPS = 2.220446049250313e-16


def label_table(spark: SparkSession, labels: list[str]) -> DataFrame:
    return spark.createDataFrame([(lab,) for lab in labels], "label string")


def confusion_counts(pred: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return pred.groupBy(F.col(y).alias("y_true"), F.col(p).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class(pred: DataFrame, labels: DataFrame, y: str = "y_true",
              p: str = "y_pred") -> DataFrame:
    """E2 per label: tp, support, predicted, precision, recall, f1 (zero division -> 0)."""
    cc = confusion_counts(pred, y, p)
    parts = cc.select(F.explode(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
                 .cast("bigint").alias("tp")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")))
    ).alias("r")).select("r.*")
    agg = parts.groupBy("label").agg(F.sum("support").alias("support"),
                                     F.sum("predicted").alias("predicted"),
                                     F.sum("tp").alias("tp"))
    j = labels.join(agg, "label", "left").fillna(0, ["support", "predicted", "tp"])
    tp, sup, prd = F.col("tp"), F.col("support"), F.col("predicted")
    return j.select(
        "label", "tp", "support", "predicted",
        F.when(prd > 0, tp / prd).otherwise(0.0).alias("precision"),
        F.when(sup > 0, tp / sup).otherwise(0.0).alias("recall"),
        F.when(sup + prd > 0, 2 * tp / (sup + prd)).otherwise(0.0).alias("f1_score"))


def macro_metrics(pred: DataFrame, labels: DataFrame, y="y_true", p="y_pred") -> DataFrame:
    """E1 + E2: accuracy and macro precision / recall / F1 over the given labels."""
    pc = per_class(pred, labels, y, p)
    return pc.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1_score").alias("f1_macro"),
        F.sum("support").alias("n_rows"))


def weighted_metrics(pred: DataFrame, labels: DataFrame, y="y_true", p="y_pred") -> DataFrame:
    """Support-weighted precision / recall / F1."""
    pc = per_class(pred, labels, y, p)
    s = F.sum("support")
    return pc.agg(
        (F.sum(F.col("precision") * F.col("support")) / s).alias("precision_weighted"),
        (F.sum(F.col("recall") * F.col("support")) / s).alias("recall_weighted"),
        (F.sum(F.col("f1_score") * F.col("support")) / s).alias("f1_weighted"))


def class_report(pred: DataFrame, labels: DataFrame, y="y_true", p="y_pred") -> DataFrame:
    """Per-class rows plus ``macro avg`` and ``weighted avg`` rows."""
    pc = per_class(pred, labels, y, p).select("label", "precision", "recall", "f1_score",
                                             "support")
    s = F.sum("support")
    macro = pc.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
                   s.alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("label"),
                      (F.sum(F.col("precision") * F.col("support")) / s).alias("precision"),
                      (F.sum(F.col("recall") * F.col("support")) / s).alias("recall"),
                      (F.sum(F.col("f1_score") * F.col("support")) / s).alias("f1_score"),
                      s.alias("support"))
    return pc.unionByName(macro).unionByName(weighted)


def confusion_dense(pred: DataFrame, labels: list[str], y="y_true", p="y_pred") -> DataFrame:
    """Every (true, predicted) pair of the given labels, zero-filled. The grid is
    generated from the label list (bounded) with ``explode``, not a cross join."""
    spark = pred.sparkSession
    arr = F.array(*[F.lit(x) for x in labels])
    grid = label_table(spark, labels).select(F.col("label").alias("y_true"),
                                             F.explode(arr).alias("y_pred"))
    cc = confusion_counts(pred, y, p)
    return grid.join(cc, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def log_loss(pred: DataFrame, labels: list[str], y="y_true", proba="proba") -> DataFrame:
    """Mean of -log(clip(p[true class])); NULL with a reason when undefined."""
    idx = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(y))
    p = F.when(idx > 0, F.element_at(F.col(proba), idx.cast("int")))
    clipped = F.greatest(F.least(p, F.lit(1 - LOG_LOSS_EPS)), F.lit(LOG_LOSS_EPS))
    a = pred.agg(F.avg(-F.log(clipped)).alias("log_loss"),
                 F.count_if(idx == 0).alias("_unknown"), F.count(F.lit(1)).alias("n_rows"))
    return a.select(F.when(F.col("_unknown") == 0, F.col("log_loss")).alias("log_loss"),
                    F.when(F.col("n_rows") == 0, "empty")
                    .when(F.col("_unknown") > 0, "label outside the model classes")
                    .alias("undefined_reason"), "n_rows")


def roc_auc_ovr(pred: DataFrame, labels: list[str], y="y_true", proba="proba") -> DataFrame:
    """E5: one-vs-rest ROC-AUC per class and the macro average over the classes present
    in ``y``; probabilities are cut to those classes and renormalised.

    Mann-Whitney with mid-ranks: rank intervals of each distinct (class, score) come
    from ``rows_before`` over the pre-aggregated counts."""
    present = pred.select(F.col(y).alias("label")).distinct()
    lab = F.array(*[F.lit(x) for x in labels])
    # renormalise over present classes: per-row sum of present-class scores
    with_row = pred.select(F.col(y).alias("_y"), F.col(proba).alias("_pr"))
    pres = [r["label"] for r in present.collect()]  # bounded: the class list
    mask = F.array(*[F.lit(x in pres) for x in labels])
    tot = F.aggregate(F.zip_with(F.col("_pr"), mask, lambda v, m: F.when(m, v).otherwise(0.0)),
                      F.lit(0.0), lambda a, b: a + b)
    with_row = with_row.withColumn("_tot", F.array_repeat(tot, F.size("_pr")))
    cut = F.zip_with(F.zip_with(F.col("_pr"), mask, lambda v, m: F.when(m, v)), F.col("_tot"),
                     lambda v, t: v / t)
    rows = with_row.select("_y", F.posexplode(cut).alias("_i", "score"))
    rows = rows.where(F.col("score").isNotNull()).withColumn(
        "label", F.element_at(lab, (F.col("_i") + 1).cast("int")))
    vc = rows.groupBy("label", "score").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(F.col("_y") == F.col("label")).alias("pos"))
    r = rows_before(vc, ["label"], "score", "c")
    r = r.withColumn("midrank", F.col("_before") + (F.col("c") + 1) / 2.0)
    cls = r.groupBy("label").agg(
        F.sum(F.col("pos") * F.col("midrank")).alias("_r_pos"),
        F.sum("pos").alias("n_pos"), F.sum("c").alias("_n"))
    n_neg = F.col("_n") - F.col("n_pos")
    auc = (F.col("_r_pos") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0) / (
        F.col("n_pos") * n_neg)
    return cls.select("label", "n_pos", n_neg.alias("n_neg"),
                      F.when((F.col("n_pos") > 0) & (n_neg > 0), auc).alias("auc"))


def roc_auc_macro(per_class_auc: DataFrame) -> DataFrame:
    return per_class_auc.agg(
        F.avg("auc").alias("roc_auc_macro"), F.count("auc").alias("n_classes"),
        F.when(F.count("auc") < 2, F.lit("fewer than two classes present"))
        .alias("undefined_reason"))


def fold_metrics(pred: DataFrame, fold_col: str = "fold", y="y_true", p="y_pred") -> DataFrame:
    """E3 per fold: accuracy and macro F1 over the labels present in that fold."""
    cc = pred.groupBy(fold_col, F.col(y).alias("y_true"), F.col(p).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))
    parts = cc.select(fold_col, F.explode(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
                 .cast("bigint").alias("tp")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")))
    ).alias("r")).select(fold_col, "r.*")
    pc = parts.groupBy(fold_col, "label").agg(F.sum("support").alias("support"),
                                              F.sum("predicted").alias("predicted"),
                                              F.sum("tp").alias("tp"))
    f1 = F.when(F.col("support") + F.col("predicted") > 0,
                2 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(0.0)
    return pc.groupBy(fold_col).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg(f1).alias("f1_macro"))


def fold_summary(per_fold: DataFrame, fold_col: str = "fold",
                 metrics=("accuracy", "f1_macro")) -> DataFrame:
    """A10: per-fold values, mean and population std as rows (metric, fold, stat, value)."""
    long = per_fold.select(fold_col, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
        .alias("r")).select(F.col(fold_col).cast("int").alias("fold"), "r.metric", "r.value")
    vals = long.select("metric", "fold", F.lit("value").alias("stat"), "value")
    summ = long.groupBy("metric").agg(F.avg("value").alias("mean"),
                                      F.stddev_pop("value").alias("std"))
    stats = summ.select("metric", F.lit(None).cast("int").alias("fold"), F.explode(F.array(
        F.struct(F.lit("mean").alias("stat"), F.col("mean").alias("value")),
        F.struct(F.lit("std").alias("stat"), F.col("std").alias("value")))).alias("r")) \
        .select("metric", "fold", "r.stat", "r.value")
    return vals.unionByName(stats)
