"""Model training on DataFrames: M5, M7, M8, M12-M15, V6 (pyspark.ml pipelines).

Fits are distributed by ``pyspark.ml``; the cross-validation loop runs on the
driver over a handful of fold ids (bounded) against one fold-tagged DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (IndexToString, OneHotEncoder, SQLTransformer, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import metrics as M
from .ml_prep import apply_scaler, scaler_arrays, scaler_stats, with_class_weights
from .quantiles import quantile_values

# Fixed values of the reference models.
RF_TREES = 200
RF_SEED = 42
RF_MAX_DEPTH = 30   # no limit in the rules of the model; the deepest that Spark's trees go
# Training rows of a task: fewer are not worth one, more (with a counter and a node for each
# tree, under 2 KB a row) do not fit its memory.
MIN_TASK_ROWS, MAX_TASK_ROWS = 500, 100_000
LR_MAX_ITER = 2000
LR_TOL = 1e-9
LR_C = 1.0


def label_indexer(df: DataFrame, label: str):
    """M1: alphabetical label codes, fitted once on the full label column."""
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(df)


def fit_fill(train: DataFrame, numeric: list[str], categorical: list[str]) -> dict:
    """M2 + M3 fitted on the training part: interpolated medians of the numeric columns and
    most frequent values of the others (ties -> smallest). One value per column."""
    fill = {c: v[0] for c, v in quantile_values(train, numeric, [0.5]).items()} if numeric else {}
    if categorical:
        st = train.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v")) for c in categorical]))
            .alias("kv")).select("kv.*").where(F.col("v").isNotNull())
        c = st.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
        fill |= {r["f"]: r["v"] for r in c.groupBy("f").agg(
            F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v")).collect()}
    return fill


def apply_fill(df: DataFrame, fill: dict) -> DataFrame:
    """The fitted values in place of NULLs, in training and in scored rows alike."""
    out = {}
    for c, v in fill.items():
        if v is not None:
            out[c] = F.coalesce(F.col(c).cast("double") if isinstance(v, float) else F.col(c), F.lit(v))
    return df.withColumns(out) if out else df


def feature_stages(numeric: list[str], categorical: list[str]):
    """M4 + M5 on filled columns: keep-unknown indexers, one-hot (unknown slot dropped),
    assembler with numeric columns first."""
    stages = []
    num_out = [f"num__{c}" for c in numeric]
    if numeric:
        stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
            f"CAST(`{c}` AS DOUBLE) AS `num__{c}`" for c in numeric) + " FROM __THIS__"))
    cat_idx = [f"{c}__idx" for c in categorical]
    cat_vec = [f"cat__{c}" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=cat_idx,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=cat_idx, outputCols=cat_vec, dropLast=True,
                                    handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=num_out + cat_vec, outputCol="features",
                                  handleInvalid="keep"))
    return stages


def random_forest(weight_col: str = "weight", seed: int = RF_SEED) -> RandomForestClassifier:
    """M7: 200 trees, sqrt features, gini, balanced weights. The node that each row has reached
    in each tree is kept: a pass over the rows for a group of deep nodes walks no tree again."""
    return RandomForestClassifier(featuresCol="features", labelCol="label",
                                  weightCol=weight_col, numTrees=RF_TREES, seed=seed,
                                  featureSubsetStrategy="sqrt", impurity="gini",
                                  maxDepth=RF_MAX_DEPTH, cacheNodeIds=True)


def spread(train: DataFrame) -> DataFrame:
    """Training rows dealt over the cores. A customer table is small in bytes, so its partitions
    come out coalesced to one or few, which grow all trees alone; and each partition sends
    counts for every node of a group, so partitions beyond the cores only add to that. Up to
    MIN_TASK_ROWS rows stay as they are."""
    spark = train.sparkSession
    checkpoint_dir(spark)   # kept node ids are checkpointed too
    n = train.count()
    if n <= MIN_TASK_ROWS:
        return train
    parts = max(min(spark.sparkContext.defaultParallelism, -(-n // MIN_TASK_ROWS)), -(-n // MAX_TASK_ROWS))
    return train.repartition(parts).checkpoint(eager=True)


def fit_product_model(train: DataFrame, label: str, numeric: list[str],
                      categorical: list[str], label_model=None) -> PipelineModel:
    """M5 + M7 (+ M9 weights on the training part only)."""
    lm = label_model or label_indexer(train, label)
    w = with_class_weights(spread(train), label)
    pipe = Pipeline(stages=[lm, *feature_stages(numeric, categorical), random_forest()])
    return pipe.fit(w)


def predict_labels(model: PipelineModel, df: DataFrame, labels: list[str]) -> DataFrame:
    """M13 + M1 inverse: predicted class name, its probability, probability array."""
    out = model.transform(df)
    conv = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels)
    out = conv.transform(out)
    p = vector_to_array("probability")
    return out.withColumn("proba", p).withColumn("confidence", F.array_max(p))


def feature_importances(model: PipelineModel, spark, features_col: str = "features") -> DataFrame:
    """Named importances (names from the assembled vector metadata), descending."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    names = _vector_names(model, features_col, len(imp))
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def _vector_names(model: PipelineModel, col: str, n: int) -> list[str]:
    """``num__x`` for numeric inputs, ``cat__x_value`` per one-hot slot (the dropped
    slot is the unknown index, so every known value has a name)."""
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)]
    inputs = assembler[-1].getInputCols() if assembler else []
    labels_of = {}
    for s in model.stages:
        if type(s).__name__ == "StringIndexerModel" and s.isSet("outputCols"):
            for inc, lab in zip(s.getInputCols(), s.labelsArray):
                labels_of[f"cat__{inc}"] = lab
    names = []
    for c in inputs:
        names += [f"{c}_{v}" for v in labels_of[c]] if c in labels_of else [c]
    return names if len(names) == n else [f"f{i}" for i in range(n)]


def logistic_regression(sum_weights: float, c: float = LR_C) -> LogisticRegression:
    """M8: L2 with the regularisation of C on weighted rows: regParam = 1 / (C * sum w).
    Binomial for two classes, multinomial otherwise (a multinomial fit of two classes
    would penalise both coefficient vectors, i.e. half the intended strength)."""
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                              maxIter=LR_MAX_ITER, tol=LR_TOL, regParam=1.0 / (c * sum_weights),
                              elasticNetParam=0.0, standardization=False, family="auto")


def fit_identity_model(train: DataFrame, vec_col: str, label: str, label_model=None):
    """M6 (inputs already scaled) + M8 with balanced weights."""
    lm = label_model or label_indexer(train, label)
    w = with_class_weights(train, label).withColumn("features", array_to_vector(vec_col))
    sw = w.agg(F.sum("weight")).first()[0]
    return Pipeline(stages=[lm, logistic_regression(sw)]).fit(w)


@dataclass
class ScaledIdentityModel:
    """M6 + M8: a scaler and a classifier fitted on the same rows."""

    mean: list[float]
    std: list[float]
    model: PipelineModel

    def scaled(self, df: DataFrame, vec_col: str) -> DataFrame:
        return apply_scaler(df, vec_col, self.mean, self.std, "x")

    def predict(self, df: DataFrame, vec_col: str, labels: list[str]) -> DataFrame:
        return predict_labels(self.model, self.scaled(df, vec_col).withColumn(
            "features", array_to_vector("x")), labels)


def fit_scaled_identity(train: DataFrame, vec_col: str, label: str, label_model=None) -> ScaledIdentityModel:
    """The scaler sees the training rows only, so no test fold shapes its own scaling."""
    mean, std = scaler_arrays(scaler_stats(train, vec_col))
    scaled = apply_scaler(train, vec_col, mean, std, "x")
    return ScaledIdentityModel(mean, std, fit_identity_model(scaled, "x", label, label_model))


def cross_validate(df: DataFrame, fold_col: str, fit, predict, label: str) -> DataFrame:
    """For each fold id, fit on the others and score it; per-fold accuracy and macro
    F1 over the labels present in that fold (E3)."""
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())  # k ids
    parts = []
    for f in folds:
        model = fit(df.where(F.col(fold_col) != f))
        scored = predict(model, df.where(F.col(fold_col) == f)).select(
            F.lit(f).alias(fold_col), F.col(label).alias("y_true"),
            F.col("predicted").alias("y_pred"))
        parts.append(scored)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return M.fold_metrics(allp, fold_col)

