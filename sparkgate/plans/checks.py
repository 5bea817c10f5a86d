"""Queries over sources and fitted models whose answers SQL can state: file round trips, saved
models, and what holds for any correct fit (sums, maxima, a vanishing gradient)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bool_text, to_double
from ..operators import clean as C
from ..operators import decide as D
from ..operators import metrics as M
from ..operators import ml_split as SP
from ..operators import ml_train as MT
from ..operators import verify as V
from ..session import checkpoint_dir, register_cleanup, scratch_path
from ..sources import tables as S
from . import catalog as Q
from . import roles as R
from .catalog import query, round_doubles


@query
def csv_sources(spark, sf):
    """Orders written as CSV text with bad amounts, odd booleans
    and blanks, read back through the fallback source, typed, filled and previewed."""
    k = F.col("o_orderkey")
    raw = S.read_table(spark, sf, "orders").select(
        k.alias("transaction_id"), F.concat(F.lit("a"), F.col("o_custkey")).alias("customer_id_legacy"),
        F.when(k % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(k % 4 == 0, "TRUE").when(k % 4 == 1, "0").when(k % 4 == 2, "1").otherwise("maybe").alias("is_fraud"),
        F.when(k % 7 != 0, F.col("o_orderpriority")).alias("category"),
        (k % 5).alias("f_a"), F.when(k % 13 != 0, k % 3).alias("f_b"))
    path = scratch_path(spark, "orders-csv")
    S.write_table(raw, path, fmt="csv")
    register_cleanup(spark, path)
    S.check_sources(spark, {"orders": path})
    text = S.first_available(
        spark, path + "-primary", path,
        lambda p: S.load_csv(spark, p, required=raw.columns, name="orders"), C.distinct_keep_first)
    named = C.rename_if_present(text, {"customer_id_legacy": "customer_id", "absent": "x"})
    features = S.assemble_features(named, S.feature_columns(named, prefix="f_"), "f")
    typed = features.withColumns({
        "transaction_id": F.col("transaction_id").cast("bigint"), "amount": to_double("amount"),
        "is_fraud": bool_text("is_fraud"), "f_a": F.col("f_a").cast("bigint"),
        "f_sum": F.aggregate("f", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))})
    filled = C.fill_typed_defaults(typed)
    texts, numbers = C.split_by_type(filled.select("customer_id", "category", "amount", "f_sum"))
    out = filled.withColumns({"n_text": F.lit(len(texts)), "n_numeric": F.lit(len(numbers))})
    return round_doubles(S.preview(
        out, ["transaction_id", "customer_id", "amount", "is_fraud", "category", "f_sum", "f_has_null",
              "n_text", "n_numeric", "absent"], prefix="f_a", first_n=1))


def _rows(spark, rows) -> DataFrame:
    return spark.createDataFrame([(c, bool(ok), int(n)) for c, ok, n in rows],
                                 "check string, passed boolean, observed long")


def _fitted_identity(spark, sf, modality: str):
    checkpoint_dir(spark)
    df = R.samples(spark, sf).checkpoint(eager=True)
    lm = MT.label_indexer(df, "person")
    return df, lm, MT.fit_scaled_identity(df, modality, "person", lm)


@query
def saved_model_scores(spark, sf):
    """S7 + S10 + S11: a fitted identity model and its verification settings are saved, loaded
    and used; loaded and fitted model predict the same."""
    df, lm, fitted = _fitted_identity(spark, sf, "face")
    path = scratch_path(spark, "identity-model")
    register_cleanup(spark, path)
    S.save_model(fitted.model, path + "/model")
    profile = V.class_profile(fitted.scaled(df, "face"), "person", "x")
    S.write_verification_config(spark, profile, path + "/config", V.UNKNOWN_THRESHOLD, V.DISTANCE_MARGIN, ["face"])
    loaded = MT.ScaledIdentityModel(fitted.mean, fitted.std, S.load_model(spark, path + "/model"))
    stored, settings = S.read_verification_config(spark, path + "/config")
    mine, theirs = (m.predict(df, "face", lm.labels).select("vec_id", F.col("predicted").alias(n))
                    for m, n in ((fitted, "a"), (loaded, "b")))
    same = mine.join(theirs, "vec_id").agg(F.count_if(F.col("a") != F.col("b")).alias("n"),
                                           F.count("*").alias("rows")).first()
    metrics = S.metrics_table(spark, "identity", "all", {"rows": same.rows, "changed": same.n})
    kept = metrics.where("metric = 'rows'").first().value
    try:
        S.load_model(spark, path + "/absent")
        missing = 0
    except S.ModelNotAvailableError:
        missing = 1
    return _rows(spark, [
        ("scored_rows", kept == same.rows, same.rows), ("changed_predictions", same.n == 0, same.n),
        ("stored_classes", True, stored.count()), ("missing_model_reported", missing == 1, missing),
        ("threshold_percent", True, round(100 * settings["unknown_threshold"]))])


def _gradient(scored: DataFrame, lm, model, modality: str) -> float:
    """Largest entry of the penalised gradient of the fitted logistic regression: zero at the
    solution, whatever the optimiser."""
    lr = model.model.stages[-1]
    k = len(lm.labels)
    w = scored.withColumn("y", F.array_position(F.array(*[F.lit(x) for x in lm.labels]), F.col("person")) - 1)
    rows = w.select("weight", "y", "proba", F.posexplode("x").alias("pos", "x")).groupBy("pos").agg(*[
        F.sum(F.col("weight") * F.col("x") * (F.col("proba")[c] - (F.col("y") == c).cast("double"))).alias(f"g{c}")
        for c in range(k)], F.sum("weight").alias("w")).collect()
    beta = lr.coefficientMatrix.toArray()
    two = k == 2   # one vector of coefficients, of the second class
    out = 0.0
    for r in rows:
        for c in ([1] if two else range(k)):
            penalty = lr.getRegParam() * beta[0 if two else c][r.pos]
            out = max(out, abs(r[f"g{c}"] / r.w + penalty))
    return out


@query
def lr_optimality(spark, sf):
    """M6 + M8 + M14: refitted identity models of both modalities: every row is scored, the
    probabilities sum to one, the confidence is their maximum, the gradient vanishes."""
    out = []
    for modality in ("face", "voice"):
        df, lm, model = _fitted_identity(spark, sf, modality)
        scored = MT.with_class_weights(model.predict(df, modality, lm.labels), "person").checkpoint(eager=True)
        total = F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)
        a = scored.agg(F.count("*").alias("n"), F.count_if(F.abs(total - 1) > 1e-9).alias("sums"),
                       F.count_if(F.col("confidence") != F.array_max("proba")).alias("top"),
                       F.countDistinct("person").alias("k")).first()
        out += [(f"{modality}_rows", True, a.n), (f"{modality}_classes", a.k == len(lm.labels), a.k),
                (f"{modality}_sums", a.sums == 0, a.sums), (f"{modality}_confidence", a.top == 0, a.top),
                (f"{modality}_gradient", _gradient(scored, lm, model, modality) < 1e-3, 0)]
    return _rows(spark, out)


@query
def rf_invariants(spark, sf):
    """The forest scores exactly the test part; probabilities sum to one;
    importances are named, sorted and sum to one; no leaky column is a feature."""
    model, lm, _, test = Q.product_model(spark, sf)
    scored = MT.predict_labels(model, test, lm.labels)
    total = F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)
    a = scored.agg(F.count("*").alias("n"), F.count_if(F.abs(total - 1) > 1e-9).alias("sums"),
                   F.count_if(F.col("confidence") != F.array_max("proba")).alias("top"),
                   F.count_if(~F.col("predicted").isin(list(lm.labels))).alias("strange")).first()
    imp = [(r.feature, r.importance) for r in MT.feature_importances(model, spark).collect()]
    values = [v for _, v in imp]
    leaky = [n for n, _ in imp if any(c in n for c in Q.ML.TRANSACTION_LEAK_COLS)]
    return _rows(spark, [
        ("test_rows", True, a.n), ("sums", a.sums == 0, a.sums), ("confidence", a.top == 0, a.top),
        ("known_labels", a.strange == 0, a.strange),
        ("importances", abs(sum(values) - 1) < 1e-9 and values == sorted(values, reverse=True), 0),
        ("leaky_features", not leaky, len(leaky))])


def model_gate(spark, sf, modality: str) -> DataFrame:
    """V4 with the trained classifier's probabilities and the distance rule."""
    df, lm, fitted = _fitted_identity(spark, sf, modality)
    profile = Q.fitted_profile(fitted.scaled(df, modality))
    scored = fitted.predict(df, modality, lm.labels).drop("person")
    return V.gate_predictions(scored, "x", profile).select("vec_id", "person", "confidence")


def model_decisions(spark, sf) -> DataFrame:
    """V5 with trained face and voice models: every attempt gets a decision."""
    att = R.attempts(spark, sf)
    face, voice = (model_gate(spark, sf, m) for m in ("face", "voice"))
    keys = R.profiles_raw(spark, sf).select(Q.normalize_key("customer_id").alias("customer_id")).distinct()
    return D.decide(D.scored_attempts(att, face, voice), R.identity_map(spark, sf, keys))


@query
def model_decision_checks(spark, sf):
    """V5 + M14: outcomes of the trained models' decisions add up to the attempts, and only
    granted attempts have a customer and two equal people."""
    d = model_decisions(spark, sf).checkpoint(eager=True)
    a = d.agg(
        F.count("*").alias("n"), F.countDistinct("attempt_id").alias("k"),
        F.count_if(F.col("outcome").isNull()).alias("undecided"),
        F.count_if(F.col("granted") & (F.col("customer_id").isNull() | (F.col("face_person") != F.col("voice_person"))))
        .alias("wrong"),
        F.count_if((F.col("outcome") == D.DENIED_FACE) & F.col("voice_person").isNotNull()).alias("after")).first()
    return _rows(spark, [
        ("attempts", a.n == a.k, a.n), ("undecided", a.undecided == 0, a.undecided),
        ("granted_without_agreement", a.wrong == 0, a.wrong), ("voice_after_face_denial", a.after == 0, a.after)])


@query
def identity_holdout(spark, sf):
    """M8 + E1-E9 on fold 0 of the grouped face folds: fitted on the other folds. One tidy table
    (metric, value), and the rows that the confidence rule rejects."""
    checkpoint_dir(spark)
    df = SP.group_folds(R.samples(spark, sf), "person", "group_id", k=3).checkpoint(eager=True)
    lm = MT.label_indexer(df, "person")
    model = MT.fit_scaled_identity(df.where("fold != 0"), "face", "person", lm)
    p = model.predict(df.where("fold = 0"), "face", lm.labels).select(
        F.col("person").alias("y_true"), F.col("predicted").alias("y_pred"), "predicted", "confidence", "proba"
    ).checkpoint(eager=True)
    labels = M.label_table(spark, list(lm.labels))
    gated = V.confidence_label(p).agg(
        F.count_if(F.col("gated_label") == V.UNKNOWN_LABEL).cast("double").alias("n_rejected"),
        F.count("*").cast("double").alias("n_rows"))
    tidy = None
    for part in (M.macro_metrics(p, labels).drop("n_rows"), M.weighted_metrics(p, labels),
                 M.log_loss(p, list(lm.labels)).select("log_loss"), gated):
        rows = part.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in part.columns])))
        tidy = rows if tidy is None else tidy.unionByName(rows)
    return round_doubles(tidy)
