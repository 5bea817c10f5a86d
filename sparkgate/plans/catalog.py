"""Registered queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the whole role tables (``plans/roles.py``). Doubles that come out
of sums and means are rounded to 6 decimals so cross-engine summation order does
not show up in value hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.columns import normalize_key, stable_round
from ..operators import clean as C
from ..operators import decide as D
from ..operators import features as FE
from ..operators import fsm as FSM
from ..operators import media as MD
from ..operators import metrics as M
from ..operators import ml_prep as ML
from ..operators import ml_split as SP
from ..operators import ml_train as MT
from ..operators import observed as OB
from ..operators import quality as Q
from ..operators import verify as V
from ..session import checkpoint_dir, materialize, register_cleanup, scratch_path
from ..sources import bucketed as BK
from ..sources import export as EX
from ..streaming import fsm_stream as FS
from . import roles as R

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column for cross-engine comparison: first to 9 decimals
    (absorbs last-bit differences from summation order), then half-to-even to
    ``digits`` in decimal arithmetic, so a value that is exactly halfway is a tie in
    every engine."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(stable_round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- shared stages
def in_parallel(*thunks):
    """Build independent inputs concurrently: each may run small eager jobs (medians,
    winsor bounds, fitted profiles); Spark schedules jobs from several driver threads
    side by side."""
    session = SparkSession.getActiveSession()
    wrap = inheritable_thread_target(session) if session is not None \
        else inheritable_thread_target
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        # inherit the caller's local properties and session tags (job group, scheduler
        # pool), so the jobs are cancelled and scheduled together with the calling query
        futures = [pool.submit(wrap(t)) for t in thunks]
        return [f.result() for f in futures]


def profiles_clean(spark, sf) -> DataFrame:
    return C.clean_profiles(R.profiles_raw(spark, sf))


def tx_valid(spark, sf) -> DataFrame:
    return C.valid_transactions(R.transactions_raw(spark, sf))


def tx_clean(spark, sf) -> DataFrame:
    return C.clean_transactions(R.transactions_raw(spark, sf))


def tx_features(spark, sf) -> DataFrame:
    return FE.transaction_features(tx_clean(spark, sf), R.ROLE_REFERENCE_DAY)


def platform_rows(spark, sf, keep_match_flag=False) -> DataFrame:
    prof, txf = in_parallel(lambda: profiles_clean(spark, sf), lambda: tx_features(spark, sf))
    return FE.platform_table(prof, txf, keep_match_flag)


def customers(spark, sf) -> DataFrame:
    prof, txf = in_parallel(lambda: profiles_clean(spark, sf), lambda: tx_features(spark, sf))
    return FE.customer_table(prof, txf)


# ---------------------------------------------------------------- data quality
@query
def dq_profile_events(spark, sf):
    """Q1 on the raw profile table."""
    return Q.profile_table(R.profiles_raw(spark, sf).drop("src_ord"), "customer_id")


@query
def dq_profile_transactions(spark, sf):
    """Q1 on the raw transaction table."""
    return Q.profile_table(R.transactions_raw(spark, sf).drop("src_ord"), "customer_id")


@query
def dq_distribution(spark, sf):
    """Q2: platform value counts after normalisation."""
    return Q.value_counts(C.distinct_profiles(R.profiles_raw(spark, sf)), "social_media_platform")


@query
def dq_category_distribution(spark, sf):
    """Q2: transaction category value counts after normalisation (the model target)."""
    return Q.value_counts(tx_valid(spark, sf), "category")


@query
def dq_expectations(spark, sf):
    """Q3/Q4 expectations as rows (check, passed, observed): each table is written once at
    most, and its metrics are collected on the way."""
    prof, (valid, faults) = in_parallel(lambda: profiles_clean(spark, sf),
                                        lambda: C.written_transactions(R.transactions_raw(spark, sf)))
    txf = FE.transaction_features(C.winsorized(valid), R.ROLE_REFERENCE_DAY)
    p = OB.seen(prof, {"rows": OB.rows(), "nulls": OB.null_cells(prof.columns)})
    plat = OB.seen(FE.platform_table(prof, txf), {
        "rows": OB.rows(), "upper": F.count_if(F.col("customer_id") != F.lower("customer_id"))})
    unique = Q.expect_unique(FE.customer_table(prof, txf).select("customer_id"), "customer_table_unique_key",
                             "customer_id")
    return OB.findings(spark, {**faults, "profiles_no_nulls": p["nulls"], "platform_ids_lowercase": plat["upper"],
                               "platform_rows_preserved": plat["rows"] - p["rows"]}).unionByName(unique)


@query
def dq_key_overlap(spark, sf):
    """Profile keys, transaction keys, and their intersection."""
    # keys are the same before and after duplicate rows go
    return Q.key_overlap(C.normalize_profiles(R.profiles_raw(spark, sf)), tx_valid(spark, sf), "customer_id")


@query
def dq_match_rate(spark, sf):
    """Q5: share of platform rows with a transaction match, before default fill."""
    return round_doubles(Q.match_rate(platform_rows(spark, sf, True), "_tx_matched", 0.5))


# ---------------------------------------------------------------- cleaning
@query
def clean_profiles(spark, sf):
    return round_doubles(profiles_clean(spark, sf))


@query
def clean_transactions(spark, sf):
    return round_doubles(tx_valid(spark, sf))


@query
def rejects_by_reason(spark, sf):
    return C.reject_counts(R.transactions_raw(spark, sf))


@query
def winsorized_orders(spark, sf):
    v = materialize(tx_valid(spark, sf), "transactions-valid")   # the distinct runs once
    lo, hi = C.winsor_bounds(v, "amount")
    w = C.winsorize(v.withColumn("amount_raw", F.col("amount")), "amount", lo, hi, "was_clipped")
    return round_doubles(w.select("transaction_id", "customer_id", "amount_raw", "amount",
                                  "was_clipped"))


# ---------------------------------------------------------------- features
@query
def rfm_customer(spark, sf):
    r = FE.rfm(tx_clean(spark, sf), R.ROLE_REFERENCE_DAY)
    return round_doubles(r.select("customer_id", "total_spent", "average_spent",
                                  "purchase_count", "last_purchase", "fraud_rate"))


@query
def recency_days(spark, sf):
    r = FE.rfm(tx_valid(spark, sf), R.ROLE_REFERENCE_DAY)   # clipping amounts moves no date
    return r.select("customer_id", "last_purchase", "days_since_last_purchase")


@query
def mode_category_first_seen(spark, sf):
    return FE.mode_first_seen(tx_valid(spark, sf), "customer_id", "category",
                              out="product_category")


@query
def mode_platform_alpha(spark, sf):
    return FE.mode_smallest(C.distinct_profiles(R.profiles_raw(spark, sf)), "customer_id", "social_media_platform",
                            out="primary_platform")


@query
def social_aggregates(spark, sf):
    return round_doubles(FE.social_aggregates(profiles_clean(spark, sf)))


@query
def platform_table(spark, sf):
    return round_doubles(platform_rows(spark, sf))


@query
def platform_table_bucketed(spark, sf):
    """S8 + J1/J2: the cleaned tables are written into common buckets of the customer, opened by
    their metadata and joined without an exchange; the same rows as ``platform_table``."""
    prof, tx = in_parallel(lambda: profiles_clean(spark, sf), lambda: tx_clean(spark, sf))
    path = scratch_path(spark, "customer-buckets")
    register_cleanup(spark, path)
    BK.write_together({"profiles": prof, "transactions": tx}, "customer_id", path)

    def rows(profiles, transactions):
        return FE.platform_table(profiles, FE.transaction_features(transactions, R.ROLE_REFERENCE_DAY), write=False)
    return round_doubles(BK.per_key(spark, path, rows))


@query
def customer_table(spark, sf):
    """Flagship: customer-grain feature table."""
    return round_doubles(customers(spark, sf))


@query
def legacy_row_join(spark, sf):
    """J4 re-aimed: the grain of the legacy many-to-many join per customer (pairs are
    counted, never emitted)."""
    return FE.legacy_join_grain(C.distinct_profiles(R.profiles_raw(spark, sf)), tx_valid(spark, sf))


@query
def legacy_customer_features(spark, sf):
    return round_doubles(FE.legacy_customer_features(profiles_clean(spark, sf),
                                                     tx_valid(spark, sf)))


@query
def dedupe_best_platform(spark, sf):
    return round_doubles(FE.best_platform_row(profiles_clean(spark, sf)))


@query
def first_row_per_customer(spark, sf):
    return round_doubles(FE.first_row(profiles_clean(spark, sf)))


@query
def topk_customers(spark, sf):
    c = customers(spark, sf).select("customer_id", "total_spent", "purchase_count")
    return round_doubles(FE.top_k(c, [F.desc("total_spent"), F.asc("customer_id")], 20))


@query
def distinct_customers(spark, sf):
    return R.profiles_raw(spark, sf).select(normalize_key("customer_id").alias("customer_id")).distinct()


# ---------------------------------------------------------------- risk
@query
def risk_score(spark, sf):
    s = D.risk_scores(platform_rows(spark, sf))
    return round_doubles(s.select("customer_id", "src_ord", "risk_score", "decision",
                                  "risk_label"))


@query
def risk_decision(spark, sf):
    s = D.risk_scores(platform_rows(spark, sf))
    return s.groupBy("decision", "risk_label").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- model preparation
def customer_classes(spark, sf) -> DataFrame:
    """The customers' classes, written once: ranking reads them for sizes, cuts and ranks."""
    return materialize(customers(spark, sf).select("customer_id", "product_category"), "customer-classes")


def class_split(spark, sf) -> DataFrame:
    return SP.stratified_holdout(customer_classes(spark, sf), "product_category", "customer_id")


def customers_split(spark, sf) -> DataFrame:
    """The whole customer rows, written once, with their part of the holdout."""
    return SP.stratified_holdout(materialize(customers(spark, sf), "customers"), "product_category", "customer_id")


@query
def class_weights(spark, sf):
    """A9 on the training part of the stratified holdout."""
    train = class_split(spark, sf).where(F.col("split") == "train")
    return round_doubles(ML.class_weights(train, "product_category"))


@query
def scaler_stats(spark, sf):
    """Per-dimension mean and population std of the face vectors."""
    return round_doubles(ML.scaler_stats(R.samples(spark, sf), "face"))


@query
def one_hot_platform(spark, sf):
    """M1/M4: alphabetical index and one-hot slot of main_platform (the dropped slot is
    the unknown index, so every known value has a live slot)."""
    o = ML.one_hot(customers(spark, sf), "main_platform", "platform")
    return o.select("customer_id", "main_platform",
                    F.col("platform_index").cast("int").alias("platform_index"),
                    "platform_active")


@query
def impute_median_mode(spark, sf):
    """M2/M3 fitted on the customer table."""
    st = ML.impute_stats(customers(spark, sf),
                         ["engagement_score", "purchase_interest_score", "average_engagement",
                          "platform_count"], ["review_sentiment", "main_platform"])
    return round_doubles(st)


@query
def stratified_holdout(spark, sf):
    return class_split(spark, sf).select("customer_id", "product_category", "split")


@query
def stratified_folds(spark, sf):
    f = SP.stratified_folds(customer_classes(spark, sf), "product_category", "customer_id", k=2)
    return f.select("customer_id", "product_category", "fold")


def sample_folds(spark, sf) -> DataFrame:
    return SP.group_folds(R.samples(spark, sf), "person", "group_id", k=3)


@query
def group_folds(spark, sf):
    return sample_folds(spark, sf).select("vec_id", "group_id", "person", "fold")


@query
def group_fold_balance(spark, sf):
    """M11 on groups of several labels: in every class the folds differ by no more rows than the
    largest group holds, and no group is in two folds."""
    s = R.samples(spark, sf).select("person", "vec_id", F.expr("(vec_id * 7 + 3) % 60").alias("gid"))
    f = materialize(SP.group_folds(s, "person", "gid", k=3), "mixed-folds")
    folds = F.array(*[F.count_if(F.col("fold") == i) for i in range(3)])
    per = f.groupBy("person").agg(folds.alias("_n"), F.count("*").alias("n_rows"))
    most = f.groupBy("gid").count().agg(F.max("count")).first()[0] or 0
    split = f.groupBy("gid").agg(F.countDistinct("fold").alias("_f")).agg(F.max("_f").alias("_f")).first()[0]
    return per.select(
        "person", "n_rows", (F.array_max("_n") - F.array_min("_n") <= most).alias("balanced"),
        F.lit(split == 1).alias("whole_groups"))


@query
def split_leakage(spark, sf):
    """Q7: groups of each held-out fold also present in training folds (must be 0)."""
    return SP.leaked_groups(sample_folds(spark, sf), "group_id")


@query
def missing_classes(spark, sf):
    """Classes of the customer table absent from the holdout part."""
    s = class_split(spark, sf)
    allc = s.select("product_category").distinct()
    test = s.where(F.col("split") == "test").select("product_category").distinct()
    return allc.join(test, "product_category", "left_anti")


@query
def variants_union(spark, sf):
    """Original + augmented variant rows with their names."""
    s = R.samples(spark, sf).select("vec_id", "person")
    v = F.explode(F.array(*[F.struct(F.lit(i).alias("variant_no"), F.lit(x).alias("suffix"))
                            for i, x in enumerate(MD.IMAGE_VARIANTS)]))
    e = s.select("vec_id", "person", v.alias("v")).select("vec_id", "person", "v.*")
    return e.select("vec_id", "person", F.col("variant_no").cast("int").alias("variant_no"),
                    F.concat(F.lit("sample"), F.col("vec_id").cast("string"), F.col("suffix"),
                             F.lit(".jpg")).alias("image_name"))


# ---------------------------------------------------------------- metrics
def labels(spark) -> DataFrame:
    return M.label_table(spark, R.SCORE_CLASSES)


@query
def metrics_macro(spark, sf):
    return round_doubles(M.macro_metrics(R.predictions(spark, sf), labels(spark)))


@query
def metrics_weighted(spark, sf):
    return round_doubles(M.weighted_metrics(R.predictions(spark, sf), labels(spark)))


@query
def class_report(spark, sf):
    return round_doubles(M.class_report(R.predictions(spark, sf), labels(spark)))


@query
def confusion_dense(spark, sf):
    return M.confusion_dense(R.predictions(spark, sf), R.SCORE_CLASSES)


@query
def log_loss(spark, sf):
    return round_doubles(M.log_loss(R.predictions(spark, sf), R.SCORE_CLASSES))


@query
def roc_auc_ovr(spark, sf):
    per = M.roc_auc_ovr(R.predictions(spark, sf), R.SCORE_CLASSES)
    macro = M.roc_auc_macro(per).select(F.lit("macro avg").alias("label"),
                                        F.lit(None).cast("bigint").alias("n_pos"),
                                        F.lit(None).cast("bigint").alias("n_neg"),
                                        F.col("roc_auc_macro").alias("auc"))
    return round_doubles(per.unionByName(macro))


@query
def fold_summary(spark, sf):
    """A10 over stratified 2-fold assignment of the scored rows."""
    p = SP.stratified_folds(R.predictions(spark, sf), "y_true", "row_id", k=2)
    return round_doubles(M.fold_summary(M.fold_metrics(p)))


# ---------------------------------------------------------------- verification
def scaled_samples(spark, sf, modality: str) -> DataFrame:
    s = R.samples(spark, sf)
    mean, std = ML.scaler_arrays(ML.scaler_stats(s, modality))
    return ML.apply_scaler(s, modality, mean, std, "x")


def fitted_profile(scaled: DataFrame) -> DataFrame:
    """The class profile, written once: it is measured, packed and joined."""
    return materialize(V.class_profile(scaled, "person", "x"), "class-profile")


@query
def class_profile(spark, sf):
    """Centroids of the scaled face vectors, one row per (class, position)."""
    long = V.class_centroids_long(scaled_samples(spark, sf, "face"), "person", "x")
    return round_doubles(long.select("person", F.col("pos").cast("int").alias("pos"), "value"))


@query
def intra_class_max(spark, sf):
    sc = scaled_samples(spark, sf, "face")
    c = V.centroid_arrays(V.class_centroids_long(sc, "person", "x"), "person")
    return round_doubles(V.intra_class_max(sc, "person", "x", c))


def face_gate(spark, sf) -> DataFrame:
    sc = scaled_samples(spark, sf, "face")
    return V.open_set_gate(sc, "x", fitted_profile(sc))


@query
def open_set_gate(spark, sf):
    g = face_gate(spark, sf)
    return round_doubles(g.select("vec_id", "predicted", "confidence", "distance", "person",
                                  "reject_reason"))


@query
def rejection_counts(spark, sf):
    """Rejected at the confidence gate alone and at confidence + distance."""
    g = V.confidence_label(face_gate(spark, sf))
    return g.agg(
        F.count_if(F.col("gated_label") == V.UNKNOWN_LABEL).alias("n_rejected_confidence"),
        F.count_if(F.col("person").isNull()).alias("n_rejected_open_set"),
        F.count(F.lit(1)).alias("n_rows"))


def decisions(spark, sf) -> DataFrame:
    """V5 over the attempts table. The voice gate is scored for every attempt and its
    result is discarded for attempts whose face was rejected (``attempt_decisions``
    nulls it), which keeps the short-circuit semantics. Filtering attempts first would
    add a semi-join and let predicate pushdown inline the whole gate into the filter;
    the vectorised gate is cheaper than either."""
    def gate(modality):
        sc = scaled_samples(spark, sf, modality)
        return V.open_set_gate(sc, "x", fitted_profile(sc))
    att, fgate, vgate = in_parallel(lambda: R.attempts(spark, sf), lambda: gate("face"),
                                    lambda: gate("voice"))
    # the customer keys of the feature table are the normalised profile keys
    keys = R.profiles_raw(spark, sf).select(
        normalize_key("customer_id").alias("customer_id")).distinct()
    ident = R.identity_map(spark, sf, keys)
    return D.decide(D.scored_attempts(att, fgate, vgate), ident)


@query
def attempt_decisions(spark, sf):
    return round_doubles(decisions(spark, sf))


@query
def denial_audit(spark, sf):
    return D.denial_audit(decisions(spark, sf))


def decisions_with_customer(spark, sf) -> DataFrame:
    cu, dec = in_parallel(lambda: customers(spark, sf), lambda: decisions(spark, sf))
    return D.with_customer(dec, cu.select("customer_id", "product_category", "last_purchase"))


@query
def attempt_trace(spark, sf):
    return D.attempt_trace(decisions_with_customer(spark, sf), "product_category")


@query
def granted_lookup(spark, sf):
    """P20 batch form: customer rows of the granted attempts (semi-join on the key)."""
    cu, dec = in_parallel(lambda: customers(spark, sf), lambda: decisions(spark, sf))
    g = dec.where("granted").select("customer_id")
    hit, _ = D.semi_by_keys(cu, g, "customer_id")
    return round_doubles(hit.select("customer_id", "product_category", "total_spent",
                                    "purchase_count", "main_platform"))


@query
def display_rows(spark, sf):
    d = decisions_with_customer(spark, sf).withColumn(
        "_product", F.when(F.col("granted"), F.col("product_category")))
    out = D.display_rows(d, "_product", "face_confidence", "granted", "last_purchase")
    return out.select("attempt_id", "recommended_product", "confidence_percent",
                      "authentication_status", "formatted_timestamp", "valid")


# ---------------------------------------------------------------- state machine
def fsm_sessions(spark, sf) -> DataFrame:
    return FSM.replay(R.fsm_events(spark, sf), ["user_id", "day"], ["ts", "event_id"])


@query
def fsm_replay(spark, sf):
    return fsm_sessions(spark, sf)


@query
def fsm_illegal_events(spark, sf):
    s = fsm_sessions(spark, sf)
    return s.where(F.col("n_illegal") > 0).select("user_id", "day", "final_state", "n_illegal")


@query
def fsm_allowed_events(spark, sf):
    return FSM.allowed_events(fsm_sessions(spark, sf).select("user_id", "day", "final_state"))


@query
def fsm_moves(spark, sf):
    """V9 by rows: every transition that the sessions made."""
    return FSM.moves(R.fsm_events(spark, sf), ["user_id", "day"], ["ts", "event_id"])


@query
def fsm_retry_users(spark, sf):
    """V9 on a cyclic table: a user's whole history, in which each end may be followed by a start."""
    return FSM.replay(R.fsm_events(spark, sf), ["user_id"], ["ts", "event_id"], transitions=FSM.RETRY_TRANSITIONS,
                      terminal=()).select("user_id", "final_state", "n_events", "n_transitions", "n_illegal")


# ---------------------------------------------------------------- model training (rows-only)

PRODUCT_NUMERIC = ["engagement_score", "purchase_interest_score", "average_engagement",
                   "platform_count"]
PRODUCT_CATEGORICAL = ["review_sentiment", "main_platform"]


def product_model(spark, sf):
    """M7 fitted on the training part of the stratified holdout (leaky columns dropped)."""
    # iterative fitting re-reads its input many times: cut the lineage once with a
    # reliable checkpoint in the shared checkpoint folder
    checkpoint_dir(spark)
    s = customers_split(spark, sf)
    feats = C.drop_if_present(s, ML.TRANSACTION_LEAK_COLS).checkpoint(eager=True)
    lm = MT.label_indexer(feats, "product_category")
    train = feats.where(F.col("split") == "train")
    test = feats.where(F.col("split") == "test")
    fill = MT.fit_fill(train, PRODUCT_NUMERIC, PRODUCT_CATEGORICAL)
    train, test = MT.apply_fill(train, fill), MT.apply_fill(test, fill)
    model = MT.fit_product_model(train, "product_category", PRODUCT_NUMERIC,
                                 PRODUCT_CATEGORICAL, lm)
    return model, lm, fill, test


@query
def train_rf_category(spark, sf):
    """Holdout predictions of the product-category forest."""
    model, lm, _, test = product_model(spark, sf)
    p = MT.predict_labels(model, test, lm.labels)
    return round_doubles(p.select("customer_id", "product_category", "predicted", "confidence"))


@query
def feature_importance(spark, sf):
    """Named forest importances, descending."""
    model, _, _, _ = product_model(spark, sf)
    return round_doubles(MT.feature_importances(model, spark))


@query
def eval_rf_category(spark, sf):
    """S11 + E1-E6 on the forest's holdout: one tidy (metric, value) table — macro and
    weighted metrics over all model classes, log loss, OvR ROC-AUC over present classes."""
    model, lm, _, test = product_model(spark, sf)
    labels = list(lm.labels)
    p = MT.predict_labels(model, test, labels).select(
        F.col("product_category").alias("y_true"), F.col("predicted").alias("y_pred"),
        "proba").checkpoint(eager=True)
    lt = M.label_table(spark, labels)
    parts = [M.macro_metrics(p, lt).drop("n_rows"), M.weighted_metrics(p, lt),
             M.log_loss(p, labels).select("log_loss"),
             M.roc_auc_macro(M.roc_auc_ovr(p, labels)).select("roc_auc_macro")]
    tidy = None
    for part in parts:
        rows = part.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in part.columns])).alias("r")).select("r.*")
        tidy = rows if tidy is None else tidy.unionByName(rows)
    return round_doubles(tidy)


@query
def cv_rf_category(spark, sf):
    """M10 + M12: stratified 2-fold cross-validation of the product forest (accuracy and
    macro F1 over the labels present in each fold)."""
    checkpoint_dir(spark)
    f = SP.stratified_folds(materialize(customers(spark, sf), "customers"), "product_category", "customer_id", k=2)
    feats = C.drop_if_present(f, ML.TRANSACTION_LEAK_COLS).checkpoint(eager=True)
    lm = MT.label_indexer(feats, "product_category")

    def fit(train):
        fill = MT.fit_fill(train, PRODUCT_NUMERIC, PRODUCT_CATEGORICAL)
        return fill, MT.fit_product_model(MT.apply_fill(train, fill), "product_category",
                                          PRODUCT_NUMERIC, PRODUCT_CATEGORICAL, lm)

    def predict(fitted, part):
        fill, model = fitted
        return MT.predict_labels(model, MT.apply_fill(part, fill), lm.labels)
    return round_doubles(M.fold_summary(MT.cross_validate(feats, "fold", fit, predict,
                                                          "product_category")))


def identity_cv(spark, sf, modality: str, k: int) -> DataFrame:
    """Folds of raw vectors; each fold's scaler and classifier see its training rows only."""
    checkpoint_dir(spark)
    df = SP.group_folds(R.samples(spark, sf), "person", "group_id", k=k).checkpoint(eager=True)
    lm = MT.label_indexer(df, "person")

    def fit(train):
        return MT.fit_scaled_identity(train, modality, "person", lm)

    def predict(model, part):
        return model.predict(part, modality, lm.labels)
    return round_doubles(MT.cross_validate(df, "fold", fit, predict, "person"))


@query
def train_lr_identity(spark, sf):
    """M8 + M11 + M12: grouped 3-fold cross-validation of the face identity model."""
    return identity_cv(spark, sf, "face", 3)


@query
def train_lr_voice(spark, sf):
    """M8 + M11 + M12: grouped 2-fold cross-validation of the voice identity model."""
    return identity_cv(spark, sf, "voice", 2)


@query
def open_set_identify_lr(spark, sf):
    """M14 + V4: refit on all rows, gate LR probabilities with the distance rule."""
    checkpoint_dir(spark)
    df = scaled_samples(spark, sf, "face").checkpoint(eager=True)
    lm = MT.label_indexer(df, "person")
    model = MT.fit_identity_model(df, "x", "person", lm)
    scored = MT.predict_labels(model, df.withColumn("features", MT.array_to_vector("x")), lm.labels)
    g = V.gate_predictions(scored.drop("person"), "x", fitted_profile(df))
    return round_doubles(g.select("vec_id", "predicted", "confidence", "distance", "person",
                                  "reject_reason"))


@query
def recommend_granted(spark, sf):
    """V6: product category predicted for the customers of granted attempts only; a customer
    without a feature row gets a reason instead of a prediction."""
    model, lm, fill, _ = product_model(spark, sf)
    granted = decisions(spark, sf).where("granted").select("attempt_id", "customer_id")
    feats = C.drop_if_present(customers(spark, sf), ML.TRANSACTION_LEAK_COLS)
    p = MT.predict_labels(model, MT.apply_fill(granted.join(feats, "customer_id"), fill), lm.labels)
    missing = granted.join(feats.select("customer_id"), "customer_id", "left_anti").select(
        "attempt_id", "customer_id", F.lit(None).cast("string").alias("predicted"),
        F.lit(None).cast("double").alias("confidence"), F.lit("no_customer_features").alias("reason"))
    return round_doubles(p.select(
        "attempt_id", "customer_id", "predicted", "confidence",
        F.lit(None).cast("string").alias("reason")).unionByName(missing))


# ---------------------------------------------------------------- streaming (rows-only)


@query
def fsm_stream(spark, sf):
    """The state machine as a stateful stream over the events table; the final
    state per session (last output row) equals ``fsm_replay``."""
    out = FS.run_events_stream(spark, sf)
    last = out.groupBy("user_id", "day").agg(
        F.max_by(F.struct("to_state", "n_events"), F.col("n_events")).alias("r"),
        F.count_if(~F.col("legal")).alias("n_illegal"))
    return last.select("user_id", "day", F.col("r.to_state").alias("final_state"),
                       F.col("r.n_events").alias("n_events"), "n_illegal")


# ---------------------------------------------------------------- media and triage


@query
def sample_triage(spark, sf):
    """Q10 over the page table taken as submitted samples: path from the URL (query and
    fragment removed), content = page bytes. Some are named as images: one in five with an
    image's first bytes, one in five without, one in five with no content."""
    page, kind = F.encode("html", "UTF-8"), F.col("page_id") % 5
    path = F.regexp_replace("url", r"[?#].*$", "")
    pg = R.read_table(spark, sf, "pages").select(
        "page_id",
        F.concat(path, F.when(kind == 0, "/a.png").when(kind == 1, "/a.jpg").when(kind == 2, "/a.gif")
                 .otherwise("")).alias("path"),
        F.when(kind == 0, F.concat(F.lit(b"\x89PNG"), page)).when(kind != 2, page).alias("content"))
    return Q.triage_samples(pg, "path", "content").select("page_id", "path", "status",
                                                          "message")


@query
def media_audio_features(spark, sf):
    """A clip per voice sample synthesised in Spark from its vector, four
    variants each, 17 features per variant."""
    # spread the (small) sample rows before the heavy per-clip work: a round-robin
    # shuffle of 64-float rows, no key, so no skew
    s = R.samples(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    clips = s.select(F.col("vec_id").cast("string").alias("clip_id"), "person",
                     F.concat(F.lit("phrase"), (F.col("vec_id") % 5).cast("string"))
                     .alias("phrase"), F.lit(MD.SAMPLE_RATE).alias("sr"),
                     MD.tone_clips(s, "voice").alias("samples"))
    return round_doubles(MD.audio_feature_table(clips))


@query
def media_image_variants(spark, sf):
    """An 8x8 BGR image per sample built in Spark from its vector, four
    variants (with checksums), and the first orientation where the stand-in encoder
    finds a face."""
    e = R.read_table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("image_id"),
        F.col("label").cast("string").alias("person"), F.lit("neutral").alias("emotion"),
        F.transform("embedding", lambda v: v.cast("double") * 4).alias("_v"))
    imgs = MD.grid_images(e, "_v").drop("_v")
    var = MD.image_variant_table(imgs)
    found, _ = MD.first_encoding(MD.orientation_candidates(imgs), MD.brightness_encoder)
    return var.join(found.select("image_id", F.col("rotation").alias("face_rotation")),
                    "image_id", "left").select(
        "image_id", "person", "variant", "height", "width", "nChannels",
        F.md5("data").alias("checksum"), "face_rotation")


@query
def dq_model_inputs(spark, sf):
    """Q3/Q8/Q9 on the identity training table: features present, no leaky column,
    at least two people, no NULL feature (the vectors are expanded to named columns)."""
    s = R.samples(spark, sf)
    names = [f"Feature{i + 1}" for i in range(R.FACE_DIMS[1])]
    wide = s.select("person", *[F.col("face")[i].alias(n) for i, n in enumerate(names)])
    return Q.model_input_checks(wide, "person", names, ML.TRANSACTION_LEAK_COLS + ["person"])


@query
def distinct_counts(spark, sf):
    """Exact distinct counts of the cleaned profile columns."""
    p = C.distinct_profiles(R.profiles_raw(spark, sf))
    return Q.distinct_counts(p, ["customer_id", "social_media_platform", "review_sentiment"])


@query
def mode_category_user_lambda(spark, sf):
    """The first-seen mode written as a user lambda over value counts (same answer
    as ``mode_category_first_seen``)."""
    return FE.value_count_aggregate(tx_valid(spark, sf), "customer_id", "category",
                                    lambda vc: vc.index[0], out="product_category")


@query
def risk_first_row(spark, sf):
    """W2 + V7/V8 for every customer at once: the first source row of each customer
    in the platform table is the row that gets scored."""
    first = FE.first_row(platform_rows(spark, sf))
    s = D.risk_scores(first)
    return round_doubles(s.select("customer_id", "src_ord", "risk_score", "decision",
                                  "risk_label"))


@query
def export_readback(spark, sf):
    """S8 + S9: the customer table is exported (CSV with header, overwrite) to the shared
    checkpoint folder and read back: rows by their fingerprint, columns, spend and key."""
    path = scratch_path(spark, "customer-export")
    register_cleanup(spark, path)
    EX.export(customers(spark, sf), path, fmt="csv")
    return EX.check_export(spark, path, "customer_id", "total_spent")
