"""Cleaning and feature semantics on small literal tables (FIXTURES.md goldens)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkgate.operators import clean as C
from sparkgate.operators import features as FE
from sparkgate.operators import quantiles as QN
from sparkgate.operators import ranking as RK

TX_SCHEMA = ("transaction_id string, customer_id string, timestamp string, amount string, "
             "category string, is_fraud boolean, src_ord long")


def test_recency_floors_elapsed_days(spark):
    """Last purchase 2025-03-31 10:02 is 0 whole days before 2025-04-01."""
    df = spark.createDataFrame([("a190", dt.datetime(2025, 3, 31, 10, 2))],
                               "customer_id string, timestamp timestamp_ntz")
    df = df.withColumn("amount", F.lit(1.0)).withColumn("is_fraud", F.lit(False))
    r = FE.rfm(df).first()
    assert r["days_since_last_purchase"] == 0
    later = spark.createDataFrame([("x", dt.datetime(2025, 4, 1, 6, 0))],
                                  "customer_id string, timestamp timestamp_ntz")
    later = later.withColumn("amount", F.lit(1.0)).withColumn("is_fraud", F.lit(False))
    assert FE.rfm(later).first()["days_since_last_purchase"] == -1


def test_mode_ties_go_to_first_seen(spark):
    """Three-way tie whose first-seen value is not the smallest."""
    rows = [("c", "zeta", 1), ("c", "alpha", 2), ("c", "mid", 3), ("c", "alpha", 4),
            ("c", "zeta", 5), ("c", "mid", 6)]
    df = spark.createDataFrame(rows, "customer_id string, category string, src_ord long")
    assert FE.mode_first_seen(df, "customer_id", "category").first()["category"] == "zeta"
    assert FE.mode_smallest(df, "customer_id", "category").first()["category"] == "alpha"


def test_transactions_cleaning_and_reasons(spark):
    rows = [("T1", " A1 ", "2025-01-01 10:00:00", "10.5", "Travel", False, 1),
            ("T1", " A1 ", "2025-01-01 10:00:00", "10.5", "Travel", False, 2),
            ("T2", "a1", "2025-01-02 10:00:00", "abc", "travel", False, 3),
            ("T3", "a1", "2025-01-03 10:00:00", "-1", "food", True, 4),
            ("T4", "a1", "not a date", "5", "food", True, 5),
            ("T5", "a2", "2025-01-04 10:00:00", "NaN", "food", False, 6),
            ("T6", "a2", "2025-01-05 10:00:00", "7", " FOOD ", True, 7)]
    raw = spark.createDataFrame(rows, TX_SCHEMA)
    reasons = {r["reason"]: r["n_rows"] for r in C.reject_counts(raw).collect()}
    assert reasons == {"ok": 2, "bad_amount": 3, "bad_timestamp": 1}
    v = {r["transaction_id"]: r for r in C.valid_transactions(raw).collect()}
    assert set(v) == {"T1", "T6"}
    assert v["T1"]["customer_id"] == "a1" and v["T1"]["src_ord"] == 1
    assert v["T6"]["category"] == "food"


def test_profiles_median_fill_after_distinct(spark):
    rows = [(" A1", "Twitter", "10", "2.0", "Positive", 1),
            ("a1 ", "twitter", "10", "2.0", "positive", 2),
            ("a2", None, "x", "4.0", None, 3),
            ("a3", "TikTok", "30", None, "Neutral", 4)]
    raw = spark.createDataFrame(rows, "customer_id string, social_media_platform string, "
                                      "engagement_score string, purchase_interest_score string, "
                                      "review_sentiment string, src_ord long")
    out = {r["src_ord"]: r for r in C.clean_profiles(raw).collect()}
    assert set(out) == {1, 3, 4}                      # row 2 duplicates row 1
    assert out[3]["engagement_score"] == 20.0          # median of 10, 30
    assert out[4]["purchase_interest_score"] == 3.0    # median of 2, 4
    assert out[3]["social_media_platform"] == "unknown"
    assert out[3]["review_sentiment"] == "unknown"


@pytest.mark.parametrize("skewed", [False, True])
def test_exact_quantiles_match_numpy(spark, skewed):
    rng = np.random.default_rng(3)
    x = rng.normal(100, 30, 5000).round(2)
    if skewed:
        x[:2000] = 42.0                                 # one value holds 40 % of the rows
    df = spark.createDataFrame(pd.DataFrame({"v": x}))
    qs = [0.01, 0.25, 0.5, 0.99]
    got = QN.quantile_values(df, "v", qs)["v"]
    want = np.quantile(x, qs)                           # linear interpolation
    assert np.allclose(got, want, rtol=0, atol=1e-9)


@pytest.mark.parametrize("buckets", [None, 1, 7, 1000])
def test_rows_before_is_rank_within_group(spark, buckets):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.exponential(1.0, 2000), rng.normal(50, 1, 1000)])  # skewed
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3000, p=[0.7, 0.2, 0.1]),
                        "v": rng.permutation(v)})
    df = spark.createDataFrame(pdf)
    got = RK.rows_before(df, ["g"], "v", num_buckets=buckets).toPandas() \
        .set_index("v")["_before"]
    want = pdf.groupby("g")["v"].rank(method="first").astype(int) - 1
    want.index = pdf["v"]
    assert (got.sort_index() == want.sort_index()).all()


def test_winsorize_keeps_null_and_clips(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,), (100.0,)], "amount double")
    out = [r["amount"] for r in C.winsorize(df, "amount", 2.0, 50.0).collect()]
    assert out == [2.0, 5.0, None, 50.0]


def test_legacy_features_equal_pairwise_join(spark):
    """J4 factorised == the many-to-many join aggregated (brute force in pandas)."""
    rng = np.random.default_rng(11)
    prof = pd.DataFrame({
        "customer_id": rng.choice(["a1", "a2", "a3"], 40),
        "social_media_platform": rng.choice(["twitter", "linkedin", "tiktok"], 40),
        "engagement_score": rng.integers(0, 100, 40).astype(float),
        "purchase_interest_score": rng.integers(10, 50, 40) / 10.0,
        "review_sentiment": rng.choice(["positive", "neutral", "negative"], 40),
        "src_ord": np.arange(40)})
    tx = pd.DataFrame({
        "transaction_id": [f"T{i}" for i in range(30)],
        "customer_id": rng.choice(["a1", "a2", "a4"], 30),
        "amount": rng.integers(100, 10000, 30) / 100.0,
        "is_fraud": rng.choice([True, False], 30)})
    got = FE.legacy_customer_features(spark.createDataFrame(prof), spark.createDataFrame(tx))
    got = got.toPandas().set_index("customer_id").sort_index()
    m = prof.merge(tx, on="customer_id", how="inner")
    m["sent"] = m["review_sentiment"].map({"negative": 0, "neutral": 1, "positive": 2})
    g = m.groupby("customer_id")
    want = pd.DataFrame({
        "purchase_count": g["transaction_id"].nunique(),
        "total_spent": g["amount"].sum(),
        "fraud_count": g["is_fraud"].sum(),
        "avg_engagement_score": g["engagement_score"].mean(),
        "platform_count": g["social_media_platform"].nunique()}).sort_index()
    assert list(got.index) == list(want.index)
    assert (got["purchase_count"] == want["purchase_count"]).all()
    assert (got["fraud_count"] == want["fraud_count"]).all()
    assert (got["platform_count"] == want["platform_count"]).all()
    assert np.allclose(got["total_spent"], want["total_spent"], atol=0.006)
    assert np.allclose(got["avg_engagement_score"], want["avg_engagement_score"], atol=0.006)


def test_rows_before_spreads_a_hot_group(spark):
    """Scale property: a group holding 90 % of the rows is split over the buckets, so
    no task ranks the whole group."""
    rng = np.random.default_rng(9)
    g = np.where(rng.random(20000) < 0.9, "hot", rng.choice(["a", "b"], 20000))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": rng.permutation(20000)}))
    out = RK.rows_before(df, ["g"], "v", num_buckets=8, keep_bucket=True)
    hot = out.where("g = 'hot'").groupBy("_bucket").count().toPandas()
    assert len(hot) == 8
    assert hot["count"].max() <= 0.2 * hot["count"].sum()
    ranks = out.where("g = 'hot'").select("_before").toPandas()["_before"]
    assert sorted(ranks) == list(range(len(ranks)))


def test_small_column_helpers(spark):
    from sparkgate.functions.columns import bool_text, sentiment_ordinal
    df = spark.createDataFrame([("TRUE",), ("0",), ("yes",), (None,)], "b string")
    assert [r[0] for r in df.select(bool_text("b")).collect()] == [True, False, False, False]
    s = spark.createDataFrame([(" Negative ",), ("POSITIVE",), ("meh",)], "s string")
    assert [r[0] for r in s.select(sentiment_ordinal("s")).collect()] == [0, 2, 1]
    r = C.rename_if_present(df, {"b": "flag", "nope": "x"})
    assert r.columns == ["flag"]
    mixed = spark.createDataFrame([("a", 1.0, 2, True)], "s string, d double, i int, f boolean")
    assert C.split_by_type(mixed) == (["s"], ["d", "i"])


def test_assert_expectations_lists_every_failure(spark):
    from sparkgate.operators import quality as Q
    df = spark.createDataFrame([(None, -1.0), ("a1", 2.0)], "customer_id string, amount double")
    findings = Q.expectations([
        Q.expect_zero(df, "ids_not_null", F.col("customer_id").isNull()),
        Q.expect_zero(df, "amount_positive", F.col("amount") <= 0),
        Q.expect_unique(df, "unique_ids", "customer_id")])
    with pytest.raises(Q.ExpectationError) as e:
        Q.assert_expectations(findings)
    assert "ids_not_null" in str(e.value) and "amount_positive" in str(e.value)
    assert "unique_ids" not in str(e.value)


def test_cleaning_empty_inputs(spark):
    """Empty tables flow through the materialised cleaning steps (no schema inference)."""
    prof = spark.createDataFrame([], "customer_id string, social_media_platform string, "
                                     "engagement_score string, purchase_interest_score string, "
                                     "review_sentiment string, src_ord long")
    assert C.clean_profiles(prof).count() == 0
    tx = spark.createDataFrame([], TX_SCHEMA)
    assert C.clean_transactions(tx).count() == 0


def test_value_counts_reach_the_lambda_in_batches_of_groups(spark):
    """Ties by first ordinal (none: last), null keys a group, null values none; no frame per group."""
    rows = [("a", "x", 5), ("a", "y", 3), ("a", "z", None), ("b", "y", 9), ("b", "x", 2), ("b", "y", 1),
            (None, "q", 4), ("c", None, 7)]
    df = spark.createDataFrame(rows, "k string, v string, src_ord long")
    got = FE.value_count_aggregate(df, "k", "v", lambda vc: ",".join(f"{i}{n}" for i, n in vc.items()))
    assert {r["k"]: r["result"] for r in got.collect()} == {"a": "y1,x1,z1", "b": "y2,x1", None: "q1"}
    assert "FlatMapGroupsInPandas" not in got._jdf.queryExecution().toString()
    top = FE.value_count_aggregate(df, "k", "src_ord", lambda vc: vc.index.max() if len(vc) > 1 else None, "long")
    assert {r["k"]: r["result"] for r in top.collect()} == {"a": 5, "b": 9, None: None, "c": None}
