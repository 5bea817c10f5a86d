"""Feature tables: A1-A4, P8, P11, P14, P15, J1-J3, W1-W3.

Every per-customer aggregate is a ``groupBy(customer_id)`` with map-side combine,
so a customer holding a large share of the rows is reduced before the shuffle.
The aggregates come out hash-partitioned on ``customer_id``; the left joins
between them need no further exchange, and only the platform-grain rows are
shuffled once to meet them (AQE splits a skewed key on that side).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import elapsed_days, round_half_even, sentiment_ordinal
from ..session import materialize

# Reference day of the recency feature and post-join defaults.
REFERENCE_DAY = "2025-04-01 00:00:00"
TX_DEFAULTS = {"total_spent": 0.0, "average_spent": 0.0, "purchase_count": 0,
               "days_since_last_purchase": -1, "fraud_rate": 0.0,
               "product_category": "unknown"}

PLATFORM_COLUMNS = ["customer_id", "social_media_platform", "engagement_score",
                    "purchase_interest_score", "review_sentiment", "total_spent",
                    "average_spent", "purchase_count", "last_purchase", "fraud_rate",
                    "days_since_last_purchase", "product_category", "average_engagement",
                    "platform_count", "main_platform"]
MODELING_COLUMNS = ["customer_id", "engagement_score", "purchase_interest_score",
                    "review_sentiment", "average_engagement", "platform_count",
                    "main_platform", "total_spent", "average_spent", "purchase_count",
                    "last_purchase", "fraud_rate", "days_since_last_purchase",
                    "product_category"]


def mode_first_seen(df: DataFrame, key: str, value: str, ord_col: str = "src_ord",
                    out: str | None = None) -> DataFrame:
    """A2: most frequent non-null value per key; ties go to the first-seen value.

    Two map-side-combined aggregates: (key, value) -> (n, first ordinal), then
    key -> max_by(value, (n, -first)). No group is ever collected.
    """
    c = (df.where(F.col(value).isNotNull()).groupBy(key, value)
         .agg(F.count(F.lit(1)).alias("_n"), F.min(ord_col).alias("_o")))
    return c.groupBy(key).agg(
        F.max_by(value, F.struct(F.col("_n"), -F.col("_o"))).alias(out or value))


def mode_smallest(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """A4 mode: most frequent value per key, ties -> smallest value."""
    c = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("_n"))
    return c.groupBy(key).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out or value))


def rfm(tx: DataFrame, ref_day: str = REFERENCE_DAY) -> DataFrame:
    """A1 + P11: spend sum / mean / count of non-null amounts, last purchase, fraud rate,
    whole elapsed days since the last purchase."""
    return (tx.groupBy("customer_id").agg(
        F.sum("amount").alias("total_spent"),
        F.avg("amount").alias("average_spent"),
        F.count("amount").alias("purchase_count"),
        F.max("timestamp").alias("last_purchase"),
        F.avg(F.col("is_fraud").cast("double")).alias("fraud_rate"))
        .withColumn("days_since_last_purchase", elapsed_days(ref_day, "last_purchase")))


def transaction_features(tx: DataFrame, ref_day: str = REFERENCE_DAY) -> DataFrame:
    """A1 + P11 + A2 (category, first seen) + J3."""
    mode = mode_first_seen(tx, "customer_id", "category", out="product_category")
    return rfm(tx, ref_day).join(mode, "customer_id", "left")


def social_aggregates(profiles: DataFrame) -> DataFrame:
    """A3 fused: mean engagement, mean interest, distinct platforms per customer."""
    return profiles.groupBy("customer_id").agg(
        F.avg("engagement_score").alias("average_engagement"),
        F.avg("purchase_interest_score").alias("average_purchase_interest"),
        F.countDistinct("social_media_platform").alias("platform_count"))


def fill_tx_defaults(df: DataFrame) -> DataFrame:
    """Neutral defaults for customers without transactions (last_purchase stays NULL)."""
    return (df.fillna({k: v for k, v in TX_DEFAULTS.items() if k != "purchase_count"})
              .withColumn("purchase_count",
                          F.coalesce(F.col("purchase_count"), F.lit(0)).cast("bigint"))
              .withColumn("days_since_last_purchase",
                          F.col("days_since_last_purchase").cast("bigint")))


def platform_table(profiles: DataFrame, tx_features: DataFrame,
                   keep_match_flag: bool = False, write: bool = True) -> DataFrame:
    """Every cleaned profile row with the customer aggregates (platform grain).

    ``write=False`` is for inputs in buckets of the customer, where no join needs an exchange."""
    soc = social_aggregates(profiles).drop("average_purchase_interest")
    main = mode_first_seen(profiles, "customer_id", "social_media_platform",
                           out="main_platform")
    # written once (a row per customer): joined as a plain table, a hot customer's profile
    # rows can be split by skew-join handling, which a chain of joins on the right prevents
    cust = soc.join(main, "customer_id", "left").join(tx_features, "customer_id", "left")
    if write:
        cust = materialize(cust, "customer-aggregate")
    joined = profiles.join(cust, "customer_id", "left").withColumn(
        "_tx_matched", F.col("total_spent").isNotNull())
    out = fill_tx_defaults(joined).select(*PLATFORM_COLUMNS, "src_ord", "_tx_matched")
    return out if keep_match_flag else out.drop("_tx_matched")


def customer_table(profiles: DataFrame, tx_features: DataFrame) -> DataFrame:
    """Customer grain (one row per profile customer) for modelling."""
    soc = social_aggregates(profiles)
    sent = mode_first_seen(profiles, "customer_id", "review_sentiment")
    main = mode_first_seen(profiles, "customer_id", "social_media_platform",
                           out="main_platform")
    base = (soc.join(sent, "customer_id", "left").join(main, "customer_id", "left")
            .select("customer_id", F.col("average_engagement").alias("engagement_score"),
                    F.col("average_purchase_interest").alias("purchase_interest_score"),
                    "review_sentiment", "average_engagement", "platform_count",
                    "main_platform"))
    return fill_tx_defaults(base.join(tx_features, "customer_id", "left")).select(
        *MODELING_COLUMNS)


def best_platform_row(profiles: DataFrame) -> DataFrame:
    """One row per customer, highest engagement first, ties keep source order.

    Written as ``max_by`` over (engagement, -ordinal) rather than a window, so a hot
    customer is reduced map-side instead of being sorted in one task. NULL
    engagement sorts last, as in a stable descending sort.
    """
    others = [c for c in profiles.columns if c != "customer_id"]
    s = profiles.groupBy("customer_id").agg(F.max_by(
        F.struct(*others), F.struct(F.col("engagement_score"), -F.col("src_ord"))).alias("_r"))
    return s.select("customer_id", *[F.col(f"_r.{c}").alias(c) for c in others])


def first_row(df: DataFrame, key: str = "customer_id", ord_col: str = "src_ord") -> DataFrame:
    """The first source row per key, as an aggregate (map-side combined)."""
    others = [c for c in df.columns if c != key]
    s = df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(ord_col)).alias("_r"))
    return s.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def top_k(df: DataFrame, order_cols, k: int) -> DataFrame:
    """Ordered top-k (plans as TakeOrderedAndProject: k rows per task)."""
    return df.orderBy(*order_cols).limit(k)


def _exact_mean(c) -> "F.Column":
    """Mean in decimal arithmetic, so a mean that is exactly halfway at the rounding
    digit is seen as a tie in every engine (float means disagree in the last bit)."""
    return F.avg(F.col(c).cast("decimal(38,9)"))


def _round2(c, digits: int = 2):
    return F.bround(c, digits).cast("double")


def legacy_customer_features(profiles: DataFrame, tx: DataFrame) -> DataFrame:
    """A4 with J4 factorised: the legacy inner join of profile rows x transaction rows
    is never materialised (it emits every pair inside a customer). Each aggregate over
    the product equals a combination of per-side aggregates:

    mean over pairs = per-side mean; sum over pairs = sum x partner count;
    distinct counts and modes are unchanged by the uniform multiplication.
    Means and sums are taken in decimal and rounded half-to-even at 2 decimals
    (P14); the fraud rate at 3. Results equal the pairwise computation (the oracle
    SQL materialises the pairs).
    """
    p = profiles.withColumn("_sent", sentiment_ordinal("review_sentiment"))
    ps = p.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_np"),
        _exact_mean("engagement_score").alias("avg_engagement_score"),
        _exact_mean("purchase_interest_score").alias("avg_purchase_interest"),
        _exact_mean("_sent").alias("avg_sentiment_score"),
        F.countDistinct("social_media_platform").alias("platform_count"))
    prim = mode_smallest(profiles, "customer_id", "social_media_platform",
                         out="primary_platform")
    amount = F.coalesce(F.col("amount"), F.lit(0.0)).cast("decimal(38,9)")
    ts = tx.groupBy("customer_id").agg(
        F.countDistinct("transaction_id").alias("purchase_count"),
        F.avg(amount).alias("average_spent"),
        F.sum(amount).alias("_sum_amount"),
        F.sum(F.col("is_fraud").cast("bigint")).alias("_sum_fraud"))
    j = ps.join(ts, "customer_id", "inner").join(prim, "customer_id", "left")
    out = j.select(
        "customer_id", "purchase_count",
        _round2(F.col("average_spent")).alias("average_spent"),
        _round2(F.col("_sum_amount") * F.col("_np")).alias("total_spent"),
        (F.col("_sum_fraud") * F.col("_np")).alias("fraud_count"),
        _round2(F.col("avg_engagement_score")).alias("avg_engagement_score"),
        _round2(F.col("avg_purchase_interest")).alias("avg_purchase_interest"),
        _round2(F.col("avg_sentiment_score")).alias("avg_sentiment_score"),
        "platform_count", "primary_platform")
    return proxy_metrics(out.withColumn(
        "fraud_rate", round_half_even(F.col("fraud_count") / F.col("purchase_count"), 3)))


def proxy_metrics(df: DataFrame, eng: str = "avg_engagement_score",
                  platforms: str = "platform_count") -> DataFrame:
    """likes = 12 eng, comments = 3 eng, followers = 40 eng + 100 platforms."""
    e, n = F.col(eng), F.col(platforms)
    return (df.withColumn("likes", round_half_even(e * 12, 0).cast("bigint"))
              .withColumn("comments", round_half_even(e * 3, 0).cast("bigint"))
              .withColumn("followers", round_half_even(e * 40 + n * 100, 0).cast("bigint")))


def value_count_aggregate(df: DataFrame, key: str, value: str, fn, out_type: str = "string",
                          ord_col: str = "src_ord", out: str = "result") -> DataFrame:
    """A user aggregate written as a pandas lambda over the *value counts* of a group
    (a Series: index = value in first-seen order, values = counts, sorted by count
    descending with first-seen order kept on ties — what ``value_counts`` returns).

    Rows are reduced to (key, value) -> (count, first ordinal) with map-side combine
    first, so the lambda sees one row per distinct value, never the group's rows. The value
    counts of many groups share an Arrow batch: a batch for each group costs milliseconds.
    """
    c = (df.where(F.col(value).isNotNull()).groupBy(key, value)
         .agg(F.count(F.lit(1)).alias("_n"), F.min(ord_col).alias("_o")))
    # by count descending, then first ordinal (none: last)
    vc = c.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("_n")).alias("m"), F.col("_o").isNull().alias("u"), F.col("_o").alias("o"),
        F.col(value).alias("v")))).alias("_vc"))

    def run(values: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([fn(pd.Series(n, index=v)) for v, n in zip(values, counts)], dtype=object)
    return vc.select(key, F.pandas_udf(run, out_type)(
        F.col("_vc.v"), F.transform("_vc", lambda x: -x["m"])).alias(out))


def legacy_join_grain(profiles: DataFrame, tx: DataFrame) -> DataFrame:
    """J4 grain without emitting pairs: rows per customer on each side and the number
    of rows the legacy many-to-many inner join would produce (their product)."""
    p = profiles.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_profile_rows"))
    t = tx.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_transactions"))
    return p.join(t, "customer_id", "inner").withColumn(
        "n_pairs", F.col("n_profile_rows") * F.col("n_transactions"))
