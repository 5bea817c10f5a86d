"""Tables in common buckets."""

import pytest
from pyspark.sql import functions as F

from sparkgate.operators import features as FE
from sparkgate.session import scratch_path
from sparkgate.sources import bucketed as BK


def _inputs(spark, n=3_000, hot=0.0):
    """Profiles and transactions; ``hot`` is the share of both on one customer."""
    key = lambda m: F.when(F.col("id") % 100 < int(100 * hot), F.lit("hot")).when(
        F.col("id") % 50 == 49, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), F.col("id") % m))
    prof = spark.range(n).select(
        key(157).alias("customer_id"), F.concat(F.lit("p"), F.col("id") % 3).alias("social_media_platform"),
        (F.col("id") % 7).cast("double").alias("engagement_score"), F.lit(1.0).alias("purchase_interest_score"),
        F.lit("neutral").alias("review_sentiment"), F.col("id").alias("src_ord"))
    tx = spark.range(2 * n).select(
        key(211).alias("customer_id"), (F.col("id") % 90 + 1).cast("double").alias("amount"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"),
        F.concat(F.lit("k"), F.col("id") % 4).alias("category"), (F.col("id") % 9 == 0).alias("is_fraud"),
        F.col("id").alias("src_ord"))
    return prof, tx


def _rows(profiles, transactions):
    return FE.platform_table(profiles, FE.transaction_features(transactions), write=False)


def _exchanges(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("Exchange " in line for line in plan.splitlines())


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_customer_join_has_no_exchange(spark, no_broadcast):
    prof, tx = _inputs(spark)
    path = scratch_path(spark, "buckets-test")
    BK.write_together({"profiles": prof, "transactions": tx}, "customer_id", path, buckets=4)
    cold, hot = BK.open_together(spark, path)
    assert hot["profiles"].count() == hot["transactions"].count() == 0
    assert _exchanges(_rows(**cold)) == 0 < _exchanges(_rows(prof, tx))
    assert sorted(map(str, BK.per_key(spark, path, _rows).collect())) == sorted(map(str, _rows(prof, tx).collect()))


def test_hot_customer_stays_out_of_the_buckets(spark):
    prof, tx = _inputs(spark, hot=0.9)
    path = scratch_path(spark, "buckets-hot")
    BK.write_together({"profiles": prof, "transactions": tx}, "customer_id", path, buckets=4, hot_rows=500)
    cold, hot = BK.open_together(spark, path)
    assert cold["profiles"].where("customer_id = 'hot'").count() == 0
    assert hot["profiles"].select("customer_id").distinct().collect() == [("hot",)]
    assert hot["profiles"].count() == 2_700 and cold["profiles"].count() == 300
    assert sorted(map(str, BK.per_key(spark, path, _rows).collect())) == sorted(map(str, _rows(prof, tx).collect()))


def test_null_keys_and_empty_tables(spark):
    prof, tx = _inputs(spark, 300)
    path = scratch_path(spark, "buckets-null")
    BK.write_together({"profiles": prof, "transactions": tx.where("false")}, "customer_id", path, buckets=3, hot_rows=5)
    cold, hot = BK.open_together(spark, path)
    assert hot["profiles"].where("customer_id IS NULL").count() == 6      # six NULL keys are a hot key here
    assert cold["transactions"].count() == hot["transactions"].count() == 0
    assert BK.per_key(spark, path, _rows).count() == 300
