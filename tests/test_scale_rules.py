"""Rules for scale and leaks: even buckets, kept NULL keys, train-only statistics, missing samples."""

import random

import pytest
from pyspark.sql import functions as F

from sparkgate.operators import decide as D
from sparkgate.operators import ml_split as SP
from sparkgate.operators import ml_train as MT
from sparkgate.operators import verify as V
from sparkgate.operators.quantiles import quantile_values
from sparkgate.operators.ranking import rows_before


def test_buckets_are_even_on_a_heavy_tail(spark):
    rnd = random.Random(3)
    rows = [("a", rnd.lognormvariate(5, 2)) for _ in range(40_000)] + [("a", 1e12), ("b", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = rows_before(df, ["k"], "v", num_buckets=256, keep_bucket=True).where("k = 'a'")
    sizes = [r["count"] for r in out.groupBy("_bucket").count().collect()]
    assert len(sizes) > 200 and max(sizes) <= 4 * 40_001 / 256
    got = sorted((r.v, r._before) for r in out.collect())
    assert [b for _, b in got] == list(range(40_001))


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_rows_before_keeps_null_keys(spark, limit, monkeypatch):
    from sparkgate.operators import ranking
    monkeypatch.setattr(ranking, "MAX_OFFSET_ROWS", limit)
    df = spark.createDataFrame([(None if i % 5 == 0 else "x", i) for i in range(100)], "k string, v long")
    got = {(r.k, r.v): (r._before, r._group_total) for r in rows_before(df, ["k"], "v", num_buckets=9).collect()}
    for k in (None, "x"):
        mine = sorted(v for kk, v in got if kk == k)
        assert [got[k, v] for v in mine] == [(i, len(mine)) for i in range(len(mine))]


def test_rows_without_a_label_are_split_too(spark):
    df = spark.createDataFrame([(i, None if i < 20 else "ab"[i % 2]) for i in range(100)], "id long, label string")
    hold = SP.stratified_holdout(df, "label", "id")
    assert hold.count() == 100 and hold.where("split = 'test'").count() == 20
    assert hold.where("label IS NULL AND split = 'test'").count() == 4
    folds = SP.stratified_folds(df, "label", "id", k=2)
    assert folds.count() == 100 and folds.where("label IS NULL").groupBy("fold").count().first()["count"] == 10


def test_scaler_is_fitted_on_the_training_rows_only(spark):
    rows = [(i, "p" if i % 2 else "q", [float(i % 2) + 0.1 * (i % 5), 1.0 + 0.01 * i], i % 2 if i else 1)
            for i in range(40)]
    df = spark.createDataFrame([(*r[:3], 0) for r in rows], "id long, person string, v array<double>, fold int")
    outlier = spark.createDataFrame([(99, "p", [1e6, -1e6], 1)], df.schema)
    train = lambda d: MT.fit_scaled_identity(d.where("fold != 1"), "v", "person")
    plain, beside = train(df), train(df.union(outlier))
    assert plain.mean == pytest.approx(beside.mean) and plain.std == pytest.approx(beside.std)
    got = beside.predict(outlier, "v", ["p", "q"]).select("x").first().x
    assert got == pytest.approx([(1e6 - plain.mean[0]) / plain.std[0], (-1e6 - plain.mean[1]) / plain.std[1]])


def test_fill_is_the_interpolated_median_and_reaches_scored_rows(spark):
    schema = "n double, c string"
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "a"), (10.0, "b"), (None, None)], schema)
    fill = MT.fit_fill(train, ["n"], ["c"])
    assert fill == {"n": 3.0, "c": "a"} == {"n": quantile_values(train, "n", [0.5])["n"][0], "c": "a"}
    scored = spark.createDataFrame([(None, None), (7.0, "z")], schema)
    assert [tuple(r) for r in MT.apply_fill(scored, fill).orderBy("n").collect()] == [(3.0, "a"), (7.0, "z")]


def test_attempt_without_samples_is_denied_at_the_face(spark):
    attempts = spark.createDataFrame([(1, 10, 20), (2, 11, 21), (3, 12, 99)], "attempt_id long, face_vec long, voice_vec long")
    gate = spark.createDataFrame([(10, "p", 0.9), (20, "p", 0.8), (12, "p", 0.7)], "vec_id long, person string, confidence double")
    ident = spark.createDataFrame([("p", "a1")], "person string, customer_id string")
    got = {r.attempt_id: r for r in D.attempt_decisions(
        D.attempt_samples(attempts, gate, "face_vec"), D.attempt_samples(attempts, gate, "voice_vec"), ident).collect()}
    assert len(got) == 3
    assert got[1].outcome == D.GRANTED and got[1].customer_id == "a1"
    assert got[2].outcome == D.DENIED_FACE and got[2].face_confidence == 0.0
    assert got[3].outcome == D.DENIED_VOICE and got[3].voice_confidence == 0.0


def test_decisions_keep_rows_without_a_customer(spark):
    dec = spark.createDataFrame([(1, "a1"), (2, None), (3, "zz")], "attempt_id long, customer_id string")
    cu = spark.createDataFrame([("a1", 5.0)], "customer_id string, total double")
    got = {r.attempt_id: r.total for r in D.with_customer(dec, cu).collect()}
    assert got == {1: 5.0, 2: None, 3: None}


def _profile_rows(k, d, seed=2):
    import random
    rnd = random.Random(seed)
    return [(f"c{i:05d}", [rnd.gauss(0, 1) for _ in range(d)], 0.5 + rnd.random()) for i in range(k)]


@pytest.mark.parametrize("block, broadcast", [(10**6, 8 * 10**6), (300, 8 * 10**6), (300, 0)])
def test_gate_in_blocks_equals_all_classes_at_once(spark, monkeypatch, block, broadcast):
    """One block, many broadcast, many by shuffle: the same as a dense softmax in numpy."""
    import numpy as np
    monkeypatch.setattr(V, "BLOCK_BYTES", block)
    monkeypatch.setattr(V, "BROADCAST_BYTES", broadcast)
    prof = _profile_rows(40, 4) + [("a-twin", [9.0] * 4, 1.0), ("b-twin", [9.0] * 4, 1.0)]
    rng = np.random.default_rng(1)
    pts = [(i, (np.array(prof[i % 42][1]) + rng.normal(0, .4, 4)).tolist()) for i in range(60)]
    pts += [(90, [9.0] * 4), (91, None), (92, [1e3] * 4)]
    df = spark.createDataFrame(pts, "id long, x array<double>")
    got = {r.id: r for r in V.open_set_gate(df, "x", prof, threshold=0.3).collect()}
    assert len(got) == len(pts) and got[91].reject_reason == V.REASON_NO_SAMPLE and got[91].predicted is None
    names = sorted(range(len(prof)), key=lambda i: prof[i][0])
    for i, x in pts:
        if x is None:
            continue
        d2 = np.array([((np.array(x) - prof[j][1]) ** 2).sum() for j in names])
        best = int(d2.argmin())
        p = 1 / np.exp(d2.min() - d2).sum()
        assert got[i].predicted == prof[names[best]][0], i
        assert abs(got[i].confidence - p) < 1e-9 and abs(got[i].distance - np.sqrt(d2.min())) < 1e-9
        ok = p >= 0.3 and np.sqrt(d2.min()) <= 1.5 * prof[names[best]][2]
        assert (got[i].person == got[i].predicted) if ok else got[i].person is None


def test_fifty_thousand_classes(spark):
    """A profile that would not fit a plan literal: every sample finds its own class."""
    k, d = 50_000, 16
    prof = spark.range(k).select(
        F.concat(F.lit("c"), F.col("id")).alias("person"), F.transform(F.sequence(F.lit(1), F.lit(d)), lambda i: (
            F.pmod(F.xxhash64("id", i), F.lit(1_000)) / 10).cast("double")).alias("centroid"),
        F.lit(1.0).alias("max_intra_class_distance"))
    df = prof.where("person IN ('c7', 'c123', 'c49999', 'c25000')").select(
        F.col("person").alias("truth"), F.transform("centroid", lambda v: v + 0.01).alias("x"))
    _, blocks, size = V.class_blocks(V._profile(prof))
    assert blocks > 5 and size > V.BLOCK_BYTES
    got = V.open_set_gate(df, "x", prof).collect()
    assert len(got) == 4 and all(r.person == r.truth and abs(r.distance - 0.04) < 1e-9 for r in got)


def test_predictions_of_any_model_meet_the_distance_rule(spark):
    prof = [("p", [0.0, 0.0], 1.0), ("q", [5.0, 5.0], 1.0)]
    rows = [(1, [0.5, 0.0], "p", 0.9), (2, [2.0, 0.0], "p", 0.9), (3, [5.0, 5.0], "q", 0.5), (4, None, None, None),
            (5, [0.0, 0.0], "unheard", 0.9)]
    df = spark.createDataFrame(rows, "id long, x array<double>, predicted string, confidence double")
    got = {r.id: (r.person, r.reject_reason, r.confidence) for r in V.gate_predictions(df, "x", prof).collect()}
    assert got == {1: ("p", None, 0.9), 2: (None, V.REASON_TOO_FAR, 0.9), 3: (None, V.REASON_LOW_CONFIDENCE, 0.5),
                   4: (None, V.REASON_NO_SAMPLE, 0.0), 5: ("unheard", None, 0.9)}


def test_rows_without_a_key_are_joined_in_one_pass(spark):
    """NULL keys are spread over the tasks of the join, and the left side is planned once."""
    from sparkgate.operators.ranking import join_apart
    left = spark.range(1_000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id"))).alias("key"))
    right = spark.range(0, 1_000, 20).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = join_apart(left, right, "key")
        parts = out.where("key IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 450
        assert {r.id: r.v for r in out.collect()} == {i: i if i % 20 == 0 else None for i in range(1_000)}
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Range") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_customer_rows_can_be_split(spark):
    """90 % of the profile rows on one customer: the join with the written aggregate is split."""
    from sparkgate.operators import features as FE
    n = 60_000
    prof = spark.range(n).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("customer_id"),
        F.lit("x").alias("social_media_platform"), (F.col("id") % 7).cast("double").alias("engagement_score"),
        F.lit(1.0).alias("purchase_interest_score"), F.lit("neutral").alias("review_sentiment"),
        F.col("id").alias("src_ord"))
    tx = spark.createDataFrame([], ", ".join(["customer_id string", "total_spent double", "average_spent double",
                                              "purchase_count bigint", "last_purchase timestamp_ntz", "fraud_rate double",
                                              "days_since_last_purchase bigint", "product_category string"]))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = FE.platform_table(prof.repartition(8), tx)
        assert len(out.collect()) == n
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_forest_rows_are_dealt_over_the_cores(spark):
    """A table that is small in bytes comes in one partition, which would grow all trees alone."""
    from sparkgate.operators import ml_train as MT
    one = spark.range(3 * MT.MIN_TASK_ROWS).withColumn("x", F.col("id") * 2).coalesce(1)
    dealt = MT.spread(one)
    assert dealt.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)
    assert dealt.count() == one.count() and dealt.exceptAll(one).isEmpty()
    few = one.limit(MT.MIN_TASK_ROWS)
    assert MT.spread(few) is few
    assert MT.random_forest().getCacheNodeIds()
