"""Role views: the driver's test tables mapped onto the engine's input tables.

The same expressions appear in the oracle SQL (``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

# Fixed values of the role mapping.
ROLE_REFERENCE_DAY = "2001-09-01 12:00:00"
SENTIMENTS = ["Positive", "Neutral", "Negative"]          # by event_id % 3
FSM_EVENT_OF = {"signup": "START", "view": "VERIFICATION_PASSED",
                "error": "VERIFICATION_FAILED", "purchase": "RECOMMENDATION_READY",
                "click": "CLICK"}
# every so many rows lack a value or hold a bad one, so that fills and rejects have work
NO_SCORE, NO_INTEREST = 101, 103
NO_DATE, NO_AMOUNT, NEGATIVE_AMOUNT = 83, 89, 97
FACE_DIMS = (1, 32)     # 1-based start, length
VOICE_DIMS = (33, 32)
GROUP_VARIANTS = 5      # group = label || '_' || (vec_id % 5)
IDENTITY_STRIDE = 17    # person p -> customer 'a' || (p * 17)
SCORE_CLASSES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def profiles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    sent = F.element_at(F.array(*[F.lit(s) for s in SENTIMENTS]),
                        (F.col("event_id") % 3 + 1).cast("int"))
    return ev.select(
        F.concat(F.lit(" A"), F.col("user_id").cast("string"), F.lit(" ")).alias("customer_id"),
        F.upper("event_type").alias("social_media_platform"),
        F.when(F.col("event_id") % NO_SCORE != 0, F.col("value") / 5).alias("engagement_score"),
        F.when(F.col("event_id") % NO_INTEREST != 0, F.lit(1) + (k % 41) / 10)
        .alias("purchase_interest_score"),
        sent.alias("review_sentiment"),
        F.col("event_id").alias("src_ord"))


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(F.col("o_orderkey") % NO_DATE != 0, F.col("o_orderdate")).alias("timestamp"),
        F.when(F.col("o_orderkey") % NEGATIVE_AMOUNT == 0, -F.col("o_totalprice"))
        .when(F.col("o_orderkey") % NO_AMOUNT != 0, F.col("o_totalprice")).alias("amount"),
        F.col("o_orderpriority").alias("category"),
        (F.col("o_orderstatus") == "F").alias("is_fraud"),
        F.col("o_orderkey").alias("src_ord"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as identity samples: face = dims 1-32, voice = dims 33-64."""
    e = read_table(spark, sf_dir, "embeddings")
    f0, fl = FACE_DIMS
    v0, vl = VOICE_DIMS
    return e.select(
        "vec_id",
        F.col("label").cast("string").alias("person"),
        F.concat_ws("_", F.col("label").cast("string"),
                    (F.col("vec_id") % GROUP_VARIANTS).cast("string")).alias("group_id"),
        F.transform(F.slice("embedding", f0, fl), lambda v: v.cast("double")).alias("face"),
        F.transform(F.slice("embedding", v0, vl), lambda v: v.cast("double")).alias("voice"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Face sample i with voice sample (7 i + 3) mod n; claimed person = label of i."""
    s = samples(spark, sf_dir)
    n = s.count()  # one scalar
    voice = ((F.col("vec_id") * 7 + 3) % F.lit(n)) if n else F.lit(None).cast("bigint")
    return s.select(F.col("vec_id").alias("attempt_id"), F.col("vec_id").alias("face_vec"),
                    F.col("person").alias("claimed_person"), voice.alias("voice_vec"))


def identity_map(spark: SparkSession, sf_dir: str, customers: DataFrame) -> DataFrame:
    """Person -> customer link, only where that customer exists (J5 misses exercised)."""
    people = samples(spark, sf_dir).select("person").distinct()
    cand = people.select("person", F.concat(
        F.lit("a"), (F.col("person").cast("bigint") * IDENTITY_STRIDE).cast("string"))
        .alias("customer_id"))
    return cand.join(customers.select("customer_id"), "customer_id", "left_semi")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows: five class scores ((orderkey * (j + 3)) % 97 + 1), normalised."""
    o = read_table(spark, sf_dir, "orders")
    raw = [((F.col("o_orderkey") * (j + 3)) % 97 + 1).cast("double") for j in range(5)]
    tot = raw[0] + raw[1] + raw[2] + raw[3] + raw[4]
    proba = F.array(*[r / tot for r in raw])
    cls = F.array(*[F.lit(c) for c in SCORE_CLASSES])
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").alias("y_true"),
        proba.alias("proba")).withColumn(
        "y_pred", F.element_at(cls, F.array_position("proba", F.array_max("proba")).cast("int")))


def fsm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session = user x day, ordered by (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events")
    m = F.create_map(*[x for k, v in FSM_EVENT_OF.items() for x in (F.lit(k), F.lit(v))])
    return ev.select(
        F.col("user_id"), F.to_date("ts").alias("day"), "ts", "event_id",
        F.coalesce(F.element_at(m, F.col("event_type")), F.upper("event_type")).alias("event"))
