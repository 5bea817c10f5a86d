"""Decision operators: V5, V7, V8, J5-J8, P19-P22, A11."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_present, percent_text, sentiment_ordinal
from .ranking import join_apart

# Fixed values of the risk heuristic (V7/V8).
RISK_BASE = 0.15
RISK_FRAUD_W = 0.45
RISK_INTEREST_W = 0.15
RISK_ENGAGEMENT_W = 0.15
RISK_SENTIMENT_BONUS = 0.1
RISK_SENTIMENT_CUT = 0.75
NEUTRAL_INTEREST = 3.0
NEUTRAL_ENGAGEMENT = 60.0
APPROVE_BELOW = 0.25
CHALLENGE_BELOW = 0.5
DECISIONS = (("APPROVED", "legitimate"), ("CHALLENGE (face + voice)", "review"),
             ("DENIED", "suspicious"))
INTEREST_KEYS = ("avg_purchase_interest", "purchase_interest_score")
ENGAGEMENT_KEYS = ("avg_engagement_score", "average_engagement", "engagement_score")

# Fixed values of the attempt decision (V5) and the display.
GRANTED = "GRANTED"
DENIED_FACE = "DENIED_FACE"
DENIED_VOICE = "DENIED_VOICE"
DENIED_MISMATCH = "DENIED_MISMATCH"
NO_CUSTOMER = "NO_CUSTOMER"
DENIED_CLAIM = "DENIED_CLAIM"
STATUS_AUTHENTICATED = "Authenticated"
STATUS_DENIED = "Access Denied"
DISPLAY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The steps of an attempt's trace.
STEP_START = "Start"
STEP_FACE = "Submit Face"
STEP_FACE_RESULT = "Verify Face -> "
STEP_VOICE = "Submit Voice"
STEP_VOICE_RESULT = "Verify Voice -> "
STEP_MISMATCH = "Identity Check -> fail"
STEP_NO_CUSTOMER = "Customer Link -> missing"
STEP_RECOMMEND = "Run Product Recommendation"
STEP_DISPLAY = "Display Recommendation -> "
STEP_DENIED = "Access Denied"


def sentiment_value(df: DataFrame) -> Column:
    """0-2 sentiment: numeric average if present, else the text mapped, else 1."""
    if "avg_sentiment_score" in df.columns:
        base = F.col("avg_sentiment_score").cast("double")
        if "review_sentiment" in df.columns:
            return F.coalesce(base, F.when(F.col("review_sentiment").isNotNull(),
                                           sentiment_ordinal("review_sentiment").cast("double")),
                              F.lit(1.0))
        return F.coalesce(base, F.lit(1.0))
    if "review_sentiment" in df.columns:
        return F.when(F.col("review_sentiment").isNull(), F.lit(1.0)).otherwise(
            sentiment_ordinal("review_sentiment").cast("double"))
    return F.lit(1.0)


def risk_score_expr(df: DataFrame) -> Column:
    """V7 as one column expression (P19 name fallbacks, neutral defaults)."""
    fraud = first_present(df, ("fraud_rate",), 0.0)
    interest = first_present(df, INTEREST_KEYS, NEUTRAL_INTEREST)
    eng = first_present(df, ENGAGEMENT_KEYS, NEUTRAL_ENGAGEMENT)
    s = F.lit(RISK_BASE) + F.lit(RISK_FRAUD_W) * fraud
    s = s + F.greatest(F.lit(0.0), (F.lit(NEUTRAL_INTEREST) - interest) / F.lit(NEUTRAL_INTEREST)) \
        * F.lit(RISK_INTEREST_W)
    s = s + F.greatest(F.lit(0.0), (F.lit(NEUTRAL_ENGAGEMENT) - eng) / F.lit(NEUTRAL_ENGAGEMENT)) \
        * F.lit(RISK_ENGAGEMENT_W)
    s = s + F.when(sentiment_value(df) < F.lit(RISK_SENTIMENT_CUT), F.lit(RISK_SENTIMENT_BONUS)) \
        .otherwise(F.lit(0.0))
    return F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0))


def risk_scores(df: DataFrame) -> DataFrame:
    """V7 + V8: score, decision and label on every row."""
    out = df.withColumn("risk_score", risk_score_expr(df))
    sc = F.col("risk_score")
    (a, al), (c, cl), (d, dl) = DECISIONS
    return (out.withColumn("decision", F.when(sc < APPROVE_BELOW, a)
                           .when(sc < CHALLENGE_BELOW, c).otherwise(d))
               .withColumn("risk_label", F.when(sc < APPROVE_BELOW, al)
                           .when(sc < CHALLENGE_BELOW, cl).otherwise(dl)))


def filter_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """P20: case-insensitive key filter."""
    from ..functions.columns import strip_lower
    return df.where(strip_lower(key) == F.lit(str(value).strip().lower()))


def semi_by_keys(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """P20 batch form: rows whose key is listed, plus the listed keys with no row."""
    from ..functions.columns import strip_lower
    d = df.withColumn("_k", strip_lower(key))
    k = keys.select(strip_lower(key).alias("_k")).distinct()
    hit = d.join(k, "_k", "left_semi").drop("_k")
    miss = k.join(d.select("_k"), "_k", "left_anti").withColumnRenamed("_k", key)
    return hit, miss


def attempt_decisions(face: DataFrame, voice: DataFrame, ident: DataFrame,
                      claims: DataFrame | None = None) -> DataFrame:
    """V5 over whole tables. ``face``/``voice``: (attempt_id, person, confidence) where
    person NULL means rejected. ``ident``: (person, customer_id).

    Short-circuit order: face -> voice -> identity agreement -> (optional) claimed
    identity -> customer link. ``claims`` (attempt_id, claimed_person) adds the claim
    check as an extra predicate. Later-stage columns are NULL after a denial.
    """
    f = face.select("attempt_id", F.col("person").alias("face_person"),
                    F.col("confidence").alias("face_confidence"))
    v = voice.select("attempt_id", F.col("person").alias("voice_person"),
                     F.col("confidence").alias("voice_confidence"))
    return decide(f.join(v, "attempt_id", "full"), ident, claims)


def scored_attempts(attempts: DataFrame, face_gate: DataFrame, voice_gate: DataFrame) -> DataFrame:
    """Attempts ``(attempt_id, face_vec, voice_vec)`` with what the gates say of their samples,
    in one pass: a sample without a row, or no sample, is rejected with confidence 0."""
    out = attempts.select("attempt_id", "face_vec", "voice_vec")
    for gate, of in ((face_gate, "face"), (voice_gate, "voice")):
        out = join_apart(out, gate.select(F.col("vec_id").alias(f"{of}_vec"), F.col("person").alias(f"{of}_person"),
                                          F.col("confidence").alias(f"{of}_confidence")), f"{of}_vec")
    return out.select("attempt_id", "face_person", F.coalesce("face_confidence", F.lit(0.0)).alias("face_confidence"),
                      "voice_person", F.coalesce("voice_confidence", F.lit(0.0)).alias("voice_confidence"))


def decide(scored: DataFrame, ident: DataFrame, claims: DataFrame | None = None) -> DataFrame:
    """V5 for attempts ``(attempt_id, face_person, face_confidence, voice_person,
    voice_confidence)``; see ``attempt_decisions``."""
    j = scored
    if claims is not None:
        j = j.join(claims.select("attempt_id", "claimed_person"), "attempt_id", "left")
    # The identity map is a people dimension; AQE broadcasts it when its measured
    # size is under the threshold and keeps a shuffle join otherwise.
    # Rejected faces have no person; a stand-in spreads them over the tasks of the join.
    j = join_apart(j, ident.select(F.col("person").alias("face_person"), "customer_id"), "face_person")
    fp, vp = F.col("face_person"), F.col("voice_person")
    outcome = (F.when(fp.isNull(), F.lit(DENIED_FACE))
               .when(vp.isNull(), F.lit(DENIED_VOICE))
               .when(~fp.eqNullSafe(vp), F.lit(DENIED_MISMATCH)))
    if claims is not None:
        outcome = outcome.when(~fp.eqNullSafe(F.col("claimed_person")), F.lit(DENIED_CLAIM))
    outcome = (outcome.when(F.col("customer_id").isNull(), F.lit(NO_CUSTOMER))
               .otherwise(F.lit(GRANTED)))
    voice_ran = fp.isNotNull()
    return j.select(
        "attempt_id", "face_person", "face_confidence",
        F.when(voice_ran, vp).alias("voice_person"),
        F.when(voice_ran, F.col("voice_confidence")).alias("voice_confidence"),
        F.when(outcome.isin(NO_CUSTOMER, GRANTED), F.col("customer_id")).alias("customer_id"),
        outcome.alias("outcome"),
        (outcome == F.lit(GRANTED)).alias("granted"))


def attempt_samples(attempts: DataFrame, gate: DataFrame, vec_col: str) -> DataFrame:
    """``attempt_id, person, confidence`` of every attempt: one whose sample has no row is
    rejected with confidence 0."""
    g = gate.select(F.col("vec_id").alias(vec_col), "person", "confidence")
    return attempts.join(g, vec_col, "left").select(
        "attempt_id", "person", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def with_customer(decisions: DataFrame, customers: DataFrame) -> DataFrame:
    """Decisions with the customer's columns, NULL for those without a customer."""
    return join_apart(decisions, customers, "customer_id").select(
        *decisions.columns, *[c for c in customers.columns if c != "customer_id"])


def denial_audit(decisions: DataFrame) -> DataFrame:
    """Attempts and denials by outcome, with the all-denied flag per outcome."""
    return decisions.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(~F.col("granted")).alias("denied"),
        F.bool_and(~F.col("granted")).alias("all_denied"))


def attempt_trace(decisions: DataFrame, rec_col: str | None = None) -> DataFrame:
    """Ordered trace steps per attempt, one row per step."""
    o = F.col("outcome")
    face_pass = o != F.lit(DENIED_FACE)
    voice_pass = ~o.isin(DENIED_FACE, DENIED_VOICE)
    steps = F.array(
        F.lit(STEP_START), F.lit(STEP_FACE),
        F.concat(F.lit(STEP_FACE_RESULT), F.when(face_pass, "pass").otherwise("fail")),
        F.when(face_pass, F.lit(STEP_VOICE)),
        F.when(face_pass, F.concat(F.lit(STEP_VOICE_RESULT),
                                   F.when(voice_pass, "pass").otherwise("fail"))),
        F.when(o == F.lit(DENIED_MISMATCH), F.lit(STEP_MISMATCH)),
        F.when(o == F.lit(NO_CUSTOMER), F.lit(STEP_NO_CUSTOMER)),
        F.when(o == F.lit(GRANTED), F.lit(STEP_RECOMMEND)),
        F.when(o == F.lit(GRANTED), F.concat(
            F.lit(STEP_DISPLAY),
            F.coalesce(F.col(rec_col), F.lit("unknown")) if rec_col else F.lit("unknown"))),
        F.when(o != F.lit(GRANTED), F.lit(STEP_DENIED)))
    kept = F.filter(steps, lambda x: x.isNotNull())
    return decisions.select("attempt_id", F.posexplode(kept).alias("step_no", "step")).select(
        "attempt_id", (F.col("step_no") + 1).cast("int").alias("step_no"), "step")


def display_rows(df: DataFrame, product: str, confidence: str, granted: str, ts: str) -> DataFrame:
    """Product, percent text, status and formatted timestamp. Out-of-range
    confidence is not rendered: it is kept with ``valid = false``."""
    c = F.col(confidence)
    valid = c.isNotNull() & (c >= 0) & (c <= 1)
    return df.select(
        "*",
        F.col(product).alias("recommended_product"),
        F.when(valid, percent_text(c)).alias("confidence_percent"),
        F.when(F.col(granted), F.lit(STATUS_AUTHENTICATED)).otherwise(F.lit(STATUS_DENIED))
        .alias("authentication_status"),
        F.date_format(F.col(ts), DISPLAY_TS_FORMAT).alias("formatted_timestamp"),
        valid.alias("valid"))
