"""Attempt decisions, risk score, display projection and metrics on literal rows."""

import datetime as dt

import numpy as np
import pandas as pd

from sparkgate.operators import decide as D
from sparkgate.operators import metrics as M
from sparkgate.operators import verify as V

RES = "attempt_id long, person string, confidence double"


def test_decision_branches(spark):
    """Granted, denied face, denied voice, mismatch, no linked customer."""
    face = spark.createDataFrame([(1, "p1", .9), (2, None, .3), (3, "p1", .8), (4, "p1", .9),
                                  (5, "p3", .9)], RES)
    voice = spark.createDataFrame([(1, "p1", .9), (2, "p1", .9), (3, None, .2), (4, "p2", .9),
                                   (5, "p3", .9)], RES)
    ident = spark.createDataFrame([("p1", "a178"), ("p2", "a190")], "person string, customer_id string")
    out = {r["attempt_id"]: r for r in D.attempt_decisions(face, voice, ident).collect()}
    assert out[1]["outcome"] == "GRANTED" and out[1]["customer_id"] == "a178"
    assert out[2]["outcome"] == "DENIED_FACE" and out[2]["voice_person"] is None
    assert out[3]["outcome"] == "DENIED_VOICE"
    assert out[4]["outcome"] == "DENIED_MISMATCH" and out[4]["customer_id"] is None
    assert out[5]["outcome"] == "NO_CUSTOMER"
    audit = {r["outcome"]: r for r in D.denial_audit(D.attempt_decisions(face, voice, ident))
             .collect()}
    assert audit["GRANTED"]["denied"] == 0 and audit["DENIED_FACE"]["all_denied"]


def test_trace_steps(spark):
    dec = spark.createDataFrame([(1, "DENIED_FACE", "x"), (2, "GRANTED", "travel")],
                                "attempt_id long, outcome string, cat string")
    steps = {}
    for r in D.attempt_trace(dec, "cat").orderBy("attempt_id", "step_no").collect():
        steps.setdefault(r["attempt_id"], []).append(r["step"])
    assert steps[1] == ["Start", "Submit Face", "Verify Face -> fail", "Access Denied"]
    assert steps[2][-1] == "Display Recommendation -> travel"
    assert "Access Denied" not in steps[2]


def test_display_percent_and_timestamp(spark):
    """0.874 -> 87%, half-even percent, timestamp format, out of range not shown."""
    ts = dt.datetime(2026, 7, 17, 12, 10, 5)
    df = spark.createDataFrame([("card", 0.874, True, ts), ("card", 0.125, False, ts),
                                ("card", 1.5, True, ts)],
                               "p string, c double, g boolean, ts timestamp_ntz")
    out = D.display_rows(df, "p", "c", "g", "ts").collect()
    assert out[0]["confidence_percent"] == "87%"
    assert out[0]["formatted_timestamp"] == "2026-07-17 12:10:05"
    assert out[0]["authentication_status"] == "Authenticated"
    assert out[1]["confidence_percent"] == "12%"
    assert out[1]["authentication_status"] == "Access Denied"
    assert out[2]["valid"] is False and out[2]["confidence_percent"] is None


def test_risk_score_boundaries(spark):
    rows = [(0.0, 3.0, 60.0, "positive"),    # 0.15 -> APPROVED
            (0.0, 3.0, 60.0, "negative"),    # 0.25 -> CHALLENGE (>= .25)
            (1.0, 3.0, 60.0, "positive"),    # 0.60 -> DENIED
            (None, None, None, None)]        # neutral defaults -> 0.15
    df = spark.createDataFrame(rows, "fraud_rate double, purchase_interest_score double, "
                                     "engagement_score double, review_sentiment string")
    out = D.risk_scores(df).collect()
    assert [r["decision"] for r in out] == ["APPROVED", "CHALLENGE (face + voice)", "DENIED",
                                            "APPROVED"]
    assert abs(out[1]["risk_score"] - 0.25) < 1e-12


def test_open_set_gate_rules(spark):
    prof = [("p1", [0.0, 0.0], 1.0), ("p2", [10.0, 10.0], 1.0)]
    df = spark.createDataFrame([(1, [0.1, 0.0]), (2, [5.0, 5.0]), (3, [-1.49, 0.0]),
                                (4, [-1.6, 0.0]), (5, None)], "id long, x array<double>")
    out = {r["id"]: r for r in V.open_set_gate(df, "x", prof).collect()}
    assert out[1]["person"] == "p1"
    assert out[2]["reject_reason"] == "low_confidence"           # equidistant: 0.5 < 0.6
    assert out[3]["person"] == "p1"                              # 1.49 <= 1.5
    assert out[4]["reject_reason"] == "outside_class_radius"     # 1.6 > 1.5
    assert out[5]["reject_reason"] == "no_sample" and out[5]["confidence"] == 0.0


def test_macro_metrics_include_absent_labels(spark):
    """Macro average over the given label list, zero division -> 0."""
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")],
                                 "y_true string, y_pred string")
    labels = M.label_table(spark, ["a", "b", "c"])
    r = M.macro_metrics(pred, labels).first()
    assert abs(r["accuracy"] - 0.75) < 1e-12
    p = [1.0, 2 / 3, 0.0]
    rec = [0.5, 1.0, 0.0]
    f1 = [2 * a * b / (a + b) if a + b else 0 for a, b in zip(p, rec)]
    assert abs(r["precision_macro"] - np.mean(p)) < 1e-12
    assert abs(r["recall_macro"] - np.mean(rec)) < 1e-12
    assert abs(r["f1_macro"] - np.mean(f1)) < 1e-12


def test_roc_auc_matches_pairwise_count(spark):
    rng = np.random.default_rng(2)
    n = 400
    y = rng.choice(["a", "b", "c"], n)
    raw = rng.integers(1, 6, (n, 3)).astype(float)          # many ties
    pr = raw / raw.sum(axis=1, keepdims=True)
    pdf = pd.DataFrame({"y_true": y, "proba": list(pr)})
    df = spark.createDataFrame(pdf, "y_true string, proba array<double>")
    got = {r["label"]: r["auc"] for r in M.roc_auc_ovr(df, ["a", "b", "c"]).collect()}
    tot = pr[:, 0] + pr[:, 1] + pr[:, 2]                   # renormalised like the operator
    for j, lab in enumerate(["a", "b", "c"]):
        s = pr[:, j] / tot
        pos, neg = s[y == lab], s[y != lab]
        want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) \
            / (len(pos) * len(neg))
        assert abs(got[lab] - want) < 1e-12


def test_log_loss_clips(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0])],
                               "y_true string, proba array<double>")
    r = M.log_loss(df, ["a", "b"]).first()
    assert abs(r["log_loss"] - (-np.log(1 - M.LOG_LOSS_EPS) - np.log(M.LOG_LOSS_EPS)) / 2) < 1e-9


def test_gate_is_monotone_in_threshold_and_margin(spark):
    """Invariant: a higher threshold never accepts more, a wider margin never rejects more."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rng = np.random.default_rng(4)
    pts = rng.normal(0, 1, (60, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)],
                               "id long, x array<double>").cache()
    prof = [("a", [0.0, 0.0, 0.0], 1.5), ("b", [1.0, 1.0, 0.0], 1.2), ("c", [-1.0, 0.5, 1.0], 1.0)]

    def accepted(t, m):
        g = V.open_set_gate(df, "x", prof, threshold=t, margin=m)
        return {r["id"] for r in g.where("person IS NOT NULL").select("id").collect()}

    @settings(max_examples=8, deadline=None)
    @given(st.floats(0.3, 0.9), st.floats(0.0, 0.3), st.floats(0.5, 2.0), st.floats(0.0, 1.0))
    def check(t, dt_, m, dm):
        assert accepted(t + dt_, m) <= accepted(t, m)
        assert accepted(t, m) <= accepted(t, m + dm)
    check()
    df.unpersist()


def test_claimed_identity_is_an_optional_predicate(spark):
    face = spark.createDataFrame([(1, "p1", .9), (2, "p1", .9)], RES)
    voice = spark.createDataFrame([(1, "p1", .9), (2, "p1", .9)], RES)
    ident = spark.createDataFrame([("p1", "a178")], "person string, customer_id string")
    claims = spark.createDataFrame([(1, "p1"), (2, "p2")], "attempt_id long, claimed_person string")
    out = {r["attempt_id"]: r["outcome"]
           for r in D.attempt_decisions(face, voice, ident, claims).collect()}
    assert out == {1: "GRANTED", 2: "DENIED_CLAIM"}
    plain = {r["attempt_id"]: r["outcome"]
             for r in D.attempt_decisions(face, voice, ident).collect()}
    assert plain == {1: "GRANTED", 2: "GRANTED"}
