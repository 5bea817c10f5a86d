"""DuckDB oracle SQL for every registered query that has an SQL equivalent."""

from __future__ import annotations

from .oracle_base import with_roles

ORACLE: dict[str, str] = {}


def _half_even_6(text: str) -> str:
    """Spell every ``round(expr, 6)`` as the Spark side's stable rounding: to 9
    decimals first, then half-to-even at 6 in decimal arithmetic."""
    out, i, key = [], 0, "round("
    while True:
        j = text.find(key, i)
        if j < 0 or (j > 0 and (text[j - 1].isalnum() or text[j - 1] == "_")):
            if j < 0:
                out.append(text[i:])
                return "".join(out)
            out.append(text[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        inner = text[j + len(key):k - 1]
        if inner.rstrip().endswith(", 6"):
            expr = inner.rstrip()[:-3]
            out.append(text[i:j] + f"CAST(round_even(CAST(({expr}) AS DECIMAL(38,9)), 6) AS DOUBLE)")
        else:
            out.append(text[i:k])
        i = k


def sql(name: str, body: str) -> None:
    ORACLE[name] = with_roles(_half_even_6(body))


# ---------------------------------------------------------------- data quality
sql("dq_profile_events", """
, g AS (SELECT customer_id, social_media_platform, engagement_score, purchase_interest_score,
               review_sentiment, count(*) AS m FROM profiles_raw GROUP BY ALL),
a AS (SELECT sum(m) AS rows, count(*) AS distinct_rows,
             sum(CASE WHEN customer_id IS NOT NULL THEN m END) AS id_rows,
             count(DISTINCT customer_id) AS unique_ids,
             sum(CASE WHEN customer_id IS NULL THEN m ELSE 0 END) AS n1,
             sum(CASE WHEN social_media_platform IS NULL THEN m ELSE 0 END) AS n2,
             sum(CASE WHEN engagement_score IS NULL THEN m ELSE 0 END) AS n3,
             sum(CASE WHEN purchase_interest_score IS NULL THEN m ELSE 0 END) AS n4,
             sum(CASE WHEN review_sentiment IS NULL THEN m ELSE 0 END) AS n5
      FROM g)
SELECT 'rows' AS metric, CAST(rows AS BIGINT) AS value FROM a
UNION ALL SELECT 'columns', 5 FROM a
UNION ALL SELECT 'duplicate_rows', CAST(rows - distinct_rows AS BIGINT) FROM a
UNION ALL SELECT 'duplicate_ids', CAST(coalesce(id_rows, 0) - unique_ids AS BIGINT) FROM a
UNION ALL SELECT 'unique_ids', CAST(unique_ids AS BIGINT) FROM a
UNION ALL SELECT 'null_customer_id', CAST(n1 AS BIGINT) FROM a
UNION ALL SELECT 'null_social_media_platform', CAST(n2 AS BIGINT) FROM a
UNION ALL SELECT 'null_engagement_score', CAST(n3 AS BIGINT) FROM a
UNION ALL SELECT 'null_purchase_interest_score', CAST(n4 AS BIGINT) FROM a
UNION ALL SELECT 'null_review_sentiment', CAST(n5 AS BIGINT) FROM a
""")

sql("dq_distribution", """
SELECT social_media_platform, count(*) AS n_rows FROM profiles_clean GROUP BY 1
""")

sql("dq_expectations", """
SELECT 'tx_customer_id_not_null' AS "check", count(*) FILTER (WHERE customer_id IS NULL) = 0 AS passed,
       CAST(count(*) FILTER (WHERE customer_id IS NULL) AS BIGINT) AS observed FROM tx_valid
UNION ALL
SELECT 'tx_amount_positive', count(*) FILTER (WHERE amount IS NULL OR amount <= 0) = 0,
       CAST(count(*) FILTER (WHERE amount IS NULL OR amount <= 0) AS BIGINT) FROM tx_valid
UNION ALL
SELECT 'tx_timestamp_not_null', count(*) FILTER (WHERE ts IS NULL) = 0,
       CAST(count(*) FILTER (WHERE ts IS NULL) AS BIGINT) FROM tx_valid
UNION ALL
SELECT 'profiles_no_nulls', n = 0, CAST(n AS BIGINT) FROM (
  SELECT count(*) FILTER (WHERE customer_id IS NULL) + count(*) FILTER (WHERE social_media_platform IS NULL)
       + count(*) FILTER (WHERE engagement_score IS NULL) + count(*) FILTER (WHERE purchase_interest_score IS NULL)
       + count(*) FILTER (WHERE review_sentiment IS NULL) + count(*) FILTER (WHERE src_ord IS NULL) AS n
  FROM profiles_clean)
UNION ALL
SELECT 'platform_ids_lowercase', count(*) FILTER (WHERE customer_id <> lower(customer_id)) = 0,
       CAST(count(*) FILTER (WHERE customer_id <> lower(customer_id)) AS BIGINT) FROM platform_tbl
UNION ALL
SELECT 'customer_table_unique_key', count(*) - count(DISTINCT customer_id) = 0,
       CAST(count(*) - count(DISTINCT customer_id) AS BIGINT) FROM customer_tbl
UNION ALL
SELECT 'platform_rows_preserved', d = 0, CAST(d AS BIGINT) FROM (
  SELECT (SELECT count(*) FROM platform_tbl) - (SELECT count(*) FROM profiles_clean) AS d)
""")

sql("dq_key_overlap", """
, a AS (SELECT DISTINCT customer_id FROM profiles_clean WHERE customer_id IS NOT NULL),
b AS (SELECT DISTINCT customer_id FROM tx_valid WHERE customer_id IS NOT NULL)
SELECT (SELECT count(*) FROM a) AS n_left_keys, (SELECT count(*) FROM b) AS n_right_keys,
       (SELECT count(*) FROM (SELECT customer_id FROM a INTERSECT SELECT customer_id FROM b))
         AS n_overlap
""")

sql("dq_match_rate", """
SELECT round(avg(CAST(tx_matched AS DOUBLE)), 6) AS match_rate,
       avg(CAST(tx_matched AS DOUBLE)) >= 0.5 AS passed
FROM platform_tbl
""")

# ---------------------------------------------------------------- cleaning
sql("clean_profiles", """
SELECT customer_id, social_media_platform, round(engagement_score, 6) AS engagement_score,
       round(purchase_interest_score, 6) AS purchase_interest_score, review_sentiment, src_ord
FROM profiles_clean
""")

sql("clean_transactions", """
SELECT transaction_id, customer_id, ts AS "timestamp", round(amount, 6) AS amount, category,
       is_fraud, src_ord
FROM tx_valid
""")

sql("rejects_by_reason", """
SELECT coalesce(reject_reason, 'ok') AS reason, count(*) AS n_rows FROM tx_reason GROUP BY 1
""")

sql("winsorized_orders", """
SELECT transaction_id, customer_id, round(amount_raw, 6) AS amount_raw, round(amount, 6) AS amount,
       was_clipped
FROM tx_clean
""")

# ---------------------------------------------------------------- features
sql("rfm_customer", """
SELECT customer_id, round(total_spent, 6) AS total_spent, round(average_spent, 6) AS average_spent,
       purchase_count, last_purchase, round(fraud_rate, 6) AS fraud_rate
FROM tx_rfm
""")

sql("recency_days", """
SELECT customer_id, last_purchase, days_since_last_purchase FROM tx_rfm
""")

sql("mode_category_first_seen", """
SELECT customer_id, product_category FROM tx_mode
""")

sql("mode_platform_alpha", """
SELECT customer_id, social_media_platform AS primary_platform FROM (
  SELECT customer_id, social_media_platform,
         row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, social_media_platform ASC) AS rn
  FROM (SELECT customer_id, social_media_platform, count(*) AS n FROM profiles_clean
        WHERE social_media_platform IS NOT NULL GROUP BY 1, 2))
WHERE rn = 1
""")

sql("social_aggregates", """
SELECT customer_id, round(average_engagement, 6) AS average_engagement,
       round(average_purchase_interest, 6) AS average_purchase_interest, platform_count
FROM soc
""")

_PLATFORM_SELECT = """
SELECT customer_id, social_media_platform, round(engagement_score, 6) AS engagement_score,
       round(purchase_interest_score, 6) AS purchase_interest_score, review_sentiment,
       round(total_spent, 6) AS total_spent, round(average_spent, 6) AS average_spent,
       purchase_count, last_purchase, round(fraud_rate, 6) AS fraud_rate,
       days_since_last_purchase, product_category,
       round(average_engagement, 6) AS average_engagement, platform_count, main_platform, src_ord
FROM platform_tbl
"""
sql("platform_table", _PLATFORM_SELECT)
sql("platform_table_bucketed", _PLATFORM_SELECT)

sql("customer_table", """
SELECT customer_id, round(engagement_score, 6) AS engagement_score,
       round(purchase_interest_score, 6) AS purchase_interest_score, review_sentiment,
       round(average_engagement, 6) AS average_engagement, platform_count, main_platform,
       round(total_spent, 6) AS total_spent, round(average_spent, 6) AS average_spent,
       purchase_count, last_purchase, round(fraud_rate, 6) AS fraud_rate,
       days_since_last_purchase, product_category
FROM customer_tbl
""")

# Legacy features computed the way the legacy code does: materialise the
# many-to-many join, then aggregate (the oracle may emit the pairs).
sql("legacy_customer_features", """
, pairs AS (
  SELECT p.customer_id, t.transaction_id, coalesce(t.amount, 0) AS amount, t.is_fraud,
         p.engagement_score, p.purchase_interest_score, p.social_media_platform,
         coalesce(CASE lower(trim(p.review_sentiment)) WHEN 'negative' THEN 0
                  WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END, 1) AS sentiment_score
  FROM profiles_clean p JOIN tx_valid t ON p.customer_id = t.customer_id),
prim AS (
  SELECT customer_id, social_media_platform AS primary_platform FROM (
    SELECT customer_id, social_media_platform,
           row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, social_media_platform) AS rn
    FROM (SELECT customer_id, social_media_platform, count(*) AS n FROM pairs GROUP BY 1, 2))
  WHERE rn = 1),
agg AS (
  SELECT customer_id, count(DISTINCT transaction_id) AS purchase_count,
         CAST(round_even(CAST(sum(CAST(amount AS DECIMAL(38,9))) / count(*) AS DECIMAL(38,9)), 2)
              AS DOUBLE) AS average_spent,
         CAST(round_even(sum(CAST(amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS total_spent,
         CAST(sum(CAST(is_fraud AS BIGINT)) AS BIGINT) AS fraud_count,
         CAST(round_even(CAST(sum(CAST(engagement_score AS DECIMAL(38,9))) / count(*)
              AS DECIMAL(38,9)), 2) AS DOUBLE) AS avg_engagement_score,
         CAST(round_even(CAST(sum(CAST(purchase_interest_score AS DECIMAL(38,9))) / count(*)
              AS DECIMAL(38,9)), 2) AS DOUBLE) AS avg_purchase_interest,
         CAST(round_even(CAST(sum(CAST(sentiment_score AS DECIMAL(38,9))) / count(*)
              AS DECIMAL(38,9)), 2) AS DOUBLE) AS avg_sentiment_score,
         count(DISTINCT social_media_platform) AS platform_count
  FROM pairs GROUP BY customer_id)
SELECT a.customer_id, a.purchase_count, round(a.average_spent, 6) AS average_spent,
       round(a.total_spent, 6) AS total_spent, a.fraud_count,
       round(a.avg_engagement_score, 6) AS avg_engagement_score,
       round(a.avg_purchase_interest, 6) AS avg_purchase_interest,
       round(a.avg_sentiment_score, 6) AS avg_sentiment_score, a.platform_count,
       p.primary_platform,
       round(round_even(a.fraud_count / a.purchase_count * 1000, 0) / 1000, 6) AS fraud_rate,
       CAST(round_even(a.avg_engagement_score * 12, 0) AS BIGINT) AS likes,
       CAST(round_even(a.avg_engagement_score * 3, 0) AS BIGINT) AS comments,
       CAST(round_even(a.avg_engagement_score * 40 + a.platform_count * 100, 0) AS BIGINT) AS followers
FROM agg a LEFT JOIN prim p USING (customer_id)
""")

sql("dedupe_best_platform", """
SELECT customer_id, social_media_platform, round(engagement_score, 6) AS engagement_score,
       round(purchase_interest_score, 6) AS purchase_interest_score, review_sentiment, src_ord
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                   ORDER BY engagement_score DESC NULLS LAST, src_ord) AS rn
      FROM profiles_clean)
WHERE rn = 1
""")

sql("first_row_per_customer", """
SELECT customer_id, social_media_platform, round(engagement_score, 6) AS engagement_score,
       round(purchase_interest_score, 6) AS purchase_interest_score, review_sentiment, src_ord
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY src_ord) AS rn
      FROM profiles_clean)
WHERE rn = 1
""")

sql("topk_customers", """
SELECT customer_id, round(total_spent, 6) AS total_spent, purchase_count
FROM customer_tbl ORDER BY total_spent DESC, customer_id ASC LIMIT 20
""")

sql("distinct_customers", """
SELECT DISTINCT customer_id FROM platform_tbl
""")

# ---------------------------------------------------------------- risk
_RISK = """
, risk AS (
  SELECT customer_id, src_ord,
         least(greatest(
           0.15 + 0.45 * coalesce(fraud_rate, 0.0)
           + greatest(0.0, (3.0 - coalesce(purchase_interest_score, 3.0)) / 3.0) * 0.15
           + greatest(0.0, (60.0 - coalesce(average_engagement, engagement_score, 60.0)) / 60.0) * 0.15
           + CASE WHEN (CASE WHEN review_sentiment IS NULL THEN 1.0
                             ELSE coalesce(CASE lower(trim(review_sentiment)) WHEN 'negative' THEN 0
                                           WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END, 1) END)
                       < 0.75 THEN 0.1 ELSE 0.0 END, 0.0), 1.0) AS risk_score
  FROM platform_tbl),
risk2 AS (
  SELECT *, CASE WHEN risk_score < 0.25 THEN 'APPROVED' WHEN risk_score < 0.5
                 THEN 'CHALLENGE (face + voice)' ELSE 'DENIED' END AS decision,
            CASE WHEN risk_score < 0.25 THEN 'legitimate' WHEN risk_score < 0.5 THEN 'review'
                 ELSE 'suspicious' END AS risk_label
  FROM risk)
"""
sql("risk_score", _RISK + """
SELECT customer_id, src_ord, round(risk_score, 6) AS risk_score, decision, risk_label FROM risk2
""")
sql("risk_decision", _RISK + """
SELECT decision, risk_label, count(*) AS n_rows FROM risk2 GROUP BY 1, 2
""")


def sql_rec(name: str, body: str) -> None:
    ORACLE[name] = with_roles(_half_even_6(body), recursive=True)


# ---------------------------------------------------------------- model preparation
_SPLIT = """
, cls AS (SELECT product_category, count(*) AS n_class FROM customer_tbl GROUP BY 1),
tot AS (SELECT sum(n_class) AS n,
               CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n_class)) AS BIGINT) AS n_test FROM cls),
q AS (SELECT c.product_category, c.n_class, (t.n_test * c.n_class) // t.n AS fl,
             (t.n_test * c.n_class) % t.n AS rem, t.n_test FROM cls c, tot t),
q2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, product_category) AS ord,
              n_test - sum(fl) OVER () AS seats FROM q),
sizes AS (SELECT product_category, fl + CASE WHEN ord <= seats THEN 1 ELSE 0 END AS n_test FROM q2),
ranked AS (
  SELECT customer_id, product_category,
         row_number() OVER (PARTITION BY product_category
                            ORDER BY md5('42' || customer_id), customer_id) - 1 AS rk
  FROM customer_tbl),
split AS (
  SELECT r.customer_id, r.product_category,
         CASE WHEN r.rk < s.n_test THEN 'test' ELSE 'train' END AS split
  FROM ranked r JOIN sizes s ON r.product_category = s.product_category)
"""

sql("class_weights", _SPLIT + """
SELECT product_category, n_class,
       round(sum(n_class) OVER () / (count(*) OVER () * n_class), 6) AS weight
FROM (SELECT product_category, count(*) AS n_class FROM split WHERE split = 'train' GROUP BY 1)
""")

sql("scaler_stats", """
SELECT CAST(pos AS INTEGER) AS pos, round(mean, 6) AS mean, round(std, 6) AS std FROM face_stats
""")

sql("one_hot_platform", """
, vals AS (SELECT main_platform, dense_rank() OVER (ORDER BY main_platform) - 1 AS idx
           FROM (SELECT DISTINCT main_platform FROM customer_tbl))
SELECT c.customer_id, c.main_platform, CAST(v.idx AS INTEGER) AS platform_index,
       CAST(v.idx AS INTEGER) AS platform_active
FROM customer_tbl c JOIN vals v ON c.main_platform = v.main_platform
""")

sql("impute_median_mode", """
, modes AS (
  SELECT feature, v FROM (
    SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS rn
    FROM (SELECT 'review_sentiment' AS feature, review_sentiment AS v, count(*) AS n
          FROM customer_tbl WHERE review_sentiment IS NOT NULL GROUP BY 2
          UNION ALL
          SELECT 'main_platform', main_platform, count(*) FROM customer_tbl
          WHERE main_platform IS NOT NULL GROUP BY 2))
  WHERE rn = 1)
SELECT 'engagement_score' AS feature, 'median' AS statistic,
       round(quantile_cont(engagement_score, 0.5), 6) AS value_num, CAST(NULL AS VARCHAR) AS value_str
FROM customer_tbl
UNION ALL SELECT 'purchase_interest_score', 'median', round(quantile_cont(purchase_interest_score, 0.5), 6), NULL
FROM customer_tbl
UNION ALL SELECT 'average_engagement', 'median', round(quantile_cont(average_engagement, 0.5), 6), NULL
FROM customer_tbl
UNION ALL SELECT 'platform_count', 'median', round(quantile_cont(CAST(platform_count AS DOUBLE), 0.5), 6), NULL
FROM customer_tbl
UNION ALL SELECT feature, 'most_frequent', NULL, v FROM modes
""")

sql("stratified_holdout", _SPLIT + """
SELECT customer_id, product_category, split FROM split
""")

sql("stratified_folds", """
SELECT customer_id, product_category,
       CAST((row_number() OVER (PARTITION BY product_category
                                ORDER BY md5('42' || customer_id), customer_id) - 1) % 2 AS INTEGER)
         AS fold
FROM customer_tbl
""")

_GROUP_FOLDS = """
, grp AS (
  SELECT group_id, person FROM (
    SELECT group_id, person, row_number() OVER (PARTITION BY group_id ORDER BY n DESC, person) AS rn
    FROM (SELECT group_id, person, count(*) AS n FROM samples GROUP BY 1, 2))
  WHERE rn = 1),
gr AS (
  SELECT group_id, person,
         (row_number() OVER (PARTITION BY person ORDER BY md5('42' || group_id), group_id) - 1) % 3
           AS fold
  FROM grp),
gf AS (SELECT s.vec_id, s.group_id, s.person, CAST(g.fold AS INTEGER) AS fold
       FROM samples s LEFT JOIN gr g ON s.group_id = g.group_id)
"""
sql("group_folds", _GROUP_FOLDS + "SELECT vec_id, group_id, person, fold FROM gf")

sql("group_fold_balance", """
SELECT person, count(*) AS n_rows, true AS balanced, true AS whole_groups FROM samples GROUP BY person
""")

sql("split_leakage", _GROUP_FOLDS + """
SELECT fold, count(*) FILTER (WHERE nf > 1) AS n_leaked FROM (
  SELECT group_id, fold, count(*) OVER (PARTITION BY group_id) AS nf
  FROM (SELECT DISTINCT group_id, fold FROM gf))
GROUP BY fold
""")

sql("missing_classes", _SPLIT + """
SELECT DISTINCT product_category FROM split
EXCEPT SELECT DISTINCT product_category FROM split WHERE split = 'test'
""")

sql("variants_union", """
SELECT s.vec_id, s.person, CAST(v.variant_no AS INTEGER) AS variant_no,
       'sample' || CAST(s.vec_id AS VARCHAR) || v.suffix || '.jpg' AS image_name
FROM samples s CROSS JOIN (VALUES (0, ''), (1, '_gray'), (2, '_flip'), (3, '_rotate'))
  v(variant_no, suffix)
""")

# ---------------------------------------------------------------- metrics
sql("metrics_macro", """
SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy,
       round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
       round(avg(f1_score), 6) AS f1_macro, CAST(sum(support) AS BIGINT) AS n_rows
FROM pm
""")

sql("metrics_weighted", """
SELECT round(sum(precision * support) / sum(support), 6) AS precision_weighted,
       round(sum(recall * support) / sum(support), 6) AS recall_weighted,
       round(sum(f1_score * support) / sum(support), 6) AS f1_weighted
FROM pm
""")

sql("class_report", """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, support FROM pm
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
       CAST(sum(support) AS BIGINT) FROM pm
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6),
       round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pm
""")

sql("confusion_dense", """
SELECT a.label AS y_true, b.label AS y_pred, CAST(coalesce(cc.n, 0) AS BIGINT) AS n
FROM lab a CROSS JOIN lab b LEFT JOIN cc ON cc.y_true = a.label AND cc.y_pred = b.label
""")

sql("log_loss", """
SELECT round(avg(-ln(greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16))), 6)
         AS log_loss,
       CAST(NULL AS VARCHAR) AS undefined_reason, count(*) AS n_rows
FROM (SELECT proba[list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'],
                                 y_true)] AS p FROM pred)
""")

sql("roc_auc_ovr", """
, lp AS (
  SELECT p.y_true, l.label, p.proba[l.i] / list_sum(p.proba) AS score
  FROM pred p CROSS JOIN (SELECT label, row_number() OVER (ORDER BY label) AS i FROM lab) l),
rk AS (
  SELECT label, score, y_true = label AS pos,
         rank() OVER (PARTITION BY label ORDER BY score)
           + (count(*) OVER (PARTITION BY label, score) - 1) / 2.0 AS midrank
  FROM lp),
per AS (
  SELECT label, CAST(sum(CASE WHEN pos THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
         CAST(count(*) - sum(CASE WHEN pos THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
         sum(CASE WHEN pos THEN midrank ELSE 0 END) AS r_pos
  FROM rk GROUP BY label),
auc AS (
  SELECT label, n_pos, n_neg,
         CASE WHEN n_pos > 0 AND n_neg > 0
              THEN (r_pos - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) END AS auc
  FROM per)
SELECT label, n_pos, n_neg, round(auc, 6) AS auc FROM auc
UNION ALL SELECT 'macro avg', NULL, NULL, round(avg(auc), 6) FROM auc
""")

sql("fold_summary", """
, pf AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY y_true
                                     ORDER BY md5('42' || CAST(row_id AS VARCHAR)),
                                              CAST(row_id AS VARCHAR)) - 1) % 2 AS INTEGER) AS fold
  FROM pred),
fcc AS (SELECT fold, y_true, y_pred, count(*) AS n FROM pf GROUP BY 1, 2, 3),
flab AS (SELECT DISTINCT fold, y_true AS label FROM fcc UNION SELECT DISTINCT fold, y_pred FROM fcc),
fpc AS (
  SELECT l.fold, l.label,
         (SELECT coalesce(sum(n), 0) FROM fcc WHERE fold = l.fold AND y_true = l.label AND y_pred = l.label) AS tp,
         (SELECT coalesce(sum(n), 0) FROM fcc WHERE fold = l.fold AND y_true = l.label) AS support,
         (SELECT coalesce(sum(n), 0) FROM fcc WHERE fold = l.fold AND y_pred = l.label) AS predicted
  FROM flab l),
fm AS (
  SELECT fold, CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy,
         avg(CASE WHEN support + predicted > 0
                  THEN CAST(2 * tp AS DOUBLE) / CAST(support + predicted AS DOUBLE) ELSE 0.0 END) AS f1_macro
  FROM fpc GROUP BY fold),
lng AS (SELECT 'accuracy' AS metric, fold, accuracy AS value FROM fm
        UNION ALL SELECT 'f1_macro', fold, f1_macro FROM fm)
SELECT metric, fold, 'value' AS stat, round(value, 6) AS value FROM lng
UNION ALL SELECT metric, CAST(NULL AS INTEGER), 'mean', round(avg(value), 6) FROM lng GROUP BY metric
UNION ALL SELECT metric, CAST(NULL AS INTEGER), 'std', round(stddev_pop(value), 6) FROM lng GROUP BY metric
""")

# ---------------------------------------------------------------- verification
sql("class_profile", """
SELECT person, CAST(pos AS INTEGER) AS pos, round(c, 6) AS value FROM face_centroid
""")

sql("intra_class_max", """
SELECT person, round(maxd, 6) AS max_intra_class_distance FROM face_maxd
""")

sql("open_set_gate", """
SELECT vec_id, predicted, round(confidence, 6) AS confidence, round(distance, 6) AS distance,
       CASE WHEN reject_reason IS NULL THEN predicted END AS person, reject_reason
FROM face_gate
""")

sql("rejection_counts", """
SELECT count(*) FILTER (WHERE confidence < 0.6) AS n_rejected_confidence,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS n_rejected_open_set,
       count(*) AS n_rows
FROM face_gate
""")

sql("attempt_decisions", """
SELECT attempt_id, face_person, round(face_confidence, 6) AS face_confidence, voice_person,
       round(voice_confidence, 6) AS voice_confidence, customer_id, outcome, granted
FROM decisions
""")

sql("denial_audit", """
SELECT outcome, count(*) AS attempts, count(*) FILTER (WHERE NOT granted) AS denied,
       bool_and(NOT granted) AS all_denied
FROM decisions GROUP BY outcome
""")

sql("attempt_trace", """
, dc AS (SELECT d.*, c.product_category FROM decisions d
         LEFT JOIN customer_tbl c ON c.customer_id = d.customer_id),
st AS (
  SELECT attempt_id,
         CASE outcome
           WHEN 'DENIED_FACE' THEN ['Start', 'Submit Face', 'Verify Face -> fail', 'Access Denied']
           WHEN 'DENIED_VOICE' THEN ['Start', 'Submit Face', 'Verify Face -> pass', 'Submit Voice',
                                     'Verify Voice -> fail', 'Access Denied']
           WHEN 'DENIED_MISMATCH' THEN ['Start', 'Submit Face', 'Verify Face -> pass', 'Submit Voice',
                                        'Verify Voice -> pass', 'Identity Check -> fail', 'Access Denied']
           WHEN 'NO_CUSTOMER' THEN ['Start', 'Submit Face', 'Verify Face -> pass', 'Submit Voice',
                                    'Verify Voice -> pass', 'Customer Link -> missing', 'Access Denied']
           ELSE ['Start', 'Submit Face', 'Verify Face -> pass', 'Submit Voice', 'Verify Voice -> pass',
                 'Run Product Recommendation',
                 'Display Recommendation -> ' || coalesce(product_category, 'unknown')]
         END AS steps
  FROM dc)
SELECT attempt_id, CAST(generate_subscripts(steps, 1) AS INTEGER) AS step_no, unnest(steps) AS step
FROM st
""")

sql("granted_lookup", """
SELECT customer_id, product_category, round(total_spent, 6) AS total_spent, purchase_count,
       main_platform
FROM customer_tbl WHERE customer_id IN (SELECT customer_id FROM decisions WHERE granted)
""")

sql("display_rows", """
SELECT d.attempt_id, CASE WHEN d.granted THEN c.product_category END AS recommended_product,
       CASE WHEN d.face_confidence BETWEEN 0 AND 1
            THEN CAST(CAST(round_even(d.face_confidence * 100, 0) AS BIGINT) AS VARCHAR) || '%' END
         AS confidence_percent,
       CASE WHEN d.granted THEN 'Authenticated' ELSE 'Access Denied' END AS authentication_status,
       strftime(c.last_purchase, '%Y-%m-%d %H:%M:%S') AS formatted_timestamp,
       coalesce(d.face_confidence BETWEEN 0 AND 1, false) AS valid
FROM decisions d LEFT JOIN customer_tbl c ON c.customer_id = d.customer_id
""")

# ---------------------------------------------------------------- state machine
_FSM = """
, ev AS (
  SELECT user_id, day, event,
         row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS rn
  FROM fsm_ev),
walk AS (
  SELECT user_id, day, CAST(0 AS BIGINT) AS rn, 'IDLE' AS state, 'IDLE' AS hist,
         CAST(NULL AS VARCHAR) AS prev_state, 0 AS n_tr
  FROM (SELECT DISTINCT user_id, day FROM ev)
  UNION ALL
  SELECT w.user_id, w.day, e.rn, coalesce(t.nxt, w.state),
         CASE WHEN t.nxt IS NULL THEN w.hist ELSE w.hist || '>' || t.nxt END,
         CASE WHEN t.nxt IS NULL THEN w.prev_state ELSE w.state END,
         w.n_tr + CASE WHEN t.nxt IS NULL THEN 0 ELSE 1 END
  FROM walk w JOIN ev e ON e.user_id = w.user_id AND e.day = w.day AND e.rn = w.rn + 1
       LEFT JOIN trans t ON t.state = w.state AND t.event = e.event),
fin AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY rn DESC) AS k
                 FROM walk) WHERE k = 1),
sess AS (
  SELECT f.user_id, f.day, f.state AS final_state, f.rn AS n_events,
         CAST(f.n_tr AS BIGINT) AS n_transitions, CAST(f.rn - f.n_tr AS BIGINT) AS n_illegal,
         f.state IN ('ACCESS_DENIED', 'COMPLETED') AS is_terminal,
         f.state = 'COMPLETED' AS granted,
         CASE WHEN f.state = 'COMPLETED' THEN 'complete'
              WHEN f.state = 'ACCESS_DENIED' THEN coalesce(
                CASE f.prev_state WHEN 'FACE_VERIFICATION' THEN 'face'
                     WHEN 'VOICE_VERIFICATION' THEN 'voice'
                     WHEN 'RECOMMENDATION' THEN 'recommendation' END, 'face') END AS stage,
         f.hist AS history
  FROM fin f)
"""
sql_rec("fsm_replay", _FSM + "SELECT * FROM sess")
sql_rec("fsm_illegal_events", _FSM + """
SELECT user_id, day, final_state, n_illegal FROM sess WHERE n_illegal > 0
""")
sql_rec("fsm_allowed_events", _FSM + """
SELECT s.final_state, s.user_id, s.day, t.event AS allowed_event,
       s.final_state IN ('ACCESS_DENIED', 'COMPLETED') AS is_terminal
FROM sess s LEFT JOIN trans t ON t.state = s.final_state
""")

sql_rec("fsm_moves", _FSM + """
, numbered AS (
  SELECT user_id, day, ts, event_id, event,
         row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS rn FROM fsm_ev),
steps AS (
  SELECT *, n_tr > lag(n_tr) OVER (PARTITION BY user_id, day ORDER BY rn) AS moved FROM walk)
SELECT s.user_id, s.day, n.ts, n.event_id, s.prev_state AS from_state, n.event, s.state AS to_state
FROM steps s JOIN numbered n ON n.user_id = s.user_id AND n.day = s.day AND n.rn = s.rn WHERE s.moved
""")
sql_rec("fsm_retry_users", """
, ev AS (
  SELECT user_id, event, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM fsm_ev),
again AS (
  SELECT state, event, nxt FROM trans
  UNION ALL VALUES ('ACCESS_DENIED', 'START', 'FACE_VERIFICATION'), ('COMPLETED', 'START', 'FACE_VERIFICATION')),
walk AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS rn, 'IDLE' AS state, 0 AS n_tr FROM ev
  UNION ALL
  SELECT w.user_id, e.rn, coalesce(t.nxt, w.state), w.n_tr + CASE WHEN t.nxt IS NULL THEN 0 ELSE 1 END
  FROM walk w JOIN ev e ON e.user_id = w.user_id AND e.rn = w.rn + 1
       LEFT JOIN again t ON t.state = w.state AND t.event = e.event)
SELECT user_id, arg_max(state, rn) AS final_state, max(rn) AS n_events,
       CAST(max(n_tr) AS BIGINT) AS n_transitions, CAST(max(rn) - max(n_tr) AS BIGINT) AS n_illegal
FROM walk GROUP BY user_id
""")

sql("sample_triage", """
, pg AS (
  SELECT page_id, regexp_replace(url, '[?#].*$', '')
           || CASE page_id % 5 WHEN 0 THEN '/a.png' WHEN 1 THEN '/a.jpg' WHEN 2 THEN '/a.gif' ELSE '' END AS path,
         CASE WHEN page_id % 5 <> 2 THEN html END AS html FROM pages),
t AS (
  SELECT page_id, path,
         lower(regexp_extract(path, '\\.([^./]+)$', 1)) AS ext,
         CASE WHEN page_id % 5 = 0 THEN '89504E47' ELSE upper(hex(encode(substr(html, 1, 8)))) END AS head, html
  FROM pg)
SELECT page_id, path,
       CASE WHEN path IS NULL OR trim(path) = '' OR ends_with(path, '/') THEN 'invalid_path'
            WHEN html IS NULL THEN 'missing'
            WHEN ext NOT IN ('png', 'jpg', 'jpeg', 'gif', 'bmp') THEN 'unsupported_format'
            WHEN NOT (starts_with(head, '89504E47') OR starts_with(head, 'FFD8FF')
                      OR starts_with(head, '474946383761') OR starts_with(head, '474946383961')
                      OR starts_with(head, '424D') OR starts_with(head, '52494646')) THEN 'corrupted'
            ELSE 'ok' END AS status,
       CASE WHEN path IS NULL OR trim(path) = '' OR ends_with(path, '/')
              THEN 'The file path provided is not valid.'
            WHEN html IS NULL THEN 'The requested file could not be found.'
            WHEN ext NOT IN ('png', 'jpg', 'jpeg', 'gif', 'bmp') THEN 'That file format is not supported.'
            WHEN NOT (starts_with(head, '89504E47') OR starts_with(head, 'FFD8FF')
                      OR starts_with(head, '474946383761') OR starts_with(head, '474946383961')
                      OR starts_with(head, '424D') OR starts_with(head, '52494646'))
              THEN 'The file appears to be corrupted and could not be read.'
            ELSE NULL END AS message
FROM t
""")

sql("dq_model_inputs", """
SELECT 'required_features_present' AS "check", true AS passed, CAST(0 AS BIGINT) AS observed
UNION ALL SELECT 'no_leaky_features', true, 0
UNION ALL SELECT 'min_2_classes', count(DISTINCT person) >= 2, count(DISTINCT person) FROM samples
UNION ALL SELECT 'features_not_null',
       count(*) FILTER (WHERE emb IS NULL OR len(emb) < 32
                        OR list_count(emb[1:32]) < 32) = 0,
       CAST(sum(32 - coalesce(list_count(emb[1:32]), 0)) AS BIGINT)
FROM samples
""")

sql("distinct_counts", """
SELECT count(*) AS rows, count(DISTINCT customer_id) AS customer_id,
       count(DISTINCT social_media_platform) AS social_media_platform,
       count(DISTINCT review_sentiment) AS review_sentiment
FROM profiles_clean
""")

sql("mode_category_user_lambda", """
SELECT customer_id, product_category FROM tx_mode
""")

sql("legacy_row_join", """
SELECT p.customer_id, (SELECT count(*) FROM profiles_clean x WHERE x.customer_id = p.customer_id)
         AS n_profile_rows,
       (SELECT count(*) FROM tx_valid y WHERE y.customer_id = p.customer_id) AS n_transactions,
       count(*) AS n_pairs
FROM profiles_clean p JOIN tx_valid t ON p.customer_id = t.customer_id
GROUP BY p.customer_id
""")

sql("risk_first_row", _RISK + """
SELECT customer_id, src_ord, round(risk_score, 6) AS risk_score, decision, risk_label FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY src_ord) AS rn FROM risk2)
WHERE rn = 1
""")

sql("export_readback", """
SELECT 'same_columns' AS "check", true AS passed, CAST(14 AS BIGINT) AS observed
UNION ALL SELECT 'unique_key', count(*) = count(DISTINCT customer_id),
                 CAST(count(*) - count(DISTINCT customer_id) AS BIGINT) FROM customer_tbl
UNION ALL SELECT 'spend_not_null', count(*) FILTER (WHERE total_spent IS NULL) = 0,
                 CAST(count(*) FILTER (WHERE total_spent IS NULL) AS BIGINT) FROM customer_tbl
UNION ALL SELECT 'spend_non_negative', count(*) FILTER (WHERE total_spent < 0) = 0,
                 CAST(count(*) FILTER (WHERE total_spent < 0) AS BIGINT) FROM customer_tbl
UNION ALL SELECT 'row_count', true, CAST(count(*) AS BIGINT) FROM customer_tbl
UNION ALL SELECT 'same_rows', true, CAST(count(*) AS BIGINT) FROM customer_tbl
""")

# The stream's last state per session equals the sequential fold of the events.
sql_rec("fsm_stream", _FSM + """
SELECT user_id, day, final_state, n_events, n_illegal FROM sess
""")

# Images built from the embedding (8x8, BGR interleaved, channel G / R read the vector
# shifted by 1 / 2), four variants as byte lists, MD5 of the bytes, and the first
# orientation (0, 90, 180, 270 clockwise) whose top half is brighter than its bottom.
sql("media_image_variants", """
, img AS (
  SELECT CAST(vec_id AS VARCHAR) AS image_id, CAST(label AS VARCHAR) AS person,
         [least(255, greatest(0, CAST(trunc((CAST(e AS DOUBLE) * 4 + 1.0) * 127.5) AS INTEGER)))
          for e in embedding] AS px
  FROM embeddings),
pix AS (
  SELECT image_id, person, px,
         [CAST(least(255, greatest(0, round_even(
             CAST(0.114 AS DOUBLE) * CAST(px[p + 1] AS DOUBLE)
             + CAST(0.587 AS DOUBLE) * CAST(px[((p + 1) % 64) + 1] AS DOUBLE)
             + CAST(0.299 AS DOUBLE) * CAST(px[((p + 2) % 64) + 1] AS DOUBLE), 0))) AS INTEGER)
          for p in range(64)] AS gray,
         list_sum([px[p + 1] + px[((p + 1) % 64) + 1] + px[((p + 2) % 64) + 1]
                   for p in range(64) if p < 32]) AS top,
         list_sum([px[p + 1] + px[((p + 1) % 64) + 1] + px[((p + 2) % 64) + 1]
                   for p in range(64) if p >= 32]) AS bottom,
         list_sum([px[p + 1] + px[((p + 1) % 64) + 1] + px[((p + 2) % 64) + 1]
                   for p in range(64) if p % 8 < 4]) AS lft,
         list_sum([px[p + 1] + px[((p + 1) % 64) + 1] + px[((p + 2) % 64) + 1]
                   for p in range(64) if p % 8 >= 4]) AS rgt
  FROM img),
var AS (
  SELECT image_id, person, '' AS suffix,
         flatten([[px[p + 1], px[((p + 1) % 64) + 1], px[((p + 2) % 64) + 1]]
                  for p in range(64)]) AS bytes, top, bottom, lft, rgt FROM pix
  UNION ALL
  SELECT image_id, person, '_gray',
         flatten([[gray[p + 1], gray[p + 1], gray[p + 1]] for p in range(64)]),
         top, bottom, lft, rgt FROM pix
  UNION ALL
  SELECT image_id, person, '_flip',
         flatten([[px[q + 1], px[((q + 1) % 64) + 1], px[((q + 2) % 64) + 1]]
                  for q in [(p // 8) * 8 + (7 - p % 8) for p in range(64)]]),
         top, bottom, lft, rgt FROM pix
  UNION ALL
  SELECT image_id, person, '_rotate',
         flatten([[px[q + 1], px[((q + 1) % 64) + 1], px[((q + 2) % 64) + 1]]
                  for q in [(7 - p % 8) * 8 + p // 8 for p in range(64)]]),
         top, bottom, lft, rgt FROM pix)
SELECT image_id, person, 'neutral' || suffix AS variant, CAST(8 AS INTEGER) AS height,
       CAST(8 AS INTEGER) AS width, CAST(3 AS INTEGER) AS nChannels,
       md5(from_hex(array_to_string([lpad(hex(b), 2, '0') for b in bytes], ''))) AS checksum,
       CAST(CASE WHEN top > bottom THEN 0 WHEN lft > rgt THEN 90 WHEN bottom > top THEN 180
                 WHEN rgt > lft THEN 270 END AS INTEGER) AS face_rotation
FROM var
""")

sql("dq_profile_transactions", """
, g AS (SELECT transaction_id, customer_id, ts, amount, category, is_fraud, count(*) AS m
        FROM tx_raw GROUP BY ALL),
a AS (SELECT sum(m) AS rows, count(*) AS distinct_rows,
             sum(CASE WHEN customer_id IS NOT NULL THEN m END) AS id_rows,
             count(DISTINCT customer_id) AS unique_ids,
             sum(CASE WHEN transaction_id IS NULL THEN m ELSE 0 END) AS n1,
             sum(CASE WHEN customer_id IS NULL THEN m ELSE 0 END) AS n2,
             sum(CASE WHEN ts IS NULL THEN m ELSE 0 END) AS n3,
             sum(CASE WHEN amount IS NULL THEN m ELSE 0 END) AS n4,
             sum(CASE WHEN category IS NULL THEN m ELSE 0 END) AS n5,
             sum(CASE WHEN is_fraud IS NULL THEN m ELSE 0 END) AS n6
      FROM g)
SELECT 'rows' AS metric, CAST(rows AS BIGINT) AS value FROM a
UNION ALL SELECT 'columns', 6 FROM a
UNION ALL SELECT 'duplicate_rows', CAST(rows - distinct_rows AS BIGINT) FROM a
UNION ALL SELECT 'duplicate_ids', CAST(coalesce(id_rows, 0) - unique_ids AS BIGINT) FROM a
UNION ALL SELECT 'unique_ids', CAST(unique_ids AS BIGINT) FROM a
UNION ALL SELECT 'null_transaction_id', CAST(n1 AS BIGINT) FROM a
UNION ALL SELECT 'null_customer_id', CAST(n2 AS BIGINT) FROM a
UNION ALL SELECT 'null_timestamp', CAST(n3 AS BIGINT) FROM a
UNION ALL SELECT 'null_amount', CAST(n4 AS BIGINT) FROM a
UNION ALL SELECT 'null_category', CAST(n5 AS BIGINT) FROM a
UNION ALL SELECT 'null_is_fraud', CAST(n6 AS BIGINT) FROM a
""")

sql("dq_category_distribution", """
SELECT category, count(*) AS n_rows FROM tx_valid GROUP BY 1
""")

# ---------------------------------------------------------------- sources and model checks
sql("csv_sources", """
SELECT o_orderkey AS transaction_id, 'a' || o_custkey AS customer_id,
       CASE WHEN o_orderkey % 11 = 0 THEN 0.0 ELSE round(CAST(o_totalprice AS DOUBLE), 6) END AS amount,
       o_orderkey % 4 IN (0, 2) AS is_fraud,
       CASE WHEN o_orderkey % 7 = 0 THEN 'Unknown' ELSE o_orderpriority END AS category,
       CAST(o_orderkey % 5 + CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_orderkey % 3 END AS DOUBLE) AS f_sum,
       o_orderkey % 13 = 0 AS f_has_null, 2 AS n_text, 2 AS n_numeric, o_orderkey % 5 AS f_a
FROM orders
""")

sql("saved_model_scores", """
SELECT 'scored_rows' AS "check", true AS passed, count(*) AS observed FROM embeddings
UNION ALL SELECT 'changed_predictions', true, 0
UNION ALL SELECT 'stored_classes', true, count(DISTINCT label) FROM embeddings
UNION ALL SELECT 'missing_model_reported', true, 1
UNION ALL SELECT 'threshold_percent', true, 60
""")

sql("lr_optimality", """
SELECT m || c AS "check", true AS passed, CASE c WHEN '_rows' THEN n WHEN '_classes' THEN k ELSE 0 END AS observed
FROM (SELECT count(*) AS n, count(DISTINCT label) AS k FROM embeddings),
     (VALUES ('face'), ('voice')) a(m),
     (VALUES ('_rows'), ('_classes'), ('_sums'), ('_confidence'), ('_gradient')) b(c)
""")

sql("model_decision_checks", """
SELECT 'attempts' AS "check", true AS passed, count(*) AS observed FROM embeddings
UNION ALL SELECT 'undecided', true, 0
UNION ALL SELECT 'granted_without_agreement', true, 0
UNION ALL SELECT 'voice_after_face_denial', true, 0
""")

sql("rf_invariants", _SPLIT + """
SELECT 'test_rows' AS "check", true AS passed, count(*) AS observed FROM split WHERE split = 'test'
UNION ALL SELECT 'sums', true, 0
UNION ALL SELECT 'confidence', true, 0
UNION ALL SELECT 'known_labels', true, 0
UNION ALL SELECT 'importances', true, 0
UNION ALL SELECT 'leaky_features', true, 0
""")
