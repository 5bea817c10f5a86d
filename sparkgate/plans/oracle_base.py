"""DuckDB-side role views and shared CTEs for the oracle SQL.

Written independently of the Spark code paths (window ``row_number`` modes,
``quantile_cont`` quantiles, recursive folds) so that the oracle is a real
cross-check, not the same plan twice.
"""

ROLE_CTES = r"""
profiles_raw AS (
  SELECT ' A' || CAST(user_id AS VARCHAR) || ' ' AS customer_id,
         upper(event_type) AS social_media_platform,
         CASE WHEN event_id % 101 <> 0 THEN value / 5 END AS engagement_score,
         CASE WHEN event_id % 103 <> 0 THEN
           1 + (TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 41) / 10 END AS purchase_interest_score,
         CASE event_id % 3 WHEN 0 THEN 'Positive' WHEN 1 THEN 'Neutral' ELSE 'Negative' END
           AS review_sentiment,
         event_id AS src_ord
  FROM events),
profiles_dedup AS (
  SELECT customer_id, social_media_platform, engagement_score, purchase_interest_score,
         review_sentiment, min(src_ord) AS src_ord
  FROM (SELECT lower(trim(customer_id)) AS customer_id,
               lower(trim(social_media_platform)) AS social_media_platform,
               CASE WHEN isnan(engagement_score) THEN NULL ELSE engagement_score END AS engagement_score,
               CASE WHEN isnan(purchase_interest_score) THEN NULL ELSE purchase_interest_score END
                 AS purchase_interest_score,
               lower(trim(review_sentiment)) AS review_sentiment, src_ord
        FROM profiles_raw)
  GROUP BY ALL),
profiles_clean AS (
  SELECT customer_id, coalesce(social_media_platform, 'unknown') AS social_media_platform,
         coalesce(engagement_score, (SELECT median(engagement_score) FROM profiles_dedup))
           AS engagement_score,
         coalesce(purchase_interest_score, (SELECT median(purchase_interest_score) FROM profiles_dedup))
           AS purchase_interest_score,
         coalesce(review_sentiment, 'unknown') AS review_sentiment, src_ord
  FROM profiles_dedup),
tx_raw AS (
  SELECT o_orderkey AS transaction_id, 'a' || CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 83 <> 0 THEN o_orderdate END AS ts,
         CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice WHEN o_orderkey % 89 <> 0 THEN o_totalprice END AS amount,
         o_orderpriority AS category,
         o_orderstatus = 'F' AS is_fraud, o_orderkey AS src_ord
  FROM orders),
tx_norm AS (
  SELECT transaction_id, customer_id, ts,
         CASE WHEN isnan(amount) THEN NULL ELSE amount END AS amount,
         lower(trim(category)) AS category, is_fraud, src_ord
  FROM (SELECT transaction_id, lower(trim(customer_id)) AS customer_id, ts, amount, category,
               is_fraud, min(src_ord) AS src_ord
        FROM tx_raw GROUP BY ALL)),
tx_reason AS (
  SELECT *, CASE WHEN amount IS NULL OR amount <= 0 THEN 'bad_amount'
                 WHEN ts IS NULL THEN 'bad_timestamp' END AS reject_reason
  FROM tx_norm),
tx_valid AS (SELECT * EXCLUDE (reject_reason) FROM tx_reason WHERE reject_reason IS NULL),
tx_bounds AS (
  SELECT quantile_cont(amount, 0.01) AS lo, quantile_cont(amount, 0.99) AS hi FROM tx_valid),
tx_clean AS (
  SELECT v.transaction_id, v.customer_id, v.ts,
         CASE WHEN v.amount IS NULL THEN NULL ELSE greatest(least(v.amount, b.hi), b.lo) END AS amount,
         v.amount AS amount_raw, (v.amount < b.lo OR v.amount > b.hi) AS was_clipped,
         v.category, v.is_fraud, v.src_ord
  FROM tx_valid v, tx_bounds b),
tx_rfm AS (
  SELECT customer_id, sum(amount) AS total_spent, avg(amount) AS average_spent,
         count(amount) AS purchase_count, max(ts) AS last_purchase,
         avg(CAST(is_fraud AS DOUBLE)) AS fraud_rate,
         CAST(floor((epoch(TIMESTAMP '2001-09-01 12:00:00') - epoch(max(ts))) / 86400) AS BIGINT)
           AS days_since_last_purchase
  FROM tx_clean GROUP BY customer_id),
tx_mode AS (
  SELECT customer_id, category AS product_category FROM (
    SELECT customer_id, category,
           row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, o ASC) AS rn
    FROM (SELECT customer_id, category, count(*) AS n, min(src_ord) AS o
          FROM tx_clean WHERE category IS NOT NULL GROUP BY 1, 2))
  WHERE rn = 1),
tx_features AS (
  SELECT r.*, m.product_category FROM tx_rfm r LEFT JOIN tx_mode m USING (customer_id)),
soc AS (
  SELECT customer_id, avg(engagement_score) AS average_engagement,
         avg(purchase_interest_score) AS average_purchase_interest,
         count(DISTINCT social_media_platform) AS platform_count
  FROM profiles_clean GROUP BY customer_id),
main_platform AS (
  SELECT customer_id, social_media_platform AS main_platform FROM (
    SELECT customer_id, social_media_platform,
           row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, o ASC) AS rn
    FROM (SELECT customer_id, social_media_platform, count(*) AS n, min(src_ord) AS o
          FROM profiles_clean WHERE social_media_platform IS NOT NULL GROUP BY 1, 2))
  WHERE rn = 1),
sentiment_mode AS (
  SELECT customer_id, review_sentiment FROM (
    SELECT customer_id, review_sentiment,
           row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, o ASC) AS rn
    FROM (SELECT customer_id, review_sentiment, count(*) AS n, min(src_ord) AS o
          FROM profiles_clean WHERE review_sentiment IS NOT NULL GROUP BY 1, 2))
  WHERE rn = 1),
platform_tbl AS (
  SELECT p.customer_id, p.social_media_platform, p.engagement_score, p.purchase_interest_score,
         p.review_sentiment, coalesce(t.total_spent, 0.0) AS total_spent,
         coalesce(t.average_spent, 0.0) AS average_spent,
         CAST(coalesce(t.purchase_count, 0) AS BIGINT) AS purchase_count, t.last_purchase,
         coalesce(t.fraud_rate, 0.0) AS fraud_rate,
         CAST(coalesce(t.days_since_last_purchase, -1) AS BIGINT) AS days_since_last_purchase,
         coalesce(t.product_category, 'unknown') AS product_category, s.average_engagement,
         s.platform_count, m.main_platform, p.src_ord,
         t.total_spent IS NOT NULL AS tx_matched
  FROM profiles_clean p LEFT JOIN soc s ON p.customer_id = s.customer_id
       LEFT JOIN main_platform m ON p.customer_id = m.customer_id
       LEFT JOIN tx_features t ON p.customer_id = t.customer_id),
customer_tbl AS (
  SELECT s.customer_id, s.average_engagement AS engagement_score,
         s.average_purchase_interest AS purchase_interest_score, se.review_sentiment,
         s.average_engagement, s.platform_count, m.main_platform,
         coalesce(t.total_spent, 0.0) AS total_spent, coalesce(t.average_spent, 0.0) AS average_spent,
         CAST(coalesce(t.purchase_count, 0) AS BIGINT) AS purchase_count, t.last_purchase,
         coalesce(t.fraud_rate, 0.0) AS fraud_rate,
         CAST(coalesce(t.days_since_last_purchase, -1) AS BIGINT) AS days_since_last_purchase,
         coalesce(t.product_category, 'unknown') AS product_category
  FROM soc s LEFT JOIN sentiment_mode se ON s.customer_id = se.customer_id
       LEFT JOIN main_platform m ON s.customer_id = m.customer_id
       LEFT JOIN tx_features t ON s.customer_id = t.customer_id)
"""


def with_roles(body: str, recursive: bool = False) -> str:
    """Prefix a query body with the role CTEs (DuckDB inlines only those referenced)."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ROLE_CTES.strip() + ",\n" + SAMPLE_CTES.strip() + "\n" + body


def _modality(name: str, offset: int, dims: int = 32) -> str:
    """Long form, scaler, centroids, distances and gate of one sample modality."""
    return f"""
{name}_long AS (
  SELECT s.vec_id, s.person, r.pos, CAST(s.emb[r.pos + {offset + 1}] AS DOUBLE) AS x
  FROM samples s CROSS JOIN range(0, {dims}) r(pos)),
{name}_stats AS (
  SELECT pos, avg(x) AS mean,
         CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS std
  FROM {name}_long GROUP BY pos),
{name}_scaled AS (
  SELECT l.vec_id, l.person, l.pos, (l.x - s.mean) / s.std AS x
  FROM {name}_long l JOIN {name}_stats s ON l.pos = s.pos),
{name}_centroid AS (
  SELECT person, pos, avg(x) AS c FROM {name}_scaled GROUP BY person, pos),
{name}_maxd AS (
  SELECT person, max(d) AS maxd FROM (
    SELECT s.vec_id, s.person, sqrt(sum((s.x - c.c) * (s.x - c.c))) AS d
    FROM {name}_scaled s JOIN {name}_centroid c ON s.person = c.person AND s.pos = c.pos
    GROUP BY s.vec_id, s.person)
  GROUP BY person),
{name}_d2 AS (
  SELECT s.vec_id, c.person AS cls, sum((s.x - c.c) * (s.x - c.c)) AS d2
  FROM {name}_scaled s JOIN {name}_centroid c ON s.pos = c.pos GROUP BY s.vec_id, c.person),
{name}_soft AS (
  SELECT vec_id, cls, d2, exp(min(d2) OVER (PARTITION BY vec_id) - d2) AS e FROM {name}_d2),
{name}_prob AS (
  SELECT vec_id, cls, d2, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM {name}_soft),
{name}_gate AS (
  SELECT k.vec_id, k.cls AS predicted, k.p AS confidence, sqrt(k.d2) AS distance,
         CASE WHEN k.p < 0.6 THEN 'low_confidence'
              WHEN sqrt(k.d2) > m.maxd * 1.5 THEN 'outside_class_radius' END AS reject_reason
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, cls) AS rn
        FROM {name}_prob) k
  JOIN {name}_maxd m ON m.person = k.cls
  WHERE k.rn = 1)"""


SAMPLE_CTES = r"""
samples AS (
  SELECT vec_id, CAST(label AS VARCHAR) AS person,
         CAST(label AS VARCHAR) || '_' || CAST(vec_id % 5 AS VARCHAR) AS group_id,
         embedding AS emb
  FROM embeddings),
""" + _modality("face", 0) + ",\n" + _modality("voice", 32) + r""",
attempts AS (
  SELECT vec_id AS attempt_id, vec_id AS face_vec, person AS claimed_person,
         (vec_id * 7 + 3) % (SELECT count(*) FROM samples) AS voice_vec
  FROM samples),
ident AS (
  SELECT DISTINCT person, 'a' || CAST(CAST(person AS BIGINT) * 17 AS VARCHAR) AS customer_id
  FROM samples
  WHERE 'a' || CAST(CAST(person AS BIGINT) * 17 AS VARCHAR) IN (SELECT customer_id FROM soc)),
face_res AS (
  SELECT a.attempt_id, CASE WHEN g.reject_reason IS NULL THEN g.predicted END AS person,
         g.confidence
  FROM attempts a JOIN face_gate g ON g.vec_id = a.face_vec),
voice_res AS (
  SELECT a.attempt_id, CASE WHEN g.reject_reason IS NULL THEN g.predicted END AS person,
         g.confidence
  FROM attempts a JOIN voice_gate g ON g.vec_id = a.voice_vec),
dec0 AS (
  SELECT f.attempt_id, f.person AS face_person, f.confidence AS face_confidence,
         CASE WHEN f.person IS NOT NULL THEN v.person END AS voice_person,
         CASE WHEN f.person IS NOT NULL THEN v.confidence END AS voice_confidence,
         i.customer_id AS linked,
         CASE WHEN f.person IS NULL THEN 'DENIED_FACE'
              WHEN v.person IS NULL THEN 'DENIED_VOICE'
              WHEN f.person <> v.person THEN 'DENIED_MISMATCH'
              WHEN i.customer_id IS NULL THEN 'NO_CUSTOMER'
              ELSE 'GRANTED' END AS outcome
  FROM face_res f LEFT JOIN voice_res v ON f.attempt_id = v.attempt_id
       LEFT JOIN ident i ON i.person = f.person),
decisions AS (
  SELECT attempt_id, face_person, face_confidence, voice_person, voice_confidence,
         CASE WHEN outcome IN ('NO_CUSTOMER', 'GRANTED') THEN linked END AS customer_id,
         outcome, outcome = 'GRANTED' AS granted
  FROM dec0),
scored AS (
  SELECT o_orderkey AS row_id, o_orderpriority AS y_true,
         [r0 / tot, r1 / tot, r2 / tot, r3 / tot, r4 / tot] AS proba
  FROM (SELECT *, r0 + r1 + r2 + r3 + r4 AS tot FROM (
    SELECT o_orderkey, o_orderpriority,
           CAST((o_orderkey * 3) % 97 + 1 AS DOUBLE) AS r0,
           CAST((o_orderkey * 4) % 97 + 1 AS DOUBLE) AS r1,
           CAST((o_orderkey * 5) % 97 + 1 AS DOUBLE) AS r2,
           CAST((o_orderkey * 6) % 97 + 1 AS DOUBLE) AS r3,
           CAST((o_orderkey * 7) % 97 + 1 AS DOUBLE) AS r4
    FROM orders))),
pred AS (
  SELECT row_id, y_true, proba,
         ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][
           list_position(proba, list_max(proba))] AS y_pred
  FROM scored),
lab(label) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')),
cc AS (SELECT y_true, y_pred, count(*) AS n FROM pred GROUP BY 1, 2),
pc AS (
  SELECT l.label,
         (SELECT coalesce(sum(n), 0) FROM cc WHERE y_true = l.label AND y_pred = l.label) AS tp,
         (SELECT coalesce(sum(n), 0) FROM cc WHERE y_true = l.label) AS support,
         (SELECT coalesce(sum(n), 0) FROM cc WHERE y_pred = l.label) AS predicted
  FROM lab l),
pm AS (
  SELECT label, CAST(tp AS BIGINT) AS tp, CAST(support AS BIGINT) AS support,
         CAST(predicted AS BIGINT) AS predicted,
         CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE) ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) ELSE 0.0 END AS recall,
         CASE WHEN support + predicted > 0
              THEN CAST(2 * tp AS DOUBLE) / CAST(support + predicted AS DOUBLE) ELSE 0.0 END AS f1_score
  FROM pc),
fsm_ev AS (
  SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id,
         CASE event_type WHEN 'signup' THEN 'START' WHEN 'view' THEN 'VERIFICATION_PASSED'
              WHEN 'error' THEN 'VERIFICATION_FAILED' WHEN 'purchase' THEN 'RECOMMENDATION_READY'
              WHEN 'click' THEN 'CLICK' ELSE upper(event_type) END AS event
  FROM events),
trans(state, event, nxt) AS (VALUES
  ('IDLE', 'START', 'FACE_VERIFICATION'),
  ('FACE_VERIFICATION', 'VERIFICATION_PASSED', 'VOICE_VERIFICATION'),
  ('FACE_VERIFICATION', 'VERIFICATION_FAILED', 'ACCESS_DENIED'),
  ('VOICE_VERIFICATION', 'VERIFICATION_PASSED', 'RECOMMENDATION'),
  ('VOICE_VERIFICATION', 'VERIFICATION_FAILED', 'ACCESS_DENIED'),
  ('RECOMMENDATION', 'RECOMMENDATION_READY', 'COMPLETED'))
"""
