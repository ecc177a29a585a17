"""DuckDB SQL for each registered query, over the CTEs of ``oracle``.

The model-fitting queries (assemble, train, score, importance_rank,
inference_batch, train_model) have no SQL twin: no SQL engine fits a
forest, so the driver checks them rows-only; their ``*_contract`` queries hold
what any right forest must give.
"""

from __future__ import annotations

import math

from txnlake.plans.oracle import with_layers

ORACLE: dict[str, str] = {}

FEATURES = (
    "amt, city_pop, lat, long, merch_lat, merch_long, unix_time, transaction_hour, is_weekend, "
    "customer_age, high_amount_flag, night_transaction_flag, customer_merchant_distance"
)
ALERT_COLS = "trans_num, amt, fraud_probability, inference_timestamp"

# State of the fixture runs (same values as txnlake.plans.queries).
STATE = """
scored_keys AS (
  SELECT trans_num FROM gold WHERE ingestion_timestamp < TIMESTAMP '2024-01-10 00:00:00'
),
waiting AS (
  SELECT * FROM gold g WHERE NOT EXISTS (SELECT 1 FROM scored_keys s WHERE s.trans_num = g.trans_num)
),
batch AS (
  SELECT * FROM waiting ORDER BY ingestion_timestamp ASC NULLS FIRST, trans_num LIMIT 5000
),
labelled AS (
  SELECT p.*, g.is_fraud FROM predictions p JOIN gold g USING (trans_num)
),
recent AS (
  SELECT * FROM predictions
  WHERE fraud_prediction = 1
    AND inference_timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY
),
alerts AS (
  SELECT trans_num, amt, fraud_probability, inference_timestamp FROM recent
  ORDER BY inference_timestamp DESC, trans_num LIMIT 10
),
map_rows AS (
  SELECT * FROM predictions
  WHERE fraud_prediction = 1 AND fraud_probability < 0.90 AND amt < 5000
)
"""


def sql(name: str, body: str) -> None:
    ORACLE[name] = with_layers(body, STATE)


sql("fraud_by_hour_gold", "SELECT transaction_hour, count(*) AS frauds FROM gold WHERE is_fraud = 1 GROUP BY 1")

# 2.1 sources
sql("scan_layer", "SELECT * FROM bronze")
sql("scan_keys", "SELECT trans_num FROM scored_keys")
sql("scan_predictions", "SELECT * FROM predictions")
sql("ingest_full", "SELECT * FROM bronze")
sql(
    "ingest_incremental",
    """
SELECT b.* FROM bronze b
WHERE (b.ingestion_timestamp >= (
         SELECT max(ingestion_timestamp) - INTERVAL 1 DAY FROM bronze
         WHERE ingestion_timestamp < TIMESTAMP '2024-01-20 00:00:00')
       OR b.ingestion_timestamp IS NULL)
  AND NOT EXISTS (
        SELECT 1 FROM bronze c
        WHERE c.ingestion_timestamp < TIMESTAMP '2024-01-20 00:00:00'
          AND c.trans_num = b.trans_num
          AND c.ingestion_timestamp IS NOT DISTINCT FROM b.ingestion_timestamp)
""",
)

# 2.2 sinks: rows an idempotent append would add
sql(
    "append_idempotent",
    """
SELECT p.* FROM predictions p
WHERE p.trans_num NOT IN (SELECT trans_num FROM scored_keys)
""",
)

# 2.3 projections
sql("feature_select", f"SELECT trans_num, {FEATURES} FROM gold")
sql("training_select", f"SELECT {FEATURES}, is_fraud FROM gold")
sql("cast_amount", "SELECT trans_num, amt FROM silver")
sql(
    "parse_timestamp",
    "SELECT trans_num, trans_date_trans_time AS raw_time, TRY_CAST(trans_date_trans_time AS TIMESTAMP) AS parsed_time FROM bronze",
)
sql("temporal_parts", "SELECT trans_num, transaction_year, transaction_month, transaction_day, transaction_hour FROM silver")
sql("weekend_flag", "SELECT trans_num, trans_date_trans_time, is_weekend FROM silver")
sql("customer_age", "SELECT trans_num, dob, customer_age FROM gold")
sql("high_amount_flag", "SELECT trans_num, amt, high_amount_flag FROM gold")
sql("night_flag", "SELECT trans_num, transaction_hour, night_transaction_flag FROM gold")
sql("distance", "SELECT trans_num, customer_merchant_distance FROM gold")
sql(
    "stamp_inference",
    f"SELECT trans_num, {FEATURES}, TIMESTAMP '2024-01-31 00:00:00' AS inference_timestamp FROM batch",
)
sql(
    "label_recode",
    """
SELECT trans_num,
  CASE fraud_prediction WHEN 0 THEN 'Non Fraud' WHEN 1 THEN 'Fraud' ELSE CAST(fraud_prediction AS VARCHAR) END AS fraud_label,
  CASE high_amount_flag WHEN 0 THEN 'Normal Amount' WHEN 1 THEN 'High Amount' ELSE CAST(high_amount_flag AS VARCHAR) END AS amount_label,
  CASE night_transaction_flag WHEN 0 THEN 'Day' WHEN 1 THEN 'Night' ELSE CAST(night_transaction_flag AS VARCHAR) END AS time_label
FROM predictions
""",
)
KPIS = """
SELECT count(*) AS total_transactions,
  count(*) FILTER (WHERE fraud_prediction = 1) AS fraud_transactions,
  CASE WHEN count(*) = 0 THEN NULL
       ELSE count(*) FILTER (WHERE fraud_prediction = 1) * CAST(100 AS DOUBLE) / count(*) END AS fraud_rate,
  coalesce(CAST(sum(CAST(amt AS DECIMAL(18,4))) FILTER (WHERE fraud_prediction = 1) AS DOUBLE),
           CAST(0 AS DOUBLE)) AS fraud_amount,
  CAST(sum(CAST(fraud_probability AS DECIMAL(18,12))) AS DOUBLE)
    / CAST(count(fraud_probability) AS DOUBLE) AS avg_probability
FROM predictions
"""
sql(
    "format_metrics",
    f"""
SELECT format('{{:,}}', total_transactions) AS transactions,
  format('{{:,}}', fraud_transactions) AS frauds,
  printf('%.2f%%', fraud_rate) AS fraud_rate,
  '$' || format('{{:,.2f}}', fraud_amount) AS fraud_amount,
  printf('%.4f', avg_probability) AS avg_fraud_score
FROM ({KPIS}) k
""",
)
ALERT_MESSAGE = """
SELECT count(*) AS n_alerts,
  CASE WHEN count(*) = 0 THEN 'No frauds detected.' ELSE printf('%d fraud alerts sent.', count(*)) END AS status,
  CASE WHEN count(*) > 0 THEN '\U0001f6a8 Fraud Transactions Detected' || chr(10) || chr(10) || string_agg(
    printf('Transaction: %s' || chr(10) || 'Amount: $%s' || chr(10) || 'Probability: %.4f' || chr(10)
           || 'Timestamp: %s' || chr(10) || chr(10),
           trans_num, CAST(amt AS VARCHAR), fraud_probability, CAST(inference_timestamp AS VARCHAR)),
    '' ORDER BY inference_timestamp DESC, trans_num) END AS message
FROM alerts
"""
sql("alert_message", f"SELECT message FROM ({ALERT_MESSAGE}) a")

# 2.4 filters
sql("prediction_filter", "SELECT trans_num, fraud_prediction, fraud_probability FROM predictions WHERE fraud_prediction = 0")
sql("fraud_only", "SELECT trans_num, amt, fraud_probability FROM predictions WHERE fraud_prediction = 1")
sql("map_filter", "SELECT trans_num, amt, fraud_probability, lat, long FROM map_rows")
sql(
    "drop_null_coords",
    "SELECT trans_num, amt, fraud_probability, lat, long FROM map_rows WHERE lat IS NOT NULL AND long IS NOT NULL",
)
sql(
    "drop_null_training",
    f"""
SELECT {FEATURES}, is_fraud FROM gold
WHERE {' AND '.join(c.strip() + ' IS NOT NULL' for c in (FEATURES + ', is_fraud').split(','))}
""",
)
sql("recent_fraud", f"SELECT {ALERT_COLS} FROM recent")

# 2.5 join
sql("unscored", "SELECT * FROM waiting")

# 2.6 aggregations
sql("row_count", "SELECT 'predictions' AS layer, count(*) AS rows FROM predictions")
sql("kpis", KPIS)
sql(
    "fraud_distribution",
    """
SELECT CASE fraud_prediction WHEN 0 THEN 'Non Fraud' WHEN 1 THEN 'Fraud' ELSE CAST(fraud_prediction AS VARCHAR) END AS fraud,
  count(*) AS count
FROM predictions WHERE fraud_prediction IS NOT NULL GROUP BY fraud_prediction
""",
)
sql(
    "fraud_by_hour",
    """
SELECT transaction_hour, count(*) AS count FROM predictions
WHERE fraud_prediction = 1 AND transaction_hour IS NOT NULL GROUP BY 1
""",
)
sql(
    "by_high_amount",
    """
SELECT CASE high_amount_flag WHEN 0 THEN 'Normal Amount' WHEN 1 THEN 'High Amount' ELSE CAST(high_amount_flag AS VARCHAR) END AS high_amount_flag,
  count(*) AS count
FROM predictions WHERE high_amount_flag IS NOT NULL GROUP BY predictions.high_amount_flag
""",
)
sql(
    "by_night",
    """
SELECT CASE night_transaction_flag WHEN 0 THEN 'Day' WHEN 1 THEN 'Night' ELSE CAST(night_transaction_flag AS VARCHAR) END AS night_transaction_flag,
  count(*) AS count
FROM predictions WHERE night_transaction_flag IS NOT NULL GROUP BY predictions.night_transaction_flag
""",
)
sql(
    "monitoring_panels",
    """
SELECT fraud_prediction, high_amount_flag, night_transaction_flag, transaction_hour, _prob_bin,
  count(*) AS n,
  count(*) FILTER (WHERE fraud_prediction = 1) AS frauds,
  CAST(sum(CAST(amt AS DECIMAL(18,4))) FILTER (WHERE fraud_prediction = 1) AS DOUBLE) AS fraud_amount,
  CAST(sum(CAST(fraud_probability AS DECIMAL(18,12))) AS DOUBLE) AS prob_sum,
  count(fraud_probability) AS prob_n,
  max(inference_timestamp) AS last_ts,
  grouping_id(fraud_prediction, high_amount_flag, night_transaction_flag, transaction_hour, _prob_bin) AS gid
FROM (SELECT *, CAST(least(floor(fraud_probability * 40), 39) AS INTEGER) AS _prob_bin FROM predictions) t
GROUP BY GROUPING SETS ((), (fraud_prediction), (high_amount_flag), (night_transaction_flag),
                        (transaction_hour), (_prob_bin))
""",
)
sql(
    "hist_probability",
    """
SELECT bin, CAST(0 AS DOUBLE) + bin * (CAST(1 AS DOUBLE) / 40) AS bin_start,
  CAST(0 AS DOUBLE) + (bin + 1) * (CAST(1 AS DOUBLE) / 40) AS bin_end, count(*) AS count
FROM (SELECT CAST(least(floor((fraud_probability - CAST(0 AS DOUBLE)) / CAST(1 AS DOUBLE) * 40), 39) AS INTEGER) AS bin
      FROM predictions WHERE fraud_probability IS NOT NULL) t
GROUP BY bin
""",
)
sql(
    "hist_distance",
    """
SELECT bin, r.lo + bin * ((r.hi - r.lo) / 50) AS bin_start, r.lo + (bin + 1) * ((r.hi - r.lo) / 50) AS bin_end, count(*) AS count
FROM (SELECT CAST(least(floor((customer_merchant_distance - r.lo) / (r.hi - r.lo) * 50), 49) AS INTEGER) AS bin
      FROM predictions,
           (SELECT min(customer_merchant_distance) AS lo, max(customer_merchant_distance) AS hi FROM predictions) r
      WHERE customer_merchant_distance IS NOT NULL) t,
     (SELECT min(customer_merchant_distance) AS lo, max(customer_merchant_distance) AS hi FROM predictions) r
GROUP BY bin, r.lo, r.hi
""",
)
sql(
    "silver_quality",
    """
SELECT count(*) AS bronze_rows,
  count(*) FILTER (WHERE trans_num IS NULL) AS null_keys,
  count(trans_num) - count(DISTINCT trans_num) AS duplicate_rows,
  count(*) FILTER (WHERE trans_date_trans_time IS NOT NULL AND TRY_CAST(trans_date_trans_time AS TIMESTAMP) IS NULL)
    AS bad_timestamps,
  count(*) FILTER (WHERE TRY_CAST(amt AS DOUBLE) IS NULL) AS null_amounts,
  count(*) FILTER (WHERE lat IS NULL OR long IS NULL) AS null_coordinates
FROM bronze
""",
)
sql(
    "uniqueness",
    "SELECT count(*) AS total_rows, count(DISTINCT trans_num) AS unique_rows, count(*) = count(DISTINCT trans_num) AS is_unique FROM bronze",
)
sql(
    "run_status",
    """
SELECT count(*) AS rows_processed, count(*) FILTER (WHERE fraud_prediction = 1) AS fraud_alerts,
  max(inference_timestamp) AS last_inference,
  strftime(max(inference_timestamp), '%Y-%m-%d %H:%M') AS last_inference_display
FROM predictions
""",
)
sql(
    "layer_validation",
    """
SELECT 'bronze' AS layer, count(*) AS rows, CAST(NULL AS BIGINT) AS expected, count(*) > 0 AS passed FROM bronze
UNION ALL SELECT 'silver', count(*), NULL, count(*) > 0 FROM silver
UNION ALL SELECT 'gold', count(*), NULL, count(*) > 0 FROM gold
UNION ALL SELECT 'predictions', count(*), NULL, count(*) > 0 FROM predictions
UNION ALL SELECT 'batch', (SELECT count(*) FROM batch), least(5000, (SELECT count(*) FROM waiting)),
  (SELECT count(*) FROM batch) = least(5000, (SELECT count(*) FROM waiting))
""",
)

# 2.7 top-k / sampling
sql("next_batch", "SELECT * FROM batch")
sql(
    "top_risk",
    """
SELECT trans_num, amt, customer_age, transaction_hour, customer_merchant_distance, fraud_probability, fraud_prediction
FROM predictions ORDER BY fraud_probability DESC, trans_num LIMIT 20
""",
)
sql("latest_predictions", "SELECT * FROM predictions ORDER BY inference_timestamp DESC, trans_num LIMIT 20")
sql("alerts", "SELECT * FROM alerts")
sql("raw_head", "SELECT * FROM predictions ORDER BY trans_num LIMIT 100")
sql(
    "map_sample",
    """
SELECT trans_num, lat, long, amt, fraud_probability FROM map_rows
WHERE lat IS NOT NULL AND long IS NOT NULL
ORDER BY md5(trans_num || '42'), trans_num LIMIT 3000
""",
)

# 2.9 machine learning (metric formulas; the forest itself has no SQL twin)
sql(
    "stratified_split",
    f"""
SELECT trans_num, is_fraud,
  row_number() OVER (PARTITION BY is_fraud ORDER BY md5(trans_num || '42'), trans_num)
    <= ceil(count(*) OVER (PARTITION BY is_fraud) * 0.2) AS is_test
FROM gold
WHERE {' AND '.join(c.strip() + ' IS NOT NULL' for c in (FEATURES + ', is_fraud').split(','))}
""",
)
NULLS = " + ".join(f"CASE WHEN {c.strip()} IS NULL OR isnan(CAST({c.strip()} AS DOUBLE)) THEN 1 ELSE 0 END" for c in FEATURES.split(","))
sql("reject_unscorable", f"SELECT trans_num, {NULLS} AS null_features FROM gold WHERE ({NULLS}) > 0")
COUNTS = """
SELECT count(*) FILTER (WHERE is_fraud = 1 AND fraud_prediction = 1) AS tp,
       count(*) FILTER (WHERE is_fraud = 0 AND fraud_prediction = 1) AS fp,
       count(*) FILTER (WHERE is_fraud = 1 AND fraud_prediction = 0) AS fn,
       count(*) FILTER (WHERE is_fraud = 0 AND fraud_prediction = 0) AS tn
FROM labelled
"""


def _r(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def _f(p: str, r: str) -> str:
    return f"(CASE WHEN ({p}) + ({r}) = 0 THEN CAST(0 AS DOUBLE) ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END)"


P1, R1 = _r("tp", "tp + fp"), _r("tp", "tp + fn")
P0, R0 = _r("tn", "tn + fn"), _r("tn", "tn + fp")
sql(
    "binary_metrics",
    f"SELECT {_r('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {P1} AS precision, {R1} AS recall, {_f(P1, R1)} AS f1 FROM ({COUNTS}) c",
)
sql(
    "confusion_matrix",
    f"""
SELECT 0 AS label, 0 AS prediction, tn AS count FROM ({COUNTS}) c
UNION ALL SELECT 0, 1, fp FROM ({COUNTS}) c
UNION ALL SELECT 1, 0, fn FROM ({COUNTS}) c
UNION ALL SELECT 1, 1, tp FROM ({COUNTS}) c
""",
)


def _w(a: str, b: str) -> str:
    return _r(f"({a}) * (tn + fp) + ({b}) * (tp + fn)", "tn + fp + tp + fn")


sql(
    "classification_report",
    f"""
SELECT '0' AS class, {P0} AS precision, {R0} AS recall, {_f(P0, R0)} AS f1_score, tn + fp AS support FROM ({COUNTS}) c
UNION ALL SELECT '1', {P1}, {R1}, {_f(P1, R1)}, tp + fn FROM ({COUNTS}) c
UNION ALL SELECT 'accuracy', NULL, NULL, {_r('tp + tn', 'tn + fp + tp + fn')}, tn + fp + tp + fn FROM ({COUNTS}) c
UNION ALL SELECT 'macro avg', ({P0} + {P1}) / 2, ({R0} + {R1}) / 2, ({_f(P0, R0)} + {_f(P1, R1)}) / 2, tn + fp + tp + fn FROM ({COUNTS}) c
UNION ALL SELECT 'weighted avg', {_w(P0, P1)}, {_w(R0, R1)}, {_w(_f(P0, R0), _f(P1, R1))}, tn + fp + tp + fn FROM ({COUNTS}) c
""",
)

# 2.10 end-to-end jobs
sql(
    "inference_selection",
    f"""
SELECT trans_num, {FEATURES} FROM waiting
WHERE {' AND '.join(c.strip() + ' IS NOT NULL AND NOT isnan(CAST(' + c.strip() + ' AS DOUBLE))' for c in FEATURES.split(','))}
ORDER BY ingestion_timestamp ASC NULLS FIRST, trans_num LIMIT 5000
""",
)
sql("bronze_to_silver", "SELECT * FROM silver")
sql("silver_to_gold", "SELECT * FROM gold")
sql("alert_batch", ALERT_MESSAGE)
sql(
    "validation_report",
    """
SELECT 'bronze' AS layer, count(*) AS total_rows, count(DISTINCT trans_num) AS unique_rows,
  count(*) - count(DISTINCT trans_num) AS duplicate_rows, true AS passed FROM bronze
UNION ALL SELECT 'silver', count(*), count(DISTINCT trans_num), count(*) - count(DISTINCT trans_num), count(*) = count(DISTINCT trans_num) FROM silver
UNION ALL SELECT 'gold', count(*), count(DISTINCT trans_num), count(*) - count(DISTINCT trans_num), count(*) = count(DISTINCT trans_num) FROM gold
UNION ALL SELECT 'predictions', count(*), count(DISTINCT trans_num), count(*) - count(DISTINCT trans_num), count(*) = count(DISTINCT trans_num) FROM predictions
""",
)

# 2.14 roadmap
sql(
    "fraud_trend",
    """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, transactions, frauds,
  frauds * CAST(100 AS DOUBLE) / transactions AS fraud_rate,
  CASE WHEN window_start > min(window_start) OVER () THEN frauds - coalesce(max(frauds) OVER (
    ORDER BY window_start RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING), 0) END AS frauds_change
FROM (
  SELECT time_bucket(INTERVAL '1 hour', trans_date_trans_time) AS window_start, count(*) AS transactions,
         count(*) FILTER (WHERE is_fraud = 1) AS frauds
  FROM gold WHERE trans_date_trans_time IS NOT NULL GROUP BY 1
) t
""",
)

sql(
    "amount_anomalies",
    """
SELECT v.trans_num, v.cc_num, v.amt, round(s.m, 6) AS customer_mean, round(s.sd, 6) AS customer_std,
  round(CASE WHEN s.sd > 0 THEN (v.amt - s.m) / s.sd END, 6) AS z_score,
  coalesce(abs(CASE WHEN s.sd > 0 THEN (v.amt - s.m) / s.sd END) > 3, false) AS is_anomaly
FROM (SELECT * FROM gold WHERE cc_num IS NOT NULL AND amt IS NOT NULL) v
JOIN (SELECT cc_num, avg(amt) AS m, stddev_samp(amt) AS sd FROM gold
      WHERE cc_num IS NOT NULL AND amt IS NOT NULL GROUP BY cc_num) s USING (cc_num)
""",
)
_DRIFT_FEATURES = [f.strip() for f in FEATURES.split(",")]
sql(
    "feature_drift",
    f"""
SELECT feature, psi,
  CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'shifted' END AS status
FROM (
  WITH drift_long AS (
    SELECT period, feature, x FROM (
      SELECT CASE WHEN ingestion_timestamp < TIMESTAMP '2024-01-15 00:00:00' THEN 'base' ELSE 'cur' END AS period,
             {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in _DRIFT_FEATURES)}
      FROM gold
    ) UNPIVOT (x FOR feature IN ({", ".join(_DRIFT_FEATURES)}))
  ),
  drift_rng AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM drift_long WHERE period = 'base' GROUP BY feature),
  binned AS (
    SELECT period, feature,
      CAST(least(greatest(CASE WHEN hi - lo > 0 THEN floor((x - lo) / (hi - lo) * 10) ELSE 0 END, 0), 9) AS INTEGER) AS bin
    FROM drift_long JOIN drift_rng USING (feature) WHERE x IS NOT NULL
  ),
  shares AS (
    SELECT period, feature, bin, n / sum(n) OVER (PARTITION BY period, feature) AS share
    FROM (SELECT period, feature, bin, count(*) AS n FROM binned GROUP BY period, feature, bin) t
  )
  SELECT coalesce(b.feature, c.feature) AS feature,
    round(sum((coalesce(c.share, CAST(0.0001 AS DOUBLE)) - coalesce(b.share, CAST(0.0001 AS DOUBLE)))
              * ln(coalesce(c.share, CAST(0.0001 AS DOUBLE)) / coalesce(b.share, CAST(0.0001 AS DOUBLE)))), 6) AS psi
  FROM (SELECT * FROM shares WHERE period = 'base') b
  FULL OUTER JOIN (SELECT * FROM shares WHERE period = 'cur') c ON b.feature = c.feature AND b.bin = c.bin
  GROUP BY coalesce(b.feature, c.feature)
) p
""",
)

# The model operators' contracts, and the column operators
SCORABLE = f"({NULLS}) = 0"
PARTS = " UNION ALL ".join(
    f"SELECT trans_num, CAST({i} AS INTEGER) AS position, CAST({c.strip()} AS DOUBLE) AS value FROM gold WHERE {SCORABLE}"
    for i, c in enumerate(FEATURES.split(","))
)
sql("assemble_elements", PARTS)
sql("separate_columns", f"SELECT trans_num, CAST(13 AS INTEGER) AS width FROM gold WHERE {SCORABLE}")
sql(
    "score_contract",
    f"""
SELECT count(*) AS rows, count(DISTINCT trans_num) AS keys, CAST(0 AS BIGINT) AS bad_probability,
  CAST(0 AS BIGINT) AS bad_label, CAST(0 AS BIGINT) AS bad_time
FROM gold WHERE {SCORABLE}
""",
)
sql(
    "inference_batch_contract",
    f"SELECT trans_num, amt FROM (SELECT * FROM waiting WHERE {SCORABLE} ORDER BY ingestion_timestamp ASC NULLS FIRST, trans_num LIMIT 5000)",
)
sql(
    "train_model_contract",
    f"""
SELECT CAST(is_fraud AS INTEGER) AS actual, CAST(ceil(count(*) * 0.2) AS BIGINT) AS support FROM gold
WHERE {' AND '.join(c.strip() + ' IS NOT NULL' for c in (FEATURES + ', is_fraud').split(','))}
GROUP BY is_fraud
UNION ALL
SELECT CAST(l AS INTEGER), CAST(0 AS BIGINT) FROM (VALUES (0), (1)) v(l)
WHERE l NOT IN (SELECT is_fraud FROM gold WHERE is_fraud IS NOT NULL)
""",
)
sql("importance_contract", "SELECT CAST(13 AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative, CAST(1 AS DOUBLE) AS total")
sql("normalize_columns", "SELECT trans_num, amt AS amount, city_pop FROM bronze")
sql("drop_if_present", "SELECT trans_num, amt FROM bronze")
sql("missing_source", "SELECT trans_num FROM gold WHERE trans_num IS NOT NULL")

# The incremental paths give what the full ones do
sql(
    "unscored_cursor",
    f"""
SELECT trans_num, amt FROM (
  SELECT * FROM waiting WHERE {SCORABLE} AND trans_num IS NOT NULL AND trans_num NOT IN (
    SELECT trans_num FROM waiting
    WHERE {SCORABLE} AND trans_num IS NOT NULL AND ingestion_timestamp < TIMESTAMP '2024-01-20 00:00:00' AND CAST(trans_num AS BIGINT) % 13 <> 0
    ORDER BY ingestion_timestamp, trans_num LIMIT 700)
  ORDER BY ingestion_timestamp ASC NULLS FIRST, trans_num LIMIT 5000)
""",
)
sql("train_contract", "SELECT CAST(i AS INTEGER) AS tree, true AS within_depth, true AS same_on_other_files FROM (SELECT unnest(range(0, 100)) AS i) t")
sql("silver_merge", "SELECT * FROM silver")
sql("stream_latest", "SELECT * FROM silver")

# Content reconciliation and snapshot differences
EDITED_AMT = "CASE WHEN CAST(trans_num AS BIGINT) % 89 = 3 THEN amt + 1 ELSE amt END"
EDITED_CITY = "CASE WHEN CAST(trans_num AS BIGINT) % 83 = 7 THEN NULL ELSE city_pop END"
EDITED = f"""
  SELECT * REPLACE ({EDITED_AMT} AS amt, CAST({EDITED_CITY} AS INTEGER) AS city_pop) FROM {{0}} WHERE CAST(trans_num AS BIGINT) % 97 <> 5
  UNION ALL
  SELECT * REPLACE ('9000000' || trans_num AS trans_num) FROM {{0}} WHERE CAST(trans_num AS BIGINT) % 101 = 9
"""
ORACLE["reconcile_layers"] = with_layers(
    extra_ctes=f"""
loaded AS ({EDITED.format("gold")}),
t AS (SELECT trans_num, any_value(amt) AS amt, any_value(city_pop) AS city_pop,
        CAST(CASE WHEN CAST(trans_num AS BIGINT) % 103 = 11 THEN 2 ELSE 1 END AS BIGINT) AS n FROM loaded GROUP BY trans_num)
""",
    body="""
SELECT coalesce(s.trans_num, t.trans_num) AS trans_num,
  CASE WHEN t.trans_num IS NULL THEN 'missing' WHEN s.trans_num IS NULL THEN 'extra' ELSE 'differs' END AS status,
  CASE WHEN t.trans_num IS NULL OR s.trans_num IS NULL THEN NULL
       WHEN t.n = 2 THEN 'rows'
       ELSE concat_ws(',', CASE WHEN s.amt IS DISTINCT FROM t.amt THEN 'amt' END,
                           CASE WHEN s.city_pop IS DISTINCT FROM t.city_pop THEN 'city_pop' END) END AS changed,
  CAST(CASE WHEN s.trans_num IS NULL THEN 0 ELSE 1 END AS BIGINT) AS source_rows,
  coalesce(t.n, CAST(0 AS BIGINT)) AS target_rows
FROM gold s FULL OUTER JOIN t ON s.trans_num = t.trans_num
WHERE s.trans_num IS NULL OR t.trans_num IS NULL OR t.n = 2
   OR s.amt IS DISTINCT FROM t.amt OR s.city_pop IS DISTINCT FROM t.city_pop
""",
)
ORACLE["snapshot_changes"] = with_layers(
    extra_ctes=f"snap AS ({EDITED.format('bronze_base')})",
    body="""
SELECT coalesce(n.trans_num, o.trans_num) AS trans_num,
  CASE WHEN n.trans_num IS NULL THEN o.amt ELSE n.amt END AS amt,
  CASE WHEN n.trans_num IS NULL THEN o.city_pop ELSE n.city_pop END AS city_pop,
  TIMESTAMP '2024-03-01 00:00:00' AS ingestion_timestamp, n.trans_num IS NULL AS is_deleted,
  CASE WHEN n.trans_num IS NULL THEN 'delete' WHEN o.trans_num IS NULL THEN 'insert' ELSE 'update' END AS change
FROM snap n FULL OUTER JOIN latest o ON n.trans_num = o.trans_num
WHERE n.trans_num IS NULL OR o.trans_num IS NULL OR n.amt IS DISTINCT FROM o.amt OR n.city_pop IS DISTINCT FROM o.city_pop
""",
)
ORACLE["snapshot_merge"] = with_layers("SELECT * EXCLUDE (ingestion_timestamp) FROM gold", bronze=EDITED.format("bronze_base"))

# Tables kept by state give what the whole table gives
ORACLE["append_keystore"] = ORACLE["append_idempotent"]
ORACLE["panels_refreshed"] = ORACLE["monitoring_panels"]
sql("compact_batches", "SELECT * FROM predictions")

# Anomalies against the past, model comparison, sketches
sql(
    "past_anomalies",
    """
SELECT trans_num, cc_num, amt, past, round(m, 6) AS past_mean, round(sd, 6) AS past_std,
  round(CASE WHEN sd > 0 THEN (amt - m) / sd END, 6) AS z_score,
  coalesce(abs(CASE WHEN sd > 0 THEN (amt - m) / sd END) > 3, false) AS is_anomaly
FROM (
  SELECT trans_num, cc_num, amt, past, CASE WHEN past >= 5 THEN s / past END AS m,
    CASE WHEN past >= 5 THEN sqrt(greatest((ss - s * s / past) / (past - 1), CAST(0 AS DOUBLE))) END AS sd
  FROM (
    SELECT trans_num, cc_num, amt, count(*) OVER w AS past,
      CAST(coalesce(sum(x) OVER w, 0) AS DOUBLE) AS s, CAST(coalesce(sum(x * x) OVER w, 0) AS DOUBLE) AS ss
    FROM (SELECT *, CAST(amt AS DECIMAL(18,4)) AS x FROM gold
          WHERE cc_num IS NOT NULL AND amt IS NOT NULL AND trans_date_trans_time IS NOT NULL) v
    WINDOW w AS (PARTITION BY cc_num ORDER BY trans_date_trans_time, trans_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  ) t
) u
""",
)


def _poisson_weight(h: str) -> str:
    """The weight of a 24-bit hash value: how many of the Poisson distribution's sums it passes."""
    total, term, cuts = 0.0, math.exp(-1), []
    for k in range(1, 30):
        total += term
        if (at := round(total * 2**24)) >= 2**24:
            break
        cuts.append(at)
        term /= k
    return " + ".join(f"CAST({h} >= {c} AS INTEGER)" for c in cuts)


METRICS = {
    "accuracy": "(tp + tn) / n",
    "precision": "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END",
    "recall": "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END",
    "f1_score": "CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) ELSE 0 END",
}
COMPARISON = f"""
SELECT metric, round(max(CASE WHEN j = 0 THEN a END), 6) AS current, round(max(CASE WHEN j = 0 THEN b END), 6) AS candidate,
  round(max(CASE WHEN j = 0 THEN b - a END), 6) AS difference,
  round(max(CASE WHEN place = 3 THEN b - a END), 6) AS low, round(max(CASE WHEN place = 98 THEN b - a END), 6) AS high,
  max(CASE WHEN place = 3 THEN b - a END) > 0 OR max(CASE WHEN place = 98 THEN b - a END) < 0 AS significant
FROM (
  SELECT *, CASE WHEN j > 0 THEN row_number() OVER (PARTITION BY metric, j > 0 ORDER BY b - a) END AS place
  FROM (
    {" UNION ALL ".join(
        f"SELECT '{m}' AS metric, j, max(CASE WHEN model = 'a' THEN {e} END) AS a, max(CASE WHEN model = 'b' THEN {e} END) AS b FROM counts GROUP BY j"
        for m, e in METRICS.items()
    )}
  ) m
) p
GROUP BY metric
"""
ORACLE["model_comparison"] = with_layers(
    COMPARISON,
    STATE
    + f""",
pair AS (
  SELECT trans_num, is_fraud, fraud_prediction AS a,
    CASE WHEN customer_merchant_distance > 5 OR (amt > 900 AND night_transaction_flag = 1) THEN 1 ELSE 0 END AS b
  FROM labelled WHERE is_fraud IS NOT NULL AND fraud_prediction IS NOT NULL
),
weighed AS (
  SELECT *, CASE WHEN j = 0 THEN 1 ELSE {_poisson_weight("h")} END AS w
  FROM (SELECT *, CAST('0x' || substr(md5(CAST(j AS VARCHAR) || '#' || trans_num), 1, 6) AS BIGINT) AS h
        FROM pair, (SELECT unnest(range(0, 101)) AS j) r) x
),
counts AS (
  {" UNION ALL ".join(
      f"SELECT '{m}' AS model, j, CAST(sum(w) AS DOUBLE) AS n, "
      + ", ".join(
          f"CAST(coalesce(sum(w) FILTER (WHERE {m} = {said} AND is_fraud = {real}), 0) AS DOUBLE) AS {name}"
          for name, said, real in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0))
      )
      + " FROM weighed GROUP BY j"
      for m in "ab"
  )}
)
""",
)
sql(
    "key_sketches",
    """
SELECT 'gold' AS what, count(DISTINCT trans_num) AS keys, true AS within_bound FROM gold
UNION ALL SELECT 'scored', count(DISTINCT trans_num), true FROM scored_keys
UNION ALL SELECT 'unscored', count(DISTINCT trans_num), true FROM waiting
""",
)
sql(
    "quantile_drift",
    " UNION ALL ".join(
        f"SELECT '{f.strip()}' AS feature, count({f}) FILTER (WHERE ingestion_timestamp < TIMESTAMP '2024-01-15 00:00:00') AS base_rows, "
        f"count({f}) FILTER (WHERE ingestion_timestamp >= TIMESTAMP '2024-01-15 00:00:00') AS current_rows, "
        "CAST(0 AS BIGINT) AS beyond_error FROM gold"
        for f in FEATURES.split(",")
    ),
)
