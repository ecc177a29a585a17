"""DuckDB twins of the fixture layers, for the correctness oracle.

``with_layers(sql)`` prefixes a query with CTEs ``bronze``, ``silver``,
``gold`` and ``predictions`` that compute, in DuckDB SQL, what
``txnlake.plans.fixtures.fixture_layers`` computes in Spark.  Written
independently of the Spark code: same definitions, different engine.
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format

BRONZE_BASE = f"""
SELECT
  CAST(event_id AS VARCHAR) AS trans_num,
  user_id AS cc_num,
  CASE WHEN event_id % 100 = 99 THEN 'bad'
       ELSE CAST(date_trunc('second', ts) AS VARCHAR) END AS trans_date_trans_time,
  event_type AS category,
  value * 20 AS amt,
  CASE WHEN event_id % 50 = 7 THEN NULL
       ELSE {D(30)} + (user_id * 37 % 1500) / {D(100)} END AS lat,
  {D(-100)} + (user_id * 53 % 3000) / {D(100)} AS long,
  ({D(30)} + (user_id * 37 % 1500) / {D(100)})
    + CASE WHEN event_type = 'error' THEN 10 + event_id % 10
           ELSE ((event_id * 7) % 100 - 50) / {D(1000)} END AS merch_lat,
  ({D(-100)} + (user_id * 53 % 3000) / {D(100)})
    + CASE WHEN event_type = 'error' THEN 10 + event_id % 10
           ELSE ((event_id * 11) % 100 - 50) / {D(1000)} END AS merch_long,
  CAST(1000 + (user_id * 7919) % 999000 AS INTEGER) AS city_pop,
  DATE '1944-01-01' + CAST((user_id * 97) % 22000 AS INTEGER) AS dob,
  CAST(floor(epoch(ts)) AS BIGINT) AS unix_time,
  CASE WHEN (event_type = 'error') <> (event_id % 10 = 0) THEN 1 ELSE 0 END AS is_fraud,
  date_trunc('hour', ts) AS ingestion_timestamp
FROM events
"""

BRONZE = """
  SELECT * FROM bronze_base
  UNION ALL
  SELECT * REPLACE (ingestion_timestamp + INTERVAL 1 HOUR AS ingestion_timestamp)
  FROM bronze_base WHERE CAST(trans_num AS BIGINT) % 20 = 3
"""

REST = f"""
latest AS (
  SELECT * FROM bronze WHERE trans_num IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trans_num ORDER BY ingestion_timestamp DESC) = 1
),
parsed AS (
  SELECT * REPLACE (TRY_CAST(trans_date_trans_time AS TIMESTAMP) AS trans_date_trans_time,
                    TRY_CAST(amt AS DOUBLE) AS amt)
  FROM latest
),
silver AS (
  SELECT *,
    CAST(year(trans_date_trans_time) AS INTEGER) AS transaction_year,
    CAST(month(trans_date_trans_time) AS INTEGER) AS transaction_month,
    CAST(day(trans_date_trans_time) AS INTEGER) AS transaction_day,
    CAST(hour(trans_date_trans_time) AS INTEGER) AS transaction_hour,
    CASE WHEN dayofweek(trans_date_trans_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM parsed
),
gold AS (
  SELECT *,
    CAST(floor(date_diff('day', dob, DATE '2024-02-01') / 365) AS BIGINT) AS customer_age,
    CASE WHEN amt > 500 THEN 1 ELSE 0 END AS high_amount_flag,
    CASE WHEN transaction_hour BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS night_transaction_flag,
    -- squares as products: exact IEEE products equal Spark's result, while
    -- DuckDB's pow(x, 2) misrounds near-ties (e.g. x = -11.000000000000004)
    sqrt((lat - merch_lat) * (lat - merch_lat) + (long - merch_long) * (long - merch_long))
      AS customer_merchant_distance
  FROM silver
),
scored AS (
  SELECT *, round({D(0.25)} * high_amount_flag + {D(0.1)} * night_transaction_flag
         + {D(0.02)} * least(coalesce(customer_merchant_distance, {D(0)}), {D(20)})
         + {D(0.25)} * (CAST(trans_num AS BIGINT) % 97) / {D(97)}, 6) AS p
  FROM gold
),
predictions AS (
  SELECT trans_num, amt, city_pop, lat, long, merch_lat, merch_long, unix_time,
    transaction_hour, is_weekend, customer_age, high_amount_flag, night_transaction_flag,
    customer_merchant_distance,
    CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS fraud_prediction,
    p AS fraud_probability,
    TIMESTAMP '2024-01-31 00:00:00' - (CAST(trans_num AS BIGINT) % 3) * INTERVAL '1' DAY AS inference_timestamp
  FROM scored
)
"""


def with_layers(body: str, extra_ctes: str = "", bronze: str = BRONZE) -> str:
    ctes = f"bronze_base AS ({BRONZE_BASE}),\nbronze AS ({bronze}),{REST}" + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
