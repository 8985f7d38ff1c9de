"""The registered queries as SQL over the event table, written for DuckDB."""

from __future__ import annotations

_BASE = """
WITH raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         1704067200000 + (epoch_us(ts) - 1704067200000000) // 20000 AS tms
  FROM events
), lagged AS (
  SELECT *,
         'ACC-' || CAST(1000 + user_id // 15 AS VARCHAR) AS account_id,
         (['New York','London','Paris','Tokyo','Berlin','Unknown'])[1 + (event_id * 7 + k) % 6] AS location,
         CASE WHEN event_id % 50 = 0 THEN 900 WHEN event_id % 50 = 1 THEN 600 - event_id % 11
              ELSE k % 7 END AS lag1,
         event_id % 11 AS lag2,
         make_timestamp(tms * 1000) AS event_time
  FROM raw
), clocked AS (
  SELECT *, make_timestamp((tms + lag1 * 1000) * 1000) AS kafka_timestamp,
         make_timestamp((tms + (lag1 + lag2) * 1000) * 1000) AS spark_proc_time
  FROM lagged
), timed AS (
  SELECT *,
         tms AS "timestamp",
         CAST(epoch(date_trunc('second', kafka_timestamp)) - epoch(date_trunc('second', event_time)) AS BIGINT) AS source_to_kafka_lag_sec,
         CAST(epoch(date_trunc('second', spark_proc_time)) - epoch(date_trunc('second', kafka_timestamp)) AS BIGINT) AS kafka_to_spark_lag_sec,
         CAST(epoch(date_trunc('second', spark_proc_time)) - epoch(date_trunc('second', event_time)) AS BIGINT) AS total_latency_sec,
         event_time >= spark_proc_time - INTERVAL 10 MINUTE AS on_time,
         CAST(event_time AS DATE) AS dt,
         CAST(hour(event_time) AS INTEGER) AS hr
  FROM clocked
), tx AS (
  SELECT *, CAST((CASE WHEN amount > 10000 THEN 50 ELSE 0 END)
              + (CASE WHEN is_international THEN 30 ELSE 0 END)
              + (CASE WHEN location = 'Unknown' THEN 20 ELSE 0 END) AS INTEGER) AS risk_score
  FROM (SELECT *, 'TX-' || CAST(event_id AS VARCHAR) AS transaction_id,
               CAST(round(value * 100) AS DOUBLE) AS amount, 'USD' AS currency,
               'TRANSFER' AS transaction_type, 'RETAIL' AS merchant_category,
               k % 2 = 0 AS is_international
        FROM timed WHERE event_type IN ('view', 'purchase', 'error'))
), lg AS (
  SELECT *, 'LG-' || CAST(event_id AS VARCHAR) AS login_id,
         '192.168.1.' || CAST(1 + k AS VARCHAR) AS ip_address,
         CASE WHEN k % 2 = 0 THEN 'Mobile' ELSE 'Web' END AS device_type
  FROM timed WHERE event_type = 'click'
), ac AS (
  SELECT *, CASE WHEN k % 4 = 0 THEN 'ADDRESS_CHANGE' ELSE 'LIMIT_CHANGE' END AS activity_type,
         '5000' AS old_value, '20000' AS new_value
  FROM timed WHERE event_type = 'signup'
), login_alert AS (
  SELECT t.account_id, t.event_time, t.transaction_id, t.amount, t.location AS tx_location,
         l.location AS login_location, l.ip_address, l.device_type, l.login_id,
         'LOGIN_THEN_TX' AS alert_type,
         'login location != tx location within window' AS reason, t.risk_score, t.dt, t.hr
  FROM tx t JOIN lg l ON t.account_id = l.account_id
   AND t.event_time BETWEEN l.event_time AND l.event_time + INTERVAL 1 MINUTE
  WHERE t.on_time AND l.on_time AND t.location <> l.location
), activity_alert AS (
  SELECT t.account_id, t.event_time, t.transaction_id, t.amount, a.activity_type, a.old_value,
         a.new_value, 'ACTIVITY_THEN_TX' AS alert_type,
         'limit change then high tx within window' AS reason, t.risk_score, t.dt, t.hr
  FROM tx t JOIN ac a ON t.account_id = a.account_id
   AND t.event_time BETWEEN a.event_time AND a.event_time + INTERVAL 5 MINUTE
  WHERE t.on_time AND a.on_time AND a.activity_type = 'LIMIT_CHANGE' AND t.amount >= 10000
), alert AS (
  SELECT * FROM login_alert UNION ALL BY NAME SELECT * FROM activity_alert
)
"""

_TX_WIRE = """transaction_id, account_id, amount, currency, transaction_type, merchant_category,
  location, "timestamp", is_international, kafka_timestamp"""
_LOGIN_WIRE = 'account_id, login_id, ip_address, location, device_type, "timestamp", kafka_timestamp'
_ACTIVITY_WIRE = 'account_id, activity_type, old_value, new_value, "timestamp", kafka_timestamp'
_LAGS = "spark_proc_time, source_to_kafka_lag_sec, kafka_to_spark_lag_sec, total_latency_sec"
_CALENDAR = "event_time, dt, hr"
_LOGIN_ALERT = """SELECT account_id, event_time, transaction_id, amount, tx_location, login_location,
  ip_address, device_type, login_id, alert_type, reason, risk_score FROM login_alert"""
_ACTIVITY_ALERT = """SELECT account_id, event_time, transaction_id, amount, activity_type, old_value,
  new_value, alert_type, reason, risk_score FROM activity_alert"""
_REASON = "CAST(CASE WHEN on_time THEN NULL ELSE 'late' END AS VARCHAR) AS dlq_reason"
_UNIFIED = f"""
  SELECT 'BRONZE_TX' AS _type, {_TX_WIRE}, {_CALENDAR}, {_LAGS}, {_REASON},
         CAST(NULL AS INTEGER) AS risk_score, CAST(NULL AS BOOLEAN) AS is_high_risk FROM tx WHERE on_time
  UNION ALL BY NAME SELECT 'SILVER_TX' AS _type, {_TX_WIRE}, {_CALENDAR}, {_LAGS}, {_REASON},
         risk_score, risk_score >= 50 AS is_high_risk FROM tx WHERE on_time
  UNION ALL BY NAME SELECT 'LATE_TX' AS _type, {_TX_WIRE}, {_CALENDAR}, {_LAGS}, {_REASON},
         CAST(NULL AS INTEGER) AS risk_score, CAST(NULL AS BOOLEAN) AS is_high_risk FROM tx WHERE NOT on_time
  UNION ALL BY NAME SELECT CASE WHEN on_time THEN 'BRONZE_LOGIN' ELSE 'LATE_LOGIN' END AS _type,
         {_LOGIN_WIRE}, {_CALENDAR}, {_LAGS}, {_REASON} FROM lg
  UNION ALL BY NAME SELECT CASE WHEN on_time THEN 'BRONZE_ACTIVITY' ELSE 'LATE_ACTIVITY' END AS _type,
         {_ACTIVITY_WIRE}, {_CALENDAR}, {_LAGS}, {_REASON} FROM ac
  UNION ALL BY NAME SELECT 'ALERT' AS _type, * FROM alert
"""
_KPI = _KPI_FLAG = """SELECT count(*) AS total_transactions, count(*) FILTER (risk_score >= 50) AS total_alerts,
  100.0 * count(*) FILTER (risk_score >= 50) / count(*) AS fraud_percentage,
  coalesce(sum(amount) FILTER (risk_score >= 50), 0) AS high_risk_volume"""
_PLACES = """SELECT tx_location AS location, count(*) AS alert_count,
  sum(amount) AS total_fraud_amount, avg(risk_score) AS avg_risk_score"""
_COUNTS = f"SELECT _type, count(*) AS row_count FROM ({_UNIFIED}) GROUP BY _type"
_TOP = """SELECT account_id, count(*) AS total_alerts, max(risk_score) AS peak_score
  FROM alert WHERE dt = DATE '2024-01-01' GROUP BY account_id HAVING count(*) > 2
  ORDER BY total_alerts DESC, account_id"""

_QUERIES = {
    "bronze_tx": f"SELECT {_TX_WIRE}, {_CALENDAR} FROM tx",
    "bronze_login": f"SELECT {_LOGIN_WIRE}, {_CALENDAR} FROM lg",
    "bronze_activity": f"SELECT {_ACTIVITY_WIRE}, {_CALENDAR} FROM ac",
    "frame_decode": f"SELECT {_TX_WIRE} FROM tx",
    "frame_headers": """SELECT CAST(0 AS BIGINT) AS magic,
        CAST(CASE event_type WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 1 END AS BIGINT) AS schema_id,
        count(*) AS message_count FROM timed GROUP BY ALL""",
    "bad_frame_audit": """SELECT 'logins' AS topic,
        CASE tms % 10 WHEN 0 THEN 'frame without body' WHEN 1 THEN 'unknown magic byte'
             ELSE 'undecodable body' END AS dlq_reason,
        count(*) AS message_count FROM lg WHERE tms % 10 < 3 GROUP BY ALL""",
    "schema_versions": """SELECT transaction_id, account_id, amount,
        CASE WHEN old THEN 'EUR' ELSE currency END AS currency,
        CASE WHEN NOT old THEN transaction_type END AS transaction_type,
        CASE WHEN NOT old THEN merchant_category END AS merchant_category,
        location, "timestamp", CASE WHEN NOT old THEN is_international END AS is_international, kafka_timestamp
        FROM (SELECT *, tms % 10 IN (3, 4, 5) AS old FROM tx WHERE tms % 10 NOT IN (6, 7))""",
    "schema_version_audit": """SELECT 'transactions' AS topic, CAST(CASE tms % 10 WHEN 6 THEN 99 ELSE 11 END AS BIGINT) AS schema_id,
        CASE tms % 10 WHEN 6 THEN 'unknown schema id' ELSE 'undecodable body' END AS dlq_reason,
        count(*) AS message_count FROM tx WHERE tms % 10 IN (6, 7) GROUP BY ALL""",
    "risk_scores": """SELECT transaction_id, account_id, amount, location, is_international,
        risk_score, risk_score >= 50 AS is_high_risk FROM tx""",
    "risk_score_dist": """SELECT risk_score, risk_score >= 50 AS is_high_risk, count(*) AS tx_count,
        sum(amount) AS total_amount FROM tx GROUP BY ALL""",
    "lag_metrics": f"SELECT transaction_id, event_time, kafka_timestamp, {_LAGS}, on_time FROM tx",
    "on_time_tx": """SELECT transaction_id, account_id, event_time, total_latency_sec
        FROM tx WHERE on_time""",
    "late_tx": f"""SELECT transaction_id, account_id, amount, total_latency_sec, event_time, {_REASON}
        FROM tx WHERE NOT on_time""",
    "late_login": f"""SELECT login_id, account_id, total_latency_sec, event_time, {_REASON}
        FROM lg WHERE NOT on_time""",
    "late_activity": f"""SELECT account_id, activity_type, total_latency_sec, event_time, {_REASON}
        FROM ac WHERE NOT on_time""",
    "login_then_tx": _LOGIN_ALERT,
    "login_then_tx_hot_accounts": _LOGIN_ALERT,
    "activity_then_tx": _ACTIVITY_ALERT,
    "alerts_all": "SELECT * FROM alert",
    "unified_rows": _UNIFIED,
    "route_counts": _COUNTS,
    "ingest_lag_by_hour": """SELECT dt, hr, avg(source_to_kafka_lag_sec) AS avg_network_lag,
        avg(kafka_to_spark_lag_sec) AS avg_spark_lag FROM tx WHERE on_time GROUP BY dt, hr
        ORDER BY dt DESC, hr DESC""",
    "fraud_heatmap": """SELECT tx_location, count(*) AS alert_count, sum(amount) AS value_at_risk
        FROM alert WHERE dt = DATE '2024-01-01' GROUP BY tx_location
        ORDER BY alert_count DESC, tx_location""",
    "dlq_audit": """SELECT dt, count(*) AS late_count,
        sum(amount) AS lost_realtime_visibility_amount FROM tx WHERE NOT on_time GROUP BY dt""",
    "top_risk_accounts": _TOP,
    "top5_risk_accounts": _TOP + " LIMIT 5",
    "gold_location_risk": f"{_PLACES} FROM alert WHERE dt = DATE '2024-01-01' GROUP BY tx_location",
    "gold_daily_kpi": f"{_KPI} FROM tx WHERE on_time AND dt = DATE '2024-01-01'",
    "gold_daily_kpi_flag": f"{_KPI_FLAG} FROM tx WHERE on_time AND dt = DATE '2024-01-01'",
    "layer_roundtrip": """SELECT transaction_id, account_id, amount, total_latency_sec, event_time,
        dt, hr FROM tx WHERE NOT on_time""",
    "compacted_hour": """SELECT transaction_id, account_id, amount, event_time, risk_score,
        risk_score >= 50 AS is_high_risk, dt, hr, 'compacted' AS batch_id
        FROM tx WHERE on_time AND dt = DATE '2024-01-01' AND hr = 7""",
    "compacted_day": """SELECT account_id, event_time, transaction_id, alert_type, login_id,
        risk_score, dt, hr, true AS compacted, CAST(1 AS INTEGER) AS leaves FROM alert WHERE dt = DATE '2024-01-01'""",
    "folded_hours": """SELECT account_id, event_time, transaction_id, alert_type, login_id,
        risk_score, dt, hr, CAST(0 AS INTEGER) AS leaves_left FROM alert WHERE dt = DATE '2024-01-01'""",
    "repaired_alerts": """SELECT account_id, event_time, transaction_id, alert_type, login_id, old_value, risk_score, dt, hr,
        epoch_ms(event_time) % 3 = 0 AS repaired, 0 AS still_missing FROM alert WHERE dt = DATE '2024-01-01'""",
    "partition_inventory": "SELECT dt, hr, count(*) AS row_count FROM tx WHERE on_time GROUP BY dt, hr",
    "synced_table_counts": """SELECT dt, hr, count(*) AS late_count,
        CAST(0 AS BIGINT) AS count_before_sync FROM tx WHERE NOT on_time GROUP BY dt, hr""",
    "hourly_gold_location": f"""{_PLACES}, DATE '2024-01-01' AS dt
        FROM alert WHERE dt = DATE '2024-01-01' GROUP BY tx_location""",
    "hourly_gold_kpi": f"""{_KPI_FLAG}, DATE '2024-01-01' AS dt
        FROM tx WHERE on_time AND dt = DATE '2024-01-01'""",
    "alerts_serving": """SELECT row_key, amount, alert_type AS al_type, reason AS al_reason,
          transaction_id AS tx_id, CAST(risk_score AS VARCHAR) AS tx_risk
        FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY alert_type) AS rn
              FROM (SELECT *, account_id || '_' || CAST(epoch_us(event_time) // 1000 AS VARCHAR)
                              || '_' || transaction_id AS row_key FROM alert))
        WHERE rn = 1""",
    "serving_table": """SELECT row_key, alert_type AS al_type, reason AS al_reason,
          transaction_id AS tx_id, CAST(risk_score AS VARCHAR) AS tx_risk, dt
        FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY alert_type) AS rn
              FROM (SELECT *, account_id || '_' || CAST(epoch_us(event_time) // 1000 AS VARCHAR)
                              || '_' || transaction_id AS row_key FROM alert
                    WHERE dt = DATE '2024-01-01'))
        WHERE rn = 1""",
    "serving_cells": """SELECT row_key, amount, CAST(risk_score AS INTEGER) AS risk, CAST(NULL AS TIMESTAMP) AS proc_ts
        FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY alert_type) AS rn
              FROM (SELECT *, account_id || '_' || CAST(epoch_us(event_time) // 1000 AS VARCHAR)
                              || '_' || transaction_id AS row_key FROM alert WHERE dt = DATE '2024-01-01'))
        WHERE rn = 1
        UNION ALL SELECT row_key, amount, CAST(risk_score AS INTEGER), spark_proc_time
        FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY spark_proc_time DESC, transaction_id DESC) AS rn
              FROM (SELECT *, account_id || '_' || CAST(tms AS VARCHAR) AS row_key
                    FROM tx WHERE on_time AND risk_score >= 50 AND dt = DATE '2024-01-01'))
        WHERE rn = 1""",
    "high_risk_serving": """SELECT row_key, transaction_id, amount,
          CAST(risk_score AS VARCHAR) AS tx_risk_score, location AS tx_location,
          'true' AS tx_is_high_risk
        FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY spark_proc_time DESC, transaction_id DESC) AS rn
              FROM (SELECT *, account_id || '_' || CAST(tms AS VARCHAR) AS row_key
                    FROM tx WHERE on_time AND risk_score >= 50))
        WHERE rn = 1""",
    "stream_login_then_tx": _LOGIN_ALERT,
    "stream_activity_then_tx": _ACTIVITY_ALERT,
    "stream_growing_hot_list": "SELECT * FROM alert",
    "stream_route_counts": _COUNTS,
    "replay_null_times": """SELECT CASE WHEN on_time AND NOT ends_with(transaction_id, '7') THEN 'BRONZE_TX' ELSE 'LATE_TX' END
        AS _type, count(*) AS row_count FROM tx GROUP BY ALL""",
    "stream_future_event": "SELECT * FROM alert",
    "stream_commit_records": _COUNTS,
    "stream_dual_write": """SELECT transaction_id, account_id, amount, risk_score,
        risk_score >= 50 AS is_high_risk, event_time, dt, hr FROM tx""",
}

ORACLES = {name: _BASE + sql for name, sql in _QUERIES.items()}
