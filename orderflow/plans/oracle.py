"""DuckDB oracle SQL for every named query.

An independent re-statement of each query in plain SQL over the same parquet tables: the event
log is derived from ``orders`` with string concatenation, validated with DuckDB's JSON
functions, de-duplicated with ``row_number()`` and correlated by two inner joins
(failed payments + authorized payments joined to inventory), i.e. not the Spark plan.
"""

from __future__ import annotations

TS_FMT = "'%Y-%m-%dT%H:%M:%S.000Z'"

LOG = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
         o_orderkey % 211 AS r, o_orderkey % 20 AS sc,
         'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS oid,
         'CUS-' || CAST(o_custkey AS VARCHAR) AS cid,
         'PAY-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS pid,
         CAST(o_totalprice AS VARCHAR) AS price,
         o_orderdate + to_seconds(o_orderkey % 86400) AS t0,
         CASE WHEN o_orderkey % 97 = 5 THEN 960 WHEN o_orderkey % 97 = 6 THEN 900
              WHEN o_orderkey % 97 = 7 THEN -1 ELSE 2 + o_orderkey % 7 END AS pay_gap,
         CASE WHEN o_orderkey % 101 = 5 THEN 901 WHEN o_orderkey % 101 = 6 THEN 900
              ELSE 2 + o_orderkey % 5 END AS inv_gap
  FROM orders
),
b2 AS (
  SELECT *, (sc >= 15 AND sc < 18) AS failed, (sc >= 18) AS rejected,
         t0 + to_seconds(pay_gap) AS tp, t0 + to_seconds(pay_gap + 1) AS tp2,
         t0 + to_seconds(pay_gap + inv_gap) AS ti, t0 + to_seconds(pay_gap + 60) AS ta,
         (sc >= 15 AND sc < 18 AND k % 29 = 4) AS recovers, CAST(k % 3 AS INTEGER) AS part
  FROM base
),
ohead AS (
  SELECT *, '"event_id":"O-' || k || '","event_type":"' || (CASE WHEN r = 14 THEN 'order_updated' ELSE 'order_created' END)
            || '","event_time":"'
            || (CASE WHEN r = 13 THEN 'not-a-time' ELSE strftime(t0, {TS_FMT}) END)
            || '","schema_version":' || (CASE WHEN r = 4 THEN '2' ELSE '1' END)
            || ',"order_id":"' || oid || '"'
            || (CASE WHEN r = 2 THEN '' ELSE ',"customer_id":"' || cid || '"' END) AS hd
  FROM b2
),
log AS (
  SELECT CASE WHEN r = 3 THEN 'BAD-' || k ELSE oid END AS kafka_key,
         CASE WHEN r = 5 THEN 'payments' ELSE 'orders' END AS topic,
         part AS "partition", k * 16 + s.slot AS "offset",
         CASE WHEN r = 12 THEN NULL
              WHEN r = 1 THEN '{{' || hd || ',"payload":'
              ELSE '{{' || hd || ',"payload":{{"total_amount":'
                   || (CASE WHEN r = 6 THEN '0.0' WHEN r = 15 THEN '12500000.5' ELSE price END) || ',"currency":"MAD"}}}}' END
           AS raw_json
  FROM ohead, (VALUES (0), (1)) s(slot)
  WHERE s.slot = 0 OR k % 50 = 0
  UNION ALL
  SELECT oid, 'payments', part, k * 16 + s.slot,
         '{{"event_id":"' || s.prefix || k
         || '","event_type":"' || (CASE WHEN failed AND s.slot <> 6 THEN 'payment_failed' ELSE 'payment_authorized' END)
         || '","event_time":"' || strftime(CASE s.slot WHEN 2 THEN tp WHEN 6 THEN ta ELSE tp2 END, {TS_FMT})
         || '","schema_version":1,"order_id":"' || oid || '","customer_id":"'
         || (CASE WHEN s.slot = 5 AND k % 2 = 1 THEN 'ALT-' ELSE '' END) || cid
         || '","payload":{{"payment_id":"' || pid || s.suffix
         || '","amount":' || price
         || (CASE WHEN r = 7 THEN '' ELSE ',"currency":"MAD"' END)
         || (CASE WHEN failed AND s.slot <> 6 AND r <> 9 THEN ',"reason":"payment_declined"' ELSE '' END)
         || '}}}}'
  FROM b2, (VALUES (2, 'P-', ''), (3, 'P2-', '-B'), (5, 'PR-', ''), (6, 'PA-', '-C')) s(slot, prefix, suffix)
  WHERE s.slot = 2 OR (s.slot = 3 AND k % 103 = 5) OR (s.slot = 5 AND k % 107 = 3) OR (s.slot = 6 AND recovers)
  UNION ALL
  SELECT oid, 'inventory-events', part, k * 16 + s.slot,
         '{{"event_id":"' || s.prefix || k || '","event_type":"'
         || (CASE WHEN rejected THEN 'inventory_rejected' ELSE 'inventory_reserved' END)
         || '","event_time":"' || strftime(CASE s.slot WHEN 4 THEN ti WHEN 7 THEN ta + to_seconds(2)
                                           ELSE ti + to_seconds(1) END, {TS_FMT})
         || '","schema_version":1,"order_id":"' || oid || '","customer_id":"' || cid
         || '","payload":{{"sku":"SKU-'
         || lpad(CAST((CASE WHEN s.slot = 8 THEN k + 1 ELSE k END) % 100 AS VARCHAR), 3, '0') || '","quantity":'
         || (CASE WHEN r = 8 THEN '0' WHEN r = 11 THEN '"1"' ELSE '1' END)
         || (CASE WHEN rejected AND r <> 10 THEN ',"reason":"insufficient_stock"' ELSE '' END)
         || '}}}}'
  FROM b2, (VALUES (4, 'I-'), (7, 'IA-'), (8, 'I2-')) s(slot, prefix)
  WHERE (s.slot = 7 AND recovers)
     OR (NOT failed AND k % 101 <> 7 AND (s.slot = 4 OR (s.slot = 8 AND k % 113 = 6)))
)"""

# Permissive parse: malformed text -> all fields NULL; a wrong-typed field -> corrupt,
# the other fields still read (the envelope precedes the payload in every document).
PARSED = """
jv AS (
  SELECT *, (raw_json IS NOT NULL AND raw_json <> '') AS has_text,
         coalesce(json_valid(raw_json), false) AS ok_text
  FROM log
),
typed AS (
  SELECT *,
    CASE WHEN NOT has_text THEN false
         WHEN NOT ok_text THEN true
         WHEN json_type(raw_json) <> 'OBJECT' THEN true
         ELSE coalesce(json_type(raw_json, '$.schema_version') NOT IN ('BIGINT', 'UBIGINT', 'NULL'), false)
           OR coalesce(json_type(raw_json, '$.payload') NOT IN ('OBJECT', 'NULL'), false)
           OR coalesce(json_type(raw_json, '$.payload.quantity') NOT IN ('BIGINT', 'UBIGINT', 'NULL'), false)
           OR coalesce(json_type(raw_json, '$.payload.total_amount') NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'NULL'), false)
           OR coalesce(json_type(raw_json, '$.payload.amount') NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'NULL'), false)
    END AS corrupt,
    CASE WHEN ok_text AND json_type(raw_json) = 'OBJECT' THEN raw_json END AS doc
  FROM jv
),
parsed AS (
  SELECT kafka_key, topic, "partition", "offset", raw_json, corrupt,
         json_extract_string(doc, '$.event_id') AS event_id,
         json_extract_string(doc, '$.event_type') AS event_type,
         json_extract_string(doc, '$.event_time') AS event_time,
         CASE WHEN json_type(doc, '$.schema_version') IN ('BIGINT', 'UBIGINT')
              THEN TRY_CAST(json_extract_string(doc, '$.schema_version') AS INTEGER) END AS schema_version,
         json_extract_string(doc, '$.order_id') AS order_id,
         json_extract_string(doc, '$.customer_id') AS customer_id,
         (doc IS NULL OR coalesce(json_type(doc, '$.payload'), 'NULL') = 'NULL') AS payload_null,
         TRY_CAST(json_extract_string(doc, '$.payload.total_amount') AS DOUBLE) AS total_amount,
         TRY_CAST(json_extract_string(doc, '$.payload.amount') AS DOUBLE) AS amount,
         json_extract_string(doc, '$.payload.currency') AS currency,
         json_extract_string(doc, '$.payload.payment_id') AS payment_id,
         json_extract_string(doc, '$.payload.sku') AS sku,
         CASE WHEN json_type(doc, '$.payload.quantity') IN ('BIGINT', 'UBIGINT')
              THEN TRY_CAST(json_extract_string(doc, '$.payload.quantity') AS INTEGER) END AS quantity,
         json_extract_string(doc, '$.payload.reason') AS reason
  FROM typed
),
classified AS (
  SELECT *,
    CASE
      WHEN corrupt THEN 'INVALID_JSON'
      WHEN event_id IS NULL OR event_type IS NULL OR event_time IS NULL OR order_id IS NULL
           OR customer_id IS NULL OR payload_null THEN 'MISSING_REQUIRED_FIELD'
      WHEN kafka_key IS NULL OR kafka_key <> order_id THEN 'INVALID_KAFKA_KEY'
      WHEN schema_version IS NULL OR schema_version <> 1 THEN 'UNSUPPORTED_SCHEMA_VERSION'
      WHEN NOT ((topic = 'orders' AND event_type = 'order_created')
                OR (topic = 'payments' AND event_type IN ('payment_authorized', 'payment_failed'))
                OR (topic = 'inventory-events' AND event_type IN ('inventory_reserved', 'inventory_rejected')))
           THEN 'INVALID_TOPIC_EVENT_TYPE'
      WHEN event_type = 'order_created' AND (total_amount IS NULL OR total_amount <= 0 OR currency IS NULL)
           THEN 'INVALID_ORDER_PAYLOAD'
      WHEN event_type IN ('payment_authorized', 'payment_failed')
           AND (payment_id IS NULL OR amount IS NULL OR amount <= 0 OR currency IS NULL)
           THEN 'INVALID_PAYMENT_PAYLOAD'
      WHEN event_type IN ('inventory_reserved', 'inventory_rejected')
           AND (sku IS NULL OR quantity IS NULL OR quantity <= 0) THEN 'INVALID_INVENTORY_PAYLOAD'
      WHEN event_type = 'payment_failed' AND reason IS NULL THEN 'MISSING_PAYMENT_FAILURE_REASON'
      WHEN event_type = 'inventory_rejected' AND reason IS NULL THEN 'MISSING_INVENTORY_REJECTION_REASON'
    END AS validation_error
  FROM parsed
),
validated AS (
  SELECT *, CASE WHEN validation_error IS NULL THEN 'VALID' ELSE 'INVALID' END AS validation_status
  FROM classified
),
timed AS (
  SELECT *, TRY_CAST(event_time AS TIMESTAMP) AS event_timestamp
  FROM validated WHERE validation_error IS NULL AND TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL
),
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
                                 ORDER BY event_timestamp, topic, "partition", "offset") AS rn
    FROM timed) WHERE rn = 1
),
d_orders AS (
  SELECT event_id, order_id, customer_id, event_timestamp, total_amount, currency
  FROM uniq WHERE event_type = 'order_created'
),
d_payments AS (
  SELECT event_id, order_id, customer_id, event_timestamp, event_type, payment_id, amount, currency
  FROM uniq WHERE event_type IN ('payment_authorized', 'payment_failed')
),
d_inventory AS (
  SELECT event_id, order_id, customer_id, event_timestamp, event_type, sku, quantity, reason
  FROM uniq WHERE event_type IN ('inventory_reserved', 'inventory_rejected')
),
op AS (
  SELECT o.order_id, o.customer_id, o.total_amount AS order_amount,
         CAST(o.event_timestamp AS VARCHAR) AS order_time, o.event_timestamp AS order_ts,
         p.payment_id, p.event_type AS payment_status, p.event_timestamp AS payment_time
  FROM d_orders o JOIN d_payments p
    ON o.order_id = p.order_id AND p.event_timestamp >= o.event_timestamp
   AND p.event_timestamp <= o.event_timestamp + INTERVAL 15 MINUTE
),
correlated AS (
  SELECT order_id, customer_id, order_amount, order_time, payment_id, payment_status, payment_time,
         CAST(NULL AS VARCHAR) AS inventory_status, CAST(NULL AS VARCHAR) AS sku,
         CAST(NULL AS VARCHAR) AS inventory_reason, CAST(NULL AS TIMESTAMP) AS inventory_time
  FROM op WHERE payment_status = 'payment_failed'
  UNION ALL
  SELECT op.order_id, op.customer_id, op.order_amount, op.order_time, op.payment_id,
         op.payment_status, op.payment_time, i.event_type, i.sku, i.reason, i.event_timestamp
  FROM op JOIN d_inventory i
    ON op.order_id = i.order_id AND i.event_timestamp >= op.payment_time
   AND i.event_timestamp <= op.payment_time + INTERVAL 15 MINUTE
  WHERE op.payment_status = 'payment_authorized'
),
states AS (
  SELECT order_id, customer_id, order_amount, order_time, payment_status, inventory_status,
         coalesce(inventory_time, payment_time) AS decided_at,
         CASE WHEN payment_status = 'payment_failed' THEN 'PAYMENT_FAILED'
              WHEN payment_status = 'payment_authorized' AND inventory_status = 'inventory_reserved' THEN 'COMPLETED'
              WHEN payment_status = 'payment_authorized' AND inventory_status = 'inventory_rejected' THEN 'INVENTORY_REJECTED'
              ELSE 'UNKNOWN' END AS order_status
  FROM correlated
),
state_docs AS (
  SELECT *,
    sha256('{"customer_id":"' || customer_id || '","inventory_status":'
           || coalesce('"' || inventory_status || '"', 'null')
           || ',"order_amount":' || CAST(order_amount AS VARCHAR)
           || ',"order_id":"' || order_id || '","order_status":"' || order_status
           || '","order_time":"' || order_time || '","payment_status":"' || payment_status || '"}') AS state_id
  FROM states
),
history AS (
  SELECT order_id, state_id, customer_id, order_amount,
         TRY_CAST(order_time AS TIMESTAMP) AS order_time, payment_status, inventory_status, order_status,
         max(decided_at) AS decided_at
  FROM state_docs GROUP BY ALL
)"""


def _q(body: str) -> str:
    return "WITH " + LOG.strip() + ",\n" + PARSED.strip() + "\n" + body.strip()


def _window(ts: str, width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"


ORACLE: dict[str, str] = {}

ORACLE["decode_topic"] = _q("""
SELECT kafka_key, topic, "partition", "offset", raw_json FROM log""")

ORACLE["topic_profile"] = _q("""
SELECT topic, "partition", count(*) AS row_count, min("offset") AS min_offset,
       max("offset") AS max_offset,
       count(*) FILTER (WHERE kafka_key IS NULL) AS null_keys,
       count(*) FILTER (WHERE raw_json IS NULL) AS null_values
FROM log GROUP BY topic, "partition" """)

ORACLE["validation_status"] = _q("""
SELECT kafka_key, topic, "partition", "offset", event_id, event_type, order_id,
       validation_status, validation_error FROM validated""")

ORACLE["validation_errors_by_code"] = _q("""
SELECT validation_error, topic, count(*) AS error_count
FROM validated WHERE validation_status = 'INVALID' GROUP BY validation_error, topic""")

ORACLE["validation_counts"] = _q("""
SELECT count(*) FILTER (WHERE validation_status = 'VALID') AS valid_count,
       count(*) FILTER (WHERE validation_status = 'INVALID') AS invalid_count,
       count(*) AS total_count FROM validated""")

ORACLE["dead_letter_records"] = _q("""
SELECT kafka_key AS key, raw_json AS original_message, validation_error AS error_reason,
       topic AS source_topic, "partition" AS source_partition, "offset" AS source_offset,
       '{' || coalesce('"original_message":' || to_json(raw_json) || ',', '')
           || '"error_reason":"' || validation_error || '","source_topic":"' || topic
           || '","source_partition":' || "partition" || ',"source_offset":' || "offset" || '}' AS value
FROM validated WHERE validation_status = 'INVALID'""")

ORACLE["valid_records"] = _q("""
SELECT kafka_key AS key, raw_json AS value FROM validated WHERE validation_status = 'VALID'""")

ORACLE["event_times"] = _q("""
SELECT key, event_id, event_time, event_timestamp FROM (
  SELECT kafka_key AS key, json_extract_string(raw_json, '$.event_id') AS event_id,
         json_extract_string(raw_json, '$.event_time') AS event_time,
         TRY_CAST(json_extract_string(raw_json, '$.event_time') AS TIMESTAMP) AS event_timestamp
  FROM validated WHERE validation_status = 'VALID')
WHERE event_id IS NOT NULL AND event_timestamp IS NOT NULL""")

ORACLE["deduplicated_events"] = _q("""
SELECT event_id, kafka_key, topic, "partition", "offset", event_type, order_id, event_timestamp
FROM uniq""")

ORACLE["time_span"] = _q("""
SELECT min(event_timestamp) AS oldest, max(event_timestamp) AS newest, count(*) AS event_count,
       CAST(epoch(max(event_timestamp)) - epoch(min(event_timestamp)) AS BIGINT) AS spread_seconds
FROM uniq""")

ORACLE["domain_orders"] = _q("SELECT * FROM d_orders")
ORACLE["domain_payments"] = _q("SELECT * FROM d_payments")
ORACLE["domain_inventory"] = _q("SELECT * FROM d_inventory")

ORACLE["order_payments"] = _q("""
SELECT order_id, customer_id, order_amount, order_time, payment_id, payment_status, payment_time
FROM op""")

ORACLE["payment_inventory"] = _q("""
SELECT op.order_id, op.payment_id, op.payment_time, i.event_type AS inventory_status, i.sku,
       i.event_timestamp AS inventory_time
FROM op JOIN d_inventory i
  ON op.order_id = i.order_id AND i.event_timestamp >= op.payment_time
 AND i.event_timestamp <= op.payment_time + INTERVAL 15 MINUTE
WHERE op.payment_status = 'payment_authorized'""")

ORACLE["correlated"] = _q("SELECT * FROM correlated")
ORACLE["correlated_branches"] = _q("SELECT * FROM correlated")
ORACLE["correlated_chained"] = _q("SELECT * FROM correlated")
ORACLE["order_states"] = _q("SELECT * EXCLUDE (decided_at) FROM states")

ORACLE["status_counts"] = _q("""
SELECT order_status, count(*) AS order_count FROM states GROUP BY order_status""")

ORACLE["completion_rate"] = _q("""
SELECT completed, payment_failed, inventory_rejected, final_orders,
       CASE WHEN final_orders > 0 THEN round(completed * 100.0::DOUBLE / final_orders, 2)
            ELSE 0.0::DOUBLE END AS completion_rate_pct
FROM (
  SELECT count(*) FILTER (WHERE order_status = 'COMPLETED') AS completed,
         count(*) FILTER (WHERE order_status = 'PAYMENT_FAILED') AS payment_failed,
         count(*) FILTER (WHERE order_status = 'INVENTORY_REJECTED') AS inventory_rejected,
         count(*) AS final_orders
  FROM states WHERE order_status IN ('COMPLETED', 'PAYMENT_FAILED', 'INVENTORY_REJECTED'))""")

ORACLE["expected_state_check"] = _q("""
SELECT e.order_id, e.expected_status, coalesce(s.state_rows, 0) AS state_rows,
       coalesce(s.hits, 0) > 0 AS matched
FROM (SELECT oid AS order_id,
             CASE WHEN k % 20 < 15 THEN 'COMPLETED' WHEN k % 20 < 18 THEN 'PAYMENT_FAILED'
                  ELSE 'INVENTORY_REJECTED' END AS expected_status FROM base) e
LEFT JOIN (
  SELECT st.order_id, count(*) AS state_rows,
         count(*) FILTER (WHERE st.order_status = CASE WHEN b.k % 20 < 15 THEN 'COMPLETED'
                                WHEN b.k % 20 < 18 THEN 'PAYMENT_FAILED'
                                ELSE 'INVENTORY_REJECTED' END) AS hits
  FROM states st JOIN base b ON b.oid = st.order_id GROUP BY st.order_id) s
ON e.order_id = s.order_id""")

ORACLE["state_records"] = _q("""
SELECT order_id AS key,
       '{"order_id":"' || order_id || '","customer_id":"' || customer_id
       || '","order_amount":' || CASE WHEN order_amount = 12500000.5 THEN '1.25000005E7'
                                      ELSE CAST(order_amount AS VARCHAR) END || ',"order_time":"' || order_time
       || '","payment_status":"' || payment_status || '"'
       || coalesce(',"inventory_status":"' || inventory_status || '"', '')
       || ',"order_status":"' || order_status || '"}' AS value
FROM states""")

ORACLE["state_ids"] = _q("SELECT order_id, order_status, state_id FROM state_docs")

ORACLE["history_table"] = _q("SELECT * EXCLUDE (decided_at) FROM history")

ORACLE["order_lookup"] = _q("""
SELECT h.order_id, h.order_status, h.state_id FROM history h
WHERE h.order_id IN (SELECT oid FROM base WHERE o_orderpriority = '1-URGENT')""")

ORACLE["current_state"] = _q("""
SELECT order_id, state_id, customer_id, order_amount, order_time, payment_status,
       inventory_status, order_status FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY decided_at DESC, order_time DESC, state_id DESC) AS rn
  FROM history) WHERE rn = 1""")

ORACLE["events_by_order"] = _q("""
SELECT order_id, event_timestamp, event_id, event_type, topic,
       row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp, event_id) AS event_seq
FROM uniq""")

ORACLE["multi_state_orders"] = _q("""
SELECT order_id, count(*) AS state_count, count(DISTINCT order_status) AS distinct_statuses,
       count(DISTINCT state_id) AS distinct_state_ids
FROM state_docs GROUP BY order_id HAVING count(*) > 1""")

ORACLE["window_counts_by_order"] = _q(f"""
SELECT order_id, {_window('event_timestamp', '5 minutes')} AS window_start,
       {_window('event_timestamp', '5 minutes')} + INTERVAL 5 MINUTE AS window_end,
       count(*) AS event_count
FROM timed GROUP BY 1, 2, 3""")

ORACLE["order_volume_5m"] = _q(f"""
SELECT {_window('event_timestamp', '5 minutes')} AS window_start,
       {_window('event_timestamp', '5 minutes')} + INTERVAL 5 MINUTE AS window_end,
       count(*) AS order_count
FROM d_orders GROUP BY 1, 2""")

ORACLE["orders_per_minute"] = _q(f"""
SELECT {_window('event_timestamp', '1 minute')} AS window_start,
       {_window('event_timestamp', '1 minute')} + INTERVAL 1 MINUTE AS window_end,
       count(*) AS order_count
FROM d_orders GROUP BY 1, 2""")

_FAILURE = f"""
SELECT {_window('event_timestamp', '5 minutes')} AS window_start,
       {_window('event_timestamp', '5 minutes')} + INTERVAL 5 MINUTE AS window_end,
       count(*) AS payment_count,
       count(*) FILTER (WHERE event_type = 'payment_failed') AS failed_count,
       round(count(*) FILTER (WHERE event_type = 'payment_failed') * 100.0::DOUBLE / count(*), 2)
         AS failure_rate_pct
FROM d_payments GROUP BY 1, 2"""

ORACLE["payment_failure_rate_5m"] = _q(_FAILURE)

ORACLE["metric_rows"] = _q(f"""
SELECT 'orders_per_minute' AS metric_name, {_window('event_timestamp', '1 minute')} AS window_start,
       {_window('event_timestamp', '1 minute')} + INTERVAL 1 MINUTE AS window_end,
       CAST(count(*) AS DOUBLE) AS metric_value
FROM d_orders GROUP BY 2, 3
UNION ALL
SELECT 'order_volume_5m', {_window('event_timestamp', '5 minutes')},
       {_window('event_timestamp', '5 minutes')} + INTERVAL 5 MINUTE, CAST(count(*) AS DOUBLE)
FROM d_orders GROUP BY 2, 3
UNION ALL
SELECT 'payment_failure_rate_5m', window_start, window_end, failure_rate_pct FROM ({_FAILURE})
UNION ALL
SELECT 'completion_rate_5m', {_window('TRY_CAST(order_time AS TIMESTAMP)', '5 minutes')},
       {_window('TRY_CAST(order_time AS TIMESTAMP)', '5 minutes')} + INTERVAL 5 MINUTE,
       round(count(*) FILTER (WHERE order_status = 'COMPLETED') * 100.0::DOUBLE / count(*), 2)
FROM states WHERE order_status IN ('COMPLETED', 'PAYMENT_FAILED', 'INVENTORY_REJECTED')
GROUP BY 2, 3""")

ORACLE["audit_event_log"] = _q("""
SELECT 'unparseable_json' AS check_name,
       count(*) FILTER (WHERE corrupt OR raw_json IS NULL) AS violations FROM validated
UNION ALL
SELECT 'missing_envelope_field', count(*) FILTER (WHERE NOT corrupt AND raw_json IS NOT NULL AND (
         event_id IS NULL OR event_type IS NULL OR event_time IS NULL OR order_id IS NULL
         OR customer_id IS NULL OR payload_null OR schema_version IS NULL)) FROM validated
UNION ALL
SELECT 'unknown_event_type', count(*) FILTER (WHERE NOT corrupt AND raw_json IS NOT NULL
         AND event_type IS NOT NULL AND event_type NOT IN ('order_created', 'payment_authorized',
         'payment_failed', 'inventory_reserved', 'inventory_rejected')) FROM validated
UNION ALL
SELECT 'unsupported_schema_version', count(*) FILTER (WHERE NOT corrupt AND raw_json IS NOT NULL
         AND schema_version IS NOT NULL AND schema_version <> 1) FROM validated
UNION ALL
SELECT 'event_time_not_utc', count(*) FILTER (WHERE NOT corrupt AND raw_json IS NOT NULL
         AND event_time IS NOT NULL AND NOT ends_with(event_time, 'Z')) FROM validated
UNION ALL
SELECT 'surplus_event_copies', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
FROM (SELECT event_id, count(*) AS n FROM validated WHERE event_id IS NOT NULL GROUP BY event_id)
UNION ALL
SELECT 'orders_with_many_customers', count(*) FILTER (WHERE c > 1)
FROM (SELECT order_id, count(DISTINCT customer_id) AS c FROM validated
      WHERE order_id IS NOT NULL AND customer_id IS NOT NULL GROUP BY order_id)""")

ORACLE["reconcile"] = _q("""
SELECT 'topic_rows' AS stage, count(*) AS row_count FROM validated
UNION ALL SELECT 'valid_events', count(*) FILTER (WHERE validation_status = 'VALID') FROM validated
UNION ALL SELECT 'invalid_events', count(*) FILTER (WHERE validation_status = 'INVALID') FROM validated
UNION ALL SELECT 'unique_events', count(*) FROM uniq
UNION ALL SELECT 'unique_orders', count(*) FILTER (WHERE event_type = 'order_created') FROM uniq
UNION ALL SELECT 'unique_payments', count(*) FILTER (WHERE event_type IN ('payment_authorized', 'payment_failed')) FROM uniq
UNION ALL SELECT 'unique_inventory', count(*) FILTER (WHERE event_type IN ('inventory_reserved', 'inventory_rejected')) FROM uniq
UNION ALL SELECT 'order_states', count(*) FROM states
UNION ALL SELECT 'completed_states', count(*) FILTER (WHERE order_status = 'COMPLETED') FROM states
UNION ALL SELECT 'payment_failed_states', count(*) FILTER (WHERE order_status = 'PAYMENT_FAILED') FROM states
UNION ALL SELECT 'inventory_rejected_states', count(*) FILTER (WHERE order_status = 'INVENTORY_REJECTED') FROM states
UNION ALL SELECT 'events_implied_by_states',
       2 * count(*) + count(*) FILTER (WHERE order_status IN ('COMPLETED', 'INVENTORY_REJECTED')) FROM states""")

ORACLE["pending_orders"] = _q("""
SELECT o.order_id, o.event_timestamp AS order_time,
       CASE WHEN m.last_payment_time IS NOT NULL THEN 'AWAITING_INVENTORY' ELSE 'AWAITING_PAYMENT' END
         AS pending_reason,
       CASE WHEN coalesce(m.last_payment_time, o.event_timestamp) + INTERVAL 15 MINUTE
                 < (SELECT max(event_timestamp) FROM uniq) - INTERVAL 10 MINUTE
            THEN 'EXPIRED' ELSE 'PENDING' END AS pending_status
FROM d_orders o
LEFT JOIN (SELECT order_id, max(payment_time) AS last_payment_time FROM op
           WHERE payment_status = 'payment_authorized' GROUP BY order_id) m
  ON o.order_id = m.order_id
WHERE o.order_id NOT IN (SELECT order_id FROM correlated)""")

ORACLE["business_dedup"] = _q("""
SELECT order_id, event_type, payment_id, sku, event_id, event_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, event_type, payment_id, sku
                               ORDER BY event_timestamp, event_id) AS rn
  FROM uniq) WHERE rn = 1""")

ORACLE["domain_orders_allowed"] = _q("""
SELECT * FROM d_orders WHERE order_id IN (SELECT oid FROM base WHERE o_orderpriority = '1-URGENT')""")

ORACLE["completion_rate_by_order"] = f"""
SELECT completed, payment_failed, inventory_rejected, final_orders,
       round(completed * 100.0::DOUBLE / final_orders, 2) AS completion_rate_pct FROM (
  SELECT count(*) FILTER (WHERE order_status = 'COMPLETED') AS completed,
         count(*) FILTER (WHERE order_status = 'PAYMENT_FAILED') AS payment_failed,
         count(*) FILTER (WHERE order_status = 'INVENTORY_REJECTED') AS inventory_rejected,
         count(*) FILTER (WHERE order_status IN ('COMPLETED', 'PAYMENT_FAILED', 'INVENTORY_REJECTED')) AS final_orders
  FROM ({ORACLE['current_state']}))"""

# drained streams: what batch gives over the same log
ORACLE["stream_history"] = ORACLE["history_table"]
ORACLE["stream_current_state"] = ORACLE["current_state"]
ORACLE["stream_order_completion"] = ORACLE["completion_rate_by_order"]
ORACLE["stream_routes"] = _q("""
SELECT validation_status AS route, validation_error AS error_reason, count(*) AS record_count
FROM validated GROUP BY ALL""")
ORACLE["stream_unique_events"] = _q("SELECT kafka_key AS key, event_id FROM uniq")
ORACLE["stream_expired_orders"] = f"SELECT * FROM ({ORACLE['pending_orders']}) WHERE pending_status = 'EXPIRED'"
ORACLE["stream_business_facts"] = _q("SELECT DISTINCT order_id, event_type, payment_id, sku FROM uniq")
ORACLE["stream_metric_rows"] = _q(f"""
SELECT 'orders_per_minute' AS metric_name, {_window('event_timestamp', '1 minute')} AS window_start,
       {_window('event_timestamp', '1 minute')} + INTERVAL 1 MINUTE AS window_end,
       CAST(count(*) AS DOUBLE) AS metric_value
FROM d_orders GROUP BY 2, 3
UNION ALL
SELECT 'order_volume_5m', {_window('event_timestamp', '5 minutes')},
       {_window('event_timestamp', '5 minutes')} + INTERVAL 5 MINUTE, CAST(count(*) AS DOUBLE)
FROM d_orders GROUP BY 2, 3
UNION ALL
SELECT 'payment_failure_rate_5m', window_start, window_end, failure_rate_pct FROM ({_FAILURE})
UNION ALL
SELECT 'completion_rate', CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP),
       round(count(*) FILTER (WHERE order_status = 'COMPLETED') * 100.0::DOUBLE / count(*), 2)
FROM states WHERE order_status IN ('COMPLETED', 'PAYMENT_FAILED', 'INVENTORY_REJECTED')""")

ORACLE["events_props"] = """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS prop_k
FROM events"""

ORACLE["events_window_counts"] = f"""
SELECT event_type, {_window('ts', '5 minutes')} AS window_start,
       {_window('ts', '5 minutes')} + INTERVAL 5 MINUTE AS window_end, count(*) AS event_count
FROM events GROUP BY 1, 2, 3"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
