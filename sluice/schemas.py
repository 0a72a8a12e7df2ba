"""Explicit schemas of every source, so that no read scans its data twice to guess types."""

CUSTOMERS = (
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, "
    "city STRING, state STRING"
)
PRODUCTS = (
    "product_id BIGINT, product_name STRING, category STRING, unit_price DECIMAL(12,2)"
)
SALES_ORDERS = (
    "order_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT, "
    "total_price DECIMAL(12,2), order_date DATE"
)
EMPLOYEES = (
    "employee_id BIGINT, first_name STRING, last_name STRING, email STRING, "
    "job_title STRING, department_id BIGINT"
)
DEPARTMENTS = "department_id BIGINT, department_name STRING, location STRING"

VIEWING_HISTORY = (
    "user_id BIGINT, content_id BIGINT, duration_watched_min DOUBLE, "
    "total_duration_min DOUBLE, completion_pct DOUBLE, device STRING, start_time STRING"
)
CONTENT_CATALOG = (
    "content_id BIGINT, title STRING, release_year INT, imdb_score DOUBLE, "
    "license_cost_monthly DOUBLE"
)
USER_PROFILES = "user_id BIGINT, plan_type STRING, is_churned BOOLEAN"
USER_INTERACTIONS = (
    "user_id BIGINT, content_id BIGINT, timestamp STRING, search_query STRING"
)
STREAMING_QUALITY = (
    "user_id BIGINT, session_id STRING, cdn_region STRING, isp STRING, "
    "buffering_events INT, avg_bitrate_mbps DOUBLE, resolution_changes INT, latency_ms DOUBLE"
)

# Payload of one activity message; the time stays text until it is decoded.
ACTIVITY = (
    "event_id STRING, user_id STRING, session_id STRING, event_ts STRING, "
    "action STRING, content_id STRING, title STRING, device STRING"
)
# A message as the log delivers it.
RAW_MESSAGE = "key BINARY, value BINARY"
