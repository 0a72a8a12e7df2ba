"""The queries of ``registry`` as SQL for DuckDB, written straight from their meaning.

Where the plans group first and join later, the SQL joins first and groups
then, so the two are independent. Rounded averages go through a decimal on both
sides (``functions.numbers.rounded``).
"""

from __future__ import annotations

import re

from sluice.registry import AS_OF, CHANGED_MONTH, EARLY
from sluice.views import VIEWS, view_sql

CTES = {name: view_sql(name) for name in VIEWS}
ORACLES: dict[str, str] = {}


def rnd(expr: str, digits: int = 2) -> str:
    return f"round(cast({expr} AS decimal(38,10)), {digits})::double"


def key(natural: str, stripes: int, after: str = "0") -> str:
    stripe = f"(('0x' || substr(md5(cast({natural} AS varchar)), 1, 6))::bigint % {stripes})"
    return (
        f"({after} + (row_number() OVER (PARTITION BY {stripe} ORDER BY {natural}) - 1) * {stripes}"
        f" + {stripe} + 1)::bigint"
    )


def _uses(sql: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", sql)]


def define(name: str, body: str) -> None:
    """Store a query with the common table expressions it needs, in order of need."""
    ordered: list[str] = []

    def visit(sql: str, path: tuple[str, ...]) -> None:
        for used in _uses(sql):
            if used not in ordered and used not in path:
                visit(CTES[used], (*path, used))
                ordered.append(used)

    visit(body, ())
    parts = ", ".join(f"{n} AS ({CTES[n]})" for n in ordered)
    # A body that starts with a comma goes on with tables of its own.
    ORACLES[name] = f"WITH {parts} {body}" if parts else body


# -- warehouse ----------------------------------------------------------------

CALENDAR = """
SELECT year(d)::int * 10000 + month(d)::int * 100 + day(d)::int AS date_key, d AS full_date,
       year(d)::int AS year, quarter(d)::int AS quarter, month(d)::int AS month,
       strftime(d, '%B') AS month_name, day(d)::int AS day_of_month,
       isodow(d)::int - 1 AS day_of_week, strftime(d, '%A') AS day_name,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31),
             INTERVAL 1 DAY))::date AS d
      FROM (SELECT year(min(order_date))::int AS lo, year(max(order_date))::int AS hi
            FROM sales_orders))
"""
DIM_STRIPES = 4096
PERSON = "first_name, last_name, email, city, state"

CTES |= {
    "calendar": CALENDAR,
    "dim_c": f"""
        SELECT {key('customer_id', DIM_STRIPES)} AS customer_key,
               customer_id AS source_customer_id, {PERSON} FROM customers""",
    "dim_p": f"""
        SELECT {key('product_id', DIM_STRIPES)} AS product_key,
               product_id AS source_product_id, product_name, category, unit_price
        FROM products""",
    "lines": """
        SELECT year(order_date)::int * 10000 + month(order_date)::int * 100
                 + day(order_date)::int AS date_key,
               customer_key, product_key, order_id AS source_order_id, quantity,
               p.unit_price, total_price, source_customer_id, source_product_id
        FROM sales_orders
        JOIN dim_c ON customer_id = source_customer_id
        JOIN dim_p p ON product_id = source_product_id""",
    "first_lines": """
        SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY source_order_id
          ORDER BY date_key, customer_key, product_key, quantity, total_price, unit_price) = 1""",
    "fact": """
        SELECT row_number() OVER (ORDER BY date_key, source_order_id) AS sale_key, * FROM first_lines""",
}

FACT_COLUMNS = """sale_key, date_key, customer_key, product_key, source_order_id, quantity,
       unit_price::double AS unit_price, total_price::double AS total_price"""

define("dim_date", "SELECT * FROM calendar")
define("dim_date_extension", """
SELECT * FROM calendar WHERE year > (SELECT min(year) FROM calendar)""")
define("dim_customer_upsert", f"""
, old AS (SELECT {key('customer_id', DIM_STRIPES)} AS customer_key, customer_id
          FROM customers WHERE shard = 'SE'),
fresh AS (SELECT {key('customer_id', DIM_STRIPES, '(SELECT max(customer_key) FROM old)')}
                 AS customer_key, customer_id FROM customers WHERE shard = 'NE')
SELECT customer_key, customer_id AS source_customer_id, {PERSON}
FROM customers JOIN (SELECT * FROM old UNION ALL SELECT * FROM fresh) USING (customer_id)""")
define("dim_product_upsert", f"""
, old AS (SELECT {key('product_id', DIM_STRIPES)} AS product_key, product_id
          FROM products WHERE category = 'ECONOMY'),
fresh AS (SELECT {key('product_id', DIM_STRIPES, '(SELECT max(product_key) FROM old)')}
                 AS product_key, product_id FROM products WHERE category <> 'ECONOMY')
SELECT product_key, product_id AS source_product_id, product_name, category,
       unit_price::double AS unit_price
FROM products JOIN (SELECT * FROM old UNION ALL SELECT * FROM fresh) USING (product_id)""")
define("dim_customer_buckets", """
SELECT * REPLACE (CASE WHEN state = 'NATION_12' THEN 'moved' ELSE city END AS city) FROM dim_c""")
define("dim_employee", f"""
SELECT {key('employee_id', DIM_STRIPES)} AS employee_key, employee_id AS source_employee_id,
       first_name, last_name, email, job_title, department_name, location AS department_location
FROM employees JOIN departments USING (department_id)""")
define("fact_sales", f"SELECT {FACT_COLUMNS} FROM fact")
define("fact_sales_rerun", f"""
, old AS (SELECT DISTINCT order_id AS source_order_id FROM sales_orders
          JOIN customers USING (customer_id) WHERE shard = 'SE'),
fresh AS (SELECT * FROM first_lines WHERE source_order_id NOT IN (SELECT source_order_id FROM old)),
keyed AS (SELECT (SELECT count(*) FROM old) + row_number() OVER (ORDER BY date_key, source_order_id)
                 AS sale_key, * FROM fresh)
SELECT {FACT_COLUMNS} FROM keyed""")
LOADS = f"""
, first_load AS (
    SELECT row_number() OVER (ORDER BY date_key, source_order_id) AS sale_key, * FROM first_lines
    WHERE date_key < {EARLY}0000),
second_load AS (
    SELECT (SELECT count(*) FROM first_load)
             + row_number() OVER (ORDER BY date_key, source_order_id NULLS LAST) AS sale_key, *
    FROM (SELECT * FROM lines WHERE date_key >= {EARLY}0000 AND source_order_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY source_order_id ORDER BY date_key, source_customer_id,
                                     source_product_id, quantity, total_price) = 1
          UNION ALL SELECT * REPLACE (NULL::bigint AS source_order_id) FROM lines WHERE source_order_id % 10 = 7)),
loads AS (SELECT 1 AS load, * FROM first_load UNION ALL SELECT 2, * FROM second_load)"""
define("warehouse_two_loads", f"""
{LOADS}
SELECT load, (CASE WHEN source_order_id IS NOT NULL THEN sale_key END)::double AS sale_key, date_key,
       dim_c.source_customer_id, CASE WHEN state = 'NATION_12' THEN 'moved' ELSE city END AS city,
       source_order_id::double AS source_order_id, quantity, total_price::double AS total_price
FROM loads JOIN dim_c USING (customer_key)""")
define("warehouse_audits", f"""
{LOADS},
batch AS (SELECT count(*) + count(*) FILTER (order_id % 10 = 1 AND shard = 'SE') AS n
          FROM sales_orders JOIN customers USING (customer_id) WHERE year(order_date) < {EARLY})
SELECT 1 AS load, (SELECT count(*) FROM first_load) AS inserted,
       (SELECT n FROM batch) - (SELECT count(*) FROM first_load) AS already_present, 0::bigint AS unmatched
UNION ALL
SELECT 2, (SELECT count(*) FROM second_load), (SELECT count(*) FROM first_load), 0""")
define("fact_load_audit", """
, rows_ AS (SELECT o.order_id, shard = 'NE' AND category <> 'ECONOMY' AS ok
            FROM sales_orders o LEFT JOIN customers USING (customer_id)
            LEFT JOIN products USING (product_id)),
loaded AS (SELECT source_order_id FROM first_lines JOIN dim_p USING (product_key)
           WHERE category = 'STANDARD'),
fresh AS (SELECT count(DISTINCT order_id)::bigint AS n FROM rows_
          WHERE ok AND order_id NOT IN (SELECT source_order_id FROM loaded))
SELECT any_value(n) AS inserted, (count(*) FILTER (ok) - any_value(n))::bigint AS already_present,
       (count(*) FILTER (NOT ok))::bigint AS unmatched
FROM rows_, fresh""")
define("fact_missing_dimension", """
SELECT order_id, customer_id, product_id, 'dim_customer' AS missing_dimension
FROM sales_orders WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE shard = 'NE')
UNION ALL
SELECT order_id, customer_id, product_id, 'dim_product'
FROM sales_orders
WHERE product_id NOT IN (SELECT product_id FROM products WHERE category <> 'ECONOMY')""")
define("order_dedupe", """
SELECT order_id, customer_id, product_id, quantity, total_price::double AS total_price, order_date
FROM sales_orders QUALIFY row_number() OVER (PARTITION BY order_id
  ORDER BY order_date, customer_id, product_id, quantity, total_price) = 1""")
define("shard_union", f"""
SELECT customer_id, {PERSON}, shard, CASE shard WHEN 'SE' THEN 0 ELSE 1 END AS shard_order
FROM customers""")
define("shard_clashes", """
SELECT customer_id, 2::bigint AS shards FROM customers
WHERE state IN ('NATION_1', 'NATION_2') AND shard = 'SE'""")
define("replica_difference", """
SELECT product_id, product_name, category, unit_price::double AS unit_price, 'first' AS only_in
FROM products WHERE category = 'PROMO' AND unit_price <> 1
UNION ALL
SELECT product_id, product_name, category, 1.0::double, 'second'
FROM products WHERE category = 'PROMO' AND unit_price <> 1""")

# -- sales queries ------------------------------------------------------------

define("monthly_sales", """
SELECT month_name, year, count(*) AS total_orders, sum(total_price)::double AS total_revenue
FROM fact JOIN calendar USING (date_key) GROUP BY year, month, month_name ORDER BY year, month""")
define("customer_spend", """
SELECT first_name, last_name, count(*) AS number_of_orders,
       sum(total_price)::double AS total_amount_spent
FROM fact JOIN dim_c USING (customer_key) GROUP BY customer_key, first_name, last_name
ORDER BY total_amount_spent DESC""")
define("category_month_revenue", """
SELECT category, month_name, year, sum(total_price)::double AS total_revenue
FROM fact JOIN dim_p USING (product_key) JOIN calendar USING (date_key)
GROUP BY category, year, month, month_name ORDER BY year, month, category""")
define("table_counts", """
SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM dim_c
UNION ALL SELECT 'dim_product', count(*) FROM dim_p
UNION ALL SELECT 'fact_sales', count(*) FROM fact""")
define("latest_sales", """
SELECT sale_key, full_date, first_name, last_name, product_name, quantity,
       total_price::double AS total_price
FROM fact JOIN calendar USING (date_key) JOIN dim_c USING (customer_key)
JOIN dim_p USING (product_key) ORDER BY sale_key DESC LIMIT 3""")
for shard in ("SE", "NE"):
    define(f"state_revenue_{shard.lower()}", f"""
SELECT state, sum(total_price)::double AS total_revenue
FROM sales_orders JOIN customers USING (customer_id) WHERE shard = '{shard}'
GROUP BY state ORDER BY total_revenue DESC""")
define("category_revenue_oltp", """
SELECT category, count(*) AS order_count, sum(total_price)::double AS total_revenue
FROM sales_orders JOIN products USING (product_id) GROUP BY category
ORDER BY total_revenue DESC""")
define("category_revenue_dw", """
SELECT category, count(*) AS order_count, sum(total_price)::double AS total_revenue
FROM fact JOIN dim_p USING (product_key) GROUP BY category ORDER BY total_revenue DESC""")

# -- lake ---------------------------------------------------------------------

QUALITY_MEANS = f"""{rnd('avg(buffering_events)')} AS avg_buffering_events,
       {rnd('avg(avg_bitrate_mbps)')} AS avg_bitrate_mbps,
       {rnd('avg(resolution_changes)')} AS avg_resolution_changes,
       {rnd('avg(latency_ms)')} AS avg_latency_ms"""

CTES |= {
    "clean_v": """
        SELECT user_id, content_id,
               CASE WHEN duration_watched_min > total_duration_min THEN total_duration_min
                    ELSE duration_watched_min END AS duration_watched_min,
               total_duration_min,
               CASE WHEN completion_pct < 0 THEN 0.0 WHEN completion_pct > 100 THEN 100.0
                    ELSE completion_pct END::double AS completion_pct,
               device, start_time,
               CASE WHEN lower(device) LIKE '%tv%' THEN 'TV'
                    WHEN lower(device) LIKE '%phone%' OR lower(device) LIKE '%mobile%' THEN 'Mobile'
                    WHEN lower(device) LIKE '%tablet%' THEN 'Tablet'
                    WHEN lower(device) LIKE '%web%' OR lower(device) LIKE '%desktop%' THEN 'Web'
                    ELSE 'Other' END AS device_standardized
        FROM viewing_history WHERE user_id IS NOT NULL AND content_id IS NOT NULL""",
    "clean_i": """
        SELECT user_id, content_id, "timestamp",
               CASE WHEN search_query IS NULL THEN 'no_search_query'
                    ELSE trim(search_query) END AS search_query
        FROM user_interactions""",
    "user_q": f"SELECT user_id, {QUALITY_MEANS} FROM streaming_quality GROUP BY user_id",
    "sessions": """
        SELECT v.*, title, release_year, imdb_score, license_cost_monthly, plan_type, is_churned,
               avg_buffering_events, avg_bitrate_mbps, avg_resolution_changes, avg_latency_ms
        FROM clean_v v LEFT JOIN content_catalog USING (content_id)
        LEFT JOIN user_profiles USING (user_id) LEFT JOIN user_q USING (user_id)""",
    "month_i": """
        SELECT user_id, year("timestamp"::timestamp)::int AS year,
               month("timestamp"::timestamp)::int AS month, count(*) AS interaction_count,
               count(DISTINCT content_id) AS interacted_titles
        FROM clean_i GROUP BY ALL""",
    "engaged": f"""
        SELECT m.*, coalesce(interaction_count, 0) AS interaction_count,
               coalesce(interacted_titles, 0) AS interacted_titles
        FROM (SELECT user_id, year(start_time)::int AS year, month(start_time)::int AS month,
                     plan_type, is_churned,
                     {rnd('sum(duration_watched_min) / 60')} AS total_watch_hours,
                     count(DISTINCT content_id) AS unique_titles_watched,
                     {rnd('avg(completion_pct)')} AS avg_completion_pct,
                     count(*) AS total_viewing_records,
                     {rnd('avg(avg_buffering_events)')} AS avg_buffering_events,
                     {rnd('avg(avg_resolution_changes)')} AS avg_resolution_changes,
                     {rnd('avg(avg_latency_ms)')} AS avg_latency_ms
              FROM sessions GROUP BY ALL) m
        LEFT JOIN month_i USING (user_id, year, month)""",
    "titles": f"""
        SELECT *, CASE WHEN total_viewing_hours > 0
                  THEN {rnd('license_cost_monthly / total_viewing_hours')} END
                  AS cost_per_viewing_hour
        FROM (SELECT content_id, title, release_year, imdb_score, license_cost_monthly,
                     count(DISTINCT user_id) AS unique_viewers,
                     count(*) AS total_viewing_records,
                     {rnd('sum(duration_watched_min) / 60')} AS total_viewing_hours,
                     {rnd('avg(completion_pct)')} AS avg_completion_pct
              FROM sessions GROUP BY ALL)""",
    "region_isp": f"""
        SELECT cdn_region, isp, count(DISTINCT session_id) AS total_sessions, {QUALITY_MEANS}
        FROM streaming_quality GROUP BY cdn_region, isp""",
    "risks": """
        SELECT *,
               CASE WHEN total_watch_hours < 2 THEN 1.0 WHEN total_watch_hours < 5 THEN 0.7
                    WHEN total_watch_hours < 10 THEN 0.4 ELSE 0.0 END::decimal(4,2) AS w,
               CASE WHEN avg_completion_pct < 25 THEN 1.0 WHEN avg_completion_pct < 50 THEN 0.6
                    WHEN avg_completion_pct < 75 THEN 0.3 ELSE 0.0 END::decimal(4,2) AS c,
               CASE WHEN avg_buffering_events >= 3 THEN 1.0 WHEN avg_buffering_events >= 1 THEN 0.5
                    ELSE 0.0 END::decimal(4,2) AS b,
               CASE WHEN interaction_count <= 1 THEN 1.0 WHEN interaction_count <= 5 THEN 0.5
                    ELSE 0.0 END::decimal(4,2) AS i
        FROM engaged""",
}


def risk_table(score: str) -> str:
    return f"""
        SELECT * EXCLUDE (w, c, b, i), w::double AS watch_hours_risk, c::double AS completion_risk,
               b::double AS buffering_risk, i::double AS interaction_risk,
               CASE WHEN churn_risk_score >= 0.70 THEN 'High Risk'
                    WHEN churn_risk_score >= 0.40 THEN 'Medium Risk'
                    ELSE 'Low Risk' END AS churn_risk_segment
        FROM (SELECT *, {score} AS churn_risk_score FROM risks)"""


CTES["risk_exact"] = risk_table(
    "round(0.40 * w + 0.25 * c + 0.20 * b + 0.15 * i, 2)::double")
# A double is rounded by its shortest decimal text.
_DOUBLE_SUM = " + ".join(
    f"{weight}::double * {risk}::double"
    for weight, risk in (("0.40", "w"), ("0.25", "c"), ("0.20", "b"), ("0.15", "i"))
)
CTES["risk_double"] = risk_table(
    f"round(({_DOUBLE_SUM})::varchar::decimal(38,20), 2)::double")

define("clean_viewing", "SELECT * FROM clean_v")
define("clean_viewing_distinct", "SELECT DISTINCT * FROM clean_v")
define("clean_interactions",
       "SELECT * REPLACE (content_id::double AS content_id) FROM clean_i")
define("quality_by_user", "SELECT * FROM user_q")
define("enriched_sessions", "SELECT * FROM sessions")
define("monthly_interactions", "SELECT * FROM month_i")
define("user_monthly_engagement", "SELECT * FROM engaged")
define("daily_user_engagement", "SELECT * FROM engaged")
ORACLES["engagement_two_runs"] = ORACLES["user_monthly_engagement"].replace(CTES["viewing_history"], f"""
SELECT * REPLACE (CASE WHEN year(start_time::date) * 100 + month(start_time::date) = {CHANGED_MONTH}
                       THEN duration_watched_min / 2 ELSE duration_watched_min END AS duration_watched_min)
FROM ({CTES["viewing_history"]})""")
define("content_performance", "SELECT * FROM titles")
define("quality_region_isp", "SELECT * FROM region_isp")
define("churn_risk", "SELECT * FROM risk_exact")
define("churn_risk_double", "SELECT * FROM risk_double")
define("high_risk_users",
       "SELECT * FROM risk_exact WHERE churn_risk_segment = 'High Risk'")
for name in ("top_content", "top_content_csv"):
    define(name, "SELECT * FROM titles ORDER BY total_viewing_hours DESC, content_id LIMIT 100")
define("worst_quality_regions", """
SELECT * FROM region_isp
ORDER BY avg_buffering_events DESC, avg_latency_ms DESC, cdn_region, isp LIMIT 100""")
define("viewers_by_quarter_sketch", """
SELECT year(start_time::timestamp)::int AS year, quarter(start_time::timestamp)::int AS quarter, count(*) AS sessions,
       count(DISTINCT user_id) AS viewers, true AS close FROM viewing_history GROUP BY ALL""")
define("landing_csv", "SELECT * FROM user_profiles")
define("landing_json", "SELECT * FROM content_catalog")


def spoilt(column: str, kind: str = "double") -> str:
    return f"(CASE WHEN user_id % 97 <> 0 THEN {column} END)::{kind} AS {column}"


BUILD = "'b' || (user_id % 3) AS app_build"
define("landing_viewing", f"""
SELECT * REPLACE ({spoilt('completion_pct')}, start_time::date::varchar AS start_time), {BUILD}
FROM viewing_history""")
define("landing_quality", f"""
SELECT * REPLACE ({spoilt('latency_ms')}, buffering_events::int AS buffering_events,
                  resolution_changes::int AS resolution_changes), {BUILD}
FROM streaming_quality""")
define("landing_interactions", f"""
SELECT * REPLACE ({spoilt('content_id')}), {BUILD} FROM user_interactions""")


def output(dataset: str, table: str, hours: str | None = None, top: int | None = None) -> str:
    rows = f"least(count(*), {top})" if top else "count(*)"
    total = f"sum({hours}::decimal(18,2))::double" if hours else "NULL::double"
    return f"SELECT '{dataset}' AS dataset, {rows} AS row_count, {total} AS total_time FROM {table}"


define("lake_run", " UNION ALL ".join([
    output("viewing-history", "clean_v", "duration_watched_min"),
    output("user-interactions", "clean_i"),
    output("enriched-viewing-sessions", "sessions"),
    output("user-monthly-engagement", "engaged", "total_watch_hours"),
    output("content-performance", "titles", "total_viewing_hours"),
    output("streaming-quality-region-isp", "region_isp"),
    output("churn-risk", "risk_exact"),
    output("report high-risk-users", "risk_exact WHERE churn_risk_segment = 'High Risk'"),
    output("report top-content", "titles", top=100),
    output("report worst-quality-region-isp", "region_isp", top=100),
    output("report daily-user-engagement", "engaged"),
]))

# -- quality gates ------------------------------------------------------------


def gates(users: str, titles: str) -> str:
    return f"""
, counted(gate_order, rule, violations, fatal) AS (
SELECT 1, 'viewing_range', count(*), false FROM viewing_history
WHERE duration_watched_min > total_duration_min OR completion_pct < 0 OR completion_pct > 100
UNION ALL SELECT 2, 'viewing_unknown_user', count(*), true FROM viewing_history v
WHERE NOT EXISTS (SELECT 1 FROM user_profiles u WHERE u.user_id = v.user_id AND {users})
UNION ALL SELECT 3, 'viewing_unknown_content', count(*), true FROM viewing_history v
WHERE NOT EXISTS (SELECT 1 FROM content_catalog c WHERE c.content_id = v.content_id AND {titles})
UNION ALL SELECT 4, 'quality_range', count(*), true FROM streaming_quality
WHERE buffering_events < 0 OR avg_bitrate_mbps <= 0 OR resolution_changes < 0 OR latency_ms < 0
UNION ALL SELECT 5, 'interaction_unknown_user', count(*), true FROM user_interactions v
WHERE NOT EXISTS (SELECT 1 FROM user_profiles u WHERE u.user_id = v.user_id AND {users}))
SELECT *, NOT fatal OR violations = 0 AS passed FROM counted"""


for name in ("dq_report", "dq_report_staged"):
    define(name, gates("true", "true"))
define("dq_report_lost_profiles", gates("NOT is_churned", "release_year > 1980"))
define("dq_first_failure", gates("NOT is_churned", "release_year > 1980")
       + " ORDER BY passed, gate_order LIMIT 1")
ORACLES["dq_first_failure"] = f"SELECT rule, violations FROM ({ORACLES['dq_first_failure']}) WHERE NOT passed"
define("dq_null_rates", " UNION ALL ".join(
    f"""SELECT '{v.replace("_", "-")}' AS dataset, '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS null_count,
    count(*) AS row_count, round(count(*) FILTER ("{c}" IS NULL)::double / count(*), 6) AS null_rate
    FROM {v}"""
    for v in ("viewing_history", "content_catalog", "user_profiles", "user_interactions", "streaming_quality")
    for c in VIEWS[v].columns))
ORACLES["dq_null_rates_staged"] = ORACLES["dq_null_rates"]
define("dataset_presence", " UNION ALL ".join(
    [f"SELECT '{n.replace('_', '-')}' AS dataset, count(*)::double AS row_count, true AS present "
     f"FROM {n}" for n in ("viewing_history", "content_catalog", "user_profiles",
                           "user_interactions", "streaming_quality")]
    + ["SELECT 'ratings', NULL::double, false"]))
define("orphan_sessions", """
SELECT * FROM viewing_history v WHERE NOT EXISTS (
  SELECT 1 FROM user_profiles u WHERE u.user_id = v.user_id AND NOT is_churned)""")
define("repeated_orders", """
SELECT order_id, count(*) AS copies FROM sales_orders GROUP BY order_id HAVING count(*) > 1""")

# -- activity stream ----------------------------------------------------------

CTES |= {
    "activity": """
        SELECT event_id::varchar AS event_id, user_id::varchar AS user_id,
               user_id::varchar || '-' || ts::date::varchar AS session_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'play'
                    WHEN event_type = 'error' THEN 'buffering' ELSE 'pause' END AS action,
               ((props->>'$.k')::int % 2)::varchar AS content_id,
               'title ' || ((props->>'$.k')::int % 2)::varchar AS title,
               'smart_tv' AS device, ts AS event_time
        FROM events""",
    "plays": "SELECT * FROM activity WHERE action = 'play' AND event_time IS NOT NULL",
    "sliding": """
        SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, content_id, title,
               count(user_id) AS concurrent_viewers
        FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time)
                        - to_minutes(unnest(range(5))) AS window_start FROM plays)
        GROUP BY window_start, content_id, title""",
    "tumbling": """
        SELECT time_bucket(INTERVAL 15 MINUTE, event_time) AS window_start,
               time_bucket(INTERVAL 15 MINUTE, event_time) + INTERVAL 15 MINUTE AS window_end,
               content_id, title, count(user_id) AS viewer_count
        FROM plays GROUP BY ALL""",
    "grown": """
        SELECT *, (viewer_count - previous_viewer_count)::double / previous_viewer_count
                  AS growth_ratio
        FROM (SELECT *, lag(viewer_count) OVER (PARTITION BY content_id
                        ORDER BY window_start, title) AS previous_viewer_count
              FROM tumbling)""",
    "adjacent": """
        SELECT t.*, p.viewer_count AS previous_viewer_count,
               (t.viewer_count - p.viewer_count)::double / p.viewer_count AS growth_ratio
        FROM tumbling t JOIN tumbling p ON p.window_end = t.window_start
         AND p.content_id = t.content_id AND p.title = t.title""",
}

for name in ("parse_events", "stream_parse_events"):
    define(name, "SELECT * FROM activity")
define("decode_report", """
SELECT count(*) AS messages, 0::bigint AS undecoded, 0::bigint AS without_time FROM activity""")
for name in ("concurrent_viewers", "stream_concurrent_viewers"):
    define(name, "SELECT * FROM sliding")
define("stream_closed_viewers", """
SELECT * FROM sliding WHERE window_end <=
  (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 15 MINUTE FROM plays)""")
WATERMARK = "date_trunc('millisecond', max(event_time)) - INTERVAL 30 MINUTE"
CTES |= {"gap_sessions": """
SELECT min(event_time) AS session_start, max(event_time) + INTERVAL 6 HOUR AS session_end, session_id,
       count(*) FILTER (action = 'buffering') AS buffering_count, count(*) AS events
FROM (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY event_time RANGE UNBOUNDED PRECEDING) AS n
      FROM (SELECT *, CASE WHEN event_time <= lag(event_time) OVER (PARTITION BY session_id ORDER BY event_time)
                                + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM activity))
GROUP BY session_id, n HAVING buffering_count > 1"""}
define("poor_sessions_gap", "SELECT * FROM gap_sessions")
define("stream_poor_sessions_gap", f"""
SELECT * FROM gap_sessions WHERE session_end <= (SELECT {WATERMARK} FROM activity)""")
define("stream_last_seen_spikes", f"""
SELECT * FROM grown WHERE previous_viewer_count > 0 AND growth_ratio > 2.0
  AND window_end <= (SELECT {WATERMARK} FROM plays)""")


def arrived(table: str, watermark: str) -> str:
    """Events by the part they arrive in, and the watermark before each part."""
    return f"""
, parts AS (SELECT *, CASE WHEN event_id::bigint % 10 = 0 THEN 3 WHEN day(event_time) <= 15 THEN 1 ELSE 2 END AS part
            FROM activity),
marks AS (SELECT part, coalesce((SELECT {watermark} FROM parts q WHERE q.part < p.part {table}),
                                TIMESTAMP '1970-01-01') AS watermark
          FROM (SELECT DISTINCT part FROM parts) p)"""


define("stream_lateness", f"""
{arrived("AND q.action = 'play'", WATERMARK)},
late AS (SELECT DISTINCT part, time_bucket(INTERVAL 15 MINUTE, event_time) AS w, content_id, title
         FROM parts JOIN marks USING (part)
         WHERE action = 'play' AND time_bucket(INTERVAL 15 MINUTE, event_time) + INTERVAL 15 MINUTE <= watermark)
SELECT m.part::int AS part, (SELECT count(*) FROM parts p WHERE p.part = m.part) AS input_rows,
       (SELECT count(*) FROM late l WHERE l.part = m.part) AS dropped, watermark FROM marks m""")
define("stream_late_events", f"""
{arrived("", WATERMARK)}
SELECT (m.part - 1)::bigint AS batch, count(*) AS events, count(*) FILTER (event_time < watermark) AS late,
       0::bigint AS without_time, watermark FROM marks m JOIN parts USING (part) GROUP BY m.part, watermark""")
define("stream_rejected", """
, told AS (SELECT *, event_id::bigint AS n FROM activity),
judged AS (SELECT *, CASE WHEN n % 7 = 0 THEN 'broken JSON' WHEN n % 11 = 0 THEN 'no value' WHEN n % 13 = 0 THEN 'no known field'
                          WHEN n % 17 = 0 THEN 'no usable time' END AS reason FROM told)
SELECT CASE WHEN reason IS NULL THEN 'parsed' ELSE 'rejected' END AS status, reason,
       CASE WHEN reason IS NULL THEN event_id END AS event_id, CASE WHEN reason IS NULL THEN event_time END AS event_time,
       CASE WHEN reason IS NOT NULL THEN session_id END AS key,
       CASE reason WHEN 'broken JSON' THEN '{"event_id": "' || event_id WHEN 'no known field' THEN '{"other": ' || event_id || '}'
            WHEN 'no usable time' THEN '{"event_id": "' || event_id || '", "event_ts": "noon"}' END AS value
FROM judged""")
for name in ("poor_sessions", "stream_poor_sessions"):
    define(name, """
SELECT session_id, count(*) FILTER (action = 'buffering') AS buffering_count
FROM activity GROUP BY session_id HAVING count(*) FILTER (action = 'buffering') > 3""")
define("poor_sessions_by_day", """
SELECT date_trunc('day', event_time)::timestamp AS window_start,
       date_trunc('day', event_time)::timestamp + INTERVAL 1 DAY AS window_end, session_id,
       count(*) FILTER (action = 'buffering') AS buffering_count
FROM activity GROUP BY ALL HAVING buffering_count > 2""")
for name in ("viewer_windows", "stream_viewer_windows", "stream_viewer_snapshot"):
    define(name, "SELECT * FROM tumbling")
define("viewer_growth", """
SELECT * REPLACE (previous_viewer_count::double AS previous_viewer_count) FROM grown""")
for name in ("trending_spikes", "stream_trending_spikes"):
    define(name, "SELECT * FROM grown WHERE previous_viewer_count > 0 AND growth_ratio > 2.0")
for name in ("trending_spikes_adjacent", "adjacent_spikes"):
    define(name, "SELECT * FROM adjacent WHERE growth_ratio > 2.0")
define("stream_freshness", f"""
SELECT action, max(event_time) AS newest_event, count(*) AS events,
       (epoch(TIMESTAMP '{AS_OF}')::bigint - floor(epoch(max(event_time)))::bigint) AS lag_seconds
FROM activity GROUP BY action""")

# -- findings -----------------------------------------------------------------

define("cost_decile_share", f"""
, ranked AS (SELECT *, rank() OVER (ORDER BY cost_per_viewing_hour DESC)
                    <= ceil(count(*) OVER () * 0.10) AS worst
             FROM titles WHERE cost_per_viewing_hour IS NOT NULL),
figures AS (SELECT count(*) AS priced_titles, (count(*) FILTER (worst))::bigint AS worst_titles,
                   min(cost_per_viewing_hour) FILTER (worst) AS cost_threshold,
                   (sum(license_cost_monthly::decimal(18,2)) FILTER (worst))::double
                     AS worst_monthly_spend,
                   sum(license_cost_monthly::decimal(18,2))::double AS total_monthly_spend
            FROM ranked)
SELECT *, {rnd('worst_monthly_spend * 12')} AS worst_annual_spend,
       {rnd('worst_monthly_spend / total_monthly_spend', 4)} AS spend_share
FROM figures""")
define("cost_spread", f"""
SELECT min(cost_per_viewing_hour) AS lowest_cost, max(cost_per_viewing_hour) AS highest_cost,
       {rnd('max(cost_per_viewing_hour) / nullif(min(cost_per_viewing_hour), 0)')} AS times
FROM titles""")


def cohort(metric: str) -> str:
    churned, kept = (f"avg({metric}) FILTER ({c})" for c in ("is_churned", "NOT is_churned"))
    return f"""SELECT '{metric}' AS metric, {rnd(churned, 4)} AS churned_mean,
       {rnd(kept, 4)} AS retained_mean,
       {rnd(f'({kept} - {churned}) / {kept}', 4)} AS relative_gap FROM engaged"""


define("churn_cohorts", " UNION ALL ".join(cohort(m) for m in (
    "total_watch_hours", "avg_completion_pct", "avg_buffering_events", "unique_titles_watched")))
define("quality_spread", " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, count(*) AS groups, {rnd('min(m)', 4)} AS lowest_mean,
       {rnd('max(m)', 4)} AS highest_mean, {rnd('(max(m) - min(m)) / avg(m)', 4)} AS spread
FROM (SELECT {d}, avg(buffering_events) AS m FROM streaming_quality GROUP BY {d})"""
    for d in ("cdn_region", "isp")))
define("quality_corr", f"""
SELECT count(*) AS sessions,
       {rnd('corr(completion_pct, avg_buffering_events)', 4)} AS buffering_completion_corr
FROM sessions WHERE completion_pct IS NOT NULL AND avg_buffering_events IS NOT NULL""")
