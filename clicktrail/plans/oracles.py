"""ANSI SQL that states each registered query independently of the engine.

The SQL runs on the generated tables in another engine and must give the same
rows. It is written the obvious way (plain range joins, correlated picks), not
the way the engine plans it.
"""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

CLICKS = f"""
clicks AS (
  SELECT event_id AS click_id, user_id, ts AS click_time,
         CASE WHEN event_id % 2 = 0 THEN 'Homepage' ELSE 'Product' END AS click_at,
         CASE {_K} % 7 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'Gmail' WHEN 2 THEN 'Google' WHEN 3 THEN 'Tiktok'
              WHEN 4 THEN 'Twitter' WHEN 5 THEN 'Unknown' ELSE 'Youtube' END AS source,
         '10.0.' || (event_id % 256) || '.' || {_K} AS ip
  FROM events WHERE event_type = 'click'
)"""

PURCHASES = f"""
purchases AS (
  SELECT event_id AS purchase_id, user_id, {_K} AS product_id,
         CAST(event_id % 31 AS DECIMAL(10,2)) AS shipping_cost,
         CAST((event_id % 5) * 0.08 AS DECIMAL(4,2)) AS discount,
         value AS total_cost,
         CASE event_id % 7 WHEN 0 THEN 'Visa' WHEN 1 THEN 'MasterCard' WHEN 2 THEN 'Stripe'
              WHEN 3 THEN 'Payment on Delivery' WHEN 4 THEN 'Paypal' WHEN 5 THEN 'Alipay'
              ELSE 'Skrill' END AS payment_method,
         1 + event_id % 13 AS quantity,
         CASE WHEN event_id % 9 = 4 THEN 'failure' ELSE 'success' END AS payment_status,
         CASE WHEN event_id % 9 <> 4 THEN 'none' ELSE
           CASE (event_id // 9) % 6 WHEN 0 THEN 'Insufficient Fund' WHEN 1 THEN 'Invalid Payment Details'
                WHEN 2 THEN 'Network Connectivity Issues' WHEN 3 THEN 'Payment Gateway Issues'
                WHEN 4 THEN 'Incorrect Billing Address' ELSE 'Card Expired' END END AS description,
         ts AS purchase_time
  FROM events WHERE event_type = 'purchase'
)"""

USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS name, lower(c_name) || '@example.com' AS email,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS DATE) AS birth_day,
         n_name AS location, '000' || c_custkey AS phone,
         CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS registration_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price,
         CAST((1 + p_size % 10) * 0.01 AS DECIMAL(4,2)) AS commission_rate
  FROM part
)"""

ENRICHED = """
totals AS (
  SELECT p.*, u.name, u.email, u.gender, u.birth_day, u.location, u.phone, u.registration_date,
         r.product_name, r.category, r.brand, r.commission_rate,
         CAST(r.price * CAST(p.quantity AS DECIMAL(9,0)) * (1 - p.discount) + p.shipping_cost
              AS DECIMAL(18,4)) AS new_total
  FROM purchases p JOIN users u USING (user_id) JOIN products r USING (product_id)
),
enriched AS (
  SELECT * EXCLUDE (total_cost, shipping_cost, discount, commission_rate, new_total),
         new_total AS total_cost,
         CAST((new_total - shipping_cost) * commission_rate AS DECIMAL(18,6)) AS profit
  FROM totals
)"""

_CHECKOUT_COLUMNS = """
  e.product_id, e.user_id, e.purchase_id, e.total_cost, e.payment_method, e.quantity,
  e.payment_status, e.description, e.purchase_time, e.name, e.email, e.gender, e.birth_day,
  e.location, e.phone, e.registration_date, e.product_name, e.category, e.brand, e.profit,
  c.click_id, c.click_time, c.click_at, c.source, c.ip"""

#: Layout and types of the stored table.
_CONFORMED = """
  CAST(product_id AS VARCHAR) AS product_id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(purchase_id AS VARCHAR) AS purchase_id, CAST(total_cost AS DOUBLE) AS total_cost,
  payment_method, CAST(quantity AS DOUBLE) AS quantity, payment_status, description,
  purchase_time, name, email, gender, birth_day, location, phone, registration_date,
  product_name, category, brand, CAST(profit AS DOUBLE) AS profit,
  CAST(click_id AS VARCHAR) AS click_id, click_time, click_at, source, ip"""


def _final_clicks(window: str) -> str:
    return f"""
final_clicks AS (
  SELECT click_id, user_id, click_time, click_at, source, ip FROM clicks
  QUALIFY row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL '{window}', click_time)
                             ORDER BY click_time, click_id) = 1
)"""


def _windowed(lookback: str) -> str:
    return f"""{_final_clicks(lookback)},
checkouts AS (
  SELECT {_CHECKOUT_COLUMNS}
  FROM enriched e JOIN final_clicks c ON e.user_id = c.user_id
   AND e.purchase_time >= c.click_time
   AND e.purchase_time <= c.click_time + INTERVAL '{lookback}'
)"""


def _trailing(lookback: str) -> str:
    return f"""
checkouts AS (
  SELECT {_CHECKOUT_COLUMNS}
  FROM enriched e JOIN clicks c ON e.user_id = c.user_id
   AND c.click_time <= e.purchase_time
   AND c.click_time >= e.purchase_time - INTERVAL '{lookback}'
  QUALIFY row_number() OVER (PARTITION BY e.purchase_id ORDER BY c.click_time, c.click_id) = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _checkouts(body: str) -> str:
    return _with(CLICKS, PURCHASES, USERS, PRODUCTS, ENRICHED, body)


# Dimension counted, payment status it counts.
_COUNTS = {
    "source_count": ("source", "success"),
    "fail_count": ("description", "failure"),
    "category_count": ("category", "success"),
    "gender_count": ("gender", "success"),
}
_END = "time_bucket(INTERVAL '{w}', purchase_time) + INTERVAL '{w}'"


def _count(table: str, window: str) -> str:
    dimension, status = _COUNTS[table]
    end = _END.format(w=window)
    return f"""SELECT {dimension}, CAST(count(*) AS BIGINT) AS count, {end} AS time
FROM checkouts WHERE payment_status = '{status}' GROUP BY {dimension}, {end}"""


def _revenue(window: str) -> str:
    end = _END.format(w=window)
    return f"""SELECT CAST(CAST(sum(total_cost) AS DECIMAL(18,4)) AS DOUBLE) AS revenue,
       CAST(CAST(sum(profit) AS DECIMAL(18,6)) AS DOUBLE) AS profit,
       CAST(sum(quantity) AS BIGINT) AS quantity, {end} AS time
FROM checkouts WHERE payment_status = 'success' GROUP BY {end}"""


def _rollup(table: str, window: str = "1 minute") -> str:
    return _revenue(window) if table == "revenue" else _count(table, window)


def _stored(table: str, window: str = "1 minute") -> str:
    return f"rolled AS ({_rollup(table, window)})"


def _report(table: str, horizon: str) -> str:
    """Counts per dimension value over the trailing horizon before the newest row."""
    dimension = _COUNTS[table][0]
    return f"""SELECT {dimension}, CAST(sum(count) AS BIGINT) AS count FROM rolled
WHERE time >= (SELECT max(time) FROM rolled) - INTERVAL '{horizon}' GROUP BY {dimension}"""


def _retained(keep: str) -> str:
    return f"""SELECT * FROM rolled
WHERE NOT (time < (SELECT max(time) FROM rolled) - INTERVAL '{keep}')"""


_CLICK_MESSAGE = """
  '{"Click_ID":"' || click_id || '","User_ID":"' || user_id || '","Click_time":"' ||
  replace(CAST(click_time AS VARCHAR), ' ', 'T') || '","Click_at":"' || click_at ||
  '","Source":"' || source || '","IP":"' || ip || '"}'"""

#: Messages with their faults, what is wrong with them, and the delivery they come in.
_FAULTY = f"""
faulty AS (
  SELECT *, CASE click_id % 11 WHEN 0 THEN substr(message, 1, 20)
              WHEN 1 THEN regexp_replace(message, '"Click_time":"[^"]*"', '"Click_time":"soon"')
              WHEN 2 THEN regexp_replace(message, '"Click_ID":"[^"]*",', '') ELSE message END AS value,
         CASE click_id % 11 WHEN 0 THEN 'no JSON object' WHEN 1 THEN 'Click_time is no timestamp'
              WHEN 2 THEN 'Click_ID is missing' END AS reasons,
         least(4, (epoch_us(click_time) - (SELECT min(epoch_us(click_time)) FROM clicks)) * 5
                  // (SELECT max(epoch_us(click_time)) - min(epoch_us(click_time)) + 1 FROM clicks)
                  + CASE WHEN click_id % 10 = 3 THEN 2 ELSE 0 END) AS part
  FROM (SELECT *, {_CLICK_MESSAGE} AS message FROM clicks)
)"""


def _split(late: str, lateness: str) -> str:
    """Sound clicks before or behind the watermark that earlier deliveries set."""
    return f"""
SELECT CAST(click_id AS VARCHAR) AS click_id, CAST(user_id AS VARCHAR) AS user_id, click_time, click_at, source, ip
FROM faulty f WHERE reasons IS NULL AND {late} coalesce(click_time <
  (SELECT max(click_time) FROM faulty e WHERE e.part < f.part AND e.reasons IS NULL) - INTERVAL '{lateness}', false)"""


ROLLUP_TABLES = (*_COUNTS, "revenue")
DAY = "1 day"
TEN_MINUTES = "10 minutes"


def oracle_sql(horizon: str, keep: str, lateness: str) -> dict[str, str]:
    """Oracle per query key; ``horizon`` and ``keep`` as the queries use them."""
    trailing_day = _checkouts(_trailing(DAY))
    windowed_day = _checkouts(_windowed(DAY))
    enriched = _with(PURCHASES, USERS, PRODUCTS, ENRICHED)
    conformed_day = f"{windowed_day} SELECT {_CONFORMED} FROM checkouts"
    conformed_trailing = f"{trailing_day} SELECT {_CONFORMED} FROM checkouts"
    typed_clicks = """SELECT CAST(click_id AS VARCHAR) AS click_id, CAST(user_id AS VARCHAR) AS user_id,
  click_time, click_at, source, ip FROM clicks"""
    products = """SELECT product_id, product_name, category, brand,
  CAST(price AS DOUBLE) AS price, CAST(commission_rate AS DOUBLE) AS commission_rate FROM products"""
    products_text = products.replace("product_id,", "CAST(product_id AS VARCHAR) AS product_id,", 1)
    users_text = """SELECT CAST(user_id AS VARCHAR) AS user_id, name, email, gender, birth_day,
  location, phone, registration_date FROM users"""

    sql = {
        "stream_topic_scan": _with(CLICKS, PURCHASES)
        + """SELECT 'clicks' AS topic, CAST(count(*) AS BIGINT) AS messages FROM clicks
UNION ALL SELECT 'purchases', CAST(count(*) AS BIGINT) FROM purchases""",
        "demux_topic": _with(CLICKS) + f"SELECT {_CLICK_MESSAGE} AS value FROM clicks",
        "parse_clicks": _with(CLICKS) + typed_clicks,
        "parse_rejects": _with(CLICKS, _FAULTY) + "SELECT value, reasons FROM faulty WHERE reasons IS NOT NULL",
        "parse_accepted": _with(CLICKS, _FAULTY) + typed_clicks.replace("FROM clicks", "FROM faulty WHERE reasons IS NULL"),
        "stream_rejects": _with(CLICKS, _FAULTY) + "SELECT value, reasons FROM faulty WHERE reasons IS NOT NULL",
        "stream_on_time_events": _with(CLICKS, _FAULTY) + _split("NOT", lateness),
        "stream_late_events": _with(CLICKS, _FAULTY) + _split("", lateness),
        "typed_purchases": _with(PURCHASES)
        + """SELECT CAST(purchase_id AS VARCHAR) AS purchase_id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(product_id AS VARCHAR) AS product_id, CAST(shipping_cost AS DOUBLE) AS shipping_cost,
  CAST(discount AS DOUBLE) AS discount, CAST(CAST(total_cost AS DECIMAL(14,4)) AS DOUBLE) AS total_cost,
  payment_method, CAST(quantity AS DOUBLE) AS quantity, payment_status, description, purchase_time
FROM purchases""",
        "scan_users": _with(USERS) + "SELECT * FROM users",
        "scan_products": _with(PRODUCTS) + products,
        "csv_roundtrip_products": _with(PRODUCTS) + products_text,
        "load_users": _with(USERS) + users_text,
        "load_products": _with(PRODUCTS) + products_text,
        "dimension_ids": _with(PRODUCTS) + "SELECT product_id FROM products",
        "table_readback": conformed_trailing,
        "json_encode_checkouts": conformed_trailing,
        "conform_checkouts": conformed_day,
        "key_violations_checkouts": windowed_day
        + """SELECT CAST(purchase_id AS VARCHAR) AS purchase_id, CAST(count(*) AS BIGINT) AS "rows"
FROM checkouts GROUP BY purchase_id HAVING count(*) > 1 OR purchase_id IS NULL""",
        "enrich_purchases": enriched
        + """SELECT * EXCLUDE (total_cost, profit), CAST(total_cost AS DOUBLE) AS total_cost,
  CAST(profit AS DOUBLE) AS profit FROM enriched""",
        "successful_checkouts": f"{trailing_day} SELECT {_CONFORMED} FROM checkouts WHERE payment_status = 'success'",
        "failed_checkouts": f"{trailing_day} SELECT {_CONFORMED} FROM checkouts WHERE payment_status = 'failure'",
        "stream_final_clicks": _with(CLICKS, _final_clicks(TEN_MINUTES))
        + """SELECT CAST(click_id AS VARCHAR) AS click_id, CAST(user_id AS VARCHAR) AS user_id,
  click_time, click_at, source, ip FROM final_clicks""",
        # all real windows are closed: no state but the flush message's own window
        "stream_state_after_flush": _with(CLICKS)
        + """SELECT 'flush' AS user_id, TIMESTAMP '2100-01-01 00:00:00' AS window_start FROM (SELECT count(*) AS n FROM clicks)
WHERE n > 0""",
        "hot_keys_purchases": _with(PURCHASES)
        + "\nUNION ALL ".join(
            f"""SELECT '{key}' AS key, CAST({key} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS "rows",
  (SELECT CAST(count({key}) AS BIGINT) FROM purchases) AS all_rows FROM purchases WHERE {key} IS NOT NULL
GROUP BY {key} HAVING 100 * count(*) >= (SELECT count({key}) FROM purchases)"""
            for key in ("user_id", "product_id")
        ),
        "stream_hot_key_checkouts": conformed_day,
        "stream_checkouts_sink": conformed_day
        + " QUALIFY row_number() OVER (PARTITION BY purchase_id ORDER BY click_time, click_id) = 1",
        "stream_min_click": _with(CLICKS)
        + f"""SELECT CAST(user_id AS VARCHAR) AS min_user_id, min(click_time) AS min_click_time FROM clicks
GROUP BY user_id, time_bucket(INTERVAL '{TEN_MINUTES}', click_time)""",
        "stream_first_click_attribution": conformed_trailing,
    }
    for suffix, lookback in (("", TEN_MINUTES), ("_1d", DAY)):
        sql |= {
            f"min_click{suffix}": _with(CLICKS)
            + f"""SELECT user_id AS min_user_id, min(click_time) AS min_click_time FROM clicks
GROUP BY user_id, time_bucket(INTERVAL '{lookback}', click_time)""",
            f"final_clicks{suffix}": _with(CLICKS, _final_clicks(lookback)) + "SELECT * FROM final_clicks",
            f"final_clicks_second_join{suffix}": _with(CLICKS)
            + f""", minima AS (
  SELECT user_id, min(click_time) AS first FROM clicks
  GROUP BY user_id, time_bucket(INTERVAL '{lookback}', click_time)
)
SELECT c.* FROM clicks c JOIN minima m ON c.user_id = m.user_id
 AND date_trunc('second', c.click_time) = date_trunc('second', m.first)""",
            f"checkouts{suffix}": f"{_checkouts(_windowed(lookback))} SELECT {_CONFORMED} FROM checkouts",
            f"first_click_attribution{suffix}": f"{_checkouts(_trailing(lookback))} SELECT {_CONFORMED} FROM checkouts",
        }
    for table in ROLLUP_TABLES:
        sql[table] = trailing_day + _rollup(table)
        sql[f"{table}_single_pass"] = sql[table]
        sql[f"incremental_{table}"] = sql[table]
        sql[f"stream_{table}"] = windowed_day + _rollup(table)
        sql[f"stream_topic_{table}"] = sql[f"stream_{table}"]
        sql[f"stream_update_{table}"] = sql[f"stream_{table}"]
        rolled = _checkouts(_trailing(DAY) + ", " + _stored(table))
        sql[f"retention_{table}"] = rolled + _retained(keep)
    counts = {table: _checkouts(_trailing(DAY) + ", " + _stored(table)) for table in _COUNTS}
    sql |= {
        "report_revenue": trailing_day + f"SELECT revenue, profit, time FROM ({_rollup('revenue')}) ORDER BY time",
        "report_sources": counts["source_count"] + _report("source_count", horizon) + " ORDER BY count DESC, source",
        "report_top_categories": counts["category_count"]
        + _report("category_count", horizon)
        + " ORDER BY count DESC, category LIMIT 10",
        "report_gender": counts["gender_count"]
        + f"""SELECT gender, count, CAST(count AS DOUBLE) / sum(count) OVER () AS share
FROM ({_report("gender_count", horizon)})""",
        "report_failures": counts["fail_count"]
        + _report("fail_count", horizon)
        + " ORDER BY count DESC, description",
    }
    return sql
