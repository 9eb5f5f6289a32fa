"""The results the queries must have, as SQL that DuckDB runs on the same tables.

The SQL starts from the click events in columns and never sees a message, so it
checks parsing and routing too. Amounts are decimals until the end, because sums
of doubles depend on the order of rows; amounts that are none are added as doubles.
"""

from __future__ import annotations

from clickloom.plans.fixture import CATALOG_SQL, FLAT_SQL, WIRE_FIELDS

INGESTED = "event_ts + to_seconds(n % 7)"
WIRE_TIME = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
CLOSED = "(SELECT max(event_ts) - INTERVAL '5 minutes' FROM valid)"


def _units(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(20,4))"


WITH = f"""
WITH flat AS ({FLAT_SQL}),
routed AS (
  SELECT *,
    CASE WHEN fault IN ('broken_json', 'no_event_id') THEN 'corrupt'
         WHEN event_type = 'unknown_action' OR fault IS NOT NULL THEN 'rejected'
         ELSE 'valid' END AS route,
    CASE WHEN fault IN ('broken_json', 'no_event_id') THEN NULL
         WHEN event_type = 'unknown_action' THEN 'event_type'
         WHEN fault = 'no_user_id' THEN 'user_id'
         WHEN fault = 'no_session_id' THEN 'session_id' END AS reject_reason
  FROM flat),
valid AS (
  SELECT *,
    {WIRE_TIME} AS event_timestamp,
    CAST(NULL AS VARCHAR) AS product_name,
    CAST(NULL AS VARCHAR) AS category,
    event_ts AS kafka_timestamp,
    CAST(n % 6 AS INTEGER) AS kafka_partition,
    n AS kafka_offset,
    {INGESTED} AS _ingested_at,
    CAST(event_ts AS DATE) AS event_date,
    CAST(hour(event_ts) AS INTEGER) AS event_hour,
    CAST(minute(event_ts) AS INTEGER) AS event_minute,
    event_type = 'checkout_complete' AS is_purchase,
    event_type = 'add_to_cart' AS is_add_to_cart,
    CASE WHEN event_type = 'checkout_complete' THEN cart_value ELSE CAST(0 AS DOUBLE) END AS revenue,
    CASE WHEN event_type IN ('page_view', 'search') THEN 'awareness'
         WHEN event_type IN ('product_view', 'wishlist_add') THEN 'consideration'
         WHEN event_type IN ('add_to_cart', 'remove_from_cart') THEN 'intent'
         WHEN event_type IN ('checkout_start', 'checkout_complete') THEN 'purchase'
         ELSE 'other' END AS funnel_stage,
    CAST((n % 7) * 1000 AS BIGINT) AS processing_lag_ms
  FROM routed WHERE route = 'valid'),
catalog AS ({CATALOG_SQL})
"""

EVENT_COLUMNS = """event_id, event_type, event_timestamp, user_id, session_id, device_type,
  browser, ip_address, referrer, page_url, product_id, product_name, category, price, quantity,
  search_query, cart_value, order_id, payment_method, is_authenticated, event_ts,
  kafka_timestamp, kafka_partition, kafka_offset, _ingested_at"""

ENRICHED_COLUMNS = f"""{EVENT_COLUMNS}, event_date, event_hour, event_minute, is_purchase,
  is_add_to_cart, revenue, funnel_stage, processing_lag_ms"""

_PLAIN = "(abs(revenue) < 1e15 AND round(revenue, 4) = revenue)"
TOTAL_REVENUE = f"""CASE WHEN count(revenue) > 0 THEN
    coalesce(CAST(sum(CASE WHEN {_PLAIN} THEN CAST(revenue AS DECIMAL(20,4)) END) AS DOUBLE), 0)
    + coalesce(sum(CASE WHEN NOT {_PLAIN} THEN revenue END), 0) END"""


def _cells(width: str, step: str | None = None, per_event: int = 1, where: str = "") -> str:
    """Cells of all windows of ``width`` that start every ``step``."""
    step = step or width
    return f"""{WITH},
starts AS (
  SELECT v.*, time_bucket(INTERVAL '{step}', event_ts, TIMESTAMP '1970-01-01')
              - i * INTERVAL '{step}' AS window_start
  FROM valid v CROSS JOIN (SELECT unnest(range(0, {per_event})) AS i)),
cells AS (
  SELECT event_type, event_date, device_type, funnel_stage,
    count(*) AS event_count,
    count(DISTINCT user_id) AS unique_users,
    count(DISTINCT session_id) AS unique_sessions,
    {TOTAL_REVENUE} AS total_revenue,
    {TOTAL_REVENUE} / nullif(count(revenue), 0) AS avg_revenue,
    CAST(count_if(is_purchase) AS BIGINT) AS purchase_count,
    CAST(count_if(is_add_to_cart) AS BIGINT) AS add_to_cart_count,
    avg(processing_lag_ms) AS avg_processing_lag_ms,
    max(processing_lag_ms) AS max_processing_lag_ms,
    count(DISTINCT product_id) AS unique_products_viewed,
    CAST(count_if(is_authenticated) AS BIGINT) AS authenticated_events,
    window_start,
    window_start + INTERVAL '{width}' AS window_end
  FROM starts GROUP BY ALL)
SELECT * FROM cells {where}"""


def _sessions(gap: str, where: str = "") -> str:
    return f"""{WITH},
borders AS (
  SELECT *, CASE WHEN event_ts - lag(event_ts) OVER w <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS starts
  FROM valid WINDOW w AS (PARTITION BY user_id ORDER BY event_ts)),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS number
  FROM borders),
found AS (
  SELECT user_id, min(event_ts) AS session_start,
    max(event_ts) + INTERVAL '{gap}' AS session_end,
    count(*) AS event_count,
    CAST(count_if(is_purchase) AS BIGINT) AS purchase_count,
    {TOTAL_REVENUE} AS total_revenue
  FROM numbered GROUP BY user_id, number)
SELECT * FROM found {where}"""


_ADDED = _units("round(price * quantity, 2)")
CART = f"""{WITH},
steps AS (
  SELECT *,
    CASE WHEN event_type = 'add_to_cart' THEN {_ADDED} ELSE 0 END AS added,
    count_if(event_type = 'checkout_complete') OVER (
      PARTITION BY session_id ORDER BY event_ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS epoch
  FROM valid),
carts AS (
  SELECT *, CAST(sum(added) OVER (
      PARTITION BY session_id, coalesce(epoch, 0) ORDER BY event_ts, event_id
      ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,4)) AS cart
  FROM steps)
SELECT event_id, session_id, event_type, event_ts,
  round(CAST(CASE
    WHEN event_type = 'remove_from_cart' THEN greatest(cart - {_units('price')}, 0)
    WHEN event_type IN ('add_to_cart', 'checkout_start', 'checkout_complete') THEN cart
  END AS DOUBLE), 2) AS running_cart
FROM carts"""

LOGIN = f"""{WITH}
SELECT event_id, user_id, event_type, event_ts,
  coalesce(last_value(CASE event_type WHEN 'user_login' THEN true WHEN 'user_logout' THEN false END
      IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING),
    false) AS logged_in
FROM valid"""

# Where the watermark of the valid events ends; it counts in milliseconds.
PASSED = f"""(SELECT date_trunc('milliseconds', max(event_ts) - INTERVAL '5 minutes')
FROM ({WITH} SELECT event_ts FROM valid))"""

HIGH_VALUE = "CASE WHEN isnan(coalesce(cart_value, 0)) THEN false ELSE coalesce(cart_value, 0) >= 500 END"
ALERTS = f"""{WITH}
SELECT event_id, event_ts, order_id, user_id, coalesce(cart_value, 0) AS amount, payment_method,
  printf('HIGH-VALUE PURCHASE ALERT | order_id=%s user_id=%s amount=%.2f payment=%s',
    order_id, user_id, coalesce(cart_value, 0), payment_method) AS alert_text
FROM valid WHERE is_purchase AND {HIGH_VALUE}"""

BRONZE = f"{WITH} SELECT {ENRICHED_COLUMNS} FROM valid"

LOOKUP = f"""{WITH}
SELECT e.event_id, e.product_id, c.product_name AS catalog_name, c.category AS catalog_category,
  c.price AS catalog_price
FROM flat e LEFT JOIN catalog c ON e.product_id = c.product_id"""

UPSERTED = f"""{WITH}
SELECT event_id,
  CASE WHEN resent AND n % 2 = 0 THEN 'corrected' ELSE event_type END AS event_type,
  user_id, cart_value,
  CASE WHEN resent AND n % 2 = 0 THEN 2 ELSE 1 END AS version,
  CAST(event_ts AS DATE) AS event_date
FROM flat"""

UPSERTED_TABLE = UPSERTED.replace(
    "CAST(event_ts AS DATE) AS event_date",
    """CASE WHEN n % 10 <> 3 THEN CAST(event_ts AS DATE) END AS event_date,
  CASE WHEN resent AND n % 2 = 0 THEN 'ops' END AS fixed_by""",
)

# The parts of the fixture: twelfths of the time the events span.
PARTED = """parted AS (
  SELECT *, CAST((epoch_us(event_ts) - (SELECT min(epoch_us(event_ts)) FROM flat)) * 12
    // ((SELECT max(epoch_us(event_ts)) - min(epoch_us(event_ts)) FROM flat) + 1) AS INTEGER) AS part
  FROM valid)"""

_FIELDS_SENT = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in WIRE_FIELDS)

# Rule -> (events it applies to, what must hold for them).
_RULES = {
    "required_fields": (
        "true",
        "event_id <> '' AND event_type <> '' AND event_timestamp <> '' AND user_id <> ''"
        " AND session_id <> ''",
    ),
    "event_id_uuid": (
        "true",
        "regexp_full_match(event_id, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}')",
    ),
    "timestamp_iso8601": ("true", "try_cast(event_timestamp AS TIMESTAMPTZ) IS NOT NULL"),
    "event_type_domain": ("true", "event_type <> 'unknown_action'"),
    "device_type_domain": ("true", "device_type IN ('desktop', 'mobile', 'tablet')"),
    "user_id_prefix": ("true", "starts_with(user_id, 'U-')"),
    "session_id_prefix": ("true", "starts_with(session_id, 'S-')"),
    "product_view_product": (
        "event_type = 'product_view'",
        "catalog_price IS NOT NULL AND price > 0 AND category IN ('ECONOMY', 'LARGE', 'MEDIUM')",
    ),
    "add_to_cart_quantity": (
        "event_type = 'add_to_cart'",
        "product_id IS NOT NULL AND quantity BETWEEN 1 AND 5 AND cart_value > 0",
    ),
    "checkout_complete_order": (
        "event_type = 'checkout_complete'",
        "starts_with(order_id, 'ORD-') AND payment_method IN"
        " ('credit_card', 'paypal', 'apple_pay', 'google_pay', 'debit_card')",
    ),
    "search_query_set": ("event_type = 'search'", "search_query <> ''"),
    "page_url_set": ("true", "page_url <> ''"),
    "price_positive": ("price IS NOT NULL", "price > 0"),
    "cart_value_not_negative": ("cart_value IS NOT NULL", "cart_value >= 0"),
    "json_round_trip": ("true", "n % 20 <> 13 OR event_id IS NULL"),
    "json_without_nulls": ("true", "n % 20 NOT IN (13, 14)"),
}

_RULE_ROWS = "\nUNION ALL ".join(
    f"SELECT '{rule}' AS rule, count_if({applies}) AS checked,"
    f" count_if(({applies}) AND NOT coalesce({holds}, false)) AS failed FROM q"
    for rule, (applies, holds) in _RULES.items()
)

QUALITY = f"""{WITH},
delivered AS (SELECT * FROM flat UNION ALL SELECT * FROM flat WHERE resent),
q AS (
  SELECT
    CASE WHEN d.fault IS NULL THEN
      substr(md5(event_id), 1, 8) || '-' || substr(md5(event_id), 9, 4) || '-' ||
      substr(md5(event_id), 13, 4) || '-' || substr(md5(event_id), 17, 4) || '-' ||
      substr(md5(event_id), 21, 12) ELSE event_id END AS event_id,
    d.event_type,
    CASE WHEN fault = 'no_user_id' THEN '' ELSE user_id END AS user_id,
    CASE WHEN fault = 'no_session_id' THEN NULL ELSE session_id END AS session_id,
    CASE WHEN fault = 'broken_json' THEN 'yesterday' ELSE {WIRE_TIME} END AS event_timestamp,
    n, d.product_id, order_id, c.price AS catalog_price,
    CASE WHEN n % 20 = 5 THEN 'tv' ELSE device_type END AS device_type,
    CASE WHEN n % 20 = 6 THEN '' ELSE page_url END AS page_url,
    CASE WHEN n % 20 = 7 THEN -d.price ELSE d.price END AS price,
    CASE WHEN n % 20 = 8 THEN -cart_value ELSE cart_value END AS cart_value,
    CASE WHEN n % 20 = 9 THEN quantity + 9 ELSE quantity END AS quantity,
    CASE WHEN n % 20 = 10 THEN 'cash' ELSE payment_method END AS payment_method,
    CASE WHEN n % 20 = 11 THEN '' ELSE search_query END AS search_query,
    CASE WHEN n % 20 = 12 THEN 'OTHER' ELSE c.category END AS category
  FROM delivered d LEFT JOIN catalog c ON d.product_id = c.product_id)
SELECT rule, CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed FROM (
{_RULE_ROWS}
UNION ALL SELECT 'event_types_present', 10,
  10 - (SELECT count(DISTINCT event_type) FROM q WHERE event_type <> 'unknown_action')
UNION ALL SELECT 'users_within_bound', count(DISTINCT user_id),
  greatest(count(DISTINCT user_id) - 500, 0) FROM q
UNION ALL SELECT 'event_ids_unique', count(*), count_if(copies > 1)
  FROM (SELECT event_id, count(*) AS copies FROM q GROUP BY event_id))"""

def _digest(table: str, source: str, parts: list[str], events: str = "count(*)") -> str:
    """A row of the digests of a job's tables."""
    line = f"md5(concat_ws('|', {', '.join(parts)}))"
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count,
  CAST(coalesce({events}, 0) AS BIGINT) AS events,
  CAST(coalesce(sum(CAST('0x' || substr({line}, 1, 7) AS BIGINT)), 0) AS BIGINT) AS digest
FROM {source}"""


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_CELL_DIGEST = _digest(
    "silver_agg", "closed",
    ["event_type", "device_type", "funnel_stage", _stamp("window_start")], "sum(event_count)",
)
_BRONZE_DIGEST = _digest("bronze", "valid", ["event_id", "event_type", "user_id"])
_JOB_CELLS = f"""{_cells('1 minute').rsplit('SELECT * FROM cells', 1)[0]},
closed AS (SELECT * FROM cells WHERE window_end <= {CLOSED})"""

JOB = f"""{_JOB_CELLS},
runs AS (
  SELECT user_id, min(event_ts) AS session_start, max(event_ts) + INTERVAL '30 minutes' AS session_end,
    count(*) AS event_count
  FROM (
    SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS number
    FROM (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts)
            <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS starts FROM valid))
  GROUP BY user_id, number),
over AS (SELECT * FROM runs WHERE session_end <= {CLOSED})
{_BRONZE_DIGEST}
UNION ALL {_digest('corrupt', "routed WHERE route = 'corrupt'", ["CAST(n AS VARCHAR)"])}
UNION ALL {_digest('rejected', "routed WHERE route = 'rejected'", ["reject_reason", "event_type"])}
UNION ALL {_digest('dead_letters', "routed WHERE route <> 'valid'", ["user_id"])}
UNION ALL {_CELL_DIGEST}
UNION ALL {_digest('silver_sessions', 'over', ["user_id", _stamp('session_start'), _stamp('session_end')], 'sum(event_count)')}
UNION ALL {_digest('alerts', f'valid WHERE is_purchase AND {HIGH_VALUE}', ["event_id", "order_id", "user_id"])}"""

JOB_FROM_BRONZE = f"""{_JOB_CELLS}
{_BRONZE_DIGEST}
UNION ALL {_CELL_DIGEST}"""

_CUBE_KEYS = ("event_type", "event_date", "device_type")
_CUBE = [
    f"""SELECT {grouping} AS "grouping", {', '.join(k if k in keys else f'NULL AS {k}' for k in _CUBE_KEYS)},
  count(*) AS event_count, CAST(count_if(is_purchase) AS BIGINT) AS purchase_count,
  CAST(count_if(is_add_to_cart) AS BIGINT) AS add_to_cart_count,
  CAST(count_if(is_authenticated) AS BIGINT) AS authenticated_events,
  {TOTAL_REVENUE} AS total_revenue, max(processing_lag_ms) AS max_processing_lag_ms
FROM (SELECT {ENRICHED_COLUMNS} FROM valid) {f"GROUP BY {', '.join(keys)}" if keys else ''}"""
    for grouping, keys in (
        (1, ("event_type", "event_date")), (3, ("event_type",)), (5, ("event_date",)),
        (6, ("device_type",)), (7, ()),
    )
]


def _top(column: str) -> str:
    return f"""{WITH}
SELECT {column} AS value, count(*) AS n,
  CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) AS INTEGER) AS rank
FROM valid WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n DESC, value LIMIT 20"""


CHECKOUTS = f"""{WITH},
pairs AS (
  SELECT s.session_id, s.event_id AS start_id, s.event_ts AS started_at, c.event_id AS complete_id,
    c.event_ts AS completed_at, c.cart_value, c.event_id IS NULL AS abandoned
  FROM (SELECT * FROM valid WHERE event_type = 'checkout_start') s
  LEFT JOIN (SELECT * FROM valid WHERE event_type = 'checkout_complete') c
    ON s.session_id = c.session_id
    AND c.event_ts BETWEEN s.event_ts AND s.event_ts + INTERVAL '8 hours')
SELECT * FROM pairs WHERE NOT abandoned OR started_at + INTERVAL '8 hours' < {PASSED}"""

STATE_LEFT = f"""{WITH},
{PARTED},
still AS (
  SELECT time_bucket(INTERVAL '1 minute', event_ts) AS window_start, event_type,
    CAST(event_ts AS DATE) AS event_date, device_type, funnel_stage, user_id, session_id, product_id
  FROM (SELECT {ENRICHED_COLUMNS}, part, n FROM parted) WHERE NOT (n % 10 = 7 AND part < 9))
SELECT window_start, event_type, event_date, device_type, funnel_stage,
  1 + count(DISTINCT user_id) + count(DISTINCT session_id) + count(DISTINCT product_id) AS state_rows,
  count(DISTINCT user_id) + count(DISTINCT session_id) + count(DISTINCT product_id) AS distinct_values
FROM still WHERE window_start + INTERVAL '1 minute' > {CLOSED}
GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "parse_valid": f"{WITH} SELECT {EVENT_COLUMNS} FROM valid",
    "corrupt_records": f"""{WITH}
SELECT md5(CASE WHEN fault = 'broken_json' THEN 'not json {{{{'
    ELSE user_id || '|' || session_id || '|' || ip_address END) AS raw_digest,
  CASE WHEN fault <> 'broken_json' THEN event_type END AS event_type,
  fault = 'broken_json' AS is_broken, event_ts AS kafka_timestamp,
  CAST(n % 6 AS INTEGER) AS "partition", n AS "offset", {INGESTED} AS _corrupt_ts
FROM routed WHERE route = 'corrupt'""",
    "rejected_records": f"""{WITH}
SELECT reject_reason, event_id, event_type,
  CASE WHEN fault = 'no_user_id' THEN NULL ELSE user_id END AS user_id,
  CASE WHEN fault = 'no_session_id' THEN NULL ELSE session_id END AS session_id,
  event_ts AS kafka_timestamp, CAST(n % 6 AS INTEGER) AS "partition", n AS "offset",
  {INGESTED} AS _rejected_ts
FROM routed WHERE route = 'rejected'""",
    "routing_counts": f"""{WITH}
SELECT count(*) AS total, count_if(route = 'valid')::BIGINT AS valid,
  count_if(route = 'corrupt')::BIGINT AS corrupt, count_if(route = 'rejected')::BIGINT AS rejected
FROM routed""",
    "route_by_reason": f"""{WITH}
SELECT route, reject_reason, count(*) AS messages FROM routed GROUP BY route, reject_reason""",
    "enrich_events": BRONZE,
    "page_urls": f"""{WITH}
SELECT e.event_id, e.event_type,
  CASE WHEN e.event_type IN ('product_view', 'add_to_cart') THEN '/product/' || e.product_id
       WHEN e.event_type = 'search' THEN '/search?q=' || replace(e.search_query, ' ', '+')
       WHEN e.event_type = 'remove_from_cart' THEN '/cart'
       WHEN e.event_type = 'checkout_start' THEN '/checkout'
       WHEN e.event_type = 'checkout_complete' THEN '/order-confirmation'
       WHEN e.event_type IN ('user_login', 'user_logout') THEN '/account'
       ELSE '/' END AS built_url,
  '/category/' || replace(lower(c.category || ' ' || c.product_name), ' ', '-') AS category_url
FROM flat e LEFT JOIN catalog c ON e.product_id = c.product_id""",
    "silver_agg_1m": _cells("1 minute"),
    "silver_agg_6h": _cells("6 hours"),
    "sliding_5m": _cells("5 minutes", "1 minute", 5),
    "sliding_5m_2m": _cells("5 minutes", "2 minutes", 3, "WHERE true")
    .replace("FROM starts GROUP BY ALL",
             "FROM starts WHERE event_ts < window_start + INTERVAL '5 minutes' GROUP BY ALL"),
    "sliding_12h": _cells("12 hours", "3 hours", 4),
    "sessions": _sessions("12 hours"),
    "sessions_30m": _sessions("30 minutes"),
    "totals_by_type_date": f"""{WITH}
SELECT event_type, event_date, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
  {TOTAL_REVENUE} AS total_revenue, CAST(count_if(is_purchase) AS BIGINT) AS purchase_count
FROM valid GROUP BY event_type, event_date""",
    "grand_total": f"""{WITH}
SELECT 'all' AS grain, count(*) AS total_events,
  CAST(count_if(is_purchase) AS BIGINT) AS purchase_count, {TOTAL_REVENUE} AS total_revenue
FROM valid""",
    "event_type_share": f"""{WITH},
expected(event_type, weight) AS (VALUES ('page_view', 30), ('product_view', 25), ('search', 15),
  ('add_to_cart', 12), ('remove_from_cart', 3), ('wishlist_add', 4), ('checkout_start', 5),
  ('checkout_complete', 3), ('user_login', 2), ('user_logout', 1))
SELECT event_type, count(*) AS event_count,
  count(*) / CAST((SELECT count(*) FROM valid) AS DOUBLE) AS share,
  any_value(weight) / CAST(100 AS DOUBLE) AS expected_share
FROM valid LEFT JOIN expected USING (event_type) GROUP BY event_type""",
    "top_event_type": f"""{WITH}
SELECT event_type, count(*) AS event_count FROM valid
GROUP BY event_type ORDER BY event_count DESC, event_type LIMIT 1""",
    "sessions_per_user": f"""{WITH}
SELECT user_id, count(DISTINCT session_id) AS session_count FROM valid GROUP BY user_id""",
    "high_value_alerts": ALERTS,
    "bronze_read": BRONZE,
    "silver_read": _cells("1 minute"),
    "dedup_events": f"{WITH} SELECT event_id, event_type, user_id, event_ts, 1 AS delivery FROM flat",
    "upsert_latest": UPSERTED,
    "upsert_into_table": UPSERTED_TABLE,
    "cart_state": CART,
    "login_state": LOGIN,
    "catalog_lookup": LOOKUP,
    "catalog_lookup_large": LOOKUP,
    "json_round_trip": f"""{WITH}
SELECT event_id AS sent_id, {', '.join(WIRE_FIELDS)}, 1 + {_FIELDS_SENT} AS fields_sent FROM flat""",
    "kafka_rows": f"""{WITH}
SELECT user_id AS message_key, event_id, cart_value, event_type AS header_event_type,
  'backfill' AS header_run_id, '1.0' AS header_version, 3 AS header_count
FROM flat""",
    "dlq_rows": f"""{WITH}
SELECT user_id AS message_key,
  CASE WHEN route = 'rejected' THEN event_id END AS event_id,
  CASE WHEN coalesce(fault, '') <> 'broken_json' THEN event_type END AS event_type,
  coalesce(fault, '') = 'broken_json' AS is_broken
FROM routed WHERE route <> 'valid'""",
    "quality_report": QUALITY,
    "stream_silver_append": _cells("1 minute", where=f"WHERE window_end <= {CLOSED}"),
    "stream_silver_6h": _cells("6 hours", where=f"WHERE window_end <= {CLOSED}"),
    "stream_silver_approx": _cells("6 hours", where=f"WHERE window_end <= {CLOSED}").replace(
        "SELECT * FROM cells",
        """SELECT * EXCLUDE (unique_users, unique_sessions, unique_products_viewed),
  true AS unique_users_near, true AS unique_sessions_near, true AS unique_products_viewed_near
FROM cells""",
    ),
    "stream_event_totals": f"""{WITH}
SELECT event_type, count(*) AS event_count FROM valid GROUP BY event_type""",
    "stream_sliding": _cells("5 minutes", "1 minute", 5, f"WHERE window_end <= {CLOSED}"),
    "stream_sessions": _sessions("12 hours", f"WHERE session_end <= {CLOSED}"),
    "stream_dedup": f"""{WITH}
SELECT event_id, event_type, user_id, CASE WHEN n % 4 <> 1 THEN event_ts END AS event_ts FROM flat""",
    "stream_dedup_lag": f"""{WITH}
SELECT event_id, event_type, user_id, CASE WHEN n % 4 <> 1 THEN event_ts END AS event_ts FROM flat""",
    "stream_cart": f"""SELECT * FROM ({CART}) WHERE event_ts < {PASSED}""",
    "stream_login": f"""SELECT * FROM ({LOGIN}) WHERE event_ts < {PASSED}""",
    "quality_growing": QUALITY,
    "rollup_hours": _cells("1 hour").replace(
        "SELECT * FROM cells",
        """SELECT * EXCLUDE (unique_users, unique_sessions, unique_products_viewed),
  true AS unique_users_near, true AS unique_sessions_near, true AS unique_products_viewed_near
FROM cells""",
    ),
    "rollup_days": _cells("1 day").replace(
        "SELECT * FROM cells",
        """SELECT * EXCLUDE (unique_users, unique_sessions, unique_products_viewed),
  true AS unique_users_near, true AS unique_sessions_near, true AS unique_products_viewed_near
FROM cells""",
    ),
    "event_cube": "\nUNION ALL ".join(f"({WITH} {sql})" for sql in _CUBE),
    "top_products": _top("product_id"),
    "top_sessions": _top("session_id"),
    "bucketed_sessions": _sessions("12 hours"),
    "bucketed_sessions_per_user": f"""{WITH}
SELECT user_id, count(DISTINCT session_id) AS session_count FROM valid GROUP BY user_id""",
    "stream_checkouts": CHECKOUTS,
    "stream_state_left": STATE_LEFT,
    "stream_late": _cells("1 minute", where=f"WHERE window_end <= {CLOSED}")
    .replace(",\nstarts AS (", f",\n{PARTED},\nstarts AS (")
    .replace("FROM valid v CROSS JOIN", "FROM (SELECT * FROM parted WHERE NOT (n % 10 = 7 AND part < 9)) v CROSS JOIN"),
    "stream_job_from_bronze": JOB_FROM_BRONZE,
    "stream_progress": f"""{WITH}
SELECT 'routes' AS query, count(*) AS input_rows, count(*) AS total,
  count_if(route = 'valid')::BIGINT AS valid, count_if(route = 'corrupt')::BIGINT AS corrupt,
  count_if(route = 'rejected')::BIGINT AS rejected
FROM routed""",
    "stream_bronze": BRONZE,
    "stream_alerts": ALERTS,
    "stream_alert_writer": f"SELECT event_id, alert_text FROM ({ALERTS}) AS alerts",
    "stream_lookup": f"""{WITH}
SELECT e.event_id, e.product_id, c.product_name AS catalog_name, c.price AS catalog_price
FROM valid e LEFT JOIN catalog c ON e.product_id = c.product_id""",
    "stream_job": JOB,
}
