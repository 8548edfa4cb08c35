"""The views of FIXTURES.md as DuckDB text, written as common table expressions."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["zones"] = """
SELECT n.n_nationkey AS zone_id, n.n_name AS city, concat('S', CAST(n.n_nationkey % 9 AS VARCHAR)) AS state,
  r.r_name AS region,
  CASE n.n_nationkey % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'America/Denver'
    WHEN 3 THEN 'America/Los_Angeles' ELSE 'America/Phoenix' END AS timezone,
  CASE n.n_nationkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS density_tier,
  CAST(26 + n.n_nationkey % 22 AS DOUBLE) AS latitude
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
"""

VIEWS["users"] = """
SELECT user_id, signup_date, activation_date, home_zone_id, is_subscriber, activity_weight,
  CASE WHEN user_id % 3 <> 0 AND churn_c <= DATE '2001-08-01' THEN churn_c END AS churn_date
FROM (SELECT *, CAST(activation_date + CAST(30 + user_id * 53 % 1500 AS INT) AS DATE) AS churn_c FROM (
 SELECT *, CAST(signup_date + CAST(1 + user_id % 5 AS INT) AS DATE) AS activation_date FROM (
 SELECT c_custkey AS user_id, CAST(DATE '1995-01-01' + CAST(c_custkey * 37 % 1200 AS INT) AS DATE) AS signup_date,
   c_nationkey AS home_zone_id, c_custkey % 20 < 7 AS is_subscriber,
   CAST(CAST(500 + c_custkey * 17 % 2000 AS DECIMAL(10,0)) * 0.001 AS DECIMAL(6,3)) AS activity_weight
 FROM customer) a) b) c
"""

VIEWS["merchants"] = """
SELECT id AS merchant_id, zone_id, CAST(CAST(1500 + id * 131 % 2000 AS DECIMAL(10,0)) * 0.01 AS DECIMAL(5,2)) AS baseline_prep_time_min,
  CAST(DATE '1995-01-01' + CAST(id * 7 % 400 AS INT) AS DATE) AS activation_date,
  CASE WHEN id % 5 = 0 THEN CAST(DATE '1998-01-01' + CAST(id * 11 % 900 AS INT) AS DATE) END AS churn_date,
  CASE (zone_id + j) % 4 WHEN 0 THEN 'pizza' WHEN 1 THEN 'thai' WHEN 2 THEN 'cafe' ELSE 'indian' END AS cuisine_type,
  CAST(CAST(500 + id * 97 % 1500 AS DECIMAL(10,0)) * 0.001 AS DECIMAL(6,3)) AS activity_weight
FROM (SELECT n_nationkey AS zone_id, j, n_nationkey * 4 + j AS id FROM nation CROSS JOIN (VALUES (0),(1),(2),(3)) AS t(j)) m
"""

VIEWS["dashers"] = """
SELECT id AS dasher_id, zone_id AS home_zone_id,
  CAST(DATE '1995-01-01' + CAST(id * 7 % 400 AS INT) AS DATE) AS activation_date,
  CASE WHEN id % 5 = 0 THEN CAST(DATE '1998-01-01' + CAST(id * 11 % 900 AS INT) AS DATE) END AS churn_date,
  CAST(CAST(500 + id % 20 * 100 AS DECIMAL(10,0)) * 0.001 AS DECIMAL(6,3)) AS activity_weight,
  CASE id % 3 WHEN 0 THEN 'bike' WHEN 1 THEN 'scooter' ELSE 'car' END AS vehicle_type
FROM (SELECT n_nationkey AS zone_id, n_nationkey * 2 + j AS id FROM nation CROSS JOIN (VALUES (0),(1)) AS t(j)) m
"""

VIEWS["promotions"] = """
SELECT i AS promo_id, CASE i % 4 WHEN 0 THEN 'discount_pct' WHEN 1 THEN 'flat_discount' WHEN 2 THEN 'free_delivery' ELSE 'bogo' END AS promo_type,
  CASE WHEN i % 4 = 0 THEN CAST(10 + i % 31 AS DECIMAL(5,2)) END AS discount_pct,
  CASE WHEN i % 4 = 1 THEN CAST(3 + i % 8 AS DECIMAL(6,2)) END AS flat_amount,
  CASE WHEN i % 5 >= 2 THEN i * 7 % 100 END AS merchant_id,
  CAST(DATE '1995-01-01' + CAST(i * 13 % 2300 AS INT) AS DATE) AS start_date,
  CAST(DATE '1995-01-01' + CAST(i * 13 % 2300 + 7 + i % 21 AS INT) AS DATE) AS end_date
FROM (SELECT CAST(range AS INT) AS i FROM range(0, 300)) s
"""

VIEWS["external_events"] = """
SELECT concat('event_', CAST(i AS VARCHAR)) AS event_type,
  CAST(DATE '1995-01-01' + CAST(i * 120 AS INT) AS DATE) AS start_date,
  CAST(DATE '1995-01-01' + CAST(i * 120 + 3 + i * 37 % 288 AS INT) AS DATE) AS end_date,
  CASE WHEN i % 3 <> 0 THEN concat('S', CAST(i % 9 AS VARCHAR)) END AS affected_state,
  CAST(92 + i * 29 % 49 AS DOUBLE) / CAST(100 AS DOUBLE) AS demand_multiplier,
  CAST(90 + i * 13 % 26 AS DOUBLE) / CAST(100 AS DOUBLE) AS order_value_multiplier
FROM (SELECT CAST(range AS INT) AS i FROM range(0, 19)) s
"""

VIEWS["weather"] = """
SELECT zone_id, date, precipitation_mm, temp_high_c, temp_high_c - 8 AS temp_low_c,
  CASE WHEN temp_high_c - 8 < 0 AND precipitation_mm > 0 THEN 'snow' WHEN precipitation_mm > 25 THEN 'storm'
    WHEN precipitation_mm > 0 THEN 'rain' ELSE 'clear' END AS condition,
  precipitation_mm > 45 AS is_flash_flood, temp_high_c > 36 AS is_heatwave
FROM (SELECT n_nationkey AS zone_id, CAST(DATE '1995-01-01' + i AS DATE) AS date,
    CASE WHEN (i * 31 + n_nationkey * 17) % 4 = 0 THEN CAST((i * 137 + n_nationkey * 71) % 5000 AS DOUBLE) / CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS precipitation_mm,
    CAST((i * 53 + n_nationkey * 29) % 4500 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(5 AS DOUBLE) AS temp_high_c
  FROM nation CROSS JOIN (SELECT CAST(range AS INT) AS i FROM range(0, 2410)) d
  WHERE (i + n_nationkey) % 50 <> 0) w
"""

VIEWS["deliveries"] = """
SELECT delivery_id, user_id, merchant_id, dasher_id, zone_id, order_ts,
  CAST(CAST(prep_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(5,2)) AS prep_time_min,
  CAST(CAST(travel_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(5,2)) AS travel_time_min,
  CAST(CAST(wait_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(5,2)) AS pickup_wait_min,
  CAST(CAST(prep_c + travel_c + 800 AS DECIMAL(10,0)) * 0.01 AS DECIMAL(5,2)) AS promised_eta_min,
  CAST(CAST(actual_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(5,2)) AS actual_delivery_min,
  actual_c > prep_c + travel_c + 800 AS is_late, item_count,
  CAST(CAST(subtotal_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(8,2)) AS subtotal, CAST(0 AS DECIMAL(8,2)) AS discount_amount,
  CAST(CAST(fee_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(6,2)) AS delivery_fee,
  CAST(CAST(tip_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(6,2)) AS tip_amount,
  CAST(CAST(subtotal_c + fee_c + tip_c AS DECIMAL(10,0)) * 0.01 AS DECIMAL(8,2)) AS total_amount,
  issue_type, CAST(0 AS DECIMAL(8,2)) AS refund_amount, source
FROM (
 SELECT *, CAST(FLOOR(subtotal_c * 15 / CAST(100 AS DOUBLE)) AS BIGINT) AS tip_c,
  CASE WHEN delivery_id % 211 = 0 THEN NULL ELSE prep_c + COALESCE(wait_c, 400) + travel_c + delivery_id * 4421 % 500 - 250 END AS actual_c FROM (
 SELECT o.o_orderkey AS delivery_id, o.o_custkey AS user_id, c.c_nationkey AS zone_id,
  CAST(c.c_nationkey * 4 + o.o_orderkey % 4 AS INT) AS merchant_id,
  CAST(c.c_nationkey * 2 + (o.o_orderkey * 7 + o.o_custkey) % 2 AS INT) AS dasher_id,
  o.o_orderdate + to_seconds(o.o_orderkey * 7919 % 86400) AS order_ts,
  500 + o.o_orderkey * 7919 % 3000 AS prep_c, 200 + (o.o_orderkey * 6271 + o.o_custkey * 31) % 2400 AS travel_c,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderkey * 3571 % 1000 END AS wait_c,
  CAST(1 + o.o_orderkey % 7 AS INT) AS item_count, CAST(FLOOR(o.o_totalprice / CAST(15 AS DOUBLE)) AS BIGINT) AS subtotal_c,
  199 + o.o_orderkey % 400 AS fee_c,
  CASE o.o_orderkey % 100 WHEN 3 THEN 'misplaced' WHEN 5 THEN 'not_delivered' WHEN 7 THEN 'wrong_order' WHEN 9 THEN 'wrong_order' END AS issue_type,
  CASE WHEN o.o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' THEN 'realtime' ELSE 'historical' END AS source
 FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey) p) q
"""

_RAW_REST = """promised_eta_min::DOUBLE AS promised_eta_min, actual_delivery_min::DOUBLE AS actual_delivery_min,
  {prep} AS prep_time_min, pickup_wait_min::DOUBLE AS pickup_wait_min, travel_time_min::DOUBLE AS travel_time_min,
  subtotal::DOUBLE AS subtotal, discount_amount::DOUBLE AS discount_amount, delivery_fee::DOUBLE AS delivery_fee,
  {tip} AS tip_amount, total_amount::DOUBLE AS total_amount, {items} AS item_count, is_late, {issue} AS issue_type,
  refund_amount::DOUBLE AS refund_amount, {source} AS source"""
_LOCAL = "timezone(timezone, timezone('UTC', order_ts))"
_DATE_KEY = f"CAST(strftime({_LOCAL}, '%Y%m%d%H') AS BIGINT) AS date_key"

VIEWS["raw_batch"] = f"""
SELECT delivery_id AS ingest_seq, CASE WHEN delivery_id % 401 <> 1 THEN user_id END AS user_id, merchant_id, dasher_id, zone_id,
  CAST(NULL AS INT) AS promo_id, {_DATE_KEY}, order_ts, {_RAW_REST.format(
    prep="CASE WHEN delivery_id % 401 = 2 THEN CAST(999 AS DOUBLE) WHEN delivery_id % 401 = 7 THEN CAST(150 AS DOUBLE) ELSE prep_time_min::DOUBLE END",
    tip="CASE WHEN delivery_id % 401 = 5 THEN CAST(-1 AS DOUBLE) ELSE tip_amount::DOUBLE END",
    items="CASE WHEN delivery_id % 401 = 4 THEN 0 ELSE item_count END",
    issue="CASE WHEN delivery_id % 401 = 3 THEN 'lost' ELSE issue_type END",
    source="CASE WHEN delivery_id % 401 = 6 THEN 'unknown' ELSE source END")}
FROM deliveries JOIN zones USING (zone_id)
UNION ALL
SELECT delivery_id + 1000000000, user_id, merchant_id, dasher_id, zone_id, CAST(NULL AS INT), {_DATE_KEY}, order_ts, {_RAW_REST.format(
    prep="prep_time_min::DOUBLE", tip="tip_amount::DOUBLE", items="item_count", issue="issue_type", source="source")}
FROM deliveries JOIN zones USING (zone_id) WHERE delivery_id % 401 = 8
"""

VIEWS["predictions"] = """
SELECT d.delivery_id AS prediction_id, d.delivery_id, 'eta_regressor' AS model_name, 'eta-v1' AS model_version,
  CAST(d.prep_time_min + d.travel_time_min + 6 AS DECIMAL(5,2)) AS predicted_eta_min,
  concat('{"density_tier":"', z.density_tier, '","weather_condition":"', COALESCE(w.condition, 'clear'), '"}') AS features_snapshot,
  d.order_ts + to_seconds(86400) AS scored_at
FROM deliveries d JOIN zones z ON z.zone_id = d.zone_id
LEFT JOIN weather w ON w.zone_id = d.zone_id AND w.date = CAST(d.order_ts AS DATE) WHERE d.delivery_id % 5 = 0
"""

# Feature values of every entity at given instants, long form, unrounded.
_LONG = """
SELECT a.as_of AS computed_at, 'dasher' AS entity_type, CAST(dasher_id AS BIGINT) AS entity_id,
  unnest(['avg_delivery_time_30d', 'delivery_count_30d']) AS feature_name,
  unnest([sum(actual_delivery_min)::DOUBLE / count(actual_delivery_min), count(*)::DOUBLE]) AS feature_value
FROM {as_of} a JOIN deliveries d ON d.order_ts >= a.as_of - INTERVAL 30 DAY AND d.order_ts < a.as_of GROUP BY a.as_of, dasher_id
UNION ALL
SELECT a.as_of, 'merchant', CAST(merchant_id AS BIGINT), unnest(['avg_prep_time_30d', 'late_rate_30d']),
  unnest([sum(prep_time_min)::DOUBLE / count(prep_time_min), CAST(100 AS DOUBLE) * count(*) FILTER (WHERE is_late) / count(*)])
FROM {as_of} a JOIN deliveries d ON d.order_ts >= a.as_of - INTERVAL 30 DAY AND d.order_ts < a.as_of GROUP BY a.as_of, merchant_id
UNION ALL
SELECT a.as_of, 'zone', CAST(zone_id AS BIGINT), unnest(['avg_travel_time_30d', 'order_volume_30d']),
  unnest([sum(travel_time_min)::DOUBLE / count(travel_time_min), count(*)::DOUBLE])
FROM {as_of} a JOIN deliveries d ON d.order_ts >= a.as_of - INTERVAL 30 DAY AND d.order_ts < a.as_of GROUP BY a.as_of, zone_id
"""
VIEWS["latest_order"] = "SELECT max(order_ts) AS as_of FROM deliveries"
VIEWS["month_starts"] = """
SELECT CAST(date_trunc('month', (SELECT max(order_ts) FROM deliveries)) - to_months(CAST(range AS INT)) AS TIMESTAMP) AS as_of
FROM range(0, (SELECT date_diff('month', min(order_ts), max(order_ts)) + 1 FROM deliveries))
"""
VIEWS["features_now"] = "SELECT * FROM (" + _LONG.format(as_of="latest_order") + ") f WHERE feature_value IS NOT NULL"
VIEWS["feature_history"] = "SELECT * FROM (" + _LONG.format(as_of="month_starts") + ") f WHERE feature_value IS NOT NULL"
VIEWS["feature_snapshots"] = """
SELECT entity_type, entity_id, feature_name, round(CAST(feature_value AS DECIMAL(38,12)), 4)::DOUBLE AS feature_value, computed_at FROM feature_history
"""

_NOT_NULL = [
    "user_id", "merchant_id", "dasher_id", "zone_id", "date_key", "order_ts", "promised_eta_min", "prep_time_min",
    "subtotal", "total_amount", "item_count", "source",
]
_RANGES = [
    ("prep_time_min", 0, 180), ("travel_time_min", 0, 180), ("pickup_wait_min", 0, 60), ("promised_eta_min", 0, 300),
    ("actual_delivery_min", 0, 300), ("subtotal", 0, 1000), ("total_amount", 0, 1000), ("delivery_fee", 0, 20),
    ("tip_amount", 0, 500), ("item_count", 1, 50), ("refund_amount", 0, 1000),
]
NOT_NULL_TESTS = [f"CASE WHEN {c} IS NULL THEN 'not_null:{c}' END" for c in _NOT_NULL]
RANGE_TESTS = [f"CASE WHEN {c} NOT BETWEEN {lo} AND {hi} THEN 'range:{c}' END" for c, lo, hi in _RANGES]
SET_TESTS = [
    "CASE WHEN issue_type NOT IN ('misplaced', 'not_delivered', 'wrong_order') THEN 'set:issue_type' END",
    "CASE WHEN source NOT IN ('historical', 'realtime') THEN 'set:source' END",
]
VIEWS["judged"] = (
    "SELECT *, concat_ws(',', " + ", ".join(NOT_NULL_TESTS + RANGE_TESTS + SET_TESTS) + ") AS reasons FROM raw_batch"
)
VIEWS["passed"] = "SELECT * FROM judged WHERE reasons = ''"
VIEWS["deduped"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, merchant_id, dasher_id, order_ts ORDER BY ingest_seq) AS copy
  FROM passed) c WHERE copy = 1
"""


def _median(column: str, table: str) -> str:
    return f"(SELECT round(median(CAST(round({column} * 100) AS BIGINT))) / 100 FROM {table})"


def imputed_from(table: str) -> str:
    return f"""SELECT * REPLACE (
  coalesce(actual_delivery_min, {_median('actual_delivery_min', table)}) AS actual_delivery_min,
  coalesce(pickup_wait_min, {_median('pickup_wait_min', table)}) AS pickup_wait_min,
  coalesce(travel_time_min, {_median('travel_time_min', table)}) AS travel_time_min) FROM {table}"""


CLIPS = [
    ("prep_time_min", 3, 90), ("travel_time_min", 1, 120), ("pickup_wait_min", 0, 30), ("tip_amount", 0, 100),
    ("subtotal", 0, 300), ("total_amount", 0, 300), ("item_count", 1, 20), ("refund_amount", 0, 300),
]


def clipped_from(table: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END AS {c}" for c, lo, hi in CLIPS
    )
    return f"SELECT * REPLACE ({parts}) FROM {table}"


VIEWS["imputed"] = imputed_from("deduped")
VIEWS["cleaned"] = clipped_from("imputed")


def uses(text: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", text)]


def with_views(body: str) -> str:
    """Put the views a statement needs in front of it."""
    needed: set[str] = set()
    todo = uses(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in uses(VIEWS[name]) if n != name]
    parts = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    body = body.strip()
    if not parts:
        return body
    return f"WITH {parts}, {body[5:]}" if body.startswith("WITH ") else f"WITH {parts} {body}"
