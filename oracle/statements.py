"""One SQL statement per query, written for DuckDB over the raw tables."""

from __future__ import annotations

from oracle.views import (
    CLIPS, NOT_NULL_TESTS, RANGE_TESTS, SET_TESTS, clipped_from, imputed_from, with_views,
)

BODIES: dict[str, str] = {}
B = BODIES

DAY = "strftime({0}, '%Y-%m-%d')"
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
LOCAL = "timezone(timezone, timezone('UTC', order_ts))"


def day(c: str) -> str:
    return DAY.format(c)


def ts(c: str) -> str:
    return TS.format(c)


def rounded(x: str, places: int) -> str:
    """Half away from zero on the decimal value of a double."""
    return f"round(CAST({x} AS DECIMAL(38,12)), {places})::DOUBLE"


def mean(c: str) -> str:
    return f"(sum({c})::DOUBLE / nullif(count({c}), 0))"


def pct(condition: str) -> str:
    return f"(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE {condition}) / nullif(count(*), 0))"


_FACT_DEC = [
    "promised_eta_min", "actual_delivery_min", "prep_time_min", "pickup_wait_min", "travel_time_min", "subtotal",
    "discount_amount", "delivery_fee", "tip_amount", "total_amount",
]
_FACT = (
    ", ".join(f"{c}::DOUBLE AS {c}" for c in _FACT_DEC)
    + ", item_count, is_late, issue_type, refund_amount::DOUBLE AS refund_amount, source"
)

# -- scans, sources, sinks
B["scan_fact"] = f"SELECT delivery_id, user_id, merchant_id, dasher_id, zone_id, {ts('order_ts')} AS order_ts, {_FACT} FROM deliveries"
_iso = "strftime(order_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
B["read_json_batch"] = f"SELECT ingest_seq, user_id, {_iso} AS order_ts, total_amount, issue_type FROM raw_batch"
B["write_json_batch"] = "SELECT ingest_seq, merchant_id, promised_eta_min, is_late, source FROM passed"
B["stream_ingest"] = f"""SELECT ingest_seq, zone_id, {_iso} AS order_ts, promised_eta_min, is_late, CAST(NULL AS VARCHAR) AS malformed
  FROM raw_batch WHERE ingest_seq % 397 NOT IN (11, 12, 13, 14)
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CASE ingest_seq % 397 WHEN 11 THEN concat('{{"ingest_seq": ', ingest_seq, ', "zone_id"')
    WHEN 12 THEN concat('{{"ingest_seq": ', ingest_seq, ', "zone_id": "north"}}') WHEN 13 THEN concat('no record ', ingest_seq) ELSE '' END
  FROM raw_batch WHERE ingest_seq % 397 IN (11, 12, 13, 14)"""
B["stream_publish"] = f"SELECT ingest_seq, user_id, {_iso} AS order_ts, tip_amount FROM raw_batch"
B["fact_append"] = """SELECT CAST((SELECT max(delivery_id) FROM deliveries) + row_number() OVER (ORDER BY ingest_seq) AS BIGINT) AS delivery_id,
  ingest_seq FROM deduped"""
B["snapshot_append_idempotent"] = f"""SELECT entity_type, entity_id, feature_name, feature_value, {ts('computed_at')} AS computed_at
  FROM feature_snapshots WHERE computed_at >= date_trunc('month', (SELECT as_of FROM latest_order))
  UNION ALL SELECT entity_type, entity_id, feature_name, {rounded('feature_value', 4)}, {ts('computed_at')} FROM features_now"""
_ALL_FEATURES = "(SELECT * FROM feature_history UNION ALL SELECT * FROM features_now)"
_ONLINE = f"""(SELECT concat('feature:', entity_type, ':', entity_id, ':', feature_name) AS online_key, entity_type, entity_id,
  feature_name, arg_max(feature_value, computed_at) AS value FROM {_ALL_FEATURES} f GROUP BY entity_type, entity_id, feature_name)"""
_MEMBERS = """(SELECT 'user' AS kind, user_id AS entity_id, home_zone_id AS zone_id, activation_date, churn_date, activity_weight FROM users
  UNION ALL SELECT 'merchant', CAST(merchant_id AS BIGINT), zone_id, activation_date, churn_date, activity_weight FROM merchants
  UNION ALL SELECT 'dasher', CAST(dasher_id AS BIGINT), home_zone_id, activation_date, churn_date, activity_weight FROM dashers)"""
B["online_upsert"] = f"SELECT online_key, value FROM {_ONLINE} o"
B["online_read"] = f"""SELECT k.online_key, o.value FROM (
  SELECT concat('feature:', kind, ':', entity_id, ':', CASE WHEN kind = 'dasher' THEN 'delivery_count_30d' ELSE 'late_rate_30d' END) AS online_key
  FROM {_MEMBERS} m) k LEFT JOIN {_ONLINE} o USING (online_key)"""
B["quarantine_sink"] = "SELECT ingest_seq, reasons AS failed_expectations, 'whole' AS batch_id FROM judged WHERE reasons <> ''"
_METRICS = f"""SELECT count(*) AS total_orders,
  {rounded('sum(CAST(promised_eta_min AS DECIMAL(18,2)))::DOUBLE / count(*)', 2)} AS avg_promised_eta_min,
  {rounded('count(*) FILTER (WHERE is_late) * CAST(100 AS DOUBLE) / count(*)', 2)} AS late_rate_pct,
  {day('min(order_ts)')} AS date_range_start, {day('max(order_ts)')} AS date_range_end FROM raw_batch"""
B["batch_metrics_sink"] = f"""WITH metrics AS ({_METRICS})
  SELECT 'metrics:latest_batch:total_orders' AS key, CAST(total_orders AS VARCHAR) AS value FROM metrics
  UNION ALL SELECT 'metrics:latest_batch:avg_promised_eta_min', CAST(avg_promised_eta_min AS VARCHAR) FROM metrics
  UNION ALL SELECT 'metrics:latest_batch:late_rate_pct', CAST(late_rate_pct AS VARCHAR) FROM metrics
  UNION ALL SELECT 'metrics:latest_batch:date_range_start', date_range_start FROM metrics
  UNION ALL SELECT 'metrics:latest_batch:date_range_end', date_range_end FROM metrics
  UNION ALL SELECT concat('metrics:zone:', zone_id, ':latest_batch_orders'), CAST(count(*) AS VARCHAR) FROM raw_batch GROUP BY zone_id"""
B["table_sample"] = f"SELECT delivery_id, {ts('order_ts')} AS order_ts, subtotal::DOUBLE AS subtotal FROM deliveries WHERE delivery_id % 100 < 10"

# -- projections, filters, predicates
B["type_coercion"] = f"SELECT ingest_seq, user_id, merchant_id, dasher_id, zone_id, promo_id, date_key, {ts('order_ts')} AS order_ts, {_FACT} FROM raw_batch"
_TRAILING = "d.order_ts >= (SELECT as_of FROM latest_order) - INTERVAL 30 DAY AND d.order_ts < (SELECT as_of FROM latest_order)"
B["trailing_window_filter"] = f"SELECT delivery_id, {ts('order_ts')} AS order_ts, dasher_id FROM deliveries d WHERE {_TRAILING}"


def _reasons(tests: list[str]) -> str:
    return (
        "SELECT * FROM (SELECT ingest_seq, concat_ws(',', " + ", ".join(tests)
        + ") AS failed_expectations FROM raw_batch) r WHERE failed_expectations <> ''"
    )


B["not_null_predicates"] = _reasons(NOT_NULL_TESTS)
B["range_predicates"] = _reasons(RANGE_TESTS)
B["set_predicates"] = _reasons(SET_TESTS)
B["active_entities_asof"] = f"""SELECT zone_id, kind, count(*) AS active, sum(activity_weight)::DOUBLE AS active_weight FROM {_MEMBERS} m
  WHERE activation_date <= (SELECT CAST(as_of AS DATE) FROM latest_order)
    AND (churn_date IS NULL OR churn_date > (SELECT CAST(as_of AS DATE) FROM latest_order)) GROUP BY zone_id, kind"""
B["entity_status"] = f"SELECT kind, entity_id, CASE WHEN churn_date IS NULL THEN 'active' ELSE 'inactive' END AS status FROM {_MEMBERS} m"

# -- joins
B["join_fact_zone"] = "SELECT city, state, count(*) AS deliveries FROM deliveries JOIN zones USING (zone_id) GROUP BY city, state"
B["join_dims_inner"] = """SELECT d.delivery_id, z.density_tier, z.timezone, m.baseline_prep_time_min::DOUBLE AS baseline_prep_time_min
  FROM deliveries d JOIN zones z ON z.zone_id = d.zone_id JOIN merchants m ON m.merchant_id = d.merchant_id"""
_SKY = """SELECT d.*, coalesce(w.condition, 'clear') AS weather_condition, coalesce(w.is_flash_flood, FALSE) AS is_flash_flood,
  coalesce(w.is_heatwave, FALSE) AS is_heatwave, coalesce(w.precipitation_mm, CAST(0 AS DOUBLE)) AS precipitation_mm,
  coalesce(w.temp_high_c, CAST(20 AS DOUBLE)) AS temp_high_c
  FROM deliveries d LEFT JOIN weather w ON w.zone_id = d.zone_id AND w.date = CAST(d.order_ts AS DATE)"""
B["join_weather_left"] = f"SELECT delivery_id, weather_condition, is_flash_flood, is_heatwave, precipitation_mm, temp_high_c FROM ({_SKY}) s"


def _lagged(kind: str, minutes: str) -> str:
    return f"""(SELECT {kind}_id, month, lag(avg_minutes) OVER w AS prior_avg, lag(n) OVER w AS prior_count, lag(late_rate) OVER w AS prior_late_rate
  FROM (SELECT {kind}_id, CAST(date_trunc('month', order_ts) AS DATE) AS month, {mean(minutes)} AS avg_minutes, count(*) AS n,
    {pct('is_late')} AS late_rate FROM deliveries GROUP BY ALL) g WINDOW w AS (PARTITION BY {kind}_id ORDER BY month))"""


_LAG = {"dasher": _lagged("dasher", "actual_delivery_min"), "merchant": _lagged("merchant", "prep_time_min"), "zone": _lagged("zone", "travel_time_min")}
_PRIOR_JOINS = " ".join(
    f"LEFT JOIN {_LAG[k]} {k[0]}p ON {k[0]}p.{k}_id = d.{k}_id AND {k[0]}p.month = CAST(date_trunc('month', d.order_ts) AS DATE)" for k in _LAG
)
_PRIOR_COLS = """dp.prior_avg AS dasher_avg_delivery_30d, dp.prior_count AS dasher_count_30d, mp.prior_avg AS merchant_avg_prep_30d,
  mp.prior_late_rate AS merchant_late_rate_30d, zp.prior_avg AS zone_avg_travel_30d, zp.prior_count AS zone_order_volume_30d"""
_PRIOR_WHERE = "dp.prior_avg IS NOT NULL AND mp.prior_avg IS NOT NULL AND zp.prior_avg IS NOT NULL"
B["join_prior_period_left"] = f"SELECT d.delivery_id, {_PRIOR_COLS} FROM deliveries d {_PRIOR_JOINS} WHERE {_PRIOR_WHERE}"
_SCORED = """(SELECT p.*, d.actual_delivery_min, p.predicted_eta_min - d.actual_delivery_min AS residual
  FROM predictions p JOIN deliveries d USING (delivery_id) WHERE d.actual_delivery_min IS NOT NULL)"""
B["join_predictions_actuals"] = f"""SELECT prediction_id, predicted_eta_min::DOUBLE AS predicted_eta_min, actual_delivery_min::DOUBLE AS actual_delivery_min,
  residual::DOUBLE AS residual, {ts('scored_at')} AS scored_at FROM {_SCORED} s"""
B["feature_asof_lookup"] = f"""SELECT p.delivery_id, p.entity_id, s.feature_value, {ts('s.computed_at')} AS computed_at
  FROM (SELECT delivery_id, CAST(merchant_id AS BIGINT) AS entity_id, order_ts AS as_of FROM deliveries) p
  ASOF LEFT JOIN (SELECT * FROM feature_snapshots WHERE entity_type = 'merchant' AND feature_name = 'late_rate_30d') s
  ON p.entity_id = s.entity_id AND p.as_of >= s.computed_at"""
_STATE_DAYS = "(SELECT z.state, CAST(d.order_ts AS DATE) AS day, count(*) AS orders FROM deliveries d JOIN zones z ON z.zone_id = d.zone_id GROUP BY ALL)"
_ACTIVE = "e.start_date <= s.day AND s.day <= e.end_date AND (e.affected_state IS NULL OR e.affected_state = s.state)"
B["events_active_join"] = f"""SELECT s.state, {day('s.day')} AS day, s.orders, e.event_type, e.demand_multiplier, e.order_value_multiplier
  FROM {_STATE_DAYS} s JOIN external_events e ON {_ACTIVE}"""
_DISCOUNT = """CASE p.promo_type WHEN 'discount_pct' THEN CAST(round(d.subtotal * p.discount_pct * 0.01, 2) AS DECIMAL(8,2))
  WHEN 'flat_discount' THEN CAST(p.flat_amount AS DECIMAL(8,2)) WHEN 'bogo' THEN CAST(round(d.subtotal * 0.5, 2) AS DECIMAL(8,2)) ELSE CAST(0 AS DECIMAL(8,2)) END"""
_PROMO = f"""(SELECT * FROM (SELECT d.*, p.promo_id, p.promo_type, coalesce({_DISCOUNT}, 0) AS discount,
    count(p.promo_id) OVER (PARTITION BY d.delivery_id) AS candidates,
    row_number() OVER (PARTITION BY d.delivery_id ORDER BY {_DISCOUNT} DESC, p.promo_id) AS place
  FROM deliveries d LEFT JOIN promotions p ON CAST(d.order_ts AS DATE) BETWEEN p.start_date AND p.end_date
    AND (p.merchant_id IS NULL OR p.merchant_id = d.merchant_id)) c WHERE place = 1)"""
B["promo_eligibility_join"] = f"SELECT delivery_id, candidates, promo_id AS best_promo_id FROM {_PROMO} b"


def _pool(where: str = "TRUE") -> str:
    return f"""(WITH members AS (SELECT * FROM {_MEMBERS} m WHERE {where}),
  span AS (SELECT CAST(min(order_ts) AS DATE) AS a, CAST(max(order_ts) AS DATE) AS b FROM deliveries),
  days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
  totals AS (SELECT zone_id, kind, sum(activity_weight)::DOUBLE AS total_weight FROM members GROUP BY ALL),
  counted AS (SELECT t.zone_id, t.kind, d.day, t.total_weight, count(m.entity_id) AS active, coalesce(sum(m.activity_weight), 0)::DOUBLE AS active_weight
    FROM totals t CROSS JOIN days d LEFT JOIN members m ON m.zone_id = t.zone_id AND m.kind = t.kind AND m.activation_date <= d.day
      AND (m.churn_date IS NULL OR m.churn_date > d.day) GROUP BY t.zone_id, t.kind, d.day, t.total_weight)
  SELECT zone_id, kind, day, active, active_weight, active_weight / total_weight AS active_share FROM counted)"""


B["active_pool_daily"] = f"SELECT zone_id, kind, {day('day')} AS day, active, active_weight, active_share FROM {_pool()} p"
_CUTOFF = "(SELECT as_of - INTERVAL 730 DAY FROM latest_order)"
B["prune_dependents_semi"] = f"""SELECT prediction_id, CASE WHEN delivery_id IN (SELECT delivery_id FROM deliveries WHERE order_ts < {_CUTOFF})
  THEN 'pruned' ELSE 'kept' END AS outcome FROM predictions"""
_CALENDAR_KEYS = """SELECT CAST(strftime(t, '%Y%m%d%H') AS BIGINT) AS date_key FROM (
  SELECT unnest(generate_series(CAST(CAST(min(order_ts) AS DATE) AS TIMESTAMP), CAST(CAST(max(order_ts) AS DATE) AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS t FROM deliveries) h"""
B["referential_audit"] = " UNION ALL ".join(
    f"SELECT '{key}' AS foreign_key, count(*) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys FROM raw_batch"
    f" WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})"
    for key, parent in [("user_id", "users"), ("merchant_id", "merchants"), ("dasher_id", "dashers"), ("zone_id", "zones"), ("date_key", f"({_CALENDAR_KEYS}) c")]
)

# -- aggregations
B["dasher_features_30d"] = f"""SELECT dasher_id, {mean('actual_delivery_min')} AS avg_delivery_time_30d, count(*) AS delivery_count_30d
  FROM deliveries d WHERE {_TRAILING} GROUP BY dasher_id"""
B["merchant_features_30d"] = f"""SELECT merchant_id, {mean('prep_time_min')} AS avg_prep_time_30d, {pct('is_late')} AS late_rate_30d
  FROM deliveries d WHERE {_TRAILING} GROUP BY merchant_id"""
B["zone_features_30d"] = f"""SELECT zone_id, {mean('travel_time_min')} AS avg_travel_time_30d, count(*) AS order_volume_30d
  FROM deliveries d WHERE {_TRAILING} GROUP BY zone_id"""
B["features_long"] = f"SELECT entity_type, entity_id, feature_name, {rounded('feature_value', 4)} AS feature_value, {ts('computed_at')} AS computed_at FROM features_now"
B["union_features"] = "SELECT entity_type, entity_id, feature_name, feature_value FROM features_now"
B["feature_entity_counts"] = "SELECT entity_type, count(DISTINCT entity_id) AS entities FROM features_now GROUP BY entity_type"
B["batch_window_metrics"] = _METRICS
B["batch_orders_by_zone"] = "SELECT zone_id, count(*) AS orders FROM raw_batch GROUP BY zone_id"
B["running_totals"] = """WITH numbered AS (SELECT zone_id, CAST(date_diff('day', (SELECT CAST(min(order_ts) AS DATE) FROM deliveries), CAST(order_ts AS DATE)) // 7 AS INT) AS batch_no FROM deliveries),
  counted AS (SELECT concat('zone:', zone_id) AS scope, batch_no, count(*) AS orders FROM numbered GROUP BY zone_id, batch_no
    UNION ALL SELECT 'all', batch_no, count(*) FROM numbered GROUP BY batch_no)
  SELECT scope, batch_no, orders, CAST(sum(orders) OVER (PARTITION BY scope ORDER BY batch_no) AS BIGINT) AS orders_total FROM counted"""
B["kpi_summary"] = f"""SELECT (SELECT count(*) FROM deliveries) AS total_deliveries,
  (SELECT count(*) FROM users WHERE churn_date IS NULL) AS active_users,
  (SELECT count(*) FROM merchants WHERE churn_date IS NULL) AS active_merchants,
  (SELECT count(*) FROM dashers WHERE churn_date IS NULL) AS active_dashers,
  (SELECT {rounded(pct('is_late'), 1)} FROM deliveries WHERE order_ts > (SELECT as_of FROM latest_order) - INTERVAL 30 DAY) AS late_rate_30d,
  (SELECT {rounded(mean('abs(residual)'), 2)} FROM {_SCORED} s) AS mae, (SELECT count(*) FROM {_SCORED} s) AS n_predictions,
  (SELECT count(*) FROM judged WHERE reasons <> '') AS n_quarantined"""
B["monthly_growth"] = f"SELECT {day(chr(39).join(['date_trunc(', 'month', ', order_ts)']))} AS month, count(*) AS deliveries FROM deliveries GROUP BY 1"
B["quarterly_growth"] = f"""WITH q AS (SELECT CAST(date_trunc('quarter', order_ts) AS DATE) AS quarter, count(*) AS deliveries FROM deliveries GROUP BY 1)
  SELECT {day('quarter')} AS quarter, deliveries, deliveries::DOUBLE / (SELECT deliveries FROM q ORDER BY quarter LIMIT 1)::DOUBLE AS ratio_to_first FROM q"""
B["churn_summary"] = f"SELECT kind, count(*) AS entities, {pct('churn_date IS NOT NULL')} AS churn_pct FROM {_MEMBERS} m GROUP BY kind"
B["issue_late_rates"] = f"""SELECT {pct('is_late')} AS late_pct, {pct('issue_type IS NOT NULL')} AS issue_pct, {pct("issue_type = 'misplaced'")} AS misplaced_pct,
  {pct("issue_type = 'not_delivered'")} AS not_delivered_pct, {pct("issue_type = 'wrong_order'")} AS wrong_order_pct FROM deliveries"""
B["data_overview"] = f"""SELECT {day('min(order_ts)')} AS min_date, {day('max(order_ts)')} AS max_date,
  CAST(date_diff('day', CAST(min(order_ts) AS DATE), CAST(max(order_ts) AS DATE)) AS INT) AS days_span, (SELECT count(*) FROM users) AS n_users,
  (SELECT count(*) FROM merchants) AS n_merchants, (SELECT count(*) FROM dashers) AS n_dashers, (SELECT count(*) FROM zones) AS n_zones,
  (SELECT count(DISTINCT state) FROM zones) AS n_states, (SELECT count(*) FROM promotions) AS n_promotions, (SELECT count(*) FROM weather) AS n_weather,
  (SELECT count(*) FROM external_events) AS n_events FROM deliveries"""
B["contract_pass_rate"] = """WITH c AS (SELECT count(*) FILTER (WHERE reasons = '') AS loaded, count(*) FILTER (WHERE reasons <> '') AS quarantined FROM judged),
  r AS (SELECT *, CASE WHEN loaded + quarantined = 0 THEN CAST(100 AS DOUBLE) ELSE loaded * CAST(100 AS DOUBLE) / (loaded + quarantined) END AS pass_rate FROM c)
  SELECT *, CASE WHEN pass_rate >= 99 THEN 'good' WHEN pass_rate >= 95 THEN 'warning' ELSE 'critical' END AS status FROM r"""
B["quarantine_breakdown"] = "SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM judged WHERE reasons <> '') r GROUP BY reason"
_DAILY = f"""(SELECT CAST(scored_at AS DATE) AS day, {mean('residual')} AS mean_residual, {mean('abs(residual)')} AS mae, count(*) AS n FROM {_SCORED} s GROUP BY 1)"""
B["accuracy_over_time"] = f"SELECT {day('day')} AS day, mean_residual, mae, n FROM {_DAILY} d"
B["error_by_segment"] = " UNION ALL ".join(
    f"SELECT json_extract_string(features_snapshot, '$.{k}') AS segment, {mean('abs(residual)')} AS mae, count(*) AS n, '{k}' AS segment_key FROM {_SCORED} s GROUP BY 1"
    for k in ("weather_condition", "density_tier")
)
B["scoring_coverage"] = """WITH c AS (SELECT (SELECT count(*) FROM deliveries WHERE source = 'realtime') AS n_realtime, (SELECT count(*) FROM predictions) AS n_scored)
  SELECT *, CASE WHEN n_realtime = 0 THEN CAST(0 AS DOUBLE) ELSE n_scored * CAST(100 AS DOUBLE) / n_realtime END AS coverage_pct FROM c"""
B["bias_label"] = f"""SELECT {day('day')} AS day, mae, abs(mean_residual) AS bias, CASE WHEN mean_residual > 0 THEN 'over-predicting' ELSE 'under-predicting' END AS direction
  FROM {_DAILY} d WHERE day = (SELECT max(CAST(scored_at AS DATE)) FROM {_SCORED} s)"""


def _bins(table: str, column: str, n: int) -> str:
    return f"""SELECT '{column}' AS "column", bin, lo + width * bin AS bin_start, count(*) AS rows FROM (
  SELECT lo, width, CAST(CASE WHEN width = 0 THEN 0 ELSE least(floor((v - lo) / width), {n - 1}) END AS INT) AS bin FROM (
  SELECT v, lo, (hi - lo) / {n} AS width FROM (SELECT {column}::DOUBLE AS v, min({column}::DOUBLE) OVER () AS lo, max({column}::DOUBLE) OVER () AS hi
    FROM {table} t WHERE {column} IS NOT NULL) a) b) c GROUP BY lo, width, bin"""


B["histogram_bins"] = " UNION ALL ".join(
    [_bins("deliveries", "subtotal", 40), _bins("deliveries", "actual_delivery_min", 40), _bins("deliveries", "item_count", 7), _bins(_SCORED, "residual", 30)]
)
_MULT = f"""(SELECT s.state, s.day, s.orders, count(e.event_type) AS active_events,
  coalesce(round(CAST(product(e.demand_multiplier) AS DECIMAL(38,12)), 8)::DOUBLE, CAST(1 AS DOUBLE)) AS event_demand,
  coalesce(round(CAST(product(e.order_value_multiplier) AS DECIMAL(38,12)), 8)::DOUBLE, CAST(1 AS DOUBLE)) AS event_value
  FROM {{days}} s LEFT JOIN external_events e ON {_ACTIVE} GROUP BY s.state, s.day, s.orders)"""
B["event_multipliers"] = f"SELECT state, {day('day')} AS day, orders, active_events, event_demand, event_value FROM {_MULT.format(days=_STATE_DAYS)} m"
B["monthly_entity_stats"] = " UNION ALL ".join(
    f"SELECT '{k}' AS entity_type, CAST({k}_id AS BIGINT) AS entity_id, strftime(date_trunc('month', order_ts), '%Y-%m-%d') AS month, {mean(c)} AS avg_minutes,"
    f" count(*) AS order_count, {pct('is_late')} AS late_rate_pct FROM deliveries GROUP BY {k}_id, 3"
    for k, c in (("dasher", "actual_delivery_min"), ("merchant", "prep_time_min"), ("zone", "travel_time_min"))
)
B["median_impute"] = f"SELECT ingest_seq, actual_delivery_min, pickup_wait_min, travel_time_min FROM ({imputed_from('raw_batch')}) i"
_IMPUTED = ["actual_delivery_min", "pickup_wait_min", "travel_time_min"]
B["cleaning_stats"] = f"""SELECT (SELECT count(*) FROM passed) - (SELECT count(*) FROM deduped) AS duplicates_removed,
  (SELECT CAST({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in _IMPUTED)} AS BIGINT) FROM deduped) AS nulls_imputed,
  (SELECT CAST({' + '.join(f'count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})' for c, lo, hi in CLIPS)} AS BIGINT) FROM imputed) AS values_clipped"""
B["trailing_user_stats"] = """SELECT u.user_id, count(d.delivery_id) AS trailing_orders, coalesce(sum(d.total_amount), 0)::DOUBLE AS trailing_gmv FROM users u
  LEFT JOIN deliveries d ON d.user_id = u.user_id AND d.order_ts < (SELECT date_trunc('day', as_of) FROM latest_order)
    AND d.order_ts >= (SELECT date_trunc('day', as_of) - INTERVAL 180 DAY FROM latest_order) GROUP BY u.user_id"""
B["ml_error_metrics"] = f"""SELECT n, sae / n AS mae, sqrt(sse / n) AS rmse, CAST(1 AS DOUBLE) - sse / (syy - sy * sy / n) AS r2 FROM (
  SELECT count(*) AS n, sum(abs(residual))::DOUBLE AS sae, sum(residual * residual)::DOUBLE AS sse, sum(actual_delivery_min)::DOUBLE AS sy,
    sum(actual_delivery_min * actual_delivery_min)::DOUBLE AS syy FROM {_SCORED} s) t"""

# -- windows, top-k, set operations
for _k, _cols in (("dasher", "prior_avg, prior_count"), ("merchant", "prior_avg, prior_late_rate"), ("zone", "prior_avg, prior_count")):
    B[f"prior_month_{_k}"] = f"SELECT {_k}_id, {day('month')} AS month, {_cols} FROM {_LAG[_k]} l"
_HISTORY = """(SELECT delivery_id, user_id, order_ts, coalesce(far_n, 0) + coalesce(near_n, 0) AS prior_orders,
    CAST(coalesce(far_gmv, 0) + coalesce(near_gmv, 0) AS DECIMAL(18,2)) AS prior_gmv
  FROM (SELECT delivery_id, user_id, order_ts, count(*) OVER far AS far_n, sum(total_amount) OVER far AS far_gmv, count(*) OVER near AS near_n, sum(total_amount) OVER near AS near_gmv
    FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(order_ts AS DATE)) AS day_no FROM deliveries) d
    WINDOW far AS (PARTITION BY user_id ORDER BY day_no RANGE BETWEEN 180 PRECEDING AND 1 PRECEDING),
      near AS (PARTITION BY user_id, day_no ORDER BY order_ts, delivery_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) h)"""
B["rolling_user_history_180d"] = f"SELECT delivery_id, CAST(prior_orders AS BIGINT) AS prior_orders, prior_gmv::DOUBLE AS prior_gmv FROM {_HISTORY} h"
B["dedup_first"] = f"""SELECT ingest_seq, user_id, merchant_id, dasher_id, {ts('order_ts')} AS order_ts, total_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, merchant_id, dasher_id, order_ts ORDER BY ingest_seq) AS copy FROM raw_batch) c WHERE copy = 1"""
B["time_based_split"] = """SELECT delivery_id, CASE WHEN row_number() OVER (ORDER BY order_ts, delivery_id) <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM deliveries"""
B["top_zones_demand"] = """SELECT city, state, count(*) AS deliveries, concat(city, ', ', state) AS label FROM deliveries JOIN zones USING (zone_id)
  WHERE order_ts > (SELECT as_of FROM latest_order) - INTERVAL 30 DAY GROUP BY city, state ORDER BY deliveries DESC, city, state LIMIT 15"""
B["recent_predictions"] = f"""SELECT prediction_id, predicted_eta_min::DOUBLE AS predicted_eta_min, actual_delivery_min::DOUBLE AS actual_delivery_min, {ts('s.scored_at')} AS scored_at
  FROM (SELECT * FROM {_SCORED} x ORDER BY scored_at DESC, prediction_id LIMIT 2000) s"""
B["scoring_sample"] = """SELECT delivery_id FROM deliveries WHERE source = 'realtime' ORDER BY (delivery_id * 48271 + 42 * 16807) % 2147483647, delivery_id LIMIT 300"""
B["gate_split"] = "SELECT ingest_seq, CASE WHEN reasons = '' THEN 'passing' ELSE 'quarantined' END AS outcome FROM judged"

# -- scalar functions
_LOCAL_ROWS = f"(SELECT d.*, z.timezone, z.density_tier, {LOCAL} AS local_ts FROM deliveries d JOIN zones z ON z.zone_id = d.zone_id)"
B["local_time_features"] = f"""SELECT delivery_id, CAST(hour(local_ts) AS INT) AS hour, CAST(isodow(local_ts) - 1 AS INT) AS day_of_week,
  isodow(local_ts) >= 6 AS is_weekend FROM {_LOCAL_ROWS} l"""
_DAYPART = """CASE WHEN {h} >= 6 AND {h} < 11 THEN 'breakfast' WHEN {h} >= 11 AND {h} < 15 THEN 'lunch' WHEN {h} >= 15 AND {h} < 21 THEN 'dinner' ELSE 'late_night' END"""
B["daypart"] = f"SELECT delivery_id, {_DAYPART.format(h='hour(local_ts)')} AS daypart FROM {_LOCAL_ROWS} l"
_HOLIDAY = "strftime({t}, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25', '12-31')"
B["is_holiday"] = f"SELECT delivery_id, {_HOLIDAY.format(t='local_ts')} AS is_holiday FROM {_LOCAL_ROWS} l"
_EXACT_WEIGHTS = "[0.2, 0.1, 0.1, 0.1, 0.1, 0.2, 0.4, 0.6, 0.8, 0.6, 0.5, 0.9, 1.6, 1.4, 0.8, 0.6, 0.7, 1.0, 1.7, 2.0, 1.6, 1.1, 0.8, 0.5]"
_WEIGHTS = f"{_EXACT_WEIGHTS}::DOUBLE[]"
_DAY_FACTORS = f"""CASE WHEN isodow({{d}}) >= 6 THEN CAST(1.35 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
  * CASE WHEN {_HOLIDAY.format(t="{d}")} THEN CAST(1.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"""


def _hour_weight(d: str, h: str) -> str:
    return f"({_WEIGHTS})[{h} + 1] * {_DAY_FACTORS.format(d=d)}"


B["hourly_demand_weight"] = f"SELECT delivery_id, {_hour_weight('local_ts', 'hour(local_ts)')} AS hour_weight FROM {_LOCAL_ROWS} l"
B["density_multiplier"] = f"SELECT delivery_id, CAST(CASE density_tier WHEN 'high' THEN 1.8 WHEN 'medium' THEN 1.0 ELSE 0.5 END AS DOUBLE) AS density_weight FROM {_LOCAL_ROWS} l"
B["weather_condition"] = """SELECT d.delivery_id, w.condition, w.is_flash_flood FROM deliveries d JOIN weather w ON w.zone_id = d.zone_id AND w.date = CAST(d.order_ts AS DATE)"""
B["heatwave_flag"] = """SELECT d.delivery_id, month(w.date) BETWEEN 6 AND 9 AND w.temp_high_c >
    (CAST(28 AS DOUBLE) - z.latitude * CAST(0.55 AS DOUBLE)) + (CAST(8 AS DOUBLE) + z.latitude * CAST(0.35 AS DOUBLE)) * CAST(1.15 AS DOUBLE) AS is_heatwave
  FROM deliveries d JOIN weather w ON w.zone_id = d.zone_id AND w.date = CAST(d.order_ts AS DATE) JOIN zones z ON z.zone_id = d.zone_id"""


def _weather_rule(clear, rain, storm, snow, flood, heat) -> str:
    return f"""CAST(CASE weather_condition WHEN 'rain' THEN {rain} WHEN 'storm' THEN {storm} WHEN 'snow' THEN {snow} ELSE {clear} END AS DOUBLE)
  * CAST(CASE WHEN is_flash_flood THEN {flood} ELSE 1.0 END AS DOUBLE) * CAST(CASE WHEN is_heatwave THEN {heat} ELSE 1.0 END AS DOUBLE)"""


_DEMAND = _weather_rule(1.0, 1.15, 1.25, 1.20, 1.15, 1.12)
B["weather_multipliers"] = f"""SELECT delivery_id, {_DEMAND} AS demand, {_weather_rule(1.0, 1.2, 1.5, 1.6, 1.4, 1.05)} AS issue_rate,
  {_weather_rule(1.0, 1.15, 1.35, 1.5, 1.25, 1.08)} AS travel_mean, {_weather_rule(1.0, 1.3, 1.6, 1.8, 1.4, 1.1)} AS travel_sd FROM ({_SKY}) s"""
B["promo_discount"] = f"SELECT delivery_id, promo_id AS best_promo_id, discount::DOUBLE AS discount, coalesce(promo_type = 'free_delivery', FALSE) AS waives_fee FROM {_PROMO} b"
B["order_economics"] = f"""SELECT delivery_id, (prep_time_min + travel_time_min + 8)::DOUBLE AS promised_eta_min, actual_delivery_min > prep_time_min + travel_time_min + 8 AS is_late,
  (subtotal - discount + CASE WHEN promo_type = 'free_delivery' THEN 0 ELSE delivery_fee END + tip_amount)::DOUBLE AS total_amount FROM {_PROMO} b"""
_LOYALTY = f"""(SELECT h.delivery_id, (least(CAST(1 AS DOUBLE), date_diff('day', u.activation_date, CAST(h.order_ts AS DATE)) / CAST(365 AS DOUBLE))
  + least(CAST(1 AS DOUBLE), h.prior_orders / CAST(20 AS DOUBLE)) + least(CAST(1 AS DOUBLE), h.prior_gmv::DOUBLE / CAST(500 AS DOUBLE))) / CAST(3 AS DOUBLE) AS loyalty
  FROM {_HISTORY} h JOIN users u ON u.user_id = h.user_id)"""
B["loyalty_score"] = f"SELECT delivery_id, loyalty FROM {_LOYALTY} l"
B["refund_amount"] = f"""SELECT delivery_id, CASE WHEN issue_type IS NULL THEN CAST(0 AS DOUBLE) ELSE {rounded('least(total, greatest(CAST(5 AS DOUBLE), total * least(CAST(1 AS DOUBLE), base + loyalty * CAST(0.1 AS DOUBLE))))', 2)} END AS refund
  FROM (SELECT d.delivery_id, d.issue_type, d.total_amount::DOUBLE AS total, l.loyalty,
    CAST(CASE d.issue_type WHEN 'misplaced' THEN 0.9 WHEN 'not_delivered' THEN 1.0 ELSE 0.5 END AS DOUBLE) AS base FROM deliveries d JOIN {_LOYALTY} l USING (delivery_id)) r"""
_CLIPPED_COLS = "prep_time_min, travel_time_min, pickup_wait_min, tip_amount, subtotal, total_amount, CAST(item_count AS INT) AS item_count, refund_amount"
B["clip_outliers"] = f"SELECT ingest_seq, {_CLIPPED_COLS} FROM ({clipped_from('raw_batch')}) c"
B["date_key"] = f"SELECT delivery_id, CAST(strftime(local_ts, '%Y%m%d%H') AS BIGINT) AS date_key FROM {_LOCAL_ROWS} l"
B["calendar_dim"] = f"""WITH rows AS (SELECT * FROM {_LOCAL_ROWS} l), span AS (SELECT date_trunc('day', min(local_ts)) AS a, date_trunc('day', max(local_ts)) + INTERVAL 23 HOUR AS b FROM rows),
  hours AS (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS t FROM span), counted AS (SELECT date_trunc('hour', local_ts) AS t, count(*) AS orders FROM rows GROUP BY 1)
  SELECT CAST(strftime(h.t, '%Y%m%d%H') AS BIGINT) AS date_key, {day('h.t')} AS full_date, CAST(isodow(h.t) - 1 AS INT) AS day_of_week, isodow(h.t) >= 6 AS is_weekend,
    {_HOLIDAY.format(t='h.t')} AS is_holiday, CAST(month(h.t) AS INT) AS month, CAST(year(h.t) AS INT) AS year, CAST(hour(h.t) AS INT) AS hour, {_DAYPART.format(h='hour(h.t)')} AS daypart,
    coalesce(c.orders, 0) AS orders FROM hours h LEFT JOIN counted c ON c.t = h.t"""
B["online_key"] = "SELECT concat('feature:', entity_type, ':', entity_id, ':', feature_name) AS online_key FROM features_now"
B["null_defaults"] = f"""SELECT delivery_id, weather_condition, CASE WHEN is_flash_flood THEN 'True' ELSE 'False' END AS is_flash_flood,
  CASE WHEN is_heatwave THEN 'True' ELSE 'False' END AS is_heatwave, precipitation_mm, temp_high_c FROM ({_SKY}) s"""


def _latest(kind: str, name: str, alias: str) -> str:
    return f"(SELECT o.value FROM online o WHERE o.entity_type = '{kind}' AND o.feature_name = '{name}' AND o.entity_id = s.{kind}_id) AS {alias}"


_TIME_COLS = f"""CAST(hour({LOCAL}) AS INT) AS hour, CAST(isodow({LOCAL}) - 1 AS INT) AS day_of_week"""
_FLAG_COLS = f"""CASE WHEN isodow({LOCAL}) >= 6 THEN 'True' ELSE 'False' END AS is_weekend,
  CASE WHEN is_flash_flood THEN 'True' ELSE 'False' END AS is_flash_flood, CASE WHEN is_heatwave THEN 'True' ELSE 'False' END AS is_heatwave"""
_SERVING = f"""WITH online AS (SELECT * FROM {_ONLINE} x)
  SELECT s.delivery_id, s.actual_delivery_min::DOUBLE AS actual_delivery_min, {_TIME_COLS}, s.item_count, s.subtotal::DOUBLE AS subtotal,
  m.baseline_prep_time_min::DOUBLE AS baseline_prep_time_min, s.precipitation_mm, s.temp_high_c,
  {_latest('dasher', 'avg_delivery_time_30d', 'dasher_avg_delivery_30d')}, {_latest('dasher', 'delivery_count_30d', 'dasher_count_30d')},
  {_latest('merchant', 'avg_prep_time_30d', 'merchant_avg_prep_30d')}, {_latest('merchant', 'late_rate_30d', 'merchant_late_rate_30d')},
  {_latest('zone', 'avg_travel_time_30d', 'zone_avg_travel_30d')}, {_latest('zone', 'order_volume_30d', 'zone_order_volume_30d')},
  z.density_tier, s.weather_condition, {_FLAG_COLS}
  FROM ({_SKY}) s JOIN zones z ON z.zone_id = s.zone_id JOIN merchants m ON m.merchant_id = s.merchant_id"""
B["serving_features"] = _SERVING
B["features_snapshot_json"] = f"SELECT delivery_id, 18 AS fields, hour, density_tier, is_weekend, merchant_late_rate_30d FROM ({_SERVING}) v"

# -- streaming
B["stream_tick_metrics"] = _METRICS
B["stream_running_totals"] = "SELECT concat('zone:', zone_id) AS scope, count(*) AS orders_total FROM raw_batch GROUP BY zone_id UNION ALL SELECT 'all', count(*) FROM raw_batch"
_WEEK = "date_trunc('week', {0})"
B["weekly_tick_window"] = f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS week_start, strftime(w + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS week_end, count(*) AS orders,
  count(*) FILTER (WHERE is_late) AS late FROM (SELECT CAST({_WEEK.format('order_ts')} AS TIMESTAMP) AS w, is_late FROM deliveries) d GROUP BY w"""
B["stream_weekly_ticks"] = f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS week_start, strftime(w + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS week_end, event_type, count(*) AS events
  FROM (SELECT CAST({_WEEK.format('ts')} AS TIMESTAMP) AS w, event_type FROM events) e GROUP BY w, event_type"""
B["stream_closed_weeks"] = f"""WITH span AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high, max(ts) AS last FROM events),
  placed AS (SELECT e.*, (epoch_us(ts) - low)::DOUBLE / (high - low)::DOUBLE AS place FROM events e, span)
  SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS week_start, strftime(w + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS week_end, event_type, count(*) AS events
  FROM (SELECT CAST({_WEEK.format('ts')} AS TIMESTAMP) AS w, event_type FROM placed WHERE NOT (event_id % 13 = 0 AND place < 0.2)) e, span
  WHERE w + INTERVAL 7 DAY <= last - INTERVAL 7 DAY GROUP BY w, event_type"""
B["resume_point"] = f"""WITH r AS (SELECT CAST(max(order_ts) AS DATE) + 1 AS resume_date FROM deliveries WHERE source = 'historical')
  SELECT strftime(CAST(resume_date AS DATE), '%Y-%m-%d') AS resume_date, (SELECT count(*) FROM deliveries WHERE CAST(order_ts AS DATE) >= resume_date) AS new_rows FROM r"""
B["stream_gate_and_clean"] = """SELECT ingest_seq, '' AS reasons, prep_time_min, pickup_wait_min, total_amount FROM cleaned
  UNION ALL SELECT ingest_seq, reasons, prep_time_min, pickup_wait_min, total_amount FROM judged WHERE reasons <> ''"""

# -- model
_TRAIN = f"""SELECT d.delivery_id, d.order_ts, d.actual_delivery_min::DOUBLE AS actual_delivery_min, d.item_count, d.subtotal::DOUBLE AS subtotal, z.density_tier, z.timezone,
  m.baseline_prep_time_min::DOUBLE AS baseline_prep_time_min, w.condition AS weather_condition, w.is_flash_flood, w.is_heatwave, w.precipitation_mm, w.temp_high_c, {_PRIOR_COLS}
  FROM deliveries d JOIN zones z ON z.zone_id = d.zone_id JOIN merchants m ON m.merchant_id = d.merchant_id
  LEFT JOIN weather w ON w.zone_id = d.zone_id AND w.date = CAST(d.order_ts AS DATE) {_PRIOR_JOINS} WHERE {_PRIOR_WHERE}"""
B["training_set"] = f"SELECT * REPLACE ({ts('order_ts')} AS order_ts) FROM ({_TRAIN}) t"
B["feature_engineering"] = f"""SELECT delivery_id, actual_delivery_min, {_TIME_COLS}, item_count, subtotal, baseline_prep_time_min, precipitation_mm, temp_high_c,
  dasher_avg_delivery_30d, dasher_count_30d, merchant_avg_prep_30d, merchant_late_rate_30d, zone_avg_travel_30d, zone_order_volume_30d,
  density_tier, coalesce(weather_condition, 'clear') AS weather_condition, {_FLAG_COLS} FROM ({_TRAIN}) t"""

# -- maintenance and composite jobs
B["contract_gate"] = "SELECT ingest_seq, reasons AS failed_expectations FROM judged"
B["preprocess"] = f"""SELECT ingest_seq, user_id, merchant_id, dasher_id, zone_id, promo_id, date_key, {ts('order_ts')} AS order_ts, {_FACT.replace('item_count', 'CAST(item_count AS INT) AS item_count')} FROM cleaned"""
B["prune_retention"] = f"""SELECT 'deliveries' AS table_name, count(*) FILTER (WHERE order_ts >= {_CUTOFF}) AS kept, count(*) FILTER (WHERE order_ts < {_CUTOFF}) AS pruned FROM deliveries
  UNION ALL SELECT 'predictions', count(*) FILTER (WHERE d.order_ts >= {_CUTOFF}), count(*) FILTER (WHERE d.order_ts < {_CUTOFF}) FROM predictions p JOIN deliveries d USING (delivery_id)
  UNION ALL SELECT 'feature_snapshots', count(*) FILTER (WHERE computed_at >= {_CUTOFF}), count(*) FILTER (WHERE computed_at < {_CUTOFF}) FROM feature_snapshots"""
B["pipeline_tick"] = """WITH landed AS (SELECT j.* FROM judged j JOIN deliveries d ON d.delivery_id = j.ingest_seq % 1000000000 WHERE d.source = 'realtime'),
  good AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, merchant_id, dasher_id, order_ts ORDER BY ingest_seq) AS copy FROM landed WHERE reasons = '') c WHERE copy = 1),
  fact AS (SELECT dasher_id, merchant_id, zone_id, order_ts FROM deliveries WHERE source = 'historical' UNION ALL SELECT dasher_id, merchant_id, zone_id, order_ts FROM good),
  newest AS (SELECT max(order_ts) AS t FROM fact),
  slice AS (SELECT * FROM fact WHERE order_ts >= (SELECT t FROM newest) - INTERVAL 30 DAY AND order_ts < (SELECT t FROM newest))
  SELECT 'seen' AS stage, count(*) AS rows FROM landed UNION ALL SELECT 'quarantined', count(*) FROM landed WHERE reasons <> '' UNION ALL SELECT 'appended', count(*) FROM good
  UNION ALL SELECT 'features', 2 * (count(DISTINCT dasher_id) + count(DISTINCT merchant_id) + count(DISTINCT zone_id)) FROM slice
  UNION ALL SELECT 'scored', least(300, count(*)) FROM good
  UNION ALL SELECT 'pruned', count(*) FROM fact WHERE order_ts < (SELECT t FROM newest) - INTERVAL 730 DAY
  UNION ALL SELECT 'kept', count(*) FROM fact WHERE order_ts >= (SELECT t FROM newest) - INTERVAL 730 DAY"""
_DEMAND_DAYS = "(SELECT DISTINCT z.state, p.day, 0 AS orders FROM pool p JOIN zones z ON z.zone_id = p.zone_id)"
_USER_POOL = _pool("kind = 'user'")
_DEMAND_BASE = f"""WITH pool AS (SELECT * FROM {_USER_POOL} x), mult AS (SELECT * FROM {_MULT.format(days=_DEMAND_DAYS)} y),
  base AS (SELECT p.zone_id, p.day, p.active_weight, coalesce({_DEMAND}, CAST(1 AS DOUBLE)) AS weather_demand, e.event_demand
    FROM pool p JOIN zones z ON z.zone_id = p.zone_id LEFT JOIN (SELECT zone_id, date, condition AS weather_condition, is_flash_flood, is_heatwave FROM weather) w ON w.zone_id = p.zone_id AND w.date = p.day
    JOIN mult e ON e.state = z.state AND e.day = p.day)"""
B["expected_demand"] = f"""{_DEMAND_BASE},
  daily AS (SELECT zone_id, day, CAST(0.0129 AS DOUBLE) * active_weight * (CAST(list_sum({_EXACT_WEIGHTS}) AS DOUBLE) * {_DAY_FACTORS.format(d='day')})
    * weather_demand * event_demand AS expected_orders FROM base),
  actual AS (SELECT zone_id, CAST(local_ts AS DATE) AS day, count(*) AS n FROM {_LOCAL_ROWS} l GROUP BY 1, 2)
  SELECT d.zone_id, {day('d.day')} AS day, d.expected_orders, coalesce(a.n, 0) AS actual_orders FROM daily d LEFT JOIN actual a ON a.zone_id = d.zone_id AND a.day = d.day"""
B["expected_demand_hourly"] = f"""{_DEMAND_BASE}
  SELECT zone_id, {day('day')} AS day, CAST(h.range AS INTEGER) AS hour, CAST(0.0129 AS DOUBLE) * active_weight * ({_hour_weight('day', 'h.range')})
    * weather_demand * event_demand AS expected_orders FROM base, range(24) h"""
B["training_run_parameters"] = f"""SELECT CAST(r.maxIter AS DOUBLE) AS iterations, p.name, CAST(CASE p.name WHEN 'maxIter' THEN r.maxIter WHEN 'maxDepth' THEN 6 WHEN 'stepSize' THEN 0.1
    WHEN 'seed' THEN 42 WHEN 'training_rows' THEN n * 8 // 10 WHEN 'test_rows' THEN n - n * 8 // 10 WHEN 'sample_pct' THEN 100 END AS DOUBLE) AS value
  FROM (SELECT count(*) AS n FROM ({B["training_set"]}) t) c, (VALUES (100), (200)) r(maxIter),
    (VALUES ('maxIter'), ('maxDepth'), ('stepSize'), ('seed'), ('training_rows'), ('test_rows'), ('sample_pct')) p(name)"""


def statement(name: str) -> str:
    """The body with the views it uses; a body that has tables of its own
    continues the list of views."""
    body = BODIES[name].strip()
    return with_views(body)


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in BODIES}
