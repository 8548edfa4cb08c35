"""Every operator as a named query over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle import session
from ladle.functions import conditions, localtime, money
from ladle.functions.exact import latest, scalar
from ladle.operators import (
    batches, cleaning, contract, features, history, intervals, joins, numbering, retention, sampling, store,
)
from ladle.plans import demand, monitoring, serving, tick, training
from ladle.schema import RAW_RECORD
from ladle.sources import tables
from ladle.sources.feature_tables import OnlineStore, SnapshotTable
from ladle.sources.marketplace import Marketplace
from ladle.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The fitted model and its metrics by session and folder: four queries are about the same training run.
_RUNS: dict[tuple[str, str], tuple] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that any two engines print alike: decimals as doubles, dates and
    timestamps as text, lists as joined text."""

    def plain(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind.startswith("decimal"):
            return c.cast("double").alias(name)
        if kind == "date" or kind.startswith("timestamp"):
            return c.cast("string").alias(name)
        if kind == "array<string>":
            return F.concat_ws(",", c).alias(name)
        return c

    return df.select(*[plain(n, k) for n, k in df.dtypes])


def query(build: Callable[[Marketplace], DataFrame]):
    """Register a function of the marketplace views under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Marketplace(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def _members(m: Marketplace) -> DataFrame:
    return intervals.entities(m.users(), m.merchants(), m.dashers())


def _span(m: Marketplace) -> tuple[Column, Column]:
    """First and last day with orders."""
    return intervals.day_span(m.deliveries(), F.to_date("order_ts"))


def _local(m: Marketplace, *more: str) -> DataFrame:
    """Deliveries with their zone-local time."""
    zones = m.zones().select("zone_id", "timezone", *more)
    joined = m.deliveries().join(zones, "zone_id")
    return joined.withColumn("local_ts", localtime.local_time(F.col("order_ts"), F.col("timezone")))


def _sky(m: Marketplace) -> DataFrame:
    return joins.with_weather(m.deliveries(), m.weather(), defaults=True)


def _scored(m: Marketplace) -> DataFrame:
    return joins.predictions_with_actuals(m.predictions(), m.deliveries())


def _written(m: Marketplace, batch: DataFrame) -> DataFrame:
    """Rows as a table. Jobs that read a batch more than once land it first,
    so that it is derived once and a lost task re-reads files."""
    path = session.scratch(m.spark, "landed")
    batch.write.parquet(path)
    return m.spark.read.schema(batch.schema).parquet(path)


def _landed(m: Marketplace) -> DataFrame:
    """The raw batch. A filter over checks that is planned on the views themselves would be pushed below them, and every
    check would compute the columns it looks at anew."""
    return _written(m, m.raw_batch())


def _unique(m: Marketplace) -> DataFrame:
    """The passing rows without copies: medians are taken from them and rows
    are filled and numbered, so they are landed too."""
    return _written(m, cleaning.dedup_first(_passing(m)))


def _passing(m: Marketplace) -> DataFrame:
    return contract.gate_split(_landed(m))[0]


def _prior(m: Marketplace) -> DataFrame:
    """Every entity-month with the stats of its entity's month before: one scan of the fact, written as it is looked up in
    three times."""
    return _written(m, history.prior_months(m.deliveries()))


def _newest_month(m: Marketplace) -> Column:
    return scalar(m.deliveries(), F.trunc(F.max("order_ts"), "MM").cast("timestamp_ntz"))


def _history(m: Marketplace) -> DataFrame:
    return features.features_monthly(m.deliveries(), _newest_month(m))


def _features_now(m: Marketplace) -> DataFrame:
    deliveries = m.deliveries()
    return features.features_long(deliveries).withColumn("computed_at", latest(deliveries))


def _online(m: Marketplace) -> OnlineStore:
    """The stored online values after the monthly runs, loaded at once, and a tick at the newest order."""
    online = OnlineStore(m.spark, session.scratch(m.spark, "online"))
    online.upsert(_written(m, store.newest_rows(_history(m))))
    online.upsert(_written(m, _features_now(m)))
    return online


# -- scans, sources, sinks ------------------------------------------------------


@query
def scan_fact(m):
    return m.deliveries()


@query
def read_json_batch(m):
    path = session.scratch(m.spark, "json")
    tables.write_json_batch(tables.to_json_native(m.raw_batch()), path)
    records = tables.read_json_batch(m.spark, path)
    return records.select("ingest_seq", "user_id", "order_ts", "total_amount", "issue_type")


@query
def write_json_batch(m):
    path = session.scratch(m.spark, "json")
    tables.write_json_batch(tables.to_json_native(_passing(m)), path)
    records = tables.read_json_batch(m.spark, path)
    return records.select("ingest_seq", "merchant_id", "promised_eta_min", "is_late", "source")


def _raw_stream(m: Marketplace) -> DataFrame:
    return m.raw_from(m.deliveries_from(m.stream("orders")))


def _topic(m: Marketplace) -> str:
    """A topic of JSON messages, as files: the raw batch, of which some are cut off, some hold a word for a number, some are
    no JSON, and some are empty."""
    messages = tables.as_messages(tables.to_json_native(_raw_stream(m)))
    number = F.get_json_object("value", "$.ingest_seq").cast("long")
    fault, text = number % 397, number.cast("string")
    sent = (
        F.when(fault == 11, F.concat(F.lit('{"ingest_seq": '), text, F.lit(', "zone_id"')))
        .when(fault == 12, F.concat(F.lit('{"ingest_seq": '), text, F.lit(', "zone_id": "north"}')))
        .when(fault == 13, F.concat(F.lit("no record "), text))
        .when(fault == 14, F.lit(""))
        .otherwise(F.col("value"))
    )
    topic = session.scratch(m.spark, "topic")
    jobs.publish_stream(messages.select(sent.alias("value")), "text", {"path": topic}, session.scratch(m.spark, "position"))
    return topic


@query
def stream_ingest(m):
    """Messages read from a topic: records, and what is none of them with the text that came."""
    messages = tables.message_stream(m.spark, "text", {"path": _topic(m), "maxFilesPerTrigger": "4"})
    records, malformed = jobs.ingest_messages(messages, session.scratch(m.spark, "ingest"), session.scratch(m.spark, "position"))
    fields = ["ingest_seq", "zone_id", "order_ts", "promised_eta_min", "is_late"]
    nothing = [F.lit(None).cast(records.schema[c].dataType).alias(c) for c in fields]
    return records.select(*fields, F.lit(None).cast("string").alias("malformed")).unionByName(
        malformed.select(*nothing, F.col("message").alias("malformed"))
    )


@query
def stream_publish(m):
    topic, checkpoint = session.scratch(m.spark, "topic"), session.scratch(m.spark, "position")
    jobs.publish_stream(tables.as_messages(tables.to_json_native(_raw_stream(m))), "text", {"path": topic}, checkpoint)
    messages = m.spark.read.text(topic)
    return tables.parse_messages(messages, RAW_RECORD).select("ingest_seq", "user_id", "order_ts", "tip_amount")


@query
def fact_append(m):
    start = scalar(m.deliveries(), F.max("delivery_id"))
    rows = cleaning.fill_and_clip(_unique(m))
    return numbering.dense_number(rows, "ingest_seq", "delivery_id", start).select("delivery_id", "ingest_seq")


@query
def snapshot_append_idempotent(m):
    """The last two monthly runs and the present one, appended twice to a table that already holds all months but the
    newest: what the first time adds."""
    newest = _newest_month(m)
    table = SnapshotTable(m.spark, session.scratch(m.spark, "snapshots"))
    runs = store.snapshot_rows(_history(m))
    table.append(runs.filter(F.col("computed_at") < newest))
    recent = features.trailing_window(m.deliveries(), newest, days=62 + features.WINDOW_DAYS)
    last_two = features.features_monthly(recent.unionByName(m.deliveries().filter(F.col("order_ts") >= newest)), newest)
    last_two = last_two.filter(F.col("computed_at") >= F.add_months(newest, -1))
    again = _written(m, store.snapshot_rows(last_two.unionByName(_features_now(m))))
    added = _written(m, table.missing(again).drop("run"))
    table.append(added)
    table.append(again)
    stored = table.rows().filter(F.col("run") >= scalar(added, F.min(SnapshotTable.run())))
    return stored.drop("run")


@query
def online_upsert(m):
    return _online(m).latest().select("online_key", "value")


@query
def online_read(m):
    keys = (
        _members(m)
        .select(F.col("kind").alias("entity_type"), "entity_id")
        .withColumn(
            "feature_name",
            F.when(F.col("entity_type") == "dasher", "delivery_count_30d").otherwise("late_rate_30d"),
        )
    )
    return _online(m).lookup(keys).select("online_key", "value")


@query
def quarantine_sink(m):
    _, failing = contract.gate_split(_landed(m))
    path = session.scratch(m.spark, "quarantine")
    tables.append_batch(contract.quarantine_rows(failing, "whole").drop("batch_id"), path, "whole")
    stored = m.spark.read.parquet(path)
    return stored.select(
        F.get_json_object("raw_record", "$.ingest_seq").cast("long").alias("ingest_seq"),
        contract.REASONS,
        "batch_id",
    )


@query
def batch_metrics_sink(m):
    raw = m.raw_batch()
    return batches.metric_rows(batches.batch_window_metrics(raw), batches.batch_orders_by_zone(raw))


@query
def table_sample(m):
    return sampling.table_sample(m.deliveries(), training.SAMPLE_PCT).select("delivery_id", "order_ts", "subtotal")


# -- projections, filters, predicates ---------------------------------------------


@query
def type_coercion(m):
    return cleaning.type_coercion(tables.to_json_native(m.raw_batch()))


@query
def trailing_window_filter(m):
    return features.trailing_window(m.deliveries()).select("delivery_id", "order_ts", "dasher_id")


def _failing(m, checks):
    failing = _landed(m).filter(contract.fails_any(checks))
    return contract.contract_gate(failing, checks).select("ingest_seq", contract.REASONS)


@query
def not_null_predicates(m):
    return _failing(m, contract.not_null_checks())


@query
def range_predicates(m):
    return _failing(m, contract.range_checks())


@query
def set_predicates(m):
    return _failing(m, contract.set_checks())


@query
def active_entities_asof(m):
    today = scalar(m.deliveries(), F.to_date(F.max("order_ts")))
    return intervals.active_entities_asof(_members(m), today)


@query
def entity_status(m):
    return intervals.entity_status(_members(m))


# -- joins --------------------------------------------------------------------------


@query
def join_fact_zone(m):
    return joins.orders_by_place(m.deliveries(), m.zones())


@query
def join_dims_inner(m):
    rows = joins.with_dimensions(m.deliveries(), m.zones(), m.merchants())
    return rows.select("delivery_id", "density_tier", "timezone", "baseline_prep_time_min")


@query
def join_weather_left(m):
    return _sky(m).select(
        "delivery_id", "weather_condition", "is_flash_flood", "is_heatwave", "precipitation_mm", "temp_high_c"
    )


@query
def join_prior_period_left(m):
    deliveries = m.deliveries()
    rows = deliveries.select("delivery_id", "order_ts", "dasher_id", "merchant_id", "zone_id")
    return joins.with_prior_period(rows, _prior(m)).select(
        "delivery_id", *[c for names in joins.PRIOR_COLUMNS.values() for c in names.values()]
    )


@query
def join_predictions_actuals(m):
    return _scored(m).select("prediction_id", "predicted_eta_min", "actual_delivery_min", "residual", "scored_at")


@query
def feature_asof_lookup(m):
    """The merchant's late rate as it was known when each order came in."""
    probes = m.deliveries().select(
        "delivery_id",
        F.lit("merchant").alias("entity_type"),
        F.col("merchant_id").cast("long").alias("entity_id"),
        F.lit("late_rate_30d").alias("feature_name"),
        F.col("order_ts").alias("as_of"),
    )
    found = store.feature_asof_lookup(probes, store.snapshot_rows(_history(m)))
    return found.select("delivery_id", "entity_id", "feature_value", "computed_at")


def _state_days(m: Marketplace) -> DataFrame:
    """Orders per (state, day); counted per zone before states are looked up."""
    per_zone = m.deliveries().groupBy("zone_id", F.to_date("order_ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_zone.join(m.zones().select("zone_id", "state"), "zone_id")
        .groupBy("state", "day")
        .agg(F.sum("n").alias("orders"))
    )


@query
def events_active_join(m):
    return intervals.events_active(_state_days(m), m.external_events(), m.zones(), _span(m)).select(
        "state", "day", "orders", "event_type", "demand_multiplier", "order_value_multiplier"
    )


@query
def promo_eligibility_join(m):
    orders = m.deliveries().select("delivery_id", "merchant_id", "order_ts", "subtotal")
    return intervals.promo_eligibility(orders, m.promotions()).select("delivery_id", "candidates", "best_promo_id")


@query
def active_pool_daily(m):
    return intervals.active_pool_daily(_members(m), *_span(m))


@query
def prune_dependents_semi(m):
    deliveries, predictions = m.deliveries(), m.predictions()
    gone = retention.expired(deliveries, retention.retention_cutoff(deliveries)).select("delivery_id")
    pruned = predictions.join(gone, "delivery_id", "left_semi").select("prediction_id", F.lit("pruned").alias("outcome"))
    kept = predictions.join(gone, "delivery_id", "left_anti").select("prediction_id", F.lit("kept").alias("outcome"))
    return pruned.unionByName(kept)


@query
def referential_audit(m):
    """Foreign keys of the raw batch; weather by zone and day is no key."""
    raw = m.raw_batch()
    days = m.deliveries().agg(F.to_date(F.min("order_ts")).alias("first_day"), F.to_date(F.max("order_ts")).alias("last_day"))
    return joins.referential_audit(
        raw,
        {
            "user_id": m.users(),
            "merchant_id": m.merchants(),
            "dasher_id": m.dashers(),
            "zone_id": m.zones(),
            "date_key": demand.calendar(days),
        },
    )


# -- aggregations --------------------------------------------------------------------


@query
def dasher_features_30d(m):
    return features.entity_features(m.deliveries(), "dasher")


@query
def merchant_features_30d(m):
    return features.entity_features(m.deliveries(), "merchant")


@query
def zone_features_30d(m):
    return features.entity_features(m.deliveries(), "zone")


@query
def features_long(m):
    return store.snapshot_rows(features.features_long(m.deliveries()), latest(m.deliveries()))


@query
def union_features(m):
    return features.features_long(m.deliveries())


@query
def feature_entity_counts(m):
    return features.feature_entity_counts(features.features_long(m.deliveries()))


@query
def batch_window_metrics(m):
    return batches.batch_window_metrics(m.raw_batch())


@query
def batch_orders_by_zone(m):
    return batches.batch_orders_by_zone(m.raw_batch())


@query
def running_totals(m):
    deliveries = m.deliveries()
    return batches.running_totals(deliveries.withColumn("batch_no", batches.tick_number(deliveries)))


@query
def kpi_summary(m):
    _, failing = contract.gate_split(_landed(m))
    return monitoring.kpi_summary(m.deliveries(), m.users(), m.merchants(), m.dashers(), m.predictions(), failing)


@query
def monthly_growth(m):
    return monitoring.monthly_growth(m.deliveries())


@query
def quarterly_growth(m):
    return monitoring.quarterly_growth(m.deliveries())


@query
def churn_summary(m):
    return monitoring.churn_summary(_members(m))


@query
def issue_late_rates(m):
    return monitoring.issue_late_rates(m.deliveries())


@query
def data_overview(m):
    return monitoring.data_overview(
        m.deliveries(), m.users(), m.merchants(), m.dashers(), m.zones(), m.promotions(), m.weather(), m.external_events()
    )


@query
def contract_pass_rate(m):
    bad = contract.fails_any()
    counts = m.raw_batch().agg(F.count_if(~bad).alias("l"), F.count_if(bad).alias("q"))
    return counts.select(*monitoring.contract_pass_rate(F.col("l"), F.col("q")))


@query
def quarantine_breakdown(m):
    return monitoring.quarantine_breakdown(contract.gate_split(_landed(m))[1])


@query
def accuracy_over_time(m):
    return monitoring.accuracy_over_time(_scored(m))


@query
def error_by_segment(m):
    return monitoring.error_by_segments(_scored(m), ["weather_condition", "density_tier"])


@query
def scoring_coverage(m):
    return monitoring.scoring_coverage(m.predictions(), m.deliveries())


@query
def bias_label(m):
    return monitoring.bias_label(_scored(m))


@query
def histogram_bins(m):
    residuals = sampling.histogram(_scored(m), {"residual": 30})
    shapes = sampling.histogram(m.deliveries(), {"subtotal": 40, "actual_delivery_min": 40, "item_count": None})
    return shapes.unionByName(residuals)


@query
def event_multipliers(m):
    return intervals.event_multipliers(_state_days(m), m.external_events(), m.zones(), _span(m))


@query
def monthly_entity_stats(m):
    return history.all_monthly_stats(m.deliveries())


@query
def median_impute(m):
    return cleaning.median_impute(_landed(m)).select("ingest_seq", *cleaning.IMPUTED)


@query
def cleaning_stats(m):
    return cleaning.cleaning_stats(_passing(m))


@query
def trailing_user_stats(m):
    return history.trailing_user_stats(m.deliveries(), m.users())


@query
def ml_error_metrics(m):
    return training.error_metrics(_scored(m), F.col("predicted_eta_min"), F.col("actual_delivery_min"))


# -- windows, top-k, set operations -----------------------------------------------------


def _prior_of(m, kind: str, *columns: str) -> DataFrame:
    return history.prior_month(m.deliveries(), kind).select(f"{kind}_id", "month", *columns)


@query
def prior_month_dasher(m):
    return _prior_of(m, "dasher", "prior_avg", "prior_count")


@query
def prior_month_merchant(m):
    return _prior_of(m, "merchant", "prior_avg", "prior_late_rate")


@query
def prior_month_zone(m):
    return _prior_of(m, "zone", "prior_avg", "prior_count")


@query
def rolling_user_history_180d(m):
    return history.rolling_user_history(m.deliveries()).select("delivery_id", "prior_orders", "prior_gmv")


@query
def dedup_first(m):
    return cleaning.dedup_first(m.raw_batch()).select("ingest_seq", *cleaning.DEDUP_KEY, "total_amount")


@query
def time_based_split(m):
    return numbering.time_based_split(m.deliveries()).select("delivery_id", "split")


@query
def top_zones_demand(m):
    return monitoring.top_zones_demand(m.deliveries(), m.zones())


@query
def recent_predictions(m):
    return monitoring.recent_predictions(m.predictions(), m.deliveries())


@query
def scoring_sample(m):
    new = m.deliveries().filter(F.col("source") == "realtime")
    return sampling.scoring_sample(new).select("delivery_id")


@query
def gate_split(m):
    """Which side of the split each row is on, in one pass."""
    side = F.when(contract.fails_any(), "quarantined").otherwise("passing")
    return m.raw_batch().select("ingest_seq", side.alias("outcome"))


# -- scalar functions -----------------------------------------------------------------


@query
def local_time_features(m):
    local = F.col("local_ts")
    return _local(m).select(
        "delivery_id",
        F.hour(local).alias("hour"),
        F.weekday(local).alias("day_of_week"),
        localtime.is_weekend(local).alias("is_weekend"),
    )


@query
def daypart(m):
    return _local(m).select("delivery_id", localtime.daypart(F.hour("local_ts")).alias("daypart"))


@query
def is_holiday(m):
    return _local(m).select("delivery_id", localtime.is_holiday(F.to_date("local_ts")).alias("is_holiday"))


@query
def hourly_demand_weight(m):
    weight = localtime.hour_weight(F.to_date("local_ts"), F.hour("local_ts"))
    return _local(m).select("delivery_id", weight.alias("hour_weight"))


@query
def density_multiplier(m):
    rows = m.deliveries().join(m.zones().select("zone_id", "density_tier"), "zone_id")
    return rows.select("delivery_id", conditions.density_weight(F.col("density_tier")).alias("density_weight"))


def _recorded_sky(m: Marketplace) -> DataFrame:
    """Deliveries with a recorded weather row and their zone's latitude."""
    sky = m.weather().select("zone_id", F.col("date").alias("day"), "precipitation_mm", "temp_high_c", "temp_low_c")
    rows = m.deliveries().withColumn("day", F.to_date("order_ts")).join(sky, ["zone_id", "day"])
    return rows.join(m.zones().select("zone_id", "latitude"), "zone_id")


@query
def weather_condition(m):
    rain = F.col("precipitation_mm")
    return _recorded_sky(m).select(
        "delivery_id",
        conditions.condition(rain, F.col("temp_low_c")).alias("condition"),
        conditions.flash_flood(rain).alias("is_flash_flood"),
    )


@query
def heatwave_flag(m):
    flag = conditions.heatwave(F.col("day"), F.col("latitude"), F.col("temp_high_c"))
    return _recorded_sky(m).select("delivery_id", flag.alias("is_heatwave"))


@query
def weather_multipliers(m):
    of = lambda rule: conditions.multiplier(rule, F.col("weather_condition"), F.col("is_flash_flood"), F.col("is_heatwave"))
    return _sky(m).select(
        "delivery_id",
        of(conditions.DEMAND).alias("demand"),
        of(conditions.ISSUE_RATE).alias("issue_rate"),
        of(conditions.TRAVEL_MEAN).alias("travel_mean"),
        of(conditions.TRAVEL_SD).alias("travel_sd"),
    )


def _with_promo(m: Marketplace) -> DataFrame:
    """Orders with the promotion that is best for them."""
    orders = m.deliveries().select(
        "delivery_id", "merchant_id", "order_ts", "subtotal", "delivery_fee", "tip_amount",
        "prep_time_min", "travel_time_min", "actual_delivery_min",
    )
    best = intervals.promo_eligibility(orders, m.promotions())
    kinds = m.promotions().select(
        F.col("promo_id").alias("best_promo_id"), "promo_type", "discount_pct", "flat_amount"
    )
    return best.join(kinds, "best_promo_id", "left")


def _discounted(m: Marketplace) -> DataFrame:
    kind = F.col("promo_type")
    off = money.discount(kind, F.col("discount_pct"), F.col("flat_amount"), F.col("subtotal"))
    return _with_promo(m).withColumns({"discount": off, "waives_fee": money.waives_fee(kind)})


@query
def promo_discount(m):
    return _discounted(m).select("delivery_id", "best_promo_id", "discount", "waives_fee")


@query
def order_economics(m):
    promised = money.promised_eta(F.col("prep_time_min"), F.col("travel_time_min"))
    fee = F.when(F.col("waives_fee"), F.lit(Decimal("0.00"))).otherwise(F.col("delivery_fee"))
    total = money.order_total(F.col("subtotal"), F.col("discount"), fee, F.col("tip_amount"))
    return _discounted(m).select(
        "delivery_id",
        promised.alias("promised_eta_min"),
        (F.col("actual_delivery_min") > promised).alias("is_late"),
        total.alias("total_amount"),
    )


def _loyal(m: Marketplace, *keep: str) -> DataFrame:
    past = history.rolling_user_history(m.deliveries(), keep=keep)
    since = m.users().select("user_id", "activation_date")
    tenure = F.datediff(F.to_date("order_ts"), F.col("activation_date"))
    score = money.loyalty(tenure, F.col("prior_orders"), F.col("prior_gmv"))
    return past.join(since, "user_id").select("delivery_id", *keep, score.alias("loyalty"))


@query
def loyalty_score(m):
    return _loyal(m)


@query
def refund_amount(m):
    rows = _loyal(m, "issue_type", "total_amount")
    paid = money.refund(F.col("issue_type"), F.col("total_amount"), F.col("loyalty"))
    return rows.select("delivery_id", paid.alias("refund"))


@query
def clip_outliers(m):
    return cleaning.clip_outliers(m.raw_batch()).select("ingest_seq", *cleaning.CLIP_BOUNDS)


@query
def date_key(m):
    return _local(m).select("delivery_id", localtime.date_key(F.to_date("local_ts"), F.hour("local_ts")).alias("date_key"))


@query
def calendar_dim(m):
    """The hours from the first to the last local day, and the orders in each."""
    key = localtime.date_key(F.to_date("local_ts"), F.hour("local_ts"))
    orders = _local(m).groupBy(key.alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))
    span = _local(m).agg(F.to_date(F.min("local_ts")).alias("first_day"), F.to_date(F.max("local_ts")).alias("last_day"))
    return demand.calendar(span).join(orders, "date_key", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def online_key(m):
    return store.with_online_key(features.features_long(m.deliveries())).select("online_key")


@query
def null_defaults(m):
    raw = joins.with_weather(m.deliveries(), m.weather())
    return raw.select(
        "delivery_id",
        F.coalesce("weather_condition", F.lit("clear")).alias("weather_condition"),
        training.flag_text(F.col("is_flash_flood")).alias("is_flash_flood"),
        training.flag_text(F.col("is_heatwave")).alias("is_heatwave"),
        F.coalesce("precipitation_mm", F.lit(conditions.NO_WEATHER["precipitation_mm"])).alias("precipitation_mm"),
        F.coalesce("temp_high_c", F.lit(conditions.NO_WEATHER["temp_high_c"])).alias("temp_high_c"),
    )


def _serving(m: Marketplace) -> DataFrame:
    return serving.serving_features(m.deliveries(), m.zones(), m.merchants(), m.weather(), _online(m).latest())


@query
def features_snapshot_json(m):
    snapshot = _serving(m).select("delivery_id", serving.features_snapshot().alias("snapshot"))
    field = lambda name: F.get_json_object("snapshot", f"$.{name}")
    return snapshot.select(
        "delivery_id",
        F.size(F.json_object_keys("snapshot")).alias("fields"),
        field("hour").cast("int").alias("hour"),
        field("density_tier").alias("density_tier"),
        field("is_weekend").alias("is_weekend"),
        field("merchant_late_rate_30d").cast("double").alias("merchant_late_rate_30d"),
    )


# -- streaming -------------------------------------------------------------------------


@query
def stream_tick_metrics(m):
    return jobs.tick_metrics(_raw_stream(m), session.scratch(m.spark, "parts"), session.scratch(m.spark, "position"))


@query
def stream_running_totals(m):
    return jobs.running_totals(_raw_stream(m), session.scratch(m.spark, "totals"), session.scratch(m.spark, "position"))


@query
def weekly_tick_window(m):
    ticks = batches.weekly_ticks(m.deliveries(), "order_ts").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if("is_late").alias("late")
    )
    return ticks.select(F.col("tick.start").alias("week_start"), F.col("tick.end").alias("week_end"), "orders", "late")


@query
def stream_weekly_ticks(m):
    return jobs.weekly_ticks(m.stream("events"), session.scratch(m.spark, "weeks"), session.scratch(m.spark, "position"))


@query
def stream_closed_weeks(m):
    """Weeks that are closed: three sets of events arrive one after another, the last with events of the first fifth that
    come too late. A week is given out once, when the watermark has passed it, and its state is dropped."""
    events = m.table("events")
    low, high = (scalar(events, f(F.unix_micros(F.col("ts").cast("timestamp")))) for f in (F.min, F.max))
    at = (F.unix_micros(F.col("ts").cast("timestamp")) - low) / (high - low)
    late = (F.col("event_id") % 13 == 0) & (at < 0.2)
    sets = F.when(late | (at >= 0.75), 3).when(at >= 0.5, 2).otherwise(1)
    numbered = _written(m, events.select("ts", "event_type", sets.alias("arrives")))
    topic, weeks, position = (session.scratch(m.spark, n) for n in ("events", "weeks", "position"))
    for number in (1, 2, 3):
        arrived = numbered.filter(F.col("arrives") == number).drop("arrives")
        arrived.write.mode("append").parquet(topic)
        stream = m.spark.readStream.schema(arrived.schema).parquet(topic)
        closed = jobs.weekly_ticks(stream, weeks, position, mode="append")
    return closed


@query
def resume_point(m):
    deliveries = m.deliveries()
    return batches.resume_point(deliveries.filter(F.col("source") == "historical"), deliveries)


@query
def stream_gate_and_clean(m):
    cleaned, quarantined = jobs.gate_and_clean(
        _raw_stream(m), session.scratch(m.spark, "gate"), session.scratch(m.spark, "position"), "run"
    )
    ok = cleaned.select("ingest_seq", F.lit("").alias("reasons"), "prep_time_min", "pickup_wait_min", "total_amount")
    record = lambda name, kind: F.get_json_object("raw_record", f"$.{name}").cast(kind).alias(name)
    bad = quarantined.select(
        record("ingest_seq", "long"),
        F.concat_ws(",", contract.REASONS).alias("reasons"),
        record("prep_time_min", "double"),
        record("pickup_wait_min", "double"),
        record("total_amount", "double"),
    )
    return ok.unionByName(bad)


# -- model -----------------------------------------------------------------------------


def _training(m: Marketplace) -> DataFrame:
    return training.training_set(m.deliveries(), m.zones(), m.merchants(), m.weather(), _prior(m))


@query
def training_set(m):
    return _training(m)


@query
def feature_engineering(m):
    return training.engineer_features(_training(m)).select("delivery_id", training.TARGET, *training.FEATURES)


def _landed_features(m: Marketplace) -> DataFrame:
    """Training rows written once: fitting reads them many times."""
    path = session.scratch(m.spark, "training")
    rows = training.engineer_features(_training(m)).select("delivery_id", "order_ts", training.TARGET, *training.FEATURES)
    rows.write.parquet(path)
    return m.spark.read.parquet(path)


def _run(m: Marketplace) -> tuple:
    """The training run over all deliveries of a folder, with the parameters of production: the model, its metrics on the
    later part, and the number of training and test rows. It is run once per session."""
    key = (m.spark.sparkContext.applicationId, m.folder)
    if key not in _RUNS:
        rows = _landed_features(m)
        model, metrics = training.train_eta(rows)
        path = session.scratch(m.spark, "metrics")
        metrics.write.parquet(path)
        n = rows.count()
        cut = int(n * 0.8)
        _RUNS[key] = model, m.spark.read.parquet(path), {"train": cut, "test": n - cut, "sample_pct": 100}
    return _RUNS[key]


@query
def train_eta(m):
    return _run(m)[1]


@query
def serving_features(m):
    return _serving(m)


@query
def score_batch(m):
    return serving.score_batch(_run(m)[0], _serving(m), latest(m.deliveries()))


def _run_log(m: Marketplace) -> DataFrame:
    """The log after the training run of a folder was entered twice, and once with other parameters, as a run that is only
    planned: without metrics."""
    _, metrics, counts = _run(m)
    log = training.RunLog(m.spark, session.scratch(m.spark, "runs"))
    seen = m.deliveries().agg(F.max("order_ts").cast("string")).first()[0]
    for params in ({}, {}, {"maxIter": 100}):
        name = training.run_id_of(counts, seen, **params)
        rows = training.training_runs_log(metrics, name, counts, **params)
        log.append(rows.filter("kind = 'param'") if params else rows, name)
    return log.rows()


@query
def training_runs_log(m):
    return _run_log(m)


@query
def training_run_parameters(m):
    """What the log says of each run before it began: parameters and sizes, the runs in the order of their iterations."""
    rows = _run_log(m).filter("kind = 'param'")
    iterations = rows.filter("name = 'maxIter'").select("run_id", F.col("value").alias("iterations"))
    return rows.join(iterations, "run_id").select("iterations", "name", "value")


# -- maintenance and composite jobs --------------------------------------------------------


@query
def contract_gate(m):
    return contract.contract_gate(m.raw_batch()).select("ingest_seq", contract.REASONS)


@query
def preprocess(m):
    return cleaning.type_coercion(cleaning.fill_and_clip(_unique(m)))


@query
def prune_retention(m):
    return retention.prune_counts(m.deliveries(), m.predictions(), store.snapshot_rows(_history(m)))


@query
def pipeline_tick(m):
    """The realtime orders as one new batch on top of the historical ones."""
    house = tick.Warehouse(m.spark, session.scratch(m.spark, "house"))
    deliveries = m.deliveries()
    past = deliveries.filter(F.col("source") == "historical")
    house.append_deliveries(
        past.withColumns({"promo_id": F.lit(None).cast("int"), "date_key": F.lit(None).cast("long")}), "seed"
    )
    batch = m.raw_from(deliveries.filter(F.col("source") == "realtime"))
    model = _run(m)[0]
    return tick.run_tick(house, batch, "tick-1", m.zones(), m.merchants(), m.weather(), model)


def _zone_days(m: Marketplace) -> DataFrame:
    users = _members(m).filter(F.col("kind") == "user")
    pool = intervals.active_pool_daily(users, *_span(m)).select("zone_id", "day", "active_weight")
    return demand.zone_day_demand(pool, m.zones(), m.weather(), m.external_events(), _span(m))


@query
def expected_demand(m):
    """Per zone and day, beside the actual orders."""
    return demand.demand_against_actual(demand.expected_per_day(_zone_days(m)), m.deliveries(), m.zones())


@query
def expected_demand_hourly(m):
    """Per zone, day and hour."""
    return demand.expected_demand(_zone_days(m))
