"""The marketplace star schema, derived from the order tables in a folder.

Each method is one view of FIXTURES.md. No data is cached or registered: a
view is a plan, and a query reads only the columns it uses. No join carries a
broadcast hint; Spark broadcasts a side when its measured size allows it and
shuffles otherwise, and adaptive execution splits hot customers.
"""

from __future__ import annotations

import functools
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions import conditions, localtime
from ladle.functions.exact import scalar
from ladle.schema import MINUTES, MONEY, SMALL_MONEY

FIRST_DAY = "DATE '1995-01-01'"
LAST_CHURN = "DATE '2001-08-01'"
CALENDAR_DAYS = 2410
TIMEZONES = [
    "America/New_York",
    "America/Chicago",
    "America/Denver",
    "America/Los_Angeles",
    "America/Phoenix",
]
DENSITIES = ["high", "medium", "low"]
CUISINES = ["pizza", "thai", "cafe", "indian"]
VEHICLES = ["bike", "scooter", "car"]
PROMO_TYPES = ["discount_pct", "flat_discount", "free_delivery", "bogo"]


def _nth(names: list[str], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.expr(f"CAST({index} AS INT) + 1"))


def _day(days: str, start: str = FIRST_DAY) -> Column:
    return F.expr(f"date_add({start}, CAST({days} AS INT))")


def _hundredths(amount: str, kind) -> Column:
    return (F.expr(f"CAST({amount} AS DECIMAL(10,0))") * F.lit(Decimal("0.01"))).cast(kind)


def _thousandths(amount: str) -> Column:
    return (F.expr(f"CAST({amount} AS DECIMAL(10,0))") * F.lit(Decimal("0.001"))).cast("decimal(6,3)")


def view(build):
    """Keep the plan of a view, so a query that uses it again builds it once."""

    @functools.wraps(build)
    def get(self):
        if build.__name__ not in self.views:
            self.views[build.__name__] = build(self)
        return self.views[build.__name__]

    return get


class Marketplace:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.views: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.views:
            self.views[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.views[name]

    @view
    def orders(self) -> DataFrame:
        return self.table("orders")

    def stream(self, name: str, files_per_batch: int = 1000) -> DataFrame:
        """The same table read as a stream of files. The bracket makes the
        path a pattern, which the file source wants for a single file."""
        return (
            self.spark.readStream.schema(self.table(name).schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{self.folder}/[{name[0]}]{name[1:]}.parquet")
        )

    # -- dimensions ---------------------------------------------------------

    @view
    def zones(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("zone_id"),
            F.col("n_name").alias("city"),
            F.expr("concat('S', CAST(n_nationkey % 9 AS STRING))").alias("state"),
            F.col("r_name").alias("region"),
            _nth(TIMEZONES, "n_nationkey % 5").alias("timezone"),
            _nth(DENSITIES, "n_nationkey % 3").alias("density_tier"),
            F.expr("CAST(26 + n_nationkey % 22 AS DOUBLE)").alias("latitude"),
        )

    @view
    def users(self) -> DataFrame:
        return (
            self.table("customer")
            .withColumn("signup_date", _day("c_custkey * 37 % 1200"))
            .withColumn("activation_date", _day("1 + c_custkey % 5", "signup_date"))
            .withColumn("leaves", _day("30 + c_custkey * 53 % 1500", "activation_date"))
            .select(
                F.col("c_custkey").alias("user_id"),
                "signup_date",
                "activation_date",
                F.expr(f"CASE WHEN c_custkey % 3 <> 0 AND leaves <= {LAST_CHURN} THEN leaves END").alias("churn_date"),
                F.col("c_nationkey").alias("home_zone_id"),
                F.expr("c_custkey % 20 < 7").alias("is_subscriber"),
                _thousandths("500 + c_custkey * 17 % 2000").alias("activity_weight"),
            )
        )

    def _numbered_per_zone(self, each: int) -> DataFrame:
        """``each`` entities per zone, with zone_id, a running j and an id."""
        slots = F.explode(F.sequence(F.lit(0), F.lit(each - 1)))
        return (
            self.table("nation")
            .select(F.col("n_nationkey").alias("zone_id"), slots.alias("j"))
            .withColumn("id", F.expr(f"zone_id * {each} + j"))
        )

    @view
    def merchants(self) -> DataFrame:
        return self._numbered_per_zone(4).select(
            F.col("id").alias("merchant_id"),
            "zone_id",
            _hundredths("1500 + id * 131 % 2000", MINUTES).alias("baseline_prep_time_min"),
            _day("id * 7 % 400").alias("activation_date"),
            F.when(F.expr("id % 5 = 0"), _day("id * 11 % 900", "DATE '1998-01-01'")).alias("churn_date"),
            _nth(CUISINES, "(zone_id + j) % 4").alias("cuisine_type"),
            _thousandths("500 + id * 97 % 1500").alias("activity_weight"),
        )

    @view
    def dashers(self) -> DataFrame:
        return self._numbered_per_zone(2).select(
            F.col("id").alias("dasher_id"),
            F.col("zone_id").alias("home_zone_id"),
            _day("id * 7 % 400").alias("activation_date"),
            F.when(F.expr("id % 5 = 0"), _day("id * 11 % 900", "DATE '1998-01-01'")).alias("churn_date"),
            _thousandths("500 + id % 20 * 100").alias("activity_weight"),
            _nth(VEHICLES, "id % 3").alias("vehicle_type"),
        )

    @view
    def promotions(self) -> DataFrame:
        return self.spark.range(300).withColumn("i", F.expr("CAST(id AS INT)")).select(
            F.col("i").alias("promo_id"),
            _nth(PROMO_TYPES, "i % 4").alias("promo_type"),
            F.expr("CASE WHEN i % 4 = 0 THEN CAST(10 + i % 31 AS DECIMAL(5,2)) END").alias("discount_pct"),
            F.expr("CASE WHEN i % 4 = 1 THEN CAST(3 + i % 8 AS DECIMAL(6,2)) END").alias("flat_amount"),
            F.expr("CASE WHEN i % 5 >= 2 THEN i * 7 % 100 END").alias("merchant_id"),
            _day("i * 13 % 2300").alias("start_date"),
            _day("i * 13 % 2300 + 7 + i % 21").alias("end_date"),
        )

    @view
    def external_events(self) -> DataFrame:
        """Nineteen dated events, every third one national."""
        return self.spark.range(19).withColumn("i", F.expr("CAST(id AS INT)")).select(
            F.expr("concat('event_', CAST(i AS STRING))").alias("event_type"),
            _day("i * 120").alias("start_date"),
            _day("i * 120 + 3 + i * 37 % 288").alias("end_date"),
            F.expr("CASE WHEN i % 3 <> 0 THEN concat('S', CAST(i % 9 AS STRING)) END").alias("affected_state"),
            F.expr("CAST(92 + i * 29 % 49 AS DOUBLE) / 100.0D").alias("demand_multiplier"),
            F.expr("CAST(90 + i * 13 % 26 AS DOUBLE) / 100.0D").alias("order_value_multiplier"),
        )

    @view
    def weather(self) -> DataFrame:
        days = F.explode(F.sequence(F.lit(0), F.lit(CALENDAR_DAYS - 1)))
        rain = "CASE WHEN (i * 31 + zone_id * 17) % 4 = 0 THEN (i * 137 + zone_id * 71) % 5000 ELSE 0 END"
        return (
            self.table("nation")
            .select(F.col("n_nationkey").alias("zone_id"), days.alias("i"))
            .filter("(i + zone_id) % 50 <> 0")
            .select(
                "zone_id",
                _day("i").alias("date"),
                F.expr(f"CAST({rain} AS DOUBLE) / 100.0D").alias("precipitation_mm"),
                F.expr("CAST((i * 53 + zone_id * 29) % 4500 AS DOUBLE) / 100.0D - 5.0D").alias("temp_high_c"),
            )
            .withColumn("temp_low_c", F.expr("temp_high_c - 8"))
            .withColumn("condition", conditions.condition(F.col("precipitation_mm"), F.col("temp_low_c")))
            .withColumn("is_flash_flood", conditions.flash_flood(F.col("precipitation_mm")))
            .withColumn("is_heatwave", F.col("temp_high_c") > 36)
        )

    # -- facts --------------------------------------------------------------

    @view
    def deliveries(self) -> DataFrame:
        return self.deliveries_from(self.orders())

    def deliveries_from(self, orders: DataFrame) -> DataFrame:
        """Deliveries of any set of orders, batch or stream."""
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        priced = (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .selectExpr(
                "*",
                "500 + o_orderkey * 7919 % 3000 AS prep_c",
                "200 + (o_orderkey * 6271 + o_custkey * 31) % 2400 AS travel_c",
                "CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey * 3571 % 1000 END AS wait_c",
                "CAST(FLOOR(o_totalprice / 15.0D) AS BIGINT) AS subtotal_c",
                "199 + o_orderkey % 400 AS fee_c",
            )
            .selectExpr(
                "*",
                "CAST(FLOOR(subtotal_c * 15 / 100.0D) AS BIGINT) AS tip_c",
                "CASE WHEN o_orderkey % 211 <> 0 THEN"
                " prep_c + COALESCE(wait_c, 400) + travel_c + o_orderkey * 4421 % 500 - 250 END AS actual_c",
            )
        )
        return priced.select(
            F.col("o_orderkey").alias("delivery_id"),
            F.col("o_custkey").alias("user_id"),
            F.expr("CAST(c_nationkey * 4 + o_orderkey % 4 AS INT)").alias("merchant_id"),
            F.expr("CAST(c_nationkey * 2 + (o_orderkey * 7 + o_custkey) % 2 AS INT)").alias("dasher_id"),
            F.col("c_nationkey").alias("zone_id"),
            F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400)").alias("order_ts"),
            _hundredths("prep_c + travel_c + 800", MINUTES).alias("promised_eta_min"),
            _hundredths("actual_c", MINUTES).alias("actual_delivery_min"),
            _hundredths("prep_c", MINUTES).alias("prep_time_min"),
            _hundredths("wait_c", MINUTES).alias("pickup_wait_min"),
            _hundredths("travel_c", MINUTES).alias("travel_time_min"),
            _hundredths("subtotal_c", MONEY).alias("subtotal"),
            F.lit(0).cast(MONEY).alias("discount_amount"),
            _hundredths("fee_c", SMALL_MONEY).alias("delivery_fee"),
            _hundredths("tip_c", SMALL_MONEY).alias("tip_amount"),
            _hundredths("subtotal_c + fee_c + tip_c", MONEY).alias("total_amount"),
            F.expr("CAST(1 + o_orderkey % 7 AS INT)").alias("item_count"),
            F.expr("actual_c > prep_c + travel_c + 800").alias("is_late"),
            F.expr(
                "CASE o_orderkey % 100 WHEN 3 THEN 'misplaced' WHEN 5 THEN 'not_delivered'"
                " WHEN 7 THEN 'wrong_order' WHEN 9 THEN 'wrong_order' END"
            ).alias("issue_type"),
            F.lit(0).cast(MONEY).alias("refund_amount"),
            F.expr(
                "CASE WHEN o_orderdate >= TIMESTAMP_NTZ '2001-01-01 00:00:00' THEN 'realtime' ELSE 'historical' END"
            ).alias("source"),
        )

    @view
    def raw_batch(self) -> DataFrame:
        return self.raw_from(self.deliveries())

    def raw_from(self, deliveries: DataFrame) -> DataFrame:
        """Delivery records as they arrive: JSON numbers, seeded faults, and
        every eighth fault a record that is sent twice."""
        local = localtime.local_time(F.col("order_ts"), F.col("timezone"))
        fault = F.col("delivery_id") % 401

        def unless(remainder: int, bad: Column, name: str) -> Column:
            return F.when(fault == remainder, bad).otherwise(F.col(name))

        arrivals = F.when(
            fault == 8, F.array(F.col("delivery_id"), F.col("delivery_id") + 1000000000)
        ).otherwise(F.array(F.col("delivery_id")))
        number = lambda name: F.col(name).cast("double").alias(name)
        return (
            deliveries.join(self.zones().select("zone_id", "timezone"), "zone_id")
            .select("*", F.explode(arrivals).alias("ingest_seq"))
            .select(
                "ingest_seq",
                F.when(fault != 1, F.col("user_id")).alias("user_id"),
                "merchant_id",
                "dasher_id",
                "zone_id",
                F.lit(None).cast("int").alias("promo_id"),
                localtime.date_key(F.to_date(local), F.hour(local)).alias("date_key"),
                "order_ts",
                number("promised_eta_min"),
                number("actual_delivery_min"),
                F.when(fault == 2, 999.0).when(fault == 7, 150.0)
                .otherwise(F.col("prep_time_min").cast("double")).alias("prep_time_min"),
                number("pickup_wait_min"),
                number("travel_time_min"),
                number("subtotal"),
                number("discount_amount"),
                number("delivery_fee"),
                unless(5, F.lit(-1.0), "tip_amount").cast("double").alias("tip_amount"),
                number("total_amount"),
                unless(4, F.lit(0), "item_count").alias("item_count"),
                "is_late",
                unless(3, F.lit("lost"), "issue_type").alias("issue_type"),
                number("refund_amount"),
                unless(6, F.lit("unknown"), "source").alias("source"),
            )
        )

    @view
    def predictions(self) -> DataFrame:
        """Every fifth delivery was scored."""
        deliveries = self.deliveries().filter("delivery_id % 5 = 0")
        weather = self.weather().select("zone_id", F.col("date").alias("day"), "condition")
        tier, sky = F.col("density_tier"), F.coalesce(F.col("condition"), F.lit("clear"))
        return (
            deliveries.withColumn("day", F.to_date("order_ts"))
            .join(self.zones().select("zone_id", "density_tier"), "zone_id")
            .join(weather, ["zone_id", "day"], "left")
            .select(
                F.col("delivery_id").alias("prediction_id"),
                "delivery_id",
                F.lit("eta_regressor").alias("model_name"),
                F.lit("eta-v1").alias("model_version"),
                (F.col("prep_time_min") + F.col("travel_time_min") + F.lit(6)).cast(MINUTES).alias("predicted_eta_min"),
                F.concat(
                    F.lit('{"density_tier":"'), tier, F.lit('","weather_condition":"'), sky, F.lit('"}')
                ).alias("features_snapshot"),
                F.expr("order_ts + INTERVAL 1 DAY").alias("scored_at"),
            )
        )

    def month_starts(self) -> Column:
        """The first days of all months of the data, newest first, as one array value."""
        return scalar(
            self.deliveries(),
            F.expr(
                "transform(sequence(0, CAST(months_between(trunc(max(order_ts), 'MM'), trunc(min(order_ts), 'MM')) AS INT)),"
                " k -> CAST(add_months(trunc(max(order_ts), 'MM'), -k) AS TIMESTAMP_NTZ))"
            ),
        )
