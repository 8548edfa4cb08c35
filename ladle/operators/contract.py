"""The data contract: 25 row checks, evaluated in one pass over a batch."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns and bounds of the contract, in report order.
REQUIRED = [
    "user_id", "merchant_id", "dasher_id", "zone_id", "date_key", "order_ts",
    "promised_eta_min", "prep_time_min", "subtotal", "total_amount",
    "item_count", "source",
]
RANGES = {
    "prep_time_min": (0, 180),
    "travel_time_min": (0, 180),
    "pickup_wait_min": (0, 60),
    "promised_eta_min": (0, 300),
    "actual_delivery_min": (0, 300),
    "subtotal": (0, 1000),
    "total_amount": (0, 1000),
    "delivery_fee": (0, 20),
    "tip_amount": (0, 500),
    "item_count": (1, 50),
    "refund_amount": (0, 1000),
}
ALLOWED = {
    "issue_type": ["misplaced", "not_delivered", "wrong_order"],
    "source": ["historical", "realtime"],
}

REASONS = "failed_expectations"


def not_null_checks() -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNull() for c in REQUIRED}


def range_checks() -> dict[str, Column]:
    """A null value passes: the comparison is null, which is not a failure."""
    return {f"range:{c}": ~F.col(c).between(lo, hi) for c, (lo, hi) in RANGES.items()}


def set_checks() -> dict[str, Column]:
    return {f"set:{c}": ~F.col(c).isin(values) for c, values in ALLOWED.items()}


def all_checks() -> dict[str, Column]:
    return {**not_null_checks(), **range_checks(), **set_checks()}


def failures(checks: dict[str, Column]) -> Column:
    """Names of the failed checks, in the order of the contract."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))


def fails_any(checks: dict[str, Column] | None = None) -> Column:
    """Whether a row fails a check; never null, and no list is built for it."""
    checks = checks or all_checks()
    return reduce(operator.or_, [F.coalesce(bad, F.lit(False)) for bad in checks.values()])


def contract_gate(batch: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """Every row with the list of checks it fails; an empty list is a pass."""
    return batch.withColumn(REASONS, failures(checks or all_checks()))


def gate_split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Passing rows, and failing rows with their reasons. A row is in exactly
    one of the two; the list of reasons is only built for failing rows."""
    return batch.filter(~fails_any()), contract_gate(batch.filter(fails_any()))


def quarantine_rows(failing: DataFrame, batch_id: str) -> DataFrame:
    """Failing rows as they are stored: the record as JSON (nulls kept), the
    reasons and the batch they came in."""
    record = [c for c in failing.columns if c != REASONS]
    return failing.select(
        F.to_json(F.struct(*record), {"ignoreNullFields": "false"}).alias("raw_record"),
        REASONS,
        F.lit(batch_id).alias("batch_id"),
    )
