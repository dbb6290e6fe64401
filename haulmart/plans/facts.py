"""Fact loads: clean rows with their values replaced by surrogate keys.

All lookups are inner joins, so a row without a match leaves the fact and
shows up in the clean-to-fact row comparison. Dimensions are read back from
storage: the planner knows their true size, broadcasts the small ones and
shuffles for the rest, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.contracts import (
    FACT_DELIVERIES,
    FACT_EXCEPTIONS,
    FACT_ROUTES,
    FACT_SALES,
    conform,
)
from haulmart.functions.columns import date_key, match_key
from haulmart.plans.dims import VALUE_DIMENSIONS, Lookup


def _lookup(rows: DataFrame, dims: Lookup, table: str) -> DataFrame:
    """Swap the source column of a value dimension for its surrogate key."""
    d = VALUE_DIMENSIONS[table]
    dim = dims(table).select(F.col(d.key).alias("_id"), F.col(d.value).alias("_value"))
    source: Column = F.col(d.source_column)
    value: Column = F.col("_value")
    if d.is_code:
        source, value = match_key(source), match_key(value)
    joined = rows.join(dim, source == value)
    kept = [c for c in rows.columns if c != d.source_column]
    return joined.select(*kept, F.col("_id").alias(d.key))


def _lookup_date(rows: DataFrame, dims: Lookup, source: str, target: str) -> DataFrame:
    calendar = dims("dim_date").select(F.col("DateKey").alias("_id"))
    joined = rows.withColumn("_source", date_key(F.col(source))).join(
        calendar, F.col("_source") == F.col("_id")
    )
    kept = [c for c in rows.columns if c != source]
    return joined.select(*kept, F.col("_id").alias(target))


def _stamped(rows: DataFrame, load_ts: datetime) -> DataFrame:
    return rows.withColumn("load_ts", F.lit(load_ts).cast("timestamp"))


def fact_sales(clean: Lookup, dims: Lookup, load_ts: datetime) -> DataFrame:
    rows = clean("clean_sales").filter(F.col("IsBadDateKey") == 0).drop("IsBadDateKey")
    rows = _lookup_date(rows, dims, "DateKey", "DateKey")
    rows = _lookup(rows, dims, "dim_product_type")
    rows = _lookup(rows, dims, "dim_region")
    return conform(_stamped(rows, load_ts), FACT_SALES)


def fact_deliveries(clean: Lookup, dims: Lookup, load_ts: datetime) -> DataFrame:
    rows = clean("clean_deliveries")
    rows = _lookup_date(rows, dims, "DeliveryDate", "DeliveryDateKey")
    rows = _lookup_date(rows, dims, "ExpectedDeliveryDate", "ExpectedDeliveryDateKey")
    for table in (
        "dim_shipment_type",
        "dim_delivery_status",
        "dim_priority_flag",
        "dim_region",
        "dim_route",
        "dim_driver",
    ):
        rows = _lookup(rows, dims, table)
    return conform(_stamped(rows, load_ts), FACT_DELIVERIES)


def fact_routes(clean: Lookup, dims: Lookup, load_ts: datetime) -> DataFrame:
    rows = clean("clean_routes")
    for table in ("dim_region", "dim_route", "dim_driver"):
        rows = _lookup(rows, dims, table)
    return conform(_stamped(rows, load_ts), FACT_ROUTES)


def fact_exceptions(clean: Lookup, dims: Lookup, load_ts: datetime) -> DataFrame:
    rows = _lookup_date(clean("clean_exceptions"), dims, "DateReported", "DateKey")
    for table in ("dim_exception_type", "dim_priority_flag", "dim_region"):
        rows = _lookup(rows, dims, table)
    return conform(_stamped(rows, load_ts), FACT_EXCEPTIONS)


FACT_PLANS = {
    "fact_sales": fact_sales,
    "fact_deliveries": fact_deliveries,
    "fact_routes": fact_routes,
    "fact_exceptions": fact_exceptions,
}
