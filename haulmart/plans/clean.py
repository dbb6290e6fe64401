"""Clean layer: one stateless projection per staging table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions.columns import (
    decimal_ratio,
    flag,
    in_calendar,
    none_null,
    standard_text,
)

# Fixed value: the status a delivery gets once it is past its planned date.
LATE = "LATE"


def sales_rows() -> Column:
    """Sales that survive cleaning. A date outside the calendar is kept and flagged."""
    return (
        none_null("SalesID", "DeliveryID", "DateKey")
        & (F.col("UnitsSold") > 0)
        & (F.col("SalesAmount") > 0)
    )


def delivery_rows() -> Column:
    """Lateness needs both dates, so a delivery without a planned date is dropped."""
    return none_null("DeliveryID", "RouteID", "DriverID", "DeliveryDate", "ExpectedDeliveryDate")


def exception_rows() -> Column:
    """Open exceptions (no resolved date) are valid."""
    return none_null("ExceptionID", "DeliveryID", "DateReported")


def route_rows() -> Column:
    return (
        none_null("RouteID", "DriverID")
        & (F.col("PlannedStops") > 0)
        & (F.col("ActualStops") > 0)
        & (F.col("PlannedHours") > 0)
        & (F.col("ActualHours") > 0)
    )


def is_overdue() -> Column:
    return F.col("DeliveryDate") > F.col("ExpectedDeliveryDate")


def clean_sales(staging: DataFrame) -> DataFrame:
    valid = in_calendar(F.col("DateKey"))
    return staging.filter(sales_rows()).select(
        "SalesID",
        "DeliveryID",
        F.when(valid, F.col("DateKey")).alias("DateKey"),
        F.when(valid, F.lit(0)).otherwise(F.lit(1)).alias("IsBadDateKey"),
        standard_text(F.col("ProductType")).alias("ProductType"),
        standard_text(F.col("Region")).alias("Region"),
        "UnitsSold",
        "SalesAmount",
    )


def clean_deliveries(staging: DataFrame) -> DataFrame:
    status = standard_text(F.col("DeliveryStatus"))
    return staging.filter(delivery_rows()).select(
        "DeliveryID",
        "RouteID",
        "DriverID",
        standard_text(F.col("Region")).alias("Region"),
        standard_text(F.col("ShipmentType")).alias("ShipmentType"),
        "DeliveryDate",
        "ExpectedDeliveryDate",
        F.when(is_overdue(), F.lit(LATE)).otherwise(status).alias("DeliveryStatus"),
        flag(F.col("PriorityFlag")).alias("PriorityFlag"),
    )


def clean_exceptions(staging: DataFrame) -> DataFrame:
    reported, resolved = F.col("DateReported"), F.col("ResolvedDate")
    stored = F.col("ResolutionTimeHours")
    reversed_dates = resolved < reported
    # greatest() would turn an open exception into a resolved one.
    corrected = F.when(reversed_dates, reported).otherwise(resolved)
    derived = (F.datediff(corrected, reported) * 24).cast("decimal(10,2)")
    return staging.filter(exception_rows()).select(
        "ExceptionID",
        "DeliveryID",
        standard_text(F.col("ExceptionType")).alias("ExceptionType"),
        "DateReported",
        corrected.alias("ResolvedDate"),
        flag(reversed_dates).alias("IsDateCorrected"),
        F.when(stored >= 0, stored.cast("decimal(10,2)"))
        .otherwise(derived)
        .alias("ResolutionTimeHours"),
        flag(F.col("PriorityFlag")).alias("PriorityFlag"),
        standard_text(F.col("Region")).alias("Region"),
    )


def clean_routes(staging: DataFrame) -> DataFrame:
    return staging.filter(route_rows()).select(
        "RouteID",
        "DriverID",
        "PlannedStops",
        "ActualStops",
        "PlannedHours",
        "ActualHours",
        standard_text(F.col("Region")).alias("Region"),
        decimal_ratio(F.col("ActualHours"), F.col("PlannedHours")).alias("EfficiencyRatio"),
        (F.col("ActualStops") - F.col("PlannedStops")).alias("StopVariance"),
    )


# Clean view -> (staging table, plan, row filter)
CLEAN_VIEWS = {
    "clean_sales": ("staging_sales", clean_sales, sales_rows),
    "clean_deliveries": ("staging_deliveries", clean_deliveries, delivery_rows),
    "clean_exceptions": ("staging_exceptions", clean_exceptions, exception_rows),
    "clean_routes": ("staging_routes", clean_routes, route_rows),
}
