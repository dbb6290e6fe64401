"""Informational profiles and review lists of the clean layer."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions.columns import (
    any_null,
    count_if,
    decimal_average,
    integer_average,
    null_cells,
    share,
)
from haulmart.operators.checks import Tables, parts_of
from haulmart.operators.integrity import orphan_count, orphan_rows
from haulmart.operators.shape import long_form
from haulmart.plans.clean import CLEAN_VIEWS, LATE, is_overdue

# Required fields per clean view. A missing resolved date is no defect.
REQUIRED_FIELDS = {
    "clean_sales": ("SalesID", "DeliveryID", "DateKey", "UnitsSold", "SalesAmount"),
    "clean_deliveries": ("DeliveryID", "RouteID", "DriverID", "DeliveryDate", "DeliveryStatus"),
    "clean_exceptions": ("ExceptionID", "DeliveryID", "DateReported"),
    "clean_routes": (
        "RouteID",
        "DriverID",
        "PlannedStops",
        "ActualStops",
        "PlannedHours",
        "ActualHours",
    ),
}

# Length of the review list and the texts of the issue column.
REVIEW_ROWS = 20
MISSING_FIELD = "NULL critical field"
NOT_LATE = "Expected LATE status"
NO_DELIVERY = "No matching delivery"


def _counted(tables: Tables, view: str) -> DataFrame:
    """One row: rows of the clean view, and of staging in all and by the view's own filter.

    The view is counted as it is, so that a wrong view shows against its source.
    """
    staging, _, rows = CLEAN_VIEWS[view]
    none = F.lit(0).cast("long")
    of_view = tables(view).agg(
        F.count(F.lit(1)).alias("clean"), none.alias("valid"), none.alias("total")
    )
    of_staging = tables(staging).agg(
        none.alias("clean"), count_if(rows()).alias("valid"), F.count(F.lit(1)).alias("total")
    )
    parts = of_view.unionByName(of_staging)
    return parts.agg(*[F.sum(c).alias(c) for c in ("clean", "valid", "total")])


def retention(tables: Tables, view: str) -> DataFrame:
    """Clean rows against valid and against all staging rows."""
    clean, valid, total = F.col("clean"), F.col("valid"), F.col("total")
    return _counted(tables, view).select(
        F.lit(view).alias("ViewName"),
        clean.alias("CleanRowCount"),
        valid.alias("StagingValidRowCount"),
        share(clean, valid).alias("RetentionRate"),
        total.alias("StagingRowCount"),
        share(clean, total).alias("StagingRetentionRate"),
    )


def layer_row_counts(tables: Tables) -> DataFrame:
    """TableName, StagingRows, CleanRows, DroppedRows."""
    parts = [
        _counted(tables, view).select(
            F.lit(view.removeprefix("clean_")).alias("TableName"),
            F.col("total").alias("StagingRows"),
            F.col("clean").alias("CleanRows"),
            (F.col("total") - F.col("clean")).alias("DroppedRows"),
        )
        for view in CLEAN_VIEWS
    ]
    return reduce(DataFrame.unionByName, parts)


def required_nulls(tables: Tables, view: str) -> DataFrame:
    """(NullCount, FieldName) for every required field, one pass over the view."""
    fields = REQUIRED_FIELDS[view]
    totals = tables(view).agg(*[null_cells(f).alias(f"{view}.{f}") for f in fields])
    names = [f"`{view}.{f}`" for f in fields]
    return long_form(totals, names, "FieldName", "NullCount")


def count_rows(tables: Tables, table: str, name: str, condition: Column) -> DataFrame:
    return tables(table).agg(count_if(condition).alias(name))


def incorrect_late(tables: Tables) -> DataFrame:
    wrong = is_overdue() & (F.col("DeliveryStatus") != LATE)
    return count_rows(tables, "clean_deliveries", "IncorrectLateFlag", wrong)


def invalid_priority(tables: Tables) -> DataFrame:
    return count_rows(
        tables, "clean_deliveries", "InvalidPriorityFlag", ~F.col("PriorityFlag").isin(0, 1)
    )


def date_corrected(tables: Tables, name: str = "DateCorrectedExceptions") -> DataFrame:
    return count_rows(tables, "clean_exceptions", name, F.col("IsDateCorrected") == 1)


def invalid_routes(tables: Tables) -> DataFrame:
    bad = (
        (F.col("PlannedStops") <= 0)
        | (F.col("ActualStops") <= 0)
        | (F.col("PlannedHours") <= 0)
        | (F.col("ActualHours") <= 0)
    )
    return count_rows(tables, "clean_routes", "InvalidRouteMetrics", bad)


def orphans(tables: Tables, view: str, name: str) -> DataFrame:
    counted = orphan_count(
        parts_of(tables, view), "DeliveryID", parts_of(tables, "clean_deliveries"), "DeliveryID"
    )
    return counted.withColumnRenamed("bad_rows", name)


def nonpositive_sales(tables: Tables) -> DataFrame:
    bad = (F.col("UnitsSold") <= 0) | (F.col("SalesAmount") <= 0)
    return count_rows(tables, "clean_sales", "NegativeOrZeroSales", bad)


def future_rows(tables: Tables, view: str, column: str, name: str, as_of: date) -> DataFrame:
    today = F.lit(as_of.isoformat()).cast("date")
    return count_rows(tables, view, name, F.col(column) > today)


def sales_by_region(tables: Tables) -> DataFrame:
    amount = F.col("SalesAmount")
    return (
        tables("clean_sales")
        .groupBy("Region")
        .agg(
            F.count(F.lit(1)).alias("Transactions"),
            F.sum(amount).alias("TotalSales"),
            decimal_average(amount).alias("AvgSale"),
            F.min(amount).alias("MinSale"),
            F.max(amount).alias("MaxSale"),
        )
        .orderBy("Region")
    )


def units_by_product(tables: Tables) -> DataFrame:
    units = F.col("UnitsSold")
    return (
        tables("clean_sales")
        .groupBy("ProductType")
        .agg(
            F.count(F.lit(1)).alias("Transactions"),
            F.sum(units).alias("TotalUnits"),
            integer_average("UnitsSold").alias("AvgUnits"),
            F.min(units).alias("MinUnits"),
            F.max(units).alias("MaxUnits"),
        )
        .orderBy("ProductType")
    )


def status_distribution(tables: Tables) -> DataFrame:
    counts = tables("clean_deliveries").groupBy("DeliveryStatus")
    return counts.agg(F.count(F.lit(1)).alias("RecordCount")).orderBy(
        F.desc("RecordCount"), "DeliveryStatus"
    )


def route_summary(tables: Tables) -> DataFrame:
    ratio, variance = F.col("EfficiencyRatio"), F.col("StopVariance")
    return tables("clean_routes").agg(
        F.min(ratio).alias("MinEfficiency"),
        F.max(ratio).alias("MaxEfficiency"),
        decimal_average(ratio).alias("AvgEfficiency"),
        F.min(variance).alias("MinStopVariance"),
        F.max(variance).alias("MaxStopVariance"),
        decimal_average(variance.cast("decimal(10,2)")).alias("AvgStopVariance"),
    )


def null_sales(tables: Tables) -> DataFrame:
    return (
        tables("clean_sales")
        .filter(any_null("DateKey", "SalesAmount", "UnitsSold"))
        .select(
            "SalesID",
            "DeliveryID",
            "DateKey",
            "UnitsSold",
            "SalesAmount",
            F.lit(MISSING_FIELD).alias("Issue"),
        )
    )


def null_deliveries(tables: Tables) -> DataFrame:
    return (
        tables("clean_deliveries")
        .filter(any_null("DeliveryID", "RouteID", "DriverID"))
        .select("DeliveryID", "RouteID", "DriverID", F.lit(MISSING_FIELD).alias("Issue"))
    )


def null_exceptions(tables: Tables) -> DataFrame:
    return (
        tables("clean_exceptions")
        .filter(any_null("ExceptionID", "DeliveryID", "DateReported"))
        .select(
            "ExceptionID",
            "DeliveryID",
            "DateReported",
            F.lit(MISSING_FIELD).alias("Issue"),
        )
    )


def late_rule_offenders(tables: Tables) -> DataFrame:
    """The review list shows the first offenders by key."""
    return (
        tables("clean_deliveries")
        .filter(is_overdue() & (F.col("DeliveryStatus") != LATE))
        .select(
            "DeliveryID",
            "DeliveryDate",
            "ExpectedDeliveryDate",
            "DeliveryStatus",
            F.lit(NOT_LATE).alias("Issue"),
        )
        .orderBy("DeliveryID")
        .limit(REVIEW_ROWS)
    )


def priority_distribution(tables: Tables) -> DataFrame:
    return (
        tables("clean_deliveries")
        .groupBy("PriorityFlag")
        .agg(F.count(F.lit(1)).alias("RecordCount"))
        .orderBy("PriorityFlag")
    )


def orphan_list(tables: Tables, view: str, key: str) -> DataFrame:
    child = [part.select(key, "DeliveryID") for part in parts_of(tables, view)]
    missing = orphan_rows(child, parts_of(tables, "clean_deliveries"), "DeliveryID")
    return missing.select(key, "DeliveryID", F.lit(NO_DELIVERY).alias("Issue"))


def sales_profile(tables: Tables) -> DataFrame:
    amount = F.col("SalesAmount")
    return tables("clean_sales").agg(
        F.min(amount).alias("MinSales"),
        F.max(amount).alias("MaxSales"),
        decimal_average(amount).alias("AvgSales"),
        F.sum(amount).alias("TotalSales"),
        F.count(F.lit(1)).alias("RecordCount"),
    )


def region_distribution(tables: Tables) -> DataFrame:
    counts = tables("clean_sales").groupBy("Region")
    return counts.agg(F.count(F.lit(1)).alias("RecordCount")).orderBy(
        F.desc("RecordCount"), "Region"
    )


def route_profile(tables: Tables) -> DataFrame:
    ratio = F.col("EfficiencyRatio")
    return tables("clean_routes").agg(
        F.min("ActualStops").alias("MinStops"),
        F.max("ActualStops").alias("MaxStops"),
        decimal_average(F.col("ActualHours")).alias("AvgHours"),
        F.min(ratio).alias("MinEfficiency"),
        F.max(ratio).alias("MaxEfficiency"),
        decimal_average(ratio).alias("AvgEfficiency"),
    )
