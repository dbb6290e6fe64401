"""Reporting frames: one flat row per fact row, nothing aggregated or recomputed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.plans.dims import Lookup


def _decode(rows: DataFrame, dims: Lookup, table: str, key: str, **columns: str) -> DataFrame:
    """Join one dimension by key; ``columns`` maps output name to dimension column."""
    dim_key = dims(table).columns[0]
    dim = dims(table).select(
        F.col(dim_key).alias("_id"), *[F.col(c).alias(name) for name, c in columns.items()]
    )
    return rows.join(dim, rows[key] == dim["_id"]).drop("_id")


def sales_summary(tables: Lookup) -> DataFrame:
    rows = tables("fact_sales")
    rows = _decode(rows, tables, "dim_product_type", "ProductTypeID", ProductType="ProductType")
    rows = _decode(rows, tables, "dim_region", "RegionID", Region="Region")
    rows = _decode(
        rows,
        tables,
        "dim_date",
        "DateKey",
        SaleDate="FullDate",
        SaleYear="Year",
        SaleQuarter="Quarter",
        SaleMonth="Month",
        SaleMonthName="MonthName",
    )
    return rows.select(
        "SalesID",
        "DeliveryID",
        "SaleDate",
        "SaleYear",
        "SaleQuarter",
        "SaleMonth",
        "SaleMonthName",
        "ProductType",
        "Region",
        "UnitsSold",
        "SalesAmount",
    )


def delivery_performance(tables: Lookup) -> DataFrame:
    rows = tables("fact_deliveries")
    rows = _decode(rows, tables, "dim_date", "DeliveryDateKey", DeliveryDate="FullDate")
    rows = _decode(
        rows, tables, "dim_date", "ExpectedDeliveryDateKey", ExpectedDeliveryDate="FullDate"
    )
    rows = _decode(rows, tables, "dim_shipment_type", "ShipmentTypeID", ShipmentType="ShipmentType")
    rows = _decode(
        rows, tables, "dim_delivery_status", "DeliveryStatusID", DeliveryStatus="DeliveryStatus"
    )
    rows = _decode(rows, tables, "dim_priority_flag", "PriorityFlagID", IsPriority="PriorityFlag")
    rows = _decode(rows, tables, "dim_region", "RegionID", Region="Region")
    rows = _decode(rows, tables, "dim_route", "RouteID", Route="RouteCode")
    rows = _decode(rows, tables, "dim_driver", "DriverID", Driver="DriverCode")
    return rows.select(
        "DeliveryID",
        "Route",
        "Driver",
        "Region",
        "ShipmentType",
        "DeliveryDate",
        "ExpectedDeliveryDate",
        "DeliveryStatus",
        "IsPriority",
    )


def exception_dashboard(tables: Lookup) -> DataFrame:
    rows = tables("fact_exceptions")
    rows = _decode(
        rows, tables, "dim_exception_type", "ExceptionTypeID", ExceptionType="ExceptionType"
    )
    rows = _decode(rows, tables, "dim_priority_flag", "PriorityFlagID", IsPriority="PriorityFlag")
    rows = _decode(rows, tables, "dim_region", "RegionID", Region="Region")
    rows = _decode(rows, tables, "dim_date", "DateKey", DateReported="FullDate")
    return rows.select(
        "ExceptionID",
        "DeliveryID",
        "ExceptionType",
        "DateReported",
        "ResolutionTimeHours",
        "IsPriority",
        "IsDateCorrected",
        "Region",
    )


def route_efficiency(tables: Lookup) -> DataFrame:
    rows = tables("fact_routes")
    rows = _decode(rows, tables, "dim_region", "RegionID", Region="Region")
    rows = _decode(rows, tables, "dim_route", "RouteID", Route="RouteCode")
    rows = _decode(rows, tables, "dim_driver", "DriverID", Driver="DriverCode")
    return rows.select(
        "Route",
        "Driver",
        "Region",
        "PlannedStops",
        "ActualStops",
        "PlannedHours",
        "ActualHours",
        "EfficiencyRatio",
        "StopVariance",
    )


REPORTS = {
    "rpt_sales_summary": sales_summary,
    "rpt_delivery_performance": delivery_performance,
    "rpt_exception_dashboard": exception_dashboard,
    "rpt_route_efficiency": route_efficiency,
}
