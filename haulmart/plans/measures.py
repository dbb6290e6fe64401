"""Business measures and questions over the star schema.

Every grouped measure aggregates the fact by its integer keys first and looks
names up for the few groups that remain. Only the needed fact columns are
read, the shuffle carries integers, and a hot region, route or driver is
folded map-side. Results equal an aggregation over the reporting frames,
since every fact row has its dimension rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions.columns import (
    count_if,
    date_of_key,
    month_of_key,
    share,
    whole_part,
)
from haulmart.operators.checks import Tables
from haulmart.plans.clean import LATE
from haulmart.plans.dims import VALUE_DIMENSIONS


def _names(groups: DataFrame, tables: Tables, table: str, name: str | None = None) -> DataFrame:
    """Replace a surrogate key in aggregated groups by its dimension value."""
    d = VALUE_DIMENSIONS[table]
    dim = tables(table).select(F.col(d.key).alias("_id"), F.col(d.value).alias(name or d.value))
    return groups.join(dim, groups[d.key] == dim["_id"]).drop("_id", d.key)


def _rows() -> Column:
    return F.count(F.lit(1))


def _is_late() -> Column:
    return F.col("DeliveryStatus") == LATE


# --- single measures -------------------------------------------------------


def total_revenue(tables: Tables) -> DataFrame:
    """Amounts are transaction totals already; units play no part."""
    return tables("fact_sales").agg(F.sum("SalesAmount").alias("TotalRevenue"))


def _deliveries_by(tables: Tables, *keys: str) -> DataFrame:
    """Delivery counts per key group and status, with the status named."""
    groups = tables("fact_deliveries").groupBy(*keys, "DeliveryStatusID").agg(_rows().alias("n"))
    return _names(groups, tables, "dim_delivery_status")


def _late_sums() -> list[Column]:
    late = F.coalesce(F.sum(F.when(_is_late(), F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return [
        total.alias("Deliveries"),
        late.alias("LateDeliveries"),
        share(late, total).alias("LatePct"),
    ]


def late_share(tables: Tables) -> DataFrame:
    return _deliveries_by(tables).agg(*_late_sums())


def average_resolution(tables: Tables) -> DataFrame:
    hours = F.col("ResolutionTimeHours")
    return tables("fact_exceptions").agg(
        F.count(hours).alias("ResolvedExceptions"),
        share(F.sum(hours), F.count(hours)).alias("AvgResolutionHours"),
    )


def route_efficiency_average(tables: Tables) -> DataFrame:
    ratio = F.col("EfficiencyRatio")
    return tables("fact_routes").agg(share(F.sum(ratio), F.count(ratio)).alias("AvgEfficiency"))


def stop_completion(tables: Tables) -> DataFrame:
    return tables("fact_routes").agg(
        F.sum("ActualStops").alias("ActualStops"),
        F.sum("PlannedStops").alias("PlannedStops"),
        share(F.sum("ActualStops"), F.sum("PlannedStops")).alias("StopCompletionRate"),
    )


def date_corrected(tables: Tables) -> DataFrame:
    return tables("fact_exceptions").agg(
        count_if(F.col("IsDateCorrected") == 1).alias("DateCorrectedExceptions")
    )


# --- questions -------------------------------------------------------------


def sales_by_region_product_month(tables: Tables) -> DataFrame:
    groups = (
        tables("fact_sales")
        .groupBy("RegionID", "ProductTypeID", month_of_key(F.col("DateKey")).alias("_month"))
        .agg(_rows().alias("Transactions"), F.sum("SalesAmount").alias("TotalRevenue"))
    )
    named = _names(_names(groups, tables, "dim_region"), tables, "dim_product_type")
    return named.select(
        "Region",
        "ProductType",
        whole_part(F.col("_month"), 100).alias("SaleYear"),
        (F.col("_month") % 100).alias("SaleMonth"),
        "Transactions",
        "TotalRevenue",
    ).orderBy("Region", "ProductType", "SaleYear", "SaleMonth")


def late_deliveries(tables: Tables) -> DataFrame:
    """Every late delivery with route, driver and days late."""
    status = (
        tables("dim_delivery_status").filter(_is_late()).select("DeliveryStatusID")
    )
    rows = (
        tables("fact_deliveries")
        .join(status, "DeliveryStatusID")
        .select(
            "DeliveryID",
            "RouteID",
            "DriverID",
            _days_late().alias("DaysLate"),
        )
    )
    return _names(
        _names(rows, tables, "dim_route", "Route"), tables, "dim_driver", "Driver"
    ).select("DeliveryID", "Route", "Driver", "DaysLate")


def _days_late() -> Column:
    return F.datediff(
        date_of_key(F.col("DeliveryDateKey")), date_of_key(F.col("ExpectedDeliveryDateKey"))
    )


def late_by_route_driver(tables: Tables) -> DataFrame:
    groups = (
        _deliveries_by(tables, "RouteID", "DriverID").groupBy("RouteID", "DriverID").agg(*_late_sums())
    )
    named = _names(_names(groups, tables, "dim_route", "Route"), tables, "dim_driver", "Driver")
    return named.select("Route", "Driver", "Deliveries", "LateDeliveries", "LatePct").orderBy(
        F.desc("LateDeliveries"), F.desc("LatePct"), "Route", "Driver"
    )


def on_time_share(tables: Tables) -> DataFrame:
    """Per region, and over all regions as ALL. The rollup runs on the counted groups."""
    counted = _names(_deliveries_by(tables, "RegionID"), tables, "dim_region")
    on_time = F.coalesce(F.sum(F.when(~_is_late(), F.col("n"))), F.lit(0))
    total = F.sum("n")
    return (
        counted.rollup("Region")
        .agg(
            F.grouping("Region").alias("_all"),
            total.alias("Deliveries"),
            on_time.alias("OnTimeDeliveries"),
            share(on_time, total).alias("OnTimePct"),
        )
        .select(
            F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col("Region")).alias("Region"),
            "Deliveries",
            "OnTimeDeliveries",
            "OnTimePct",
        )
        .orderBy("Region")
    )


def _resolution_columns() -> list[Column]:
    hours = F.col("ResolutionTimeHours")
    return [
        _rows().alias("Exceptions"),
        F.count(hours).alias("ResolvedExceptions"),
        share(F.sum(hours), F.count(hours)).alias("AvgResolutionHours"),
    ]


def resolution_by_type(tables: Tables) -> DataFrame:
    groups = tables("fact_exceptions").groupBy("ExceptionTypeID").agg(*_resolution_columns())
    named = _names(groups, tables, "dim_exception_type")
    return named.select(
        "ExceptionType", "Exceptions", "ResolvedExceptions", "AvgResolutionHours"
    ).orderBy(F.desc_nulls_last("AvgResolutionHours"), "ExceptionType")


def routes_over_hours(tables: Tables) -> DataFrame:
    rows = (
        tables("fact_routes")
        .filter(F.col("EfficiencyRatio") > 1)
        .select("RouteID", "DriverID", "PlannedHours", "ActualHours", "EfficiencyRatio")
    )
    named = _names(_names(rows, tables, "dim_route", "Route"), tables, "dim_driver", "Driver")
    return named.select(
        "Route", "Driver", "PlannedHours", "ActualHours", "EfficiencyRatio"
    ).orderBy(F.desc("EfficiencyRatio"), "Route", "Driver")


def drivers_under_stops(tables: Tables) -> DataFrame:
    groups = (
        tables("fact_routes")
        .filter(F.col("StopVariance") < 0)
        .groupBy("DriverID")
        .agg(
            _rows().alias("RoutesUnderPlan"),
            F.sum(-F.col("StopVariance")).alias("MissedStops"),
        )
    )
    return (
        _names(groups, tables, "dim_driver", "Driver")
        .select("Driver", "RoutesUnderPlan", "MissedStops")
        .orderBy(F.desc("MissedStops"), "Driver")
    )


def priority_by_region(tables: Tables) -> DataFrame:
    groups = (
        tables("fact_deliveries").groupBy("RegionID", "PriorityFlagID").agg(_rows().alias("n"))
    )
    named = _names(_names(groups, tables, "dim_priority_flag"), tables, "dim_region")
    priority = F.sum(F.when(F.col("PriorityFlag") == 1, F.col("n")).otherwise(F.lit(0)))
    return (
        named.groupBy("Region")
        .agg(
            F.sum("n").alias("Deliveries"),
            priority.alias("PriorityDeliveries"),
            share(priority, F.sum("n")).alias("PriorityPct"),
        )
        .orderBy("Region")
    )


def exception_trend(tables: Tables) -> DataFrame:
    groups = (
        tables("fact_exceptions")
        .groupBy(month_of_key(F.col("DateKey")).alias("_month"), "ExceptionTypeID")
        .agg(*_resolution_columns())
    )
    return (
        _names(groups, tables, "dim_exception_type")
        .select(
            whole_part(F.col("_month"), 100).alias("ReportYear"),
            (F.col("_month") % 100).alias("ReportMonth"),
            "ExceptionType",
            "Exceptions",
            "ResolvedExceptions",
            "AvgResolutionHours",
        )
        .orderBy("ReportYear", "ReportMonth", "ExceptionType")
    )


def priority_impact(tables: Tables) -> DataFrame:
    """Late share and days late, priority against standard, per region."""
    groups = (
        tables("fact_deliveries")
        .groupBy("RegionID", "PriorityFlagID", "DeliveryStatusID")
        .agg(_rows().alias("n"), F.sum(_days_late()).alias("days"))
    )
    named = groups
    for table in ("dim_delivery_status", "dim_priority_flag", "dim_region"):
        named = _names(named, tables, table)
    late = F.sum(F.when(_is_late(), F.col("n")).otherwise(F.lit(0)))
    days = F.sum(F.when(_is_late(), F.col("days")).otherwise(F.lit(0)))
    return (
        named.groupBy("Region", F.col("PriorityFlag").alias("IsPriority"))
        .agg(
            F.sum("n").alias("Deliveries"),
            late.alias("LateDeliveries"),
            share(late, F.sum("n")).alias("LatePct"),
            share(days, late).alias("AvgDaysLate"),
        )
        .orderBy("Region", "IsPriority")
    )


def routes_drivers_vs_plan(tables: Tables) -> DataFrame:
    """Planned against actual per route and per driver, and pairs that met both plans."""
    met = (F.col("ActualHours") <= F.col("PlannedHours")) & (
        F.col("ActualStops") >= F.col("PlannedStops")
    )
    sums = [
        _rows().alias("Pairs"),
        F.sum("PlannedHours").alias("PlannedHours"),
        F.sum("ActualHours").alias("ActualHours"),
        F.sum("PlannedStops").alias("PlannedStops"),
        F.sum("ActualStops").alias("ActualStops"),
        count_if(met).alias("PairsMeetingPlan"),
    ]
    parts = []
    for level, key, table in (("Route", "RouteID", "dim_route"), ("Driver", "DriverID", "dim_driver")):
        groups = tables("fact_routes").groupBy(key).agg(*sums)
        parts.append(
            _names(groups, tables, table, "Code").select(
                F.lit(level).alias("Level"),
                "Code",
                "Pairs",
                "PlannedHours",
                "ActualHours",
                "PlannedStops",
                "ActualStops",
                "PairsMeetingPlan",
                share(F.col("PairsMeetingPlan"), F.col("Pairs")).alias("MeetingPlanPct"),
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("Level", "Code")


MEASURES = {
    "kpi_total_revenue": total_revenue,
    "kpi_late_pct": late_share,
    "kpi_avg_resolution": average_resolution,
    "kpi_route_efficiency": route_efficiency_average,
    "kpi_stop_completion": stop_completion,
    "kpi_date_corrected": date_corrected,
    "bq_sales_by_region_product_month": sales_by_region_product_month,
    "bq_late_deliveries": late_deliveries,
    "bq_late_by_route_driver": late_by_route_driver,
    "bq_on_time_pct": on_time_share,
    "bq_resolution_by_type": resolution_by_type,
    "bq_routes_over_hours": routes_over_hours,
    "bq_drivers_under_stops": drivers_under_stops,
    "bq_priority_by_region": priority_by_region,
    "bq_exception_trend": exception_trend,
    "bq_priority_impact": priority_impact,
    "bq_routes_drivers_vs_plan": routes_drivers_vs_plan,
}
