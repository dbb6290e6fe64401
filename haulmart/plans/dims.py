"""Dimension values. Surrogate keys are assigned when a dimension is loaded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.contracts import DIM_DATE, Contract, conform, contract
from haulmart.functions.columns import date_key, flag, match_key, week_of_year
from haulmart.operators.keys import assign_surrogate_key
from haulmart.sources.workspace import Workspace

Lookup = Callable[[str], DataFrame]

# Weekday numbers of Sunday and Saturday.
WEEKEND = (1, 7)


def _distinct(parts: list[DataFrame], name: str) -> DataFrame:
    """Distinct non-null values over several one-column frames, one shuffle."""
    merged = reduce(DataFrame.unionByName, parts)
    return merged.filter(F.col(name).isNotNull()).distinct()


def dim_date(clean: Lookup) -> DataFrame:
    """Calendar columns for the dates that occur; sales with a bad date are left out."""
    sales = clean("clean_sales").filter(F.col("IsBadDateKey") == 0).select(
        F.col("DateKey").alias("d")
    )
    deliveries = clean("clean_deliveries").select(
        F.explode(F.array("DeliveryDate", "ExpectedDeliveryDate")).alias("d")
    )
    exceptions = clean("clean_exceptions").select(F.col("DateReported").alias("d"))
    d: Column = F.col("d")
    weekday = F.dayofweek(d)
    calendar = _distinct([sales, deliveries, exceptions], "d").select(
        date_key(d).alias("DateKey"),
        d.alias("FullDate"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.month(d).alias("Month"),
        F.dayofmonth(d).alias("Day"),
        weekday.alias("Weekday"),
        flag(weekday.isin(*WEEKEND)).alias("IsWeekend"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "EEEE").alias("DayName"),
        week_of_year(d).alias("WeekOfYear"),
        F.date_format(d, "yyyy-MM").alias("MonthYear"),
        F.date_format(d, "yyyyMM").alias("YearMonth"),
        F.year(d).alias("FiscalYear"),
        F.lit(0).alias("IsHoliday"),
    )
    return conform(calendar, DIM_DATE)


@dataclass(frozen=True)
class ValueDimension:
    """A dimension of the distinct values of one column over some clean views."""

    table: str
    source_column: str
    views: tuple[str, ...]
    # Codes are compared without case; one deterministic spelling is kept.
    is_code: bool = False

    @property
    def contract(self) -> Contract:
        return contract(self.table)

    @property
    def key(self) -> str:
        return self.contract.column_names[0]

    @property
    def value(self) -> str:
        return self.contract.column_names[1]

    def values(self, clean: Lookup) -> DataFrame:
        parts = [clean(v).select(F.col(self.source_column).alias(self.value)) for v in self.views]
        distinct = _distinct(parts, self.value)
        if not self.is_code:
            return distinct
        return (
            distinct.groupBy(match_key(F.col(self.value)).alias("_code"))
            .agg(F.min(self.value).alias(self.value))
            .select(self.value)
        )

    def build(self, clean: Lookup, workspace: Workspace, **options) -> DataFrame:
        keyed = assign_surrogate_key(
            self.values(clean), self.value, self.key, workspace, **options
        )
        return conform(keyed, self.contract)


VALUE_DIMENSIONS = {
    d.table: d
    for d in (
        ValueDimension("dim_product_type", "ProductType", ("clean_sales",)),
        ValueDimension(
            "dim_region",
            "Region",
            ("clean_sales", "clean_deliveries", "clean_exceptions", "clean_routes"),
        ),
        ValueDimension("dim_driver", "DriverID", ("clean_deliveries", "clean_routes"), True),
        ValueDimension("dim_route", "RouteID", ("clean_deliveries", "clean_routes"), True),
        ValueDimension("dim_shipment_type", "ShipmentType", ("clean_deliveries",)),
        ValueDimension("dim_delivery_status", "DeliveryStatus", ("clean_deliveries",)),
        ValueDimension("dim_exception_type", "ExceptionType", ("clean_exceptions",)),
        ValueDimension(
            "dim_priority_flag", "PriorityFlag", ("clean_deliveries", "clean_exceptions")
        ),
    )
}


def build_dimension(table: str, clean: Lookup, workspace: Workspace) -> DataFrame:
    if table == "dim_date":
        return dim_date(clean)
    return VALUE_DIMENSIONS[table].build(clean, workspace)
