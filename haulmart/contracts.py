"""Table contracts: typed columns, NOT NULL, primary and foreign keys as data.

Spark enforces none of these on plain files, so every consumer (ingest
quarantine, gates, audits, catalog) reads them from here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("staging", "clean", "dw", "reporting")


@dataclass(frozen=True)
class Field:
    name: str
    sql_type: str
    nullable: bool = False
    comment: str | None = None
    default: str | None = None

    @property
    def base_type(self) -> str:
        return self.sql_type.split("(")[0]

    @property
    def arguments(self) -> tuple[int, ...]:
        return tuple(int(n) for n in re.findall(r"\d+", self.sql_type.partition("(")[2]))

    @property
    def max_length(self) -> int | None:
        return self.arguments[0] if self.base_type == "nvarchar" and self.arguments else None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref_table: str
    ref_column: str
    label: str


@dataclass(frozen=True)
class Contract:
    layer: str
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = field(default=())

    @property
    def qualified_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if not f.nullable]

    def __getitem__(self, column: str) -> Field:
        return next(f for f in self.fields if f.name == column)

    def spark_type(self, column: str) -> T.DataType:
        f = self[column]
        if f.base_type == "bit":
            # Flags arrive as booleans and are 0/1 integers once cleaned.
            return T.BooleanType() if self.layer == "staging" else T.IntegerType()
        if f.base_type == "decimal":
            return T.DecimalType(*f.arguments)
        return {
            "int": T.IntegerType(),
            "bigint": T.LongType(),
            "date": T.DateType(),
            "datetime2": T.TimestampType(),
            "nvarchar": T.StringType(),
            "varchar": T.StringType(),
        }[f.base_type]

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    self.spark_type(f.name),
                    True,
                    {"comment": f.comment} if f.comment else None,
                )
                for f in self.fields
            ]
        )


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Project ``df`` to exactly the contract's columns and types."""
    columns: list[Column] = [
        F.col(f.name).cast(contract.spark_type(f.name)).alias(f.name) for f in contract.fields
    ]
    return df.select(*columns)


def _staging(name: str, fields: list[Field], key: tuple[str, ...]) -> Contract:
    return Contract("staging", name, tuple(fields), key)


def _dim(name: str, key: str, value: Field) -> Contract:
    fields = (Field(key, "int", comment="Surrogate key, dense from 1"), value)
    return Contract("dw", name, fields, (key,))


def _fact(
    name: str, fields: list[Field], key: tuple[str, ...], refs: list[tuple[str, str, str, str]]
) -> Contract:
    load_ts = Field("load_ts", "datetime2", comment="Time of the load that wrote the row")
    return Contract(
        "dw", name, (*fields, load_ts), key, tuple(ForeignKey(*ref) for ref in refs)
    )


# Numeric business identifiers are bigint: an int runs out long before 100 TB of rows. A sale is
# named by a code. A staging region is as wide as the dimension that it feeds.
STAGING_DELIVERIES = _staging(
    "staging_deliveries",
    [
        Field("DeliveryID", "bigint"),
        Field("RouteID", "nvarchar(10)"),
        Field("DriverID", "nvarchar(50)"),
        Field("Region", "nvarchar(50)"),
        Field("ShipmentType", "nvarchar(20)"),
        Field("DeliveryDate", "date"),
        Field("ExpectedDeliveryDate", "date", True, "Planned date, empty when not scheduled"),
        Field("DeliveryStatus", "nvarchar(20)"),
        Field("PriorityFlag", "bit"),
    ],
    ("DeliveryID",),
)

STAGING_EXCEPTIONS = _staging(
    "staging_exceptions",
    [
        Field("ExceptionID", "bigint"),
        Field("DeliveryID", "bigint"),
        Field("ExceptionType", "nvarchar(50)"),
        Field("DateReported", "date"),
        Field("ResolvedDate", "date", True, "Empty while the exception is open"),
        Field("ResolutionTimeHours", "decimal(6,2)", True),
        Field("PriorityFlag", "bit"),
        Field("Region", "nvarchar(50)"),
    ],
    ("ExceptionID",),
)

STAGING_ROUTES = _staging(
    "staging_routes",
    [
        Field("RouteID", "nvarchar(10)"),
        Field("DriverID", "nvarchar(50)"),
        Field("PlannedStops", "int"),
        Field("ActualStops", "int"),
        Field("PlannedHours", "decimal(5,2)"),
        Field("ActualHours", "decimal(5,2)"),
        Field("Region", "nvarchar(50)"),
    ],
    ("RouteID", "DriverID"),
)

STAGING_SALES = _staging(
    "staging_sales",
    [
        Field("SalesID", "nvarchar(60)"),
        Field("DeliveryID", "bigint"),
        Field("DateKey", "date"),
        Field("ProductType", "nvarchar(50)"),
        Field("Region", "nvarchar(50)"),
        Field("UnitsSold", "int"),
        Field("SalesAmount", "decimal(10,2)"),
    ],
    ("SalesID",),
)

DIM_DATE = Contract(
    "dw",
    "dim_date",
    (
        Field("DateKey", "int", comment="YYYYMMDD"),
        Field("FullDate", "date"),
        Field("Year", "int"),
        Field("Quarter", "int"),
        Field("Month", "int"),
        Field("Day", "int"),
        Field("Weekday", "int", comment="1 = Sunday ... 7 = Saturday"),
        Field("IsWeekend", "bit"),
        Field("MonthName", "nvarchar(20)"),
        Field("DayName", "nvarchar(20)"),
        Field("WeekOfYear", "int", comment="Sunday-start week, the week of 1 January is 1"),
        Field("MonthYear", "nvarchar(7)", comment="YYYY-MM"),
        Field("YearMonth", "nvarchar(6)", comment="YYYYMM"),
        Field("FiscalYear", "int", comment="Same as the calendar year"),
        Field("IsHoliday", "bit", comment="Always 0 until a holiday table exists", default="0"),
    ),
    ("DateKey",),
)

DIM_PRODUCT_TYPE = _dim("dim_product_type", "ProductTypeID", Field("ProductType", "nvarchar(100)"))
DIM_REGION = _dim("dim_region", "RegionID", Field("Region", "nvarchar(50)"))
DIM_DRIVER = _dim(
    "dim_driver", "DriverID", Field("DriverCode", "nvarchar(50)", comment="Source driver code")
)
DIM_ROUTE = _dim(
    "dim_route", "RouteID", Field("RouteCode", "nvarchar(10)", comment="Source route code")
)
DIM_SHIPMENT_TYPE = _dim(
    "dim_shipment_type", "ShipmentTypeID", Field("ShipmentType", "nvarchar(50)")
)
DIM_DELIVERY_STATUS = _dim(
    "dim_delivery_status", "DeliveryStatusID", Field("DeliveryStatus", "nvarchar(50)")
)
DIM_EXCEPTION_TYPE = _dim(
    "dim_exception_type", "ExceptionTypeID", Field("ExceptionType", "nvarchar(100)")
)
DIM_PRIORITY_FLAG = _dim("dim_priority_flag", "PriorityFlagID", Field("PriorityFlag", "bit"))

FACT_SALES = _fact(
    "fact_sales",
    [
        Field("SalesID", "nvarchar(60)"),
        Field("DeliveryID", "bigint"),
        Field("DateKey", "int"),
        Field("ProductTypeID", "int"),
        Field("RegionID", "int"),
        Field("UnitsSold", "int"),
        Field("SalesAmount", "decimal(18,2)", comment="Total revenue of the transaction"),
    ],
    ("SalesID",),
    [
        ("DateKey", "dim_date", "DateKey", "date"),
        ("ProductTypeID", "dim_product_type", "ProductTypeID", "product"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
)

FACT_DELIVERIES = _fact(
    "fact_deliveries",
    [
        Field("DeliveryID", "bigint"),
        Field("RouteID", "int"),
        Field("DriverID", "int"),
        Field("ShipmentTypeID", "int"),
        Field("DeliveryDateKey", "int", comment="Actual date"),
        Field("ExpectedDeliveryDateKey", "int", comment="Planned date"),
        Field("DeliveryStatusID", "int"),
        Field("PriorityFlagID", "int"),
        Field("RegionID", "int"),
    ],
    ("DeliveryID",),
    [
        ("RouteID", "dim_route", "RouteID", "route"),
        ("DriverID", "dim_driver", "DriverID", "driver"),
        ("ShipmentTypeID", "dim_shipment_type", "ShipmentTypeID", "shipment"),
        ("DeliveryDateKey", "dim_date", "DateKey", "delivery_date"),
        ("ExpectedDeliveryDateKey", "dim_date", "DateKey", "expected_date"),
        ("DeliveryStatusID", "dim_delivery_status", "DeliveryStatusID", "status"),
        ("PriorityFlagID", "dim_priority_flag", "PriorityFlagID", "priority"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
)

FACT_ROUTES = _fact(
    "fact_routes",
    [
        Field("RouteID", "int"),
        Field("DriverID", "int"),
        Field("PlannedStops", "int"),
        Field("ActualStops", "int"),
        Field("PlannedHours", "decimal(10,2)"),
        Field("ActualHours", "decimal(10,2)"),
        Field("RegionID", "int"),
        Field("EfficiencyRatio", "decimal(10,4)", True, "ActualHours / PlannedHours"),
        Field("StopVariance", "int", True, "ActualStops - PlannedStops"),
    ],
    ("RouteID", "DriverID"),
    [
        ("RouteID", "dim_route", "RouteID", "route"),
        ("DriverID", "dim_driver", "DriverID", "driver"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
)

FACT_EXCEPTIONS = _fact(
    "fact_exceptions",
    [
        Field("ExceptionID", "bigint"),
        Field("DeliveryID", "bigint"),
        Field("ExceptionTypeID", "int"),
        Field("DateKey", "int", comment="Date reported"),
        Field("ResolutionTimeHours", "decimal(10,2)", True, "Empty while open"),
        Field("PriorityFlagID", "int"),
        Field("RegionID", "int"),
        Field("IsDateCorrected", "int", comment="1 when the resolved date was floored"),
    ],
    ("ExceptionID",),
    [
        ("ExceptionTypeID", "dim_exception_type", "ExceptionTypeID", "type"),
        ("DateKey", "dim_date", "DateKey", "date"),
        ("PriorityFlagID", "dim_priority_flag", "PriorityFlagID", "priority"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
)

STAGING = (STAGING_SALES, STAGING_DELIVERIES, STAGING_ROUTES, STAGING_EXCEPTIONS)
DIMENSIONS = (
    DIM_DATE,
    DIM_PRODUCT_TYPE,
    DIM_REGION,
    DIM_DRIVER,
    DIM_ROUTE,
    DIM_SHIPMENT_TYPE,
    DIM_DELIVERY_STATUS,
    DIM_EXCEPTION_TYPE,
    DIM_PRIORITY_FLAG,
)
FACTS = (FACT_SALES, FACT_DELIVERIES, FACT_ROUTES, FACT_EXCEPTIONS)
WAREHOUSE = DIMENSIONS + FACTS

CONTRACTS: dict[str, Contract] = {c.name: c for c in STAGING + WAREHOUSE}


def contract(table: str) -> Contract:
    return CONTRACTS[table]
