"""SQL twins of the registered queries, written against the test tables.

Each twin is a chain of common table expressions (feeds, staging, clean,
dimensions, facts, reports) and a final SELECT. Rounded ratios are computed in
whole numbers: the SQL engine divides decimals as doubles.
"""

from __future__ import annotations

import re

TODAY = "DATE '2024-12-31'"

# Columns of the stored tables: name, SQL type, whether it may be empty.
COLUMNS = {
    "staging_sales": [
        ("SalesID", "nvarchar(60)", False),
        ("DeliveryID", "bigint", False),
        ("DateKey", "date", False),
        ("ProductType", "nvarchar(50)", False),
        ("Region", "nvarchar(50)", False),
        ("UnitsSold", "int", False),
        ("SalesAmount", "decimal(10,2)", False),
    ],
    "staging_deliveries": [
        ("DeliveryID", "bigint", False),
        ("RouteID", "nvarchar(10)", False),
        ("DriverID", "nvarchar(50)", False),
        ("Region", "nvarchar(50)", False),
        ("ShipmentType", "nvarchar(20)", False),
        ("DeliveryDate", "date", False),
        ("ExpectedDeliveryDate", "date", True),
        ("DeliveryStatus", "nvarchar(20)", False),
        ("PriorityFlag", "bit", False),
    ],
    "staging_routes": [
        ("RouteID", "nvarchar(10)", False),
        ("DriverID", "nvarchar(50)", False),
        ("PlannedStops", "int", False),
        ("ActualStops", "int", False),
        ("PlannedHours", "decimal(5,2)", False),
        ("ActualHours", "decimal(5,2)", False),
        ("Region", "nvarchar(50)", False),
    ],
    "staging_exceptions": [
        ("ExceptionID", "bigint", False),
        ("DeliveryID", "bigint", False),
        ("ExceptionType", "nvarchar(50)", False),
        ("DateReported", "date", False),
        ("ResolvedDate", "date", True),
        ("ResolutionTimeHours", "decimal(6,2)", True),
        ("PriorityFlag", "bit", False),
        ("Region", "nvarchar(50)", False),
    ],
    "dim_date": [
        ("DateKey", "int", False),
        ("FullDate", "date", False),
        ("Year", "int", False),
        ("Quarter", "int", False),
        ("Month", "int", False),
        ("Day", "int", False),
        ("Weekday", "int", False),
        ("IsWeekend", "bit", False),
        ("MonthName", "nvarchar(20)", False),
        ("DayName", "nvarchar(20)", False),
        ("WeekOfYear", "int", False),
        ("MonthYear", "nvarchar(7)", False),
        ("YearMonth", "nvarchar(6)", False),
        ("FiscalYear", "int", False),
        ("IsHoliday", "bit", False),
    ],
    "dim_product_type": [
        ("ProductTypeID", "int", False),
        ("ProductType", "nvarchar(100)", False),
    ],
    "dim_region": [
        ("RegionID", "int", False),
        ("Region", "nvarchar(50)", False),
    ],
    "dim_driver": [
        ("DriverID", "int", False),
        ("DriverCode", "nvarchar(50)", False),
    ],
    "dim_route": [
        ("RouteID", "int", False),
        ("RouteCode", "nvarchar(10)", False),
    ],
    "dim_shipment_type": [
        ("ShipmentTypeID", "int", False),
        ("ShipmentType", "nvarchar(50)", False),
    ],
    "dim_delivery_status": [
        ("DeliveryStatusID", "int", False),
        ("DeliveryStatus", "nvarchar(50)", False),
    ],
    "dim_exception_type": [
        ("ExceptionTypeID", "int", False),
        ("ExceptionType", "nvarchar(100)", False),
    ],
    "dim_priority_flag": [
        ("PriorityFlagID", "int", False),
        ("PriorityFlag", "bit", False),
    ],
    "fact_sales": [
        ("SalesID", "nvarchar(60)", False),
        ("DeliveryID", "bigint", False),
        ("DateKey", "int", False),
        ("ProductTypeID", "int", False),
        ("RegionID", "int", False),
        ("UnitsSold", "int", False),
        ("SalesAmount", "decimal(18,2)", False),
        ("load_ts", "datetime2", False),
    ],
    "fact_deliveries": [
        ("DeliveryID", "bigint", False),
        ("RouteID", "int", False),
        ("DriverID", "int", False),
        ("ShipmentTypeID", "int", False),
        ("DeliveryDateKey", "int", False),
        ("ExpectedDeliveryDateKey", "int", False),
        ("DeliveryStatusID", "int", False),
        ("PriorityFlagID", "int", False),
        ("RegionID", "int", False),
        ("load_ts", "datetime2", False),
    ],
    "fact_routes": [
        ("RouteID", "int", False),
        ("DriverID", "int", False),
        ("PlannedStops", "int", False),
        ("ActualStops", "int", False),
        ("PlannedHours", "decimal(10,2)", False),
        ("ActualHours", "decimal(10,2)", False),
        ("RegionID", "int", False),
        ("EfficiencyRatio", "decimal(10,4)", True),
        ("StopVariance", "int", True),
        ("load_ts", "datetime2", False),
    ],
    "fact_exceptions": [
        ("ExceptionID", "bigint", False),
        ("DeliveryID", "bigint", False),
        ("ExceptionTypeID", "int", False),
        ("DateKey", "int", False),
        ("ResolutionTimeHours", "decimal(10,2)", True),
        ("PriorityFlagID", "int", False),
        ("RegionID", "int", False),
        ("IsDateCorrected", "int", False),
        ("load_ts", "datetime2", False),
    ],
}
PRIMARY_KEYS = {
    "staging_sales": ("SalesID",),
    "staging_deliveries": ("DeliveryID",),
    "staging_routes": ("RouteID", "DriverID",),
    "staging_exceptions": ("ExceptionID",),
    "dim_date": ("DateKey",),
    "dim_product_type": ("ProductTypeID",),
    "dim_region": ("RegionID",),
    "dim_driver": ("DriverID",),
    "dim_route": ("RouteID",),
    "dim_shipment_type": ("ShipmentTypeID",),
    "dim_delivery_status": ("DeliveryStatusID",),
    "dim_exception_type": ("ExceptionTypeID",),
    "dim_priority_flag": ("PriorityFlagID",),
    "fact_sales": ("SalesID",),
    "fact_deliveries": ("DeliveryID",),
    "fact_routes": ("RouteID", "DriverID",),
    "fact_exceptions": ("ExceptionID",),
}
# Foreign keys of the facts: column, dimension, its key, short name of the check.
FOREIGN_KEYS = {
    "fact_sales": [
        ("DateKey", "dim_date", "DateKey", "date"),
        ("ProductTypeID", "dim_product_type", "ProductTypeID", "product"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
    "fact_deliveries": [
        ("RouteID", "dim_route", "RouteID", "route"),
        ("DriverID", "dim_driver", "DriverID", "driver"),
        ("ShipmentTypeID", "dim_shipment_type", "ShipmentTypeID", "shipment"),
        ("DeliveryDateKey", "dim_date", "DateKey", "delivery_date"),
        ("ExpectedDeliveryDateKey", "dim_date", "DateKey", "expected_date"),
        ("DeliveryStatusID", "dim_delivery_status", "DeliveryStatusID", "status"),
        ("PriorityFlagID", "dim_priority_flag", "PriorityFlagID", "priority"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
    "fact_routes": [
        ("RouteID", "dim_route", "RouteID", "route"),
        ("DriverID", "dim_driver", "DriverID", "driver"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
    "fact_exceptions": [
        ("ExceptionTypeID", "dim_exception_type", "ExceptionTypeID", "type"),
        ("DateKey", "dim_date", "DateKey", "date"),
        ("PriorityFlagID", "dim_priority_flag", "PriorityFlagID", "priority"),
        ("RegionID", "dim_region", "RegionID", "region"),
    ],
}
# Those that the warehouse gate checks one by one, and those of the health audit.
GATE_COLUMNS = {
    "fact_sales": ["DateKey", "ProductTypeID", "RegionID"],
    "fact_deliveries": ["RouteID", "DriverID", "DeliveryStatusID"],
    "fact_exceptions": ["ExceptionTypeID"],
    "fact_routes": ["RouteID", "DriverID"],
}
AUDIT_COLUMNS = {
    "fact_sales": ["DateKey", "ProductTypeID", "RegionID"],
    "fact_deliveries": ["RouteID", "DriverID", "DeliveryStatusID"],
    "fact_exceptions": ["ExceptionTypeID", "RegionID"],
    "fact_routes": ["RouteID", "DriverID", "RegionID"],
}
STAGING_NAMES = ["staging_sales", "staging_deliveries", "staging_routes", "staging_exceptions"]
DIM_NAMES = [t for t in COLUMNS if t.startswith("dim_")]
FACT_NAMES = list(FOREIGN_KEYS)
DW_NAMES = DIM_NAMES + FACT_NAMES
STORED = [("staging", t) for t in STAGING_NAMES] + [("dw", t) for t in DW_NAMES]

FEEDS = {
    "customer_region": """
  SELECT c.c_custkey, c.c_nationkey, r.r_name AS Region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "rows_sales": """
  SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                   strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d')) AS SalesID, l.l_orderkey AS DeliveryID,
         CAST(l.l_shipdate AS DATE) AS DateKey, p.p_type AS ProductType, cr.Region,
         CAST(l.l_quantity AS INTEGER) AS UnitsSold,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS SalesAmount
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer_region cr ON o.o_custkey = cr.c_custkey""",
    "shipped": """
  SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS shipped, min(l_suppkey) AS supplier
  FROM lineitem GROUP BY l_orderkey""",
    "rows_deliveries": """
  SELECT o.o_orderkey AS DeliveryID, 'RT-' || cr.c_nationkey AS RouteID,
         'DRV-' || s.supplier AS DriverID, cr.Region, o.o_orderpriority AS ShipmentType,
         s.shipped AS DeliveryDate,
         CASE WHEN o.o_orderkey % 50 <> 0 THEN CAST(o.o_orderdate AS DATE) + 60 END
           AS ExpectedDeliveryDate,
         o.o_orderstatus AS DeliveryStatus,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS PriorityFlag
  FROM orders o JOIN customer_region cr ON o.o_custkey = cr.c_custkey
  LEFT JOIN shipped s ON o.o_orderkey = s.l_orderkey""",
    "rows_exceptions": """
  SELECT e.event_id AS ExceptionID, e.user_id AS DeliveryID, e.event_type AS ExceptionType,
         CAST(e.ts AS DATE) AS DateReported,
         CASE WHEN e.event_id % 3 <> 0
              THEN CAST(e.ts AS DATE) + (CAST(floor(e.value / 24) AS INTEGER) - 1) END
           AS ResolvedDate,
         CASE WHEN e.event_id % 5 = 0 THEN CAST(-1 AS DECIMAL(6,2))
              WHEN e.event_id % 4 = 0 THEN NULL
              ELSE CAST(e.value AS DECIMAL(6,2)) END AS ResolutionTimeHours,
         CAST(e.event_id % 2 AS INTEGER) AS PriorityFlag, cr.Region
  FROM events e JOIN customer_region cr ON e.user_id = cr.c_custkey""",
    "rows_routes": """
  SELECT 'RT-' || cr.c_nationkey AS RouteID, 'DRV-' || l.l_suppkey AS DriverID,
         CAST(count(DISTINCT l.l_orderkey) AS INTEGER) AS PlannedStops,
         CAST(count(CASE WHEN l.l_returnflag <> 'R' THEN 1 END) AS INTEGER) AS ActualStops,
         CAST(sum(CAST(l.l_quantity AS DECIMAL(10,2))) * 0.1 AS DECIMAL(10,2)) AS PlannedHours,
         CAST(sum(CAST(l.l_quantity AS DECIMAL(10,2))
                  * (1 + CAST(l.l_tax AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))))
              * 0.1 AS DECIMAL(10,2)) AS ActualHours,
         cr.Region
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer_region cr ON o.o_custkey = cr.c_custkey
  GROUP BY cr.c_nationkey, l.l_suppkey, cr.Region""",
}

# Rows added by rule, per feed: the number that the rules count by, how often they apply, the key
# of rows that break rules of the gates, and what is wrong with them.
LATE = "DATE '2101-03-01'"
ODD = {
    "sales": (
        "DeliveryID",
        400,
        {"SalesID": "SalesID || '-odd'"},
        [{"UnitsSold": "0"}, {"DateKey": LATE}, {"SalesAmount": "NULL"}, {"DeliveryID": "-DeliveryID"}],
    ),
    "deliveries": (
        "DeliveryID",
        400,
        {"DeliveryID": "-DeliveryID"},
        [
            {"RouteID": "NULL"},
            {"DeliveryDate": LATE, "ExpectedDeliveryDate": LATE},
            {"DeliveryStatus": "' delivered '"},
        ],
    ),
    "exceptions": (
        "ExceptionID",
        400,
        {"ExceptionID": "-ExceptionID"},
        [{"DateReported": "NULL"}, {"DeliveryID": "-DeliveryID"}],
    ),
    "routes": (
        "PlannedStops",
        20,
        {"DriverID": "DriverID || '-' || RouteID || '-odd'"},
        [{"RouteID": "NULL"}, {"PlannedHours": "0"}],
    ),
}
# What lands as a file besides: copies, other regions under the same key, too long and empty ones.
REJECTED = [{}, {"Region": "'ZZ'"}, {"Region": "repeat('LONG ', 11)"}, {"Region": "NULL"}]


def _changed(source: str, where: str, changes: dict[str, str]) -> str:
    replaced = ", ".join(f"{sql} AS {column}" for column, sql in changes.items())
    star = f"* REPLACE ({replaced})" if replaced else "*"
    return f"SELECT {star} FROM {source} WHERE {where}"


for _t, (_by, _every, _key, _faults) in ODD.items():
    FEEDS[f"feed_{_t}"] = " UNION ALL ".join(
        [f"SELECT * FROM rows_{_t}"]
        + [
            _changed(f"rows_{_t}", f"{_by} % {_every} = {7 + i}", {**_key, **fault})
            for i, fault in enumerate(_faults)
        ]
    )
    FEEDS[f"landed_{_t}"] = " UNION ALL ".join(
        [f"SELECT * FROM feed_{_t}"]
        + [
            _changed(f"feed_{_t}", f"{_by} % {_every} = {i}", fault)
            for i, fault in enumerate(REJECTED)
        ]
    )

# What the loader accepts from a feed file, per table.
LONG = "(Region IS NOT NULL AND length(Region) > 50)"
MISSING = {
    "sales": "SalesID IS NULL OR DeliveryID IS NULL OR DateKey IS NULL OR ProductType IS NULL "
    "OR Region IS NULL OR UnitsSold IS NULL OR SalesAmount IS NULL",
    "deliveries": "DeliveryID IS NULL OR RouteID IS NULL OR DriverID IS NULL OR Region IS NULL "
    "OR ShipmentType IS NULL OR DeliveryDate IS NULL OR DeliveryStatus IS NULL "
    "OR PriorityFlag IS NULL",
    "routes": "RouteID IS NULL OR DriverID IS NULL OR PlannedStops IS NULL OR ActualStops IS NULL "
    "OR PlannedHours IS NULL OR ActualHours IS NULL OR Region IS NULL",
    "exceptions": "ExceptionID IS NULL OR DeliveryID IS NULL OR ExceptionType IS NULL "
    "OR DateReported IS NULL OR PriorityFlag IS NULL OR Region IS NULL",
}
UNREADABLE = {
    "sales": "FALSE",
    "deliveries": "FALSE",
    "routes": "coalesce(PlannedHours >= 1000, FALSE) OR coalesce(ActualHours >= 1000, FALSE)",
    "exceptions": "FALSE",
}
KEYS = {
    "sales": "SalesID",
    "deliveries": "DeliveryID",
    "routes": "RouteID, DriverID",
    "exceptions": "ExceptionID",
}


def _staging(strict: bool) -> dict[str, str]:
    parts = {}
    for t, key in KEYS.items():
        source = f"landed_{t}" if strict else f"feed_{t}"
        accepted = (
            f"NOT ({UNREADABLE[t]}) AND NOT ({LONG}) AND NOT ({MISSING[t]})" if strict else "TRUE"
        )
        parts[f"staging_{t}"] = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY Region) AS rn
    FROM {source} WHERE {accepted}) WHERE rn = 1"""
    return parts


CLEAN = {
    "clean_sales": """
  SELECT SalesID, DeliveryID,
         CASE WHEN DateKey BETWEEN DATE '1900-01-01' AND DATE '2100-12-31' THEN DateKey END
           AS DateKey,
         CASE WHEN DateKey BETWEEN DATE '1900-01-01' AND DATE '2100-12-31' THEN 0 ELSE 1 END
           AS IsBadDateKey,
         upper(trim(ProductType)) AS ProductType, upper(trim(Region)) AS Region,
         UnitsSold, SalesAmount
  FROM staging_sales
  WHERE SalesID IS NOT NULL AND DeliveryID IS NOT NULL AND DateKey IS NOT NULL
    AND UnitsSold > 0 AND SalesAmount > 0""",
    "clean_deliveries": """
  SELECT DeliveryID, RouteID, DriverID, upper(trim(Region)) AS Region,
         upper(trim(ShipmentType)) AS ShipmentType, DeliveryDate, ExpectedDeliveryDate,
         CASE WHEN DeliveryDate > ExpectedDeliveryDate THEN 'LATE'
              ELSE upper(trim(DeliveryStatus)) END AS DeliveryStatus,
         CASE WHEN PriorityFlag = 1 THEN 1 ELSE 0 END AS PriorityFlag
  FROM staging_deliveries
  WHERE DeliveryID IS NOT NULL AND RouteID IS NOT NULL AND DriverID IS NOT NULL
    AND DeliveryDate IS NOT NULL AND ExpectedDeliveryDate IS NOT NULL""",
    "clean_exceptions": """
  SELECT ExceptionID, DeliveryID, upper(trim(ExceptionType)) AS ExceptionType, DateReported,
         CASE WHEN ResolvedDate IS NULL THEN NULL
              WHEN ResolvedDate < DateReported THEN DateReported
              ELSE ResolvedDate END AS ResolvedDate,
         CASE WHEN ResolvedDate IS NOT NULL AND ResolvedDate < DateReported THEN 1 ELSE 0 END
           AS IsDateCorrected,
         CAST(CASE WHEN ResolutionTimeHours >= 0 THEN ResolutionTimeHours
              WHEN ResolvedDate IS NOT NULL THEN
                24 * (CASE WHEN ResolvedDate < DateReported THEN 0
                      ELSE date_diff('day', DateReported, ResolvedDate) END)
              END AS DECIMAL(10,2)) AS ResolutionTimeHours,
         CASE WHEN PriorityFlag = 1 THEN 1 ELSE 0 END AS PriorityFlag,
         upper(trim(Region)) AS Region
  FROM staging_exceptions
  WHERE ExceptionID IS NOT NULL AND DeliveryID IS NOT NULL AND DateReported IS NOT NULL""",
    "clean_routes": """
  SELECT RouteID, DriverID, PlannedStops, ActualStops, PlannedHours, ActualHours,
         upper(trim(Region)) AS Region,
         CAST((20000 * CAST(ActualHours * 100 AS BIGINT) + CAST(PlannedHours * 100 AS BIGINT))
           // (2 * CAST(PlannedHours * 100 AS BIGINT)) AS BIGINT) AS ratio4,
         ActualStops - PlannedStops AS StopVariance
  FROM staging_routes
  WHERE RouteID IS NOT NULL AND DriverID IS NOT NULL AND PlannedStops > 0 AND ActualStops > 0
    AND PlannedHours > 0 AND ActualHours > 0""",
}


def _value_dim(key: str, value: str, *sources: tuple[str, str]) -> str:
    union = " UNION ".join(f"SELECT DISTINCT {c} AS v FROM {view}" for view, c in sources)
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS {key}, v AS {value} "
        f"FROM ({union}) WHERE v IS NOT NULL"
    )


DIMS = {
    "dim_date": """
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate,
         CAST(year(d) AS INTEGER) AS "Year", CAST(quarter(d) AS INTEGER) AS "Quarter",
         CAST(month(d) AS INTEGER) AS "Month", CAST(day(d) AS INTEGER) AS "Day",
         CAST(dayofweek(d) + 1 AS INTEGER) AS Weekday,
         CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
         monthname(d) AS MonthName, dayname(d) AS DayName,
         CAST((dayofyear(d) + dayofweek(CAST(date_trunc('year', d) AS DATE)) - 1) // 7 + 1
           AS INTEGER) AS WeekOfYear,
         strftime(d, '%Y-%m') AS MonthYear, strftime(d, '%Y%m') AS YearMonth,
         CAST(year(d) AS INTEGER) AS FiscalYear, 0 AS IsHoliday
  FROM (SELECT DateKey AS d FROM clean_sales WHERE IsBadDateKey = 0
        UNION SELECT DeliveryDate FROM clean_deliveries
        UNION SELECT ExpectedDeliveryDate FROM clean_deliveries
        UNION SELECT DateReported FROM clean_exceptions)""",
    "dim_product_type": _value_dim("ProductTypeID", "ProductType", ("clean_sales", "ProductType")),
    "dim_region": _value_dim(
        "RegionID",
        "Region",
        *[(f"clean_{t}", "Region") for t in ("sales", "deliveries", "exceptions", "routes")],
    ),
    "dim_driver": _value_dim(
        "DriverID", "DriverCode", ("clean_deliveries", "DriverID"), ("clean_routes", "DriverID")
    ),
    "dim_route": _value_dim(
        "RouteID", "RouteCode", ("clean_deliveries", "RouteID"), ("clean_routes", "RouteID")
    ),
    "dim_shipment_type": _value_dim(
        "ShipmentTypeID", "ShipmentType", ("clean_deliveries", "ShipmentType")
    ),
    "dim_delivery_status": _value_dim(
        "DeliveryStatusID", "DeliveryStatus", ("clean_deliveries", "DeliveryStatus")
    ),
    "dim_exception_type": _value_dim(
        "ExceptionTypeID", "ExceptionType", ("clean_exceptions", "ExceptionType")
    ),
    "dim_priority_flag": _value_dim(
        "PriorityFlagID",
        "PriorityFlag",
        ("clean_deliveries", "PriorityFlag"),
        ("clean_exceptions", "PriorityFlag"),
    ),
}

STAMP = f"CAST({TODAY} AS TIMESTAMP) AS load_ts"

FACT_TABLES = {
    "fact_sales": f"""
  SELECT s.SalesID, s.DeliveryID, d.DateKey, p.ProductTypeID, r.RegionID, s.UnitsSold,
         s.SalesAmount, {STAMP}
  FROM clean_sales s JOIN dim_date d ON s.DateKey = d.FullDate
  JOIN dim_product_type p ON s.ProductType = p.ProductType
  JOIN dim_region r ON s.Region = r.Region
  WHERE s.IsBadDateKey = 0""",
    "fact_deliveries": f"""
  SELECT c.DeliveryID, rt.RouteID, dr.DriverID, st.ShipmentTypeID,
         da.DateKey AS DeliveryDateKey, de.DateKey AS ExpectedDeliveryDateKey,
         ds.DeliveryStatusID, pf.PriorityFlagID, r.RegionID, {STAMP}
  FROM clean_deliveries c
  JOIN dim_route rt ON c.RouteID = rt.RouteCode
  JOIN dim_driver dr ON c.DriverID = dr.DriverCode
  JOIN dim_shipment_type st ON c.ShipmentType = st.ShipmentType
  JOIN dim_delivery_status ds ON c.DeliveryStatus = ds.DeliveryStatus
  JOIN dim_priority_flag pf ON c.PriorityFlag = pf.PriorityFlag
  JOIN dim_region r ON c.Region = r.Region
  JOIN dim_date da ON c.DeliveryDate = da.FullDate
  JOIN dim_date de ON c.ExpectedDeliveryDate = de.FullDate""",
    "fact_routes": f"""
  SELECT rt.RouteID, dr.DriverID, c.PlannedStops, c.ActualStops, c.PlannedHours, c.ActualHours,
         r.RegionID, c.ratio4, c.ratio4 / 10000.0 AS EfficiencyRatio, c.StopVariance, {STAMP}
  FROM clean_routes c
  JOIN dim_route rt ON c.RouteID = rt.RouteCode
  JOIN dim_driver dr ON c.DriverID = dr.DriverCode
  JOIN dim_region r ON c.Region = r.Region""",
    "fact_exceptions": f"""
  SELECT c.ExceptionID, c.DeliveryID, et.ExceptionTypeID, d.DateKey, c.ResolutionTimeHours,
         pf.PriorityFlagID, r.RegionID, c.IsDateCorrected, {STAMP}
  FROM clean_exceptions c
  JOIN dim_exception_type et ON c.ExceptionType = et.ExceptionType
  JOIN dim_priority_flag pf ON c.PriorityFlag = pf.PriorityFlag
  JOIN dim_region r ON c.Region = r.Region
  JOIN dim_date d ON c.DateReported = d.FullDate""",
}

REPORTS = {
    "rpt_sales_summary": """
  SELECT s.SalesID, s.DeliveryID, d.FullDate AS SaleDate, d."Year" AS SaleYear,
         d."Quarter" AS SaleQuarter, d."Month" AS SaleMonth, d.MonthName AS SaleMonthName,
         p.ProductType, r.Region, s.UnitsSold, s.SalesAmount
  FROM fact_sales s JOIN dim_product_type p USING (ProductTypeID)
  JOIN dim_region r USING (RegionID) JOIN dim_date d USING (DateKey)""",
    "rpt_delivery_performance": """
  SELECT f.DeliveryID, rt.RouteCode AS Route, dr.DriverCode AS Driver, r.Region,
         st.ShipmentType, da.FullDate AS DeliveryDate, de.FullDate AS ExpectedDeliveryDate,
         ds.DeliveryStatus, pf.PriorityFlag AS IsPriority
  FROM fact_deliveries f JOIN dim_route rt USING (RouteID) JOIN dim_driver dr USING (DriverID)
  JOIN dim_shipment_type st USING (ShipmentTypeID)
  JOIN dim_delivery_status ds USING (DeliveryStatusID)
  JOIN dim_priority_flag pf USING (PriorityFlagID) JOIN dim_region r USING (RegionID)
  JOIN dim_date da ON f.DeliveryDateKey = da.DateKey
  JOIN dim_date de ON f.ExpectedDeliveryDateKey = de.DateKey""",
    "rpt_exception_dashboard": """
  SELECT f.ExceptionID, f.DeliveryID, et.ExceptionType, d.FullDate AS DateReported,
         f.ResolutionTimeHours, pf.PriorityFlag AS IsPriority, f.IsDateCorrected, r.Region
  FROM fact_exceptions f JOIN dim_exception_type et USING (ExceptionTypeID)
  JOIN dim_priority_flag pf USING (PriorityFlagID) JOIN dim_region r USING (RegionID)
  JOIN dim_date d USING (DateKey)""",
    "rpt_route_efficiency": """
  SELECT rt.RouteCode AS Route, dr.DriverCode AS Driver, r.Region, f.PlannedStops, f.ActualStops,
         f.PlannedHours, f.ActualHours, f.ratio4, f.EfficiencyRatio, f.StopVariance
  FROM fact_routes f JOIN dim_route rt USING (RouteID) JOIN dim_driver dr USING (DriverID)
  JOIN dim_region r USING (RegionID)""",
}


def _with(tables: dict[str, str], select: str) -> str:
    """The select behind just the tables it needs, each computed once."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        text = pending.pop()
        for name in set(re.findall(r"\w+", text)) & tables.keys() - needed:
            needed.add(name)
            pending.append(tables[name])
    if not needed:
        return select
    chain = ",\n".join(
        f"{name} AS MATERIALIZED ({body})" for name, body in tables.items() if name in needed
    )
    return f"WITH {chain}\n{select}"


RELAXED = {**FEEDS, **_staging(False), **CLEAN, **DIMS, **FACT_TABLES, **REPORTS}
STRICT = {**FEEDS, **_staging(True), **CLEAN, **DIMS, **FACT_TABLES, **REPORTS}


def q(select: str) -> str:
    return _with(RELAXED, select)


def strict(select: str) -> str:
    """Over the rows the feed loader accepts."""
    return _with(STRICT, select)


def dbl(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column}"


def avg6(scaled: str, digits: int) -> str:
    """Mean of whole numbers that carry ``digits`` decimals, half up to 6 digits."""
    s = f"CAST(sum({scaled}) AS HUGEINT)"
    n = f"CAST(count({scaled}) AS HUGEINT)"
    up = 10 ** (6 - digits)
    magnitude = f"((2 * abs({s}) * {up} + {n}) // (2 * {n}))"
    return f"CAST(CASE WHEN {s} < 0 THEN -{magnitude} ELSE {magnitude} END AS DOUBLE) / 1e6"


def pct2(part: str, whole: str) -> str:
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CAST((2 * {p} * 10000 + {w}) // (2 * {w}) AS DOUBLE) / 100.0"


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# --- sources ---------------------------------------------------------------

INGEST_COLUMNS = {
    "sales": f"SalesID, DeliveryID, DateKey, ProductType, Region, UnitsSold, {dbl('SalesAmount')}",
    "deliveries": "DeliveryID, RouteID, DriverID, Region, ShipmentType, DeliveryDate, "
    "ExpectedDeliveryDate, DeliveryStatus, PriorityFlag",
    "routes": "RouteID, DriverID, PlannedStops, ActualStops, "
    f"{dbl('PlannedHours')}, {dbl('ActualHours')}, Region",
    "exceptions": "ExceptionID, DeliveryID, ExceptionType, DateReported, ResolvedDate, "
    f"{dbl('ResolutionTimeHours')}, PriorityFlag, Region",
}


def _reject_counts() -> str:
    parts = []
    for t, key in KEYS.items():
        bad, long, missing = UNREADABLE[t], LONG, MISSING[t]
        feed = f"landed_{t}"
        good = f"NOT ({bad}) AND NOT ({long}) AND NOT ({missing})"
        for reason, count in (
            ("unreadable_value", f"SELECT count(*) FROM {feed} WHERE {bad}"),
            ("too_long", f"SELECT count(*) FROM {feed} WHERE NOT ({bad}) AND {long}"),
            (
                "missing_value",
                f"SELECT count(*) FROM {feed} WHERE NOT ({bad}) AND NOT ({long}) "
                f"AND ({missing})",
            ),
            (
                "duplicate_key",
                f"SELECT (SELECT count(*) FROM {feed} WHERE {good}) - "
                f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {feed} WHERE {good}))",
            ),
        ):
            parts.append(
                f"SELECT 'staging_{t}' AS table_name, '{reason}' AS reject_reason, "
                f"({count}) AS rejected_rows"
            )
    return f"SELECT * FROM ({union(parts)}) WHERE rejected_rows > 0"


def _record_key(t: str) -> str:
    return f"concat_ws('|', {KEYS[t]})"


def _null_rejects() -> str:
    parts = []
    for t in KEYS:
        required = [c for c, _, empty in COLUMNS[f"staging_{t}"] if not empty]
        missing = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required)
        parts.append(
            f"SELECT 'staging_{t}' AS table_name, {_record_key(t)} AS record_key, "
            f"concat_ws(',', {missing}) AS missing_columns, count(*) AS rejected_rows "
            f"FROM landed_{t} WHERE NOT ({UNREADABLE[t]}) AND NOT ({LONG}) AND ({MISSING[t]}) "
            "GROUP BY 1, 2, 3"
        )
    return union(parts)


def _key_rejects() -> str:
    return union(
        f"SELECT 'staging_{t}' AS table_name, {_record_key(t)} AS record_key, "
        f"count(*) - 1 AS rejected_rows FROM landed_{t} "
        f"WHERE NOT ({UNREADABLE[t]}) AND NOT ({LONG}) AND NOT ({MISSING[t]}) "
        f"GROUP BY {KEYS[t]} HAVING count(*) > 1"
        for t in KEYS
    )


def _counts(names, name_column="TableName", count_column="RowCount") -> str:
    return union(
        f"SELECT '{n}' AS {name_column}, (SELECT count(*) FROM {n}) AS {count_column}"
        for n in names
    )


VIEW_NAMES = [
    "clean_sales",
    "clean_deliveries",
    "clean_exceptions",
    "clean_routes",
    "rpt_sales_summary",
    "rpt_delivery_performance",
    "rpt_exception_dashboard",
    "rpt_route_efficiency",
]

BQ_SALES = f"""SELECT Region, ProductType, SaleYear, SaleMonth, count(*) AS Transactions,
  {dbl('sum(SalesAmount)', 'TotalRevenue')}
FROM rpt_sales_summary GROUP BY Region, ProductType, SaleYear, SaleMonth"""

SOURCES = {
    "parquet_scan": "SELECT l_orderkey, l_linenumber, l_quantity, "
    "CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem",
    **{
        f"ingest_{t}": strict(f"SELECT {cols} FROM staging_{t}")
        for t, cols in INGEST_COLUMNS.items()
    },
    "ingest_rejects": q(_reject_counts()),
    "ingest_notnull_quarantine": q(_null_rejects()),
    "ingest_pk_quarantine": q(_key_rejects()),
    "staging_atomic_load": strict(_counts(STAGING_NAMES)),
    "truncate_reload": q(f"SELECT {INGEST_COLUMNS['routes']} FROM staging_routes"),
    "dw_atomic_publish": strict(_counts(DW_NAMES)),
    "published_snapshot": strict(BQ_SALES),
    "publish_views": q(_counts(VIEW_NAMES)),
    "etl_step_log": strict(
        "SELECT 'Load ' || TableName AS StepName, RowCount AS RowsProcessed, "
        f"'SUCCESS' AS Status FROM ({_counts(STAGING_NAMES + DW_NAMES)})"
    ),
}

# --- layers ----------------------------------------------------------------

LAYERS = {
    **{f"staging_{t}": q(f"SELECT {cols} FROM staging_{t}") for t, cols in INGEST_COLUMNS.items()},
    "clean_sales": q(
        "SELECT SalesID, DeliveryID, DateKey, IsBadDateKey, ProductType, Region, UnitsSold, "
        f"{dbl('SalesAmount')} FROM clean_sales"
    ),
    "clean_deliveries": q("SELECT * FROM clean_deliveries"),
    "clean_exceptions": q(
        "SELECT ExceptionID, DeliveryID, ExceptionType, DateReported, ResolvedDate, "
        f"IsDateCorrected, {dbl('ResolutionTimeHours')}, PriorityFlag, Region "
        "FROM clean_exceptions"
    ),
    "clean_routes": q(
        f"SELECT RouteID, DriverID, PlannedStops, ActualStops, {dbl('PlannedHours')}, "
        f"{dbl('ActualHours')}, Region, ratio4 / 10000.0 AS EfficiencyRatio, StopVariance "
        "FROM clean_routes"
    ),
    **{t: q(f"SELECT * FROM {t}") for t in DIM_NAMES},
    "fact_sales": q(
        "SELECT SalesID, DeliveryID, DateKey, ProductTypeID, RegionID, UnitsSold, "
        f"{dbl('SalesAmount')} FROM fact_sales"
    ),
    "fact_deliveries": q("SELECT * EXCLUDE (load_ts) FROM fact_deliveries"),
    "fact_routes": q(
        f"SELECT RouteID, DriverID, PlannedStops, ActualStops, {dbl('PlannedHours')}, "
        f"{dbl('ActualHours')}, RegionID, EfficiencyRatio, StopVariance FROM fact_routes"
    ),
    "fact_exceptions": q(
        f"SELECT ExceptionID, DeliveryID, ExceptionTypeID, DateKey, "
        f"{dbl('ResolutionTimeHours')}, PriorityFlagID, RegionID, IsDateCorrected "
        "FROM fact_exceptions"
    ),
    "rpt_sales_summary": q(
        "SELECT SalesID, DeliveryID, SaleDate, SaleYear, SaleQuarter, SaleMonth, SaleMonthName, "
        f"ProductType, Region, UnitsSold, {dbl('SalesAmount')} FROM rpt_sales_summary"
    ),
    "rpt_delivery_performance": q("SELECT * FROM rpt_delivery_performance"),
    "rpt_exception_dashboard": q(
        f"SELECT ExceptionID, DeliveryID, ExceptionType, DateReported, "
        f"{dbl('ResolutionTimeHours')}, IsPriority, IsDateCorrected, Region "
        "FROM rpt_exception_dashboard"
    ),
    "rpt_route_efficiency": q(
        f"SELECT Route, Driver, Region, PlannedStops, ActualStops, {dbl('PlannedHours')}, "
        f"{dbl('ActualHours')}, EfficiencyRatio, StopVariance FROM rpt_route_efficiency"
    ),
    "orphan_rows": q(
        f"SELECT {INGEST_COLUMNS['sales']} FROM staging_sales s WHERE NOT EXISTS "
        "(SELECT 1 FROM clean_deliveries d WHERE d.DeliveryID = s.DeliveryID)"
    ),
}

# --- checks ----------------------------------------------------------------


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {child} f WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} d WHERE d.{key} = f.{column})"
    )


def _empty(table: str) -> str:
    return f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table}"


def _bad(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _nulls(table: str, *columns: str) -> str:
    terms = " + ".join(f"(count(*) - count({c}))" for c in columns)
    return f"SELECT {terms} FROM {table}"


STAGING_NULLS = {
    "sales": ("SalesID", "DeliveryID", "DateKey", "UnitsSold", "SalesAmount"),
    "deliveries": ("DeliveryID", "RouteID", "DriverID", "DeliveryDate", "DeliveryStatus"),
    "routes": ("RouteID", "DriverID"),
    "exceptions": ("ExceptionID", "DeliveryID", "DateReported"),
}
ROUTE_METRICS = "PlannedStops <= 0 OR ActualStops <= 0 OR PlannedHours <= 0 OR ActualHours <= 0"
OVERDUE = "DeliveryDate > ExpectedDeliveryDate AND DeliveryStatus <> 'LATE'"

# Fact, key as the clean view has it, rows that belong into the fact, the fact with that key.
LOADED_ROWS = [
    ("sales", "SalesID", " WHERE IsBadDateKey = 0", "fact_sales"),
    ("deliveries", "DeliveryID", "", "fact_deliveries"),
    ("exceptions", "ExceptionID", "", "fact_exceptions"),
    (
        "routes",
        "RouteID, DriverID",
        "",
        "(SELECT rt.RouteCode AS RouteID, dr.DriverCode AS DriverID FROM fact_routes f"
        " JOIN dim_route rt ON f.RouteID = rt.RouteID JOIN dim_driver dr ON f.DriverID = dr.DriverID)",
    ),
]

CHECKS = {
    **{
        f"stg_not_empty_{t}": _empty(f"staging_{t}")
        for t in ("sales", "deliveries", "routes", "exceptions")
    },
    **{f"stg_nulls_{t}": _nulls(f"staging_{t}", *cols) for t, cols in STAGING_NULLS.items()},
    "stg_positive_sales": _bad("staging_sales", "UnitsSold <= 0 OR SalesAmount <= 0"),
    "stg_positive_routes": _bad("staging_routes", ROUTE_METRICS),
    "stg_nonneg_resolution": _bad("staging_exceptions", "ResolutionTimeHours < 0"),
    "stg_ri_sales": _orphans("staging_sales", "DeliveryID", "staging_deliveries", "DeliveryID"),
    "stg_ri_exceptions": _orphans(
        "staging_exceptions", "DeliveryID", "staging_deliveries", "DeliveryID"
    ),
    "stg_range_delivery_date": _bad(
        "staging_deliveries", f"DeliveryDate < DATE '2000-01-01' OR DeliveryDate > {TODAY}"
    ),
    "stg_range_expected_date": _bad(
        "staging_deliveries",
        "ExpectedDeliveryDate < DATE '2000-01-01' "
        f"OR ExpectedDeliveryDate > {TODAY} + INTERVAL 1 YEAR",
    ),
    "stg_range_sales_date": _bad(
        "staging_sales", f"DateKey < DATE '2000-01-01' OR DateKey > {TODAY}"
    ),
    "stg_chronology": _bad("staging_exceptions", "ResolvedDate < DateReported"),
    **{
        f"cln_not_empty_{t}": _empty(f"clean_{t}")
        for t in ("sales", "deliveries", "exceptions", "routes")
    },
    "cln_required_sales": _bad(
        "clean_sales", "DateKey IS NULL OR SalesAmount IS NULL OR UnitsSold IS NULL"
    ),
    "cln_required_deliveries": _bad(
        "clean_deliveries", "DeliveryID IS NULL OR RouteID IS NULL OR DriverID IS NULL"
    ),
    "cln_late_rule": _bad("clean_deliveries", OVERDUE),
    "cln_priority_domain": _bad("clean_deliveries", "PriorityFlag NOT IN (0, 1)"),
    "cln_route_source_metrics": _bad(
        "staging_routes", f"RouteID IS NOT NULL AND DriverID IS NOT NULL AND ({ROUTE_METRICS})"
    ),
    "cln_ri_sales": _orphans("clean_sales", "DeliveryID", "clean_deliveries", "DeliveryID"),
    "cln_ri_exceptions": _orphans(
        "clean_exceptions", "DeliveryID", "clean_deliveries", "DeliveryID"
    ),
    **{f"dw_not_empty_{n}": _empty(n) for n in DW_NAMES},
    **{
        f"dw_null_keys_{t.removeprefix('fact_')}": _bad(
            t, " OR ".join(f"{column} IS NULL" for column, *_ in keys)
        )
        for t, keys in FOREIGN_KEYS.items()
    },
    **{
        f"dw_dup_pk_{t.removeprefix('fact_')}": "SELECT count(*) FROM (SELECT 1 FROM "
        f"{t} GROUP BY {', '.join(PRIMARY_KEYS[t])} HAVING count(*) > 1)"
        for t in FACT_NAMES
    },
    **{
        f"dw_rows_lost_{t}": "SELECT CAST(coalesce(sum(abs(n)), 0) AS BIGINT) FROM (SELECT sum(side) AS n FROM ("
        f"SELECT {key}, 1 AS side FROM clean_{t}{rule} UNION ALL SELECT {key}, -1 FROM {loaded}) GROUP BY ALL)"
        for t, key, rule, loaded in LOADED_ROWS
    },
    **{
        f"dw_fk_{t.removeprefix('fact_')}_{label}": _orphans(t, column, dim, key)
        for t, keys in FOREIGN_KEYS.items()
        for column, dim, key, label in keys
    },
    "dw_amount_positive": _bad("fact_sales", "SalesAmount <= 0"),
    "dw_units_positive": _bad("fact_sales", "UnitsSold <= 0"),
    "dw_hours_positive": _bad("fact_routes", "PlannedHours <= 0 OR ActualHours <= 0"),
    "dw_delivery_date_logic": "SELECT count(*) FROM fact_deliveries f "
    "JOIN dim_delivery_status s USING (DeliveryStatusID) "
    "WHERE s.DeliveryStatus <> 'LATE' AND f.DeliveryDateKey > f.ExpectedDeliveryDateKey",
}

STAGING_TITLES = {
    "stg_not_empty_sales": "staging_sales is not empty",
    "stg_not_empty_deliveries": "staging_deliveries is not empty",
    "stg_not_empty_routes": "staging_routes is not empty",
    "stg_not_empty_exceptions": "staging_exceptions is not empty",
    "stg_nulls_sales": "staging_sales has no null key fields",
    "stg_nulls_deliveries": "staging_deliveries has no null key fields",
    "stg_nulls_routes": "staging_routes has no null key fields",
    "stg_nulls_exceptions": "staging_exceptions has no null key fields",
    "stg_positive_sales": "staging_sales units and amount are positive",
    "stg_positive_routes": "staging_routes stops and hours are positive",
    "stg_nonneg_resolution": "staging_exceptions resolution hours are not negative",
    "stg_ri_sales": "staging_sales deliveries exist",
    "stg_ri_exceptions": "staging_exceptions deliveries exist",
    "stg_range_delivery_date": "staging_deliveries delivery date is plausible",
    "stg_range_expected_date": "staging_deliveries expected date is plausible",
    "stg_range_sales_date": "staging_sales date is plausible",
    "stg_chronology": "staging_exceptions are not resolved before reported",
}
CLEAN_TITLES = {
    "cln_not_empty_sales": "clean_sales is not empty",
    "cln_not_empty_deliveries": "clean_deliveries is not empty",
    "cln_not_empty_exceptions": "clean_exceptions is not empty",
    "cln_not_empty_routes": "clean_routes is not empty",
    "cln_required_sales": "clean_sales required fields are present",
    "cln_required_deliveries": "clean_deliveries required fields are present",
    "cln_late_rule": "clean_deliveries overdue rows are LATE",
    "cln_priority_domain": "clean_deliveries priority is 0 or 1",
    "cln_route_source_metrics": "staging_routes metrics are valid at the source",
    "cln_ri_sales": "clean_sales deliveries exist",
    "cln_ri_exceptions": "clean_exceptions deliveries exist",
}
WAREHOUSE_TITLES = {
    **{f"dw_not_empty_{t}": f"{t} is not empty" for t in DW_NAMES},
    **{f"dw_null_keys_{t.removeprefix('fact_')}": f"{t} has no null surrogate keys" for t in FACT_NAMES},
    **{f"dw_dup_pk_{t.removeprefix('fact_')}": f"{t} keys are unique" for t in FACT_NAMES},
    **{
        f"dw_rows_lost_{s}": f"fact_{s} has every row of clean_{s}"
        for s in ("sales", "deliveries", "routes", "exceptions")
    },
    "dw_amount_positive": "fact_sales amount is positive",
    "dw_units_positive": "fact_sales units are positive",
    "dw_hours_positive": "fact_routes hours are positive",
    "dw_delivery_date_logic": "fact_deliveries past their planned date are LATE",
}
REFERENCE_TITLES = {
    f"dw_fk_{t.removeprefix('fact_')}_{label}": f"{t}.{column} -> {dim}"
    for t, keys in FOREIGN_KEYS.items()
    for column, dim, _, label in keys
}
GATE_REFERENCES = {
    f"dw_fk_{t.removeprefix('fact_')}_{label}"
    for t, keys in FOREIGN_KEYS.items()
    for column, _, _, label in keys
    if column in GATE_COLUMNS[t]
}
SINGLE_CHECKS = [*STAGING_TITLES, *CLEAN_TITLES, *WAREHOUSE_TITLES, *GATE_REFERENCES]
TITLES = {**STAGING_TITLES, **CLEAN_TITLES, **WAREHOUSE_TITLES, **REFERENCE_TITLES}


def _result(key: str) -> str:
    return (
        f"SELECT '{TITLES[key]}' AS check_name, CAST(({CHECKS[key]}) AS BIGINT) AS bad_rows"
    )


def _report(layer: str, keys) -> str:
    rows = union(
        f"SELECT '{k}' AS check_id, '{TITLES[k]}' AS check_name, "
        f"CAST(({CHECKS[k]}) AS BIGINT) AS bad_rows"
        for k in keys
    )
    return (
        f"SELECT '{layer}' AS layer, check_id, check_name, bad_rows, severity, "
        "CASE WHEN bad_rows = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END "
        "AS status FROM (SELECT *, CASE WHEN check_id LIKE 'dw_rows_lost_%' THEN 'warn' "
        f"ELSE 'fail' END AS severity FROM ({rows}))"
    )


DW_KEYS = sorted({*WAREHOUSE_TITLES, *REFERENCE_TITLES})

FACT_VS_CLEAN = union(
    f"SELECT '{f}' AS FactTable, (SELECT count(*) FROM clean_{t}) AS CleanRows, "
    f"(SELECT count(*) FROM {f}) AS DWRows, "
    f"(SELECT count(*) FROM clean_{t}) - (SELECT count(*) FROM {f}) AS DroppedRows"
    for f in FACT_NAMES
    for t in [f.removeprefix("fact_")]
)


def _layer_counts(names) -> str:
    return union(
        f"SELECT '{s}' AS SchemaName, '{t}' AS TableName, (SELECT count(*) FROM {t}) AS RowCount"
        for s, t in names
    )


SALES_STATS = f"""{dbl('sum(SalesAmount)', 'TotalSales')},
  {avg6('CAST(SalesAmount * 100 AS BIGINT)', 2)} AS AvgSale,
  {dbl('min(SalesAmount)', 'MinSale')}, {dbl('max(SalesAmount)', 'MaxSale')}"""

GATES = {
    **{k: q(_result(k)) for k in SINGLE_CHECKS if not k.startswith("dw_not_empty_")},
    "gate_staging": q(_report("staging", STAGING_TITLES)),
    "gate_clean": q(_report("clean", CLEAN_TITLES)),
    "gate_dw": q(_report("dw", DW_KEYS)),
    "stg_row_counts": q(_counts(STAGING_NAMES)),
    "stg_null_detail": q(
        union(
            f"SELECT 'staging_{t}' AS TableName, '{c}' AS ColumnName, "
            f"(SELECT count(*) FROM staging_{t} WHERE {c} IS NULL) AS NullCount"
            for t, cols in STAGING_NULLS.items()
            for c in cols
        )
    ),
    "dw_not_empty": q(union(_result(f"dw_not_empty_{n}") for n in DW_NAMES)),
    "dw_fk_all": q(union(_result(k) for k in REFERENCE_TITLES)),
    "dw_fact_vs_clean": q(FACT_VS_CLEAN),
    "dw_row_counts": q(_layer_counts([("dw", n) for n in DW_NAMES])),
    "dw_sales_metric_summary": q(
        f"SELECT count(*) AS TotalTransactions, {SALES_STATS} FROM fact_sales"
    ),
}

# --- profiling -------------------------------------------------------------

VALID = {
    "sales": "SalesID IS NOT NULL AND DeliveryID IS NOT NULL AND DateKey IS NOT NULL "
    "AND UnitsSold > 0 AND SalesAmount > 0",
    "deliveries": "DeliveryID IS NOT NULL AND RouteID IS NOT NULL AND DriverID IS NOT NULL "
    "AND DeliveryDate IS NOT NULL AND ExpectedDeliveryDate IS NOT NULL",
    "exceptions": "ExceptionID IS NOT NULL AND DeliveryID IS NOT NULL AND DateReported IS NOT NULL",
    "routes": "RouteID IS NOT NULL AND DriverID IS NOT NULL AND PlannedStops > 0 "
    "AND ActualStops > 0 AND PlannedHours > 0 AND ActualHours > 0",
}


def _retention(t: str) -> str:
    clean = f"(SELECT count(*) FROM clean_{t})"
    valid = f"(SELECT count(*) FROM staging_{t} WHERE {VALID[t]})"
    total = f"(SELECT count(*) FROM staging_{t})"
    return (
        f"SELECT 'clean_{t}' AS ViewName, {clean} AS CleanRowCount, "
        f"{valid} AS StagingValidRowCount, {ratio(clean, valid)} AS RetentionRate, "
        f"{total} AS StagingRowCount, {ratio(clean, total)} AS StagingRetentionRate"
    )


PROFILE_NULLS = {
    "sales": STAGING_NULLS["sales"],
    "deliveries": STAGING_NULLS["deliveries"],
    "exceptions": STAGING_NULLS["exceptions"],
    "routes": (
        "RouteID",
        "DriverID",
        "PlannedStops",
        "ActualStops",
        "PlannedHours",
        "ActualHours",
    ),
}


def _scalar(name: str, sql: str) -> str:
    return q(f"SELECT ({sql}) AS {name}")


def _orphan_list(t: str, key: str) -> str:
    return q(
        f"SELECT {key}, DeliveryID, 'No matching delivery' AS Issue FROM clean_{t} c WHERE NOT "
        "EXISTS (SELECT 1 FROM clean_deliveries d WHERE d.DeliveryID = c.DeliveryID)"
    )


EFFICIENCY = f"""min(ratio4) / 10000.0 AS MinEfficiency, max(ratio4) / 10000.0 AS MaxEfficiency,
  {avg6('ratio4', 4)} AS AvgEfficiency"""

PROFILES = {
    **{f"prof_retention_{t}": q(_retention(t)) for t in VALID},
    **{
        f"prof_nulls_{t}": q(
            union(
                f"SELECT (SELECT count(*) FROM clean_{t} WHERE {c} IS NULL) AS NullCount, "
                f"'clean_{t}.{c}' AS FieldName"
                for c in cols
            )
        )
        for t, cols in PROFILE_NULLS.items()
    },
    "prof_incorrect_late": _scalar("IncorrectLateFlag", CHECKS["cln_late_rule"]),
    "prof_invalid_priority": _scalar("InvalidPriorityFlag", CHECKS["cln_priority_domain"]),
    "prof_date_corrected": _scalar(
        "DateCorrectedExceptions", _bad("clean_exceptions", "IsDateCorrected = 1")
    ),
    "prof_invalid_routes": _scalar("InvalidRouteMetrics", _bad("clean_routes", ROUTE_METRICS)),
    "prof_orphan_sales": _scalar("OrphanedSalesDeliveryIDs", CHECKS["cln_ri_sales"]),
    "prof_orphan_exceptions": _scalar(
        "OrphanedExceptionDeliveryIDs", CHECKS["cln_ri_exceptions"]
    ),
    "prof_nonpositive_sales": _scalar(
        "NegativeOrZeroSales", _bad("clean_sales", "UnitsSold <= 0 OR SalesAmount <= 0")
    ),
    "prof_future_deliveries": _scalar(
        "FutureDatedDeliveries", _bad("clean_deliveries", f"DeliveryDate > {TODAY}")
    ),
    "prof_future_exceptions": _scalar(
        "FutureDatedExceptions", _bad("clean_exceptions", f"DateReported > {TODAY}")
    ),
    "prof_sales_by_region": q(
        f"SELECT Region, count(*) AS Transactions, {SALES_STATS} FROM clean_sales GROUP BY Region"
    ),
    "prof_units_by_product": q(
        "SELECT ProductType, count(*) AS Transactions, CAST(sum(UnitsSold) AS BIGINT) AS "
        "TotalUnits, CAST(sum(UnitsSold) // count(*) AS INTEGER) AS AvgUnits, "
        "min(UnitsSold) AS MinUnits, max(UnitsSold) AS MaxUnits "
        "FROM clean_sales GROUP BY ProductType"
    ),
    "prof_status_distribution": q(
        "SELECT DeliveryStatus, count(*) AS RecordCount FROM clean_deliveries GROUP BY 1"
    ),
    "prof_route_efficiency": q(
        f"SELECT {EFFICIENCY}, min(StopVariance) AS MinStopVariance, "
        f"max(StopVariance) AS MaxStopVariance, {avg6('StopVariance', 0)} AS AvgStopVariance "
        "FROM clean_routes"
    ),
    "val_row_counts": q(
        union(
            f"SELECT '{t}' AS TableName, (SELECT count(*) FROM staging_{t}) AS StagingRows, "
            f"(SELECT count(*) FROM clean_{t}) AS CleanRows, (SELECT count(*) FROM staging_{t}) "
            f"- (SELECT count(*) FROM clean_{t}) AS DroppedRows"
            for t in VALID
        )
    ),
    "val_null_sales": q(
        f"SELECT SalesID, DeliveryID, DateKey, UnitsSold, {dbl('SalesAmount')}, "
        "'NULL critical field' AS Issue FROM clean_sales "
        "WHERE DateKey IS NULL OR SalesAmount IS NULL OR UnitsSold IS NULL"
    ),
    "val_null_deliveries": q(
        "SELECT DeliveryID, RouteID, DriverID, 'NULL critical field' AS Issue "
        "FROM clean_deliveries WHERE DeliveryID IS NULL OR RouteID IS NULL OR DriverID IS NULL"
    ),
    "val_null_exceptions": q(
        "SELECT ExceptionID, DeliveryID, DateReported, 'NULL critical field' AS Issue "
        "FROM clean_exceptions "
        "WHERE ExceptionID IS NULL OR DeliveryID IS NULL OR DateReported IS NULL"
    ),
    "val_late_rule_top20": q(
        "SELECT DeliveryID, DeliveryDate, ExpectedDeliveryDate, DeliveryStatus, "
        f"'Expected LATE status' AS Issue FROM clean_deliveries WHERE {OVERDUE} "
        "ORDER BY DeliveryID LIMIT 20"
    ),
    "val_priority_distribution": q(
        "SELECT PriorityFlag, count(*) AS RecordCount FROM clean_deliveries GROUP BY 1"
    ),
    "val_date_corrected": _scalar(
        "DateCorrectedCount", _bad("clean_exceptions", "IsDateCorrected = 1")
    ),
    "val_orphan_sales": _orphan_list("sales", "SalesID"),
    "val_orphan_exceptions": _orphan_list("exceptions", "ExceptionID"),
    "val_sales_profile": q(
        f"SELECT {dbl('min(SalesAmount)', 'MinSales')}, {dbl('max(SalesAmount)', 'MaxSales')}, "
        f"{avg6('CAST(SalesAmount * 100 AS BIGINT)', 2)} AS AvgSales, "
        f"{dbl('sum(SalesAmount)', 'TotalSales')}, count(*) AS RecordCount FROM clean_sales"
    ),
    "val_region_distribution": q(
        "SELECT Region, count(*) AS RecordCount FROM clean_sales GROUP BY 1"
    ),
    "val_route_profile": q(
        "SELECT min(ActualStops) AS MinStops, max(ActualStops) AS MaxStops, "
        f"{avg6('CAST(ActualHours * 100 AS BIGINT)', 2)} AS AvgHours, {EFFICIENCY} "
        "FROM clean_routes"
    ),
}

# --- audit -----------------------------------------------------------------

NULL_PROFILE = union(
    f"SELECT '{layer}' AS SchemaName, '{t}' AS TableName, '{c}' AS ColumnName, "
    f"count(*) - count({t}.\"{c}\") AS NullCount, count(*) AS TotalRows, "
    f"{pct2(f'count(*) - count({t}.' + chr(34) + c + chr(34) + ')', 'count(*)')} AS NullPct "
    f"FROM {t}"
    for layer, t in STORED
    for c, _, _ in COLUMNS[t]
)


def _duplicates(label: str, table: str, keys: tuple[str, ...]) -> str:
    return (
        f"SELECT '{label}' AS TableName, '{'+'.join(keys)}' AS PKColumns, "
        f"count(*) AS DuplicateGroupCount FROM {table} GROUP BY {', '.join(keys)} "
        "HAVING count(*) > 1"
    )


AUDIT_KEYS = [
    f"dw_fk_{t.removeprefix('fact_')}_{label}"
    for t, keys in FOREIGN_KEYS.items()
    for column, _, _, label in keys
    if column in AUDIT_COLUMNS[t]
]
# The date by which a fact is dated.
FACT_DATES = {
    "fact_sales": "DateKey",
    "fact_deliveries": "DeliveryDateKey",
    "fact_exceptions": "DateKey",
}

CONTRACTS = union(
    f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, '{kind}' AS SqlType, "
    f"(SELECT count(*) FROM {t} t WHERE t.\"{c}\" IS NULL) AS NullCount"
    for t in STAGING_NAMES + DW_NAMES
    for c, kind, empty in COLUMNS[t]
    if not empty
)

AUDITS = {
    "assign_surrogate_key": "SELECT CAST(row_number() OVER (ORDER BY l_orderkey) AS BIGINT) AS "
    "OrderID, l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem)",
    "table_contracts": q(CONTRACTS),
    "aud_row_counts": q(_layer_counts(STORED)),
    "aud_dup_keys": q(
        union(
            [_duplicates(f"{layer}.{t}", t, PRIMARY_KEYS[t]) for layer, t in STORED]
            + [
                _duplicates(f"feed.{t}", f"landed_{t}", PRIMARY_KEYS[f"staging_{t}"])
                for t in KEYS
            ]
        )
    ),
    "aud_dup_keys_routes": q(
        _duplicates("dw.fact_routes", "fact_routes", ("RouteID", "DriverID"))
    ),
    "aud_null_counts": q(f"SELECT * FROM ({NULL_PROFILE}) WHERE NullCount > 0"),
    "aud_null_over_20": q(f"SELECT * FROM ({NULL_PROFILE}) WHERE NullPct > 20"),
    "aud_freshness": q(
        union(
            f"SELECT '{t}' AS TableName, strftime(max(load_ts), '%Y-%m-%d') AS LastLoad, "
            f"count(*) AS RowCount, max({FACT_DATES.get(t, 'CAST(NULL AS INTEGER)')}) AS NewestDate "
            f"FROM {t}"
            for t in FACT_NAMES
        )
    ),
    "aud_fact_sizes": q(_counts(FACT_NAMES)),
    "aud_orphans": q(
        union(
            f"SELECT '{TITLES[k]}' AS CheckName, ({CHECKS[k]}) AS OrphanCount" for k in AUDIT_KEYS
        )
    ),
    "col_row_counts": q(_layer_counts(STORED)),
    "col_null_profile": q(f"SELECT * FROM ({NULL_PROFILE})"),
    "col_scorecard": q(
        "SELECT SchemaName, TableName, count(*) AS ColumnsChecked, "
        "count(CASE WHEN NullPct > 0 THEN 1 END) AS ColumnsWithNulls, "
        f"{avg6('CAST(round(NullPct * 100) AS BIGINT)', 2)} AS AvgNullPct, "
        f"max(NullPct) AS MaxNullPct FROM ({NULL_PROFILE}) GROUP BY SchemaName, TableName"
    ),
    "col_critical": q(f"SELECT * FROM ({NULL_PROFILE}) WHERE NullPct > 20"),
}

# --- measures --------------------------------------------------------------

LATE_COUNT = "count(CASE WHEN DeliveryStatus = 'LATE' THEN 1 END)"
ON_TIME = "count(CASE WHEN DeliveryStatus <> 'LATE' THEN 1 END)"
PRIORITY = "count(CASE WHEN IsPriority = 1 THEN 1 END)"
DAYS = "date_diff('day', ExpectedDeliveryDate, DeliveryDate)"
LATE_DAYS = f"sum(CASE WHEN DeliveryStatus = 'LATE' THEN {DAYS} END)"
RESOLUTION = (
    "count(*) AS Exceptions, count(ResolutionTimeHours) AS ResolvedExceptions, "
    f"{ratio('sum(ResolutionTimeHours)', 'count(ResolutionTimeHours)')} AS AvgResolutionHours"
)


def _plan_level(level: str) -> str:
    met = "count(CASE WHEN ActualHours <= PlannedHours AND ActualStops >= PlannedStops THEN 1 END)"
    return (
        f"SELECT '{level}' AS \"Level\", {level} AS Code, count(*) AS Pairs, "
        f"{dbl('sum(PlannedHours)', 'PlannedHours')}, {dbl('sum(ActualHours)', 'ActualHours')}, "
        "CAST(sum(PlannedStops) AS BIGINT) AS PlannedStops, "
        f"CAST(sum(ActualStops) AS BIGINT) AS ActualStops, {met} AS PairsMeetingPlan, "
        f"{ratio(met, 'count(*)')} AS MeetingPlanPct FROM rpt_route_efficiency GROUP BY {level}"
    )


MEASURES = {
    "kpi_total_revenue": q(
        f"SELECT {dbl('sum(SalesAmount)', 'TotalRevenue')} FROM rpt_sales_summary"
    ),
    "kpi_late_pct": q(
        f"SELECT count(*) AS Deliveries, {LATE_COUNT} AS LateDeliveries, "
        f"{ratio(LATE_COUNT, 'count(*)')} AS LatePct FROM rpt_delivery_performance"
    ),
    "kpi_avg_resolution": q(
        "SELECT count(ResolutionTimeHours) AS ResolvedExceptions, "
        f"{ratio('sum(ResolutionTimeHours)', 'count(ResolutionTimeHours)')} "
        "AS AvgResolutionHours FROM rpt_exception_dashboard"
    ),
    "kpi_route_efficiency": q(
        "SELECT CAST(sum(ratio4) AS DOUBLE) / 10000.0 / nullif(CAST(count(*) AS DOUBLE), 0) "
        "AS AvgEfficiency FROM rpt_route_efficiency"
    ),
    "kpi_stop_completion": q(
        "SELECT CAST(sum(ActualStops) AS BIGINT) AS ActualStops, "
        "CAST(sum(PlannedStops) AS BIGINT) AS PlannedStops, "
        f"{ratio('sum(ActualStops)', 'sum(PlannedStops)')} AS StopCompletionRate "
        "FROM rpt_route_efficiency"
    ),
    "kpi_date_corrected": q(
        "SELECT count(*) AS DateCorrectedExceptions FROM rpt_exception_dashboard "
        "WHERE IsDateCorrected = 1"
    ),
    "bq_sales_by_region_product_month": q(BQ_SALES),
    "bq_late_deliveries": q(
        f"SELECT DeliveryID, Route, Driver, CAST({DAYS} AS INTEGER) AS DaysLate "
        "FROM rpt_delivery_performance WHERE DeliveryStatus = 'LATE'"
    ),
    "bq_late_by_route_driver": q(
        f"SELECT Route, Driver, count(*) AS Deliveries, {LATE_COUNT} AS LateDeliveries, "
        f"{ratio(LATE_COUNT, 'count(*)')} AS LatePct "
        "FROM rpt_delivery_performance GROUP BY Route, Driver"
    ),
    "bq_on_time_pct": q(
        f"SELECT Region, count(*) AS Deliveries, {ON_TIME} AS OnTimeDeliveries, "
        f"{ratio(ON_TIME, 'count(*)')} AS OnTimePct FROM rpt_delivery_performance GROUP BY Region "
        f"UNION ALL SELECT 'ALL', count(*), {ON_TIME}, {ratio(ON_TIME, 'count(*)')} "
        "FROM rpt_delivery_performance"
    ),
    "bq_resolution_by_type": q(
        f"SELECT ExceptionType, {RESOLUTION} FROM rpt_exception_dashboard GROUP BY ExceptionType"
    ),
    "bq_routes_over_hours": q(
        f"SELECT Route, Driver, {dbl('PlannedHours')}, {dbl('ActualHours')}, EfficiencyRatio "
        "FROM rpt_route_efficiency WHERE ratio4 > 10000"
    ),
    "bq_drivers_under_stops": q(
        "SELECT Driver, count(*) AS RoutesUnderPlan, "
        "CAST(sum(-StopVariance) AS BIGINT) AS MissedStops "
        "FROM rpt_route_efficiency WHERE StopVariance < 0 GROUP BY Driver"
    ),
    "bq_priority_by_region": q(
        f"SELECT Region, count(*) AS Deliveries, {PRIORITY} AS PriorityDeliveries, "
        f"{ratio(PRIORITY, 'count(*)')} AS PriorityPct "
        "FROM rpt_delivery_performance GROUP BY Region"
    ),
    "bq_exception_trend": q(
        "SELECT CAST(year(DateReported) AS INTEGER) AS ReportYear, "
        f"CAST(month(DateReported) AS INTEGER) AS ReportMonth, ExceptionType, {RESOLUTION} "
        "FROM rpt_exception_dashboard GROUP BY 1, 2, 3"
    ),
    "bq_priority_impact": q(
        f"SELECT Region, IsPriority, count(*) AS Deliveries, {LATE_COUNT} AS LateDeliveries, "
        f"{ratio(LATE_COUNT, 'count(*)')} AS LatePct, {ratio(LATE_DAYS, LATE_COUNT)} AS "
        "AvgDaysLate FROM rpt_delivery_performance GROUP BY Region, IsPriority"
    ),
    "bq_routes_drivers_vs_plan": q(union([_plan_level("Route"), _plan_level("Driver")])),
}

ORACLE = {**SOURCES, **LAYERS, **GATES, **PROFILES, **AUDITS, **MEASURES}
