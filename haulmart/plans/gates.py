"""The three gates: staging, clean and warehouse checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.contracts import FACTS, WAREHOUSE, Contract, ForeignKey, contract
from haulmart.functions.columns import any_null, match_key, null_cells
from haulmart.operators.checks import (
    WARN,
    AggregateCheck,
    Check,
    CheckSet,
    DuplicateKeyCheck,
    OrphanCheck,
    QueryCheck,
    Tables,
    check_report,
    not_empty,
    row_check,
)
from haulmart.operators.integrity import Reference, reference_orphans, rows_apart
from haulmart.operators.keys import BROADCAST_BYTES
from haulmart.operators.shape import long_form
from haulmart.plans.clean import LATE, is_overdue
from haulmart.plans.dims import VALUE_DIMENSIONS

# The error number each gate raises, and the first plausible date.
STAGING_FAILED = 51001
CLEAN_FAILED = 51000
WAREHOUSE_FAILED = 51002
FIRST_PLAUSIBLE_DATE = "2000-01-01"

# Columns whose nulls the staging gate counts.
STAGING_KEY_FIELDS = {
    "staging_sales": ("SalesID", "DeliveryID", "DateKey", "UnitsSold", "SalesAmount"),
    "staging_deliveries": ("DeliveryID", "RouteID", "DriverID", "DeliveryDate", "DeliveryStatus"),
    "staging_routes": ("RouteID", "DriverID"),
    "staging_exceptions": ("ExceptionID", "DeliveryID", "DateReported"),
}

def _at_most_zero(*columns: str) -> Column:
    condition = F.col(columns[0]) <= 0
    for c in columns[1:]:
        condition = condition | (F.col(c) <= 0)
    return condition


def _outside(column: str, last: Column) -> Column:
    first = F.lit(FIRST_PLAUSIBLE_DATE).cast("date")
    return (F.col(column) < first) | (F.col(column) > last)


def _bad_route_metrics() -> Column:
    return _at_most_zero("PlannedStops", "ActualStops", "PlannedHours", "ActualHours")


def staging_checks(as_of: date) -> list[Check]:
    def today() -> Column:
        return F.lit(as_of.isoformat()).cast("date")

    checks: list[Check] = [
        not_empty(f"stg_not_empty_{s}", f"staging_{s} is not empty", f"staging_{s}")
        for s in ("sales", "deliveries", "routes", "exceptions")
    ]
    for table, fields in STAGING_KEY_FIELDS.items():
        short = table.removeprefix("staging_")
        checks.append(
            AggregateCheck(
                f"stg_nulls_{short}",
                f"{table} has no null key fields",
                table,
                lambda fields=fields: null_cells(*fields),
            )
        )
    checks += [
        row_check(
            "stg_positive_sales",
            "staging_sales units and amount are positive",
            "staging_sales",
            lambda: _at_most_zero("UnitsSold", "SalesAmount"),
        ),
        row_check(
            "stg_positive_routes",
            "staging_routes stops and hours are positive",
            "staging_routes",
            _bad_route_metrics,
        ),
        row_check(
            "stg_nonneg_resolution",
            "staging_exceptions resolution hours are not negative",
            "staging_exceptions",
            lambda: F.col("ResolutionTimeHours") < 0,
        ),
        OrphanCheck(
            "stg_ri_sales",
            "staging_sales deliveries exist",
            "staging_sales",
            "DeliveryID",
            "staging_deliveries",
            "DeliveryID",
        ),
        OrphanCheck(
            "stg_ri_exceptions",
            "staging_exceptions deliveries exist",
            "staging_exceptions",
            "DeliveryID",
            "staging_deliveries",
            "DeliveryID",
        ),
        row_check(
            "stg_range_delivery_date",
            "staging_deliveries delivery date is plausible",
            "staging_deliveries",
            lambda: _outside("DeliveryDate", today()),
        ),
        row_check(
            "stg_range_expected_date",
            "staging_deliveries expected date is plausible",
            "staging_deliveries",
            lambda: _outside("ExpectedDeliveryDate", F.add_months(today(), 12)),
        ),
        row_check(
            "stg_range_sales_date",
            "staging_sales date is plausible",
            "staging_sales",
            lambda: _outside("DateKey", today()),
        ),
        row_check(
            "stg_chronology",
            "staging_exceptions are not resolved before reported",
            "staging_exceptions",
            lambda: F.col("ResolvedDate") < F.col("DateReported"),
        ),
    ]
    return checks


def clean_checks() -> list[Check]:
    checks: list[Check] = [
        not_empty(f"cln_not_empty_{s}", f"clean_{s} is not empty", f"clean_{s}")
        for s in ("sales", "deliveries", "exceptions", "routes")
    ]
    checks += [
        row_check(
            "cln_required_sales",
            "clean_sales required fields are present",
            "clean_sales",
            lambda: any_null("DateKey", "SalesAmount", "UnitsSold"),
        ),
        row_check(
            "cln_required_deliveries",
            "clean_deliveries required fields are present",
            "clean_deliveries",
            lambda: any_null("DeliveryID", "RouteID", "DriverID"),
        ),
        row_check(
            "cln_late_rule",
            "clean_deliveries overdue rows are LATE",
            "clean_deliveries",
            lambda: is_overdue() & (F.col("DeliveryStatus") != LATE),
        ),
        row_check(
            "cln_priority_domain",
            "clean_deliveries priority is 0 or 1",
            "clean_deliveries",
            lambda: ~F.col("PriorityFlag").isin(0, 1),
        ),
        # Asked of staging: the clean rows cannot break this rule any more.
        row_check(
            "cln_route_source_metrics",
            "staging_routes metrics are valid at the source",
            "staging_routes",
            lambda: ~any_null("RouteID", "DriverID") & _bad_route_metrics(),
        ),
        OrphanCheck(
            "cln_ri_sales",
            "clean_sales deliveries exist",
            "clean_sales",
            "DeliveryID",
            "clean_deliveries",
            "DeliveryID",
        ),
        OrphanCheck(
            "cln_ri_exceptions",
            "clean_exceptions deliveries exist",
            "clean_exceptions",
            "DeliveryID",
            "clean_deliveries",
            "DeliveryID",
        ),
    ]
    return checks


# Foreign keys the warehouse gate checks one by one; dw_fk_all covers every one.
GATE_REFERENCES = {
    "fact_sales": ("DateKey", "ProductTypeID", "RegionID"),
    "fact_deliveries": ("RouteID", "DriverID", "DeliveryStatusID"),
    "fact_exceptions": ("ExceptionTypeID",),
    "fact_routes": ("RouteID", "DriverID"),
}
# Foreign keys of the health audit.
AUDIT_REFERENCES = {
    "fact_sales": ("DateKey", "ProductTypeID", "RegionID"),
    "fact_deliveries": ("RouteID", "DriverID", "DeliveryStatusID"),
    "fact_exceptions": ("ExceptionTypeID", "RegionID"),
    "fact_routes": ("RouteID", "DriverID", "RegionID"),
}


def reference_title(c: Contract, fk: ForeignKey) -> str:
    return f"{c.name}.{fk.column} -> {fk.ref_table}"


def reference_key(c: Contract, fk: ForeignKey) -> str:
    return f"dw_fk_{c.name.removeprefix('fact_')}_{fk.label}"


def _late_key_order(tables: Tables) -> DataFrame:
    """Deliveries past their planned date whose status is not LATE."""
    status = tables("dim_delivery_status").select(
        F.col("DeliveryStatusID").alias("_id"), "DeliveryStatus"
    )
    overdue = tables("fact_deliveries").filter(
        F.col("DeliveryDateKey") > F.col("ExpectedDeliveryDateKey")
    )
    counted = overdue.groupBy("DeliveryStatusID").agg(F.count(F.lit(1)).alias("_rows"))
    wrong = counted.join(status, F.col("DeliveryStatusID") == F.col("_id")).filter(
        F.col("DeliveryStatus") != LATE
    )
    return wrong.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("bad_rows"))


def _rows_lost(fact: str, tables: Tables) -> DataFrame:
    """Clean rows against fact rows by key: what the key lookups left out or doubled.

    Sales that the date rule leaves out on purpose are not asked for. The codes of
    a route, that the fact has keys for, are compared as the lookups compare them.
    """
    clean, loaded = tables(f"clean_{fact.removeprefix('fact_')}"), tables(fact)
    keys = contract(fact).primary_key
    if fact == "fact_sales":
        clean = clean.filter(F.col("IsBadDateKey") == 0)
    for name in keys:
        coded = next(((t, d) for t, d in VALUE_DIMENSIONS.items() if d.is_code and d.key == name), None)
        if coded is not None:
            table, dimension = coded
            codes = tables(table).select(F.col(dimension.key).alias("_id"), F.col(dimension.value).alias("_code"))
            loaded = loaded.join(codes, F.col(name) == F.col("_id"), "left").withColumn(name, match_key(F.col("_code"))).drop("_id", "_code")
            clean = clean.withColumn(name, match_key(F.col(dimension.source_column)))
    return rows_apart(clean.select(*keys), loaded.select(*keys))


def lost_rows_key(fact: str) -> str:
    return f"dw_rows_lost_{fact.removeprefix('fact_')}"


def warehouse_checks() -> list[Check]:
    checks: list[Check] = [
        not_empty(f"dw_not_empty_{c.name}", f"{c.name} is not empty", c.name) for c in WAREHOUSE
    ]
    for c in FACTS:
        short = c.name.removeprefix("fact_")
        columns = tuple(fk.column for fk in c.foreign_keys)
        checks.append(
            row_check(
                f"dw_null_keys_{short}",
                f"{c.name} has no null surrogate keys",
                c.name,
                lambda columns=columns: any_null(*columns),
            )
        )
        checks.append(
            DuplicateKeyCheck(
                f"dw_dup_pk_{short}", f"{c.name} keys are unique", c.name, c.primary_key
            )
        )
        for fk in c.foreign_keys:
            if fk.column in GATE_REFERENCES[c.name]:
                checks.append(
                    OrphanCheck(
                        reference_key(c, fk),
                        reference_title(c, fk),
                        c.name,
                        fk.column,
                        fk.ref_table,
                        fk.ref_column,
                    )
                )
        checks.append(
            QueryCheck(
                lost_rows_key(c.name),
                f"{c.name} has every row of clean_{short}",
                lambda tables, name=c.name: _rows_lost(name, tables),
            )
        )
    checks += [
        row_check(
            "dw_amount_positive",
            "fact_sales amount is positive",
            "fact_sales",
            lambda: _at_most_zero("SalesAmount"),
        ),
        row_check(
            "dw_units_positive",
            "fact_sales units are positive",
            "fact_sales",
            lambda: _at_most_zero("UnitsSold"),
        ),
        row_check(
            "dw_hours_positive",
            "fact_routes hours are positive",
            "fact_routes",
            lambda: _at_most_zero("PlannedHours", "ActualHours"),
        ),
        QueryCheck(
            "dw_delivery_date_logic",
            "fact_deliveries past their planned date are LATE",
            _late_key_order,
        ),
    ]
    return checks


def _orphans(tables: Tables, scope: Mapping[str, Sequence[str]], name) -> DataFrame:
    """(fact_column, bad_rows) for the foreign keys in ``scope``, all facts in one plan, under what ``name`` calls them."""
    references = [
        Reference(name(c, fk), c.name, fk.column, fk.ref_table, fk.ref_column)
        for c in FACTS
        for fk in c.foreign_keys
        if fk.column in scope[c.name]
    ]
    measured = getattr(tables, "measured", None)
    few = measured is not None and measured({r.ref_table for r in references}) <= BROADCAST_BYTES
    return reference_orphans(references, tables, few)


EVERY_REFERENCE = {c.name: [fk.column for fk in c.foreign_keys] for c in FACTS}


def reference_report(
    tables: Tables, scope: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """(check_name, bad_rows) for every declared foreign key, or those in ``scope``."""
    found = _orphans(tables, scope or EVERY_REFERENCE, reference_title)
    return found.withColumnRenamed("fact_column", "check_name")


def _reference_set() -> CheckSet:
    return CheckSet(
        {reference_key(c, fk): reference_title(c, fk) for c in FACTS for fk in c.foreign_keys},
        lambda tables: _orphans(tables, EVERY_REFERENCE, reference_key).withColumnRenamed("fact_column", "check_id"),
    )


def gate_staging(tables: Tables, as_of: date, **options) -> DataFrame:
    return check_report("staging", staging_checks(as_of), tables, **options)


def gate_clean(tables: Tables, **options) -> DataFrame:
    return check_report("clean", clean_checks(), tables, **options)


def gate_warehouse(tables: Tables, **options) -> DataFrame:
    """Covers every table and every declared foreign key, one pass per fact and one plan for the latter.

    Rows of the clean layer that a fact lacks are a warning unless the caller says otherwise.
    """
    lost = {lost_rows_key(c.name): WARN for c in FACTS}
    options["severities"] = {**lost, **(options.get("severities") or {})}
    own: list[Check | CheckSet] = [
        c for c in warehouse_checks() if not isinstance(c, OrphanCheck)
    ]
    own.append(_reference_set())
    return check_report("dw", own, tables, **options)


def null_detail(tables: Tables) -> DataFrame:
    """(TableName, ColumnName, NullCount) for the staging key fields, one pass per table."""
    parts = []
    for table, fields in STAGING_KEY_FIELDS.items():
        totals = tables(table).agg(*[null_cells(f).alias(f) for f in fields])
        counts = long_form(totals, fields, "ColumnName", "NullCount")
        parts.append(counts.select(F.lit(table).alias("TableName"), "ColumnName", "NullCount"))
    return reduce(DataFrame.unionByName, parts)
