from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from haulmart.contracts import FACTS, contract
from haulmart.operators.checks import WARN, GateFailed, enforce
from haulmart.plans import gates, profiling
from haulmart.plans.layers import Layers
from haulmart.runlog import utc_now

from tests.conftest import DELIVERIES, EXCEPTIONS, ROUTES, SALES, STAGED_ROWS, d, dec

AS_OF = date(2024, 12, 31)


def failures(report):
    return {r.check_id: r.bad_rows for r in report.collect() if r.status != "PASS"}


def changed(rows, index, **values):
    """Copy of ``rows`` with one row changed by position."""
    row = list(rows[index])
    for position, value in values.items():
        row[int(position[1:])] = value
    return [*rows[:index], tuple(row), *rows[index + 1 :]]


BASELINE = {"stg_chronology": 1, "stg_nonneg_resolution": 1}

BREAKS = [
    ("stg_nulls_sales", "staging_sales", changed(SALES, 0, p2=None, p5=None), 2),
    ("stg_nulls_deliveries", "staging_deliveries", changed(DELIVERIES, 0, p2=None), 1),
    ("stg_nulls_routes", "staging_routes", changed(ROUTES, 1, p1=None), 1),
    ("stg_nulls_exceptions", "staging_exceptions", changed(EXCEPTIONS, 1, p3=None), 1),
    ("stg_positive_sales", "staging_sales", changed(SALES, 0, p5=0), 1),
    ("stg_positive_routes", "staging_routes", changed(ROUTES, 0, p4=dec("0.00")), 1),
    ("stg_ri_sales", "staging_sales", changed(SALES, 2, p1=99), 1),
    ("stg_ri_exceptions", "staging_exceptions", changed(EXCEPTIONS, 2, p1=99), 1),
    ("stg_range_delivery_date", "staging_deliveries", changed(DELIVERIES, 0, p5=d("1999-12-31")), 1),
    ("stg_range_expected_date", "staging_deliveries", changed(DELIVERIES, 0, p6=d("2026-01-01")), 1),
    ("stg_range_sales_date", "staging_sales", changed(SALES, 0, p2=d("2025-01-01")), 1),
]


@pytest.mark.parametrize("check, table, rows, bad", BREAKS, ids=[b[0] for b in BREAKS])
def test_staging_check_counts_bad_rows(small_tables, staged, check, table, rows, bad):
    tables = small_tables(**{table: staged(table, rows)})
    found = failures(gates.gate_staging(tables, AS_OF))
    assert found == {**BASELINE, check: bad}


def test_staging_gate_on_valid_and_repairable_rows(small_tables):
    assert failures(gates.gate_staging(small_tables(), AS_OF)) == BASELINE


def test_expected_date_may_lie_one_year_ahead(small_tables, staged):
    rows = changed(DELIVERIES, 0, p6=d("2025-12-31"))
    tables = small_tables(staging_deliveries=staged("staging_deliveries", rows))
    assert "stg_range_expected_date" not in failures(gates.gate_staging(tables, AS_OF))


def test_empty_tables_fail_only_the_empty_guards(small_tables, staged):
    tables = small_tables(**{t: staged(t, []) for t in STAGED_ROWS})
    short = ("sales", "deliveries", "routes", "exceptions")
    assert failures(gates.gate_staging(tables, AS_OF)) == {f"stg_not_empty_{s}": 1 for s in short}
    assert failures(gates.gate_clean(tables)) == {f"cln_not_empty_{s}": 1 for s in short}


def test_gate_raises_with_every_failure(small_tables):
    report = gates.gate_staging(small_tables(), AS_OF)
    with pytest.raises(GateFailed) as failure:
        enforce(report, gates.STAGING_FAILED, "staging")
    assert failure.value.code == 51001
    assert len(failure.value.failures) == len(BASELINE)


def test_severity_and_toggle(small_tables):
    warned = gates.gate_staging(small_tables(), AS_OF, severities={k: WARN for k in BASELINE})
    rows = enforce(warned, gates.STAGING_FAILED, "staging")
    assert {r.check_id for r in rows if r.status == "WARN"} == set(BASELINE)

    def unreadable(name):
        return small_tables()(name).select(F.raise_error(F.lit("read")).alias("x"), "*")

    skipped = gates.gate_staging(unreadable, AS_OF, enabled=False).collect()
    assert {r.status for r in skipped} == {"SKIPPED"}
    assert len(skipped) == 17


def broken_clean(small_tables, view, **columns):
    base = small_tables()

    def tables(name):
        return base(name).withColumns(columns) if name == view else base(name)

    return tables


def test_clean_gate(small_tables, staged):
    assert failures(gates.gate_clean(small_tables())) == {}
    for check, view, columns, bad in (
        ("cln_late_rule", "clean_deliveries", {"DeliveryStatus": F.lit("ON TIME")}, 1),
        ("cln_priority_domain", "clean_deliveries", {"PriorityFlag": F.lit(2)}, 2),
        ("cln_required_sales", "clean_sales", {"UnitsSold": F.lit(None).cast("int")}, 3),
        ("cln_required_deliveries", "clean_deliveries", {"RouteID": F.lit(None).cast("string")}, 2),
    ):
        tables = broken_clean(small_tables, view, **columns)
        assert failures(gates.gate_clean(tables)) == {check: bad}


def test_clean_gate_looks_at_staging_routes(small_tables, staged):
    rows = changed(ROUTES, 0, p2=0)
    tables = small_tables(staging_routes=staged("staging_routes", rows))
    assert failures(gates.gate_clean(tables)) == {"cln_route_source_metrics": 1}


def test_delivery_without_plan_orphans_its_children(small_tables, staged):
    rows = changed(DELIVERIES, 0, p6=None)
    tables = small_tables(staging_deliveries=staged("staging_deliveries", rows))
    assert failures(gates.gate_clean(tables)) == {"cln_ri_sales": 2, "cln_ri_exceptions": 1}
    listed = profiling.orphan_list(tables, "clean_sales", "SalesID").collect()
    assert sorted(r.SalesID for r in listed) == ["1", "2"]


@pytest.fixture(scope="module")
def loaded(spark, workspace, small_tables):
    tables = small_tables()
    layers = Layers(workspace, tables, utc_now())
    layers.load_warehouse()
    return layers


def replaced(layers, table, df):
    return lambda name: df if name == table else layers(name)


def test_warehouse_gate_passes(loaded):
    report = gates.gate_warehouse(loaded)
    assert failures(report) == {}
    assert report.count() == 13 + 4 + 4 + 4 + 18 + 4


def test_warehouse_gate_negative(loaded):
    sales, deliveries = loaded("fact_sales"), loaded("fact_deliveries")
    for table, df, expected in (
        ("fact_sales", sales.withColumn("SalesAmount", F.lit(0)), {"dw_amount_positive": 3}),
        ("fact_sales", sales.withColumn("UnitsSold", F.lit(0)), {"dw_units_positive": 3}),
        ("fact_sales", sales.union(sales), {"dw_dup_pk_sales": 3, "dw_rows_lost_sales": 3}),
        (
            "fact_sales",
            sales.withColumn("RegionID", F.when(F.col("SalesID") != "1", F.col("RegionID"))),
            {"dw_null_keys_sales": 1, "dw_fk_sales_region": 1},
        ),
        (
            "fact_sales",
            sales.withColumn("ProductTypeID", F.lit(77)),
            {"dw_fk_sales_product": 3},
        ),
        (
            "fact_deliveries",
            deliveries.withColumn("ExpectedDeliveryDateKey", F.lit(20240101)),
            {"dw_fk_deliveries_expected_date": 2, "dw_delivery_date_logic": 1},
        ),
        (
            "fact_routes",
            loaded("fact_routes").withColumn("PlannedHours", F.lit(0)),
            {"dw_hours_positive": 2},
        ),
    ):
        assert failures(gates.gate_warehouse(replaced(loaded, table, df))) == expected


def test_an_empty_dimension_fails_the_guard_and_its_references(loaded):
    empty = loaded("dim_region").limit(0)
    assert failures(gates.gate_warehouse(replaced(loaded, "dim_region", empty))) == {
        "dw_not_empty_dim_region": 1,
        "dw_fk_sales_region": 3,
        "dw_fk_deliveries_region": 2,
        "dw_fk_routes_region": 2,
        "dw_fk_exceptions_region": 3,
    }


def test_single_checks_agree_with_the_report(loaded):
    report = {r.check_id: r.bad_rows for r in gates.gate_warehouse(loaded).collect()}
    for check in gates.warehouse_checks():
        assert check.result(loaded).first().bad_rows == report[check.key]


def test_every_foreign_key_is_covered():
    declared = sum(len(c.foreign_keys) for c in FACTS)
    assert declared == 18
    for scope in (gates.GATE_REFERENCES, gates.AUDIT_REFERENCES):
        for table, columns in scope.items():
            assert set(columns) <= {fk.column for fk in contract(table).foreign_keys}
