from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from haulmart.contracts import FACTS, WAREHOUSE
from haulmart.functions.columns import date_key, date_of_key, week_of_year
from haulmart.operators import profile
from haulmart.plans import audit, measures, profiling
from haulmart.plans.layers import Layers
from haulmart.runlog import utc_now

from tests.conftest import SALES, d, dec


@pytest.fixture(scope="module")
def layers(workspace, small_tables, staged):
    bad_date = [*SALES, (4, 10, d("2101-01-01"), "box", "ne", 1, dec("5.00"))]
    tables = small_tables(staging_sales=staged("staging_sales", bad_date))
    return Layers(workspace, tables, utc_now())


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_week_numbers(spark):
    days = ["2023-01-01", "2023-12-31", "2024-01-06", "2024-01-07", "2024-12-31"]
    df = spark.createDataFrame([(d(x),) for x in days], "d date")
    weeks = [r.w for r in df.select(week_of_year(F.col("d")).alias("w")).collect()]
    assert weeks == [1, 53, 1, 2, 53]


def test_date_keys_round_trip(spark):
    df = spark.sql("SELECT explode(sequence(date'1999-12-01', date'2001-02-01')) AS d")
    keyed = df.select("d", date_key(F.col("d")).alias("k"))
    assert keyed.filter(date_of_key(F.col("k")) != F.col("d")).count() == 0
    assert keyed.filter(F.col("d") == "2000-02-29").first().k == 20000229


def test_dim_date(layers):
    dates = {r.DateKey: r for r in layers("dim_date").collect()}
    assert sorted(dates) == [
        20240105, 20240107, 20240108, 20240109, 20240207, 20240210, 20240211,
    ]
    sunday = dates[20240107]
    assert (sunday.Weekday, sunday.IsWeekend, sunday.DayName, sunday.MonthName) == (
        1, 1, "Sunday", "January",
    )
    assert (sunday.MonthYear, sunday.YearMonth, sunday.Quarter, sunday.IsHoliday) == (
        "2024-01", "202401", 1, 0,
    )


def test_dimensions_are_normalized(layers):
    assert values(layers("dim_product_type"), "ProductTypeID", "ProductType") == [
        (1, "BOX"), (2, "PALLET"),
    ]
    assert values(layers("dim_region"), "Region") == [("NE",), ("SW",)]
    # r1 and R1 are one route; the spelling that sorts first is kept.
    assert values(layers("dim_route"), "RouteID", "RouteCode") == [(1, "R1"), (2, "R2")]
    assert values(layers("dim_driver"), "DriverCode") == [("Driver 1",), ("Driver 2",)]
    assert values(layers("dim_priority_flag"), "PriorityFlag") == [(0,), (1,)]


def test_facts_resolve_every_key(layers):
    # The sale with the bad date stays out of the fact and the date dimension.
    assert values(layers("fact_sales"), "SalesID", "DateKey") == [
        ("1", 20240105), ("2", 20240105), ("3", 20240207),
    ]
    assert layers("clean_sales").count() == 4
    assert values(layers("fact_deliveries"), "DeliveryID", "RouteID") == [(10, 1), (11, 1)]
    assert layers("fact_routes").count() == 2
    corrected = values(layers("fact_exceptions"), "ExceptionID", "IsDateCorrected")
    assert corrected == [(100, 1), (101, 0), (102, 0)]
    dropped = {r.FactTable: r.DroppedRows for r in audit.fact_versus_clean(layers).collect()}
    assert dropped == {"fact_sales": 1, "fact_deliveries": 0, "fact_routes": 0, "fact_exceptions": 0}


def test_facts_follow_their_contracts(layers):
    for c in WAREHOUSE:
        table = layers(c.name)
        assert table.columns == c.column_names
        assert [f.dataType for f in table.schema] == [f.dataType for f in c.schema()]


def test_reports(layers):
    row = layers("rpt_delivery_performance").filter("DeliveryID = 10").first()
    assert (row.Route, row.Driver, row.Region, row.DeliveryStatus, row.IsPriority) == (
        "R1", "Driver 1", "NE", "LATE", 1,
    )
    assert (row.DeliveryDate, row.ExpectedDeliveryDate) == (d("2024-01-09"), d("2024-01-07"))
    sale = layers("rpt_sales_summary").filter("SalesID = '3'").first()
    assert (sale.SaleYear, sale.SaleQuarter, sale.SaleMonthName) == (2024, 1, "February")
    assert values(layers("rpt_route_efficiency"), "Route", "StopVariance") == [("R1", -1), ("R2", 1)]
    assert layers("rpt_exception_dashboard").count() == 3


def test_measures(layers):
    assert measures.total_revenue(layers).first().TotalRevenue == dec("65.50")
    assert measures.late_share(layers).first().LatePct == 0.5
    resolved = measures.average_resolution(layers).first()
    assert (resolved.ResolvedExceptions, resolved.AvgResolutionHours) == (2, 12.0)
    assert measures.date_corrected(layers).first().DateCorrectedExceptions == 1
    assert [tuple(r) for r in measures.drivers_under_stops(layers).collect()] == [
        ("Driver 1", 1, 1)
    ]
    assert [r.Route for r in measures.routes_over_hours(layers).collect()] == ["R1"]
    on_time = {r.Region: r.OnTimePct for r in measures.on_time_share(layers).collect()}
    assert on_time == {"ALL": 0.5, "NE": 0.0, "SW": 1.0}
    late = measures.late_deliveries(layers).collect()
    assert [tuple(r) for r in late] == [(10, "R1", "Driver 1", 2)]
    impact = {(r.Region, r.IsPriority): r.AvgDaysLate for r in measures.priority_impact(layers).collect()}
    assert impact == {("NE", 1): 2.0, ("SW", 0): None}
    plan = {(r.Level, r.Code): r.PairsMeetingPlan for r in measures.routes_drivers_vs_plan(layers).collect()}
    assert plan == {
        ("Route", "R1"): 0, ("Route", "R2"): 1, ("Driver", "Driver 1"): 0, ("Driver", "Driver 2"): 1,
    }


def test_measures_over_no_rows(workspace, small_tables, staged):
    empty = {
        t: staged(t, [])
        for t in ("staging_sales", "staging_deliveries", "staging_routes", "staging_exceptions")
    }
    layers = Layers(workspace, small_tables(**empty), utc_now())
    layers.load_warehouse()
    assert measures.late_share(layers).first().LatePct is None
    assert measures.stop_completion(layers).first().StopCompletionRate is None
    assert measures.total_revenue(layers).first().TotalRevenue is None
    for name, plan in measures.MEASURES.items():
        assert plan(layers).collect() is not None, name
    assert {r.Retention for r in profiling.retention(layers, "clean_sales").select(
        F.col("RetentionRate").alias("Retention")).collect()} == {None}


def test_integer_average_is_cut(small_tables, staged):
    rows = [(i, 10, d("2024-01-05"), "box", "ne", u, dec("1.00")) for i, u in enumerate((1, 2, 2))]
    tables = small_tables(staging_sales=staged("staging_sales", rows))
    assert profiling.units_by_product(tables).first().AvgUnits == 1


def test_layer_counts_reconcile(small_tables, staged):
    rows = [*SALES, (9, 10, None, "box", "ne", 1, dec("1.00"))]
    tables = small_tables(staging_sales=staged("staging_sales", rows))
    counts = {r.TableName: r for r in profiling.layer_row_counts(tables).collect()}
    assert counts["sales"].DroppedRows == 1
    assert all(r.StagingRows == r.CleanRows + r.DroppedRows for r in counts.values())
    kept = profiling.retention(tables, "clean_sales").first()
    assert (kept.RetentionRate, kept.StagingRetentionRate) == (1.0, 0.75)


def test_review_list_of_late_rule_is_ordered(small_tables):
    base = small_tables()
    many = base("clean_deliveries").filter("DeliveryID = 10").withColumn(
        "DeliveryID", F.explode(F.sequence(F.lit(0), F.lit(29)))
    )
    wrong = many.withColumn("DeliveryStatus", F.lit("X"))
    listed = profiling.late_rule_offenders(lambda name: wrong).collect()
    assert [r.DeliveryID for r in listed] == list(range(20))


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, None)], "a int, b string")
    rows = {r.ColumnName: r for r in profile.null_profile(lambda t: df, [("s", "t")]).collect()}
    assert (rows["a"].NullCount, rows["a"].NullPct) == (0, dec("0.00"))
    assert (rows["b"].NullCount, rows["b"].TotalRows, rows["b"].NullPct) == (3, 4, dec("75.00"))
    report = profile.null_profile(lambda t: df, [("s", "t")])
    assert [r.ColumnName for r in profile.critical(report).collect()] == ["b"]
    card = profile.scorecard(report).first()
    assert (card.ColumnsChecked, card.ColumnsWithNulls, card.AvgNullPct) == (2, 1, dec("37.500000"))
    empty = profile.null_profile(lambda t: df.limit(0), [("s", "t")])
    assert {r.NullPct for r in empty.collect()} == {None}


def test_storage_reads_sizes(layers):
    layers.load_warehouse()
    sizes = audit.storage(layers, [("dw", "fact_sales")], layers.paths).first()
    assert sizes.TotalSpaceKB > 0


def test_duplicate_audit_uses_whole_keys(layers):
    layers.load_warehouse()
    assert audit.all_duplicate_keys(layers).count() == 0
    routes = layers("fact_routes")
    doubled = audit.duplicate_keys(routes.union(routes), FACTS[2]).collect()
    assert [(r.PKColumns, r.DuplicateGroupCount) for r in doubled] == [("RouteID+DriverID", 2)] * 2
