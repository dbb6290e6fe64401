"""Snapshots, run log, catalog and the full load."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from haulmart.contracts import FACTS, STAGING, WAREHOUSE
from haulmart.operators.checks import WARN, GateFailed
from haulmart.plans import catalog, measures
from haulmart.plans.pipeline import Pipeline, publish_views, published
from haulmart.runlog import RunLog, utc_now
from haulmart.sources.feeds import RejectedRows
from haulmart.sources import snapshots
from haulmart.sources.snapshots import PublishConflict, Published, SnapshotStore, reload_table

from tests.conftest import dec

AS_OF = date(2024, 12, 31)

FILES = {
    "staging_sales": [
        "SalesID,DeliveryID,DateKey,ProductType,Region,UnitsSold,SalesAmount",
        "1,10,2024-01-05,box,ne,3,30.00",
        "2,11,2024-01-06,pallet,SW,1,12.50",
    ],
    "staging_deliveries": [
        "DeliveryID,RouteID,DriverID,Region,ShipmentType,DeliveryDate,ExpectedDeliveryDate,"
        "DeliveryStatus,PriorityFlag",
        "10,R1,Driver 1,NE,Air,2024-01-09,2024-01-07,Delivered,1",
        "11,R2,Driver 2,SW,Ground,2024-01-09,2024-01-09,Delivered,0",
    ],
    "staging_routes": [
        "RouteID,DriverID,PlannedStops,ActualStops,PlannedHours,ActualHours,Region",
        "R1,Driver 1,10,9,5.7,6.8,NE",
        "R2,Driver 2,8,9,6.0,5.0,SW",
    ],
    "staging_exceptions": [
        "ExceptionID,DeliveryID,ExceptionType,DateReported,ResolvedDate,ResolutionTimeHours,"
        "PriorityFlag,Region",
        "100,10,Delay,2024-01-08,2024-01-09,12.5,1,NE",
        "101,11,Damage,2024-01-09,,,0,SW",
    ],
}


@pytest.fixture
def feeds(tmp_path):
    def write(**extra):
        folder = tmp_path / f"feeds-{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        paths = {}
        for table, lines in FILES.items():
            path = folder / f"{table}.csv"
            path.write_text("\n".join([*lines, *extra.get(table, [])]) + "\n")
            paths[table] = str(path)
        return paths

    return write


def steps_of(pipeline, run_id):
    return {
        r.StepName: r for r in pipeline.log.steps().filter(f"RunID = '{run_id}'").collect()
    }


def revenue(pipeline):
    return measures.total_revenue(published(pipeline.snapshots)).first().TotalRevenue


def test_full_load_publishes_and_logs(spark, tmp_path, feeds):
    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF)
    result = pipeline.run(feeds(), "nightly")
    assert revenue(pipeline) == dec("42.50")
    run = pipeline.log.runs().first()
    assert (run.RunID, run.PipelineName, run.Status) == (result.run_id, "nightly", "SUCCESS")
    assert run.EndTime >= run.StartTime
    steps = steps_of(pipeline, result.run_id)
    assert steps["Load fact_sales"].RowsProcessed == 2
    assert steps["Warehouse gate"].Status == "SUCCESS"
    assert {f"Load {c.name}" for c in STAGING + WAREHOUSE} <= set(steps)
    assert pipeline.log.violations().count() == 0
    assert spark.table("rpt_sales_summary").count() == 2


def test_strict_load_stops_at_the_first_bad_row(spark, tmp_path, feeds):
    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF)
    pipeline.run(feeds())
    with pytest.raises(RejectedRows):
        pipeline.run(feeds(staging_sales=["3,10,2024-01-05,box,ne,x,30.00"]))
    assert revenue(pipeline) == dec("42.50")
    assert sorted(r.Status for r in pipeline.log.runs().collect()) == ["FAILED", "SUCCESS"]
    rejected = pipeline.rejects().first()
    assert (rejected.table_name, rejected.reject_reason) == ("staging_sales", "unreadable_value")
    assert '"UnitsSold":"x"' in rejected.record


def test_failed_gate_keeps_the_previous_warehouse(spark, tmp_path, feeds):
    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF)
    pipeline.run(feeds())
    before = pipeline.snapshots.current("dw")
    with pytest.raises(GateFailed) as failure:
        pipeline.run(feeds(staging_sales=["3,99,2024-01-05,box,ne,1,30.00"]))
    assert failure.value.code == 51001
    assert pipeline.snapshots.current("dw") == before
    failed = pipeline.log.runs().filter("Status = 'FAILED'").first()
    assert "51001" in failed.ErrorMessage
    assert steps_of(pipeline, failed.RunID)["Staging gate"].Status == "FAILED"


def test_quarantine_load_replaces_the_snapshot(spark, tmp_path, feeds):
    root = str(tmp_path / "root")
    Pipeline(spark, root, as_of=AS_OF).run(feeds())
    pipeline = Pipeline(spark, root, as_of=AS_OF, mode="quarantine", default_severity=WARN)
    pipeline.run(feeds(staging_sales=["2,11,2024-01-06,box,SW,1,9.00", "4,99,2024-01-06,box,SW,1,1.00"]))
    # The duplicate keeps its first row, the orphan sale is only warned about.
    assert revenue(pipeline) == dec("40.00")
    assert set(pipeline.snapshots.current("dw")) == {c.name for c in WAREHOUSE}


def test_error_while_loading_facts_keeps_the_previous_warehouse(spark, tmp_path, feeds, monkeypatch):
    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF)
    pipeline.run(feeds())
    from haulmart.plans import layers

    def broken(*_):
        raise RuntimeError("no space")

    monkeypatch.setitem(layers.FACT_PLANS, "fact_routes", broken)
    with pytest.raises(RuntimeError):
        pipeline.run(feeds(staging_sales=["3,10,2024-01-05,box,ne,1,1.00"]))
    monkeypatch.undo()
    assert revenue(pipeline) == dec("42.50")


def test_skipped_gates(spark, tmp_path, feeds):
    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF, gates_enabled=False)
    result = pipeline.run(feeds(staging_sales=["3,99,2024-01-05,box,ne,1,30.00"]))
    assert steps_of(pipeline, result.run_id)["Staging gate"].Status == "SKIPPED"


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        Pipeline(spark, str(tmp_path), mode="lenient")


def test_snapshots(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.current("dw") == {}
    store.publish("dw", "a", {"t": Published("path-a", 1)})
    store.publish("staging", "a", {"t": Published("path-s", 2)})
    newest = {"t": Published("path-b", 3), "u": Published("path-u", 0)}
    store.publish("dw", "b", newest)
    assert store.current("dw") == newest
    assert store.current("staging") == {"t": Published("path-s", 2)}
    assert store.manifest().count() == 4


def test_order_of_publications_is_not_the_clock(spark, tmp_path, monkeypatch):
    class Earlier(snapshots.datetime):
        @classmethod
        def now(cls, tz=None):
            return super().now(tz) - timedelta(days=1)

    one, other = (SnapshotStore(spark, str(tmp_path)) for _ in range(2))
    assert one.publish("dw", "a", {"t": Published("path-a", 1)}) == 1
    monkeypatch.setattr(snapshots, "datetime", Earlier)
    assert other.publish("dw", "b", {"t": Published("path-b", 2)}) == 2
    assert one.newest_runs("dw", 2) == ["b", "a"]
    at = {r.run_id: r.published_at for r in one.manifest().collect()}
    assert at["b"] < at["a"]


def test_second_publisher_is_told(spark, tmp_path):
    one, other = (SnapshotStore(spark, str(tmp_path)) for _ in range(2))
    seen = one.last_entry("dw"), other.last_entry("dw")
    one.publish("dw", "a", {"t": Published("path-a", 1)}, after=seen[0])
    with pytest.raises(PublishConflict, match="run b: entry 1 of layer dw"):
        other.publish("dw", "b", {"t": Published("path-b", 2)}, after=seen[1])
    assert other.newest_runs("dw", 9) == ["a"]
    assert other.publish("dw", "b", {"t": Published("path-b", 2)}) == 2


def test_unfinished_entry_is_not_read(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.publish("dw", "a", {"t": Published("path-a", 1)})
    whole = (tmp_path / "manifest/dw/000000000001.json").read_text()
    (tmp_path / "manifest/dw/000000000002.json").write_text(whole[: len(whole) // 2].replace('"a"', '"b"'))
    (tmp_path / "manifest/dw/000000000003.json").write_text("")
    assert store.newest_runs("dw", 9) == ["a"]
    assert store.publish("dw", "c", {"t": Published("path-c", 3)}) == 4
    assert store.newest_run("dw") == "c"


def test_load_stops_if_another_has_published(spark, tmp_path, monkeypatch):
    load = Pipeline(spark, str(tmp_path))
    theirs = {"t": Published("theirs", 1)}

    def staged(run_id, feeds, workspace):
        load.snapshots.publish("staging", "another", theirs)
        return {}

    monkeypatch.setattr(load, "_stage", staged)
    monkeypatch.setattr(load, "_load_tables", lambda *_: {"t": Published("ours", 1)})
    with pytest.raises(PublishConflict):
        load.run({})
    assert load.snapshots.current("staging") == theirs
    assert load.log.runs().first().Status == "FAILED"


def test_reload_replaces_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    reload_table(spark.range(5), path)
    assert reload_table(spark.range(3), path).count() == 3


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    assert log.runs().count() == 0
    run = log.start_run("it's a load")
    assert log.runs().first().Status == "RUNNING"
    log.log_step(run, "one", utc_now() - timedelta(seconds=90), 5)
    log.end_run(run, "FAILED", "broken 'quote'")
    state, step = log.runs().first(), log.steps().first()
    assert (state.Status, state.ErrorMessage, state.PipelineName) == (
        "FAILED", "broken 'quote'", "it's a load",
    )
    assert step.DurationSec in (90, 91)
    with pytest.raises(ValueError):
        log.end_run(run, "DONE")
    log.log_step("no such run", "two", utc_now())
    assert [(r.table_name, r.problem) for r in log.violations().collect()] == [
        ("etl_step_log", "no such run")
    ]
    report = {(r.table_name, r.problem): r.violations for r in log.constraint_report().collect()}
    assert report == {
        ("etl_run_log", "unknown status"): 0,
        ("etl_step_log", "unknown status"): 0,
        ("etl_step_log", "no such run"): 1,
    }


def test_catalog(spark, small_tables):
    views = {v: ("clean", small_tables()(v).schema) for v in ("clean_sales", "clean_routes")}
    columns = catalog.column_catalog(spark, views)
    amount = columns.filter("TableName = 'fact_sales' AND ColumnName = 'SalesAmount'").first()
    assert (amount.DataType, amount.NumericPrecision, amount.NumericScale, amount.IsNullable) == (
        "decimal", 18, 2, "NO",
    )
    region = columns.filter("TableName = 'staging_sales' AND ColumnName = 'Region'").first()
    assert (region.MaxLength, region.ColumnOrder) == (50, 5)
    assert columns.filter("ObjectType = 'VIEW'").count() == 8 + 9
    keys = catalog.primary_key_catalog(spark)
    pairs = [(r.ColumnName) for r in keys.filter("TableName = 'fact_routes'").collect()]
    assert pairs == ["RouteID", "DriverID"]
    assert catalog.foreign_key_catalog(spark).count() == sum(len(c.foreign_keys) for c in FACTS)
    assert catalog.column_descriptions(spark).filter("Description IS NULL").count() == 0
    summary = [tuple(r) for r in catalog.layer_summary(columns).collect()]
    assert summary == [("staging", 4, 0), ("clean", 0, 2), ("dw", 13, 0), ("reporting", 0, 0)]


def test_views(spark, workspace, small_tables):
    from haulmart.plans.layers import Layers

    names = publish_views(Layers(workspace, small_tables(), utc_now()))
    assert len(names) == 25
    total = spark.sql("SELECT sum(SalesAmount) FROM rpt_sales_summary").first()[0]
    assert total == dec("65.50")
