"""Rules that matter at scale: exact averages, byte-bounded broadcasts, shared folders, clean-up, consistent readers."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from haulmart.functions.columns import integer_average
from haulmart.operators.checks import GateFailed
from haulmart.operators.keys import estimated_bytes, split_by_key
from haulmart.plans import audit, gates, profiling
from haulmart.plans.layers import Layers, sized_for_lookup
from haulmart.plans.pipeline import Pipeline, published
from haulmart.runlog import utc_now
from haulmart.sources.workspace import children, shared_folder

from tests.test_operations import AS_OF, feeds, steps_of  # noqa: F401


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_integer_average_of_four_million_rows(spark):
    df = spark.range(4_000_000).select(F.when(F.col("id") == 0, 1).otherwise(2).alias("u"))
    assert df.agg(integer_average("u").alias("a")).first().a == 1


def test_wide_values_are_joined_by_shuffle(spark, workspace):
    wide = spark.range(200).select("id", F.repeat(F.lit("x"), 10_000).alias("v"))
    stored = workspace.materialize(wide, "wide")
    assert estimated_bytes(stored) > 2_000_000
    facts = spark.range(1000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" in plan_of(facts.join(sized_for_lookup(stored), "id"))
        assert "Broadcast" not in plan_of(facts.join(sized_for_lookup(stored, 1_000_000), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    stub = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None),
        sparkContext=SimpleNamespace(master=master, applicationId="a"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(stub)


def test_clashing_rows_are_folded_before_the_minimum(spark, workspace):
    rows = [("k", i % 3) for i in range(300)] + [("other", 1)]
    split = split_by_key(spark.createDataFrame(rows, "k string, v int").coalesce(1), ["k"], workspace)
    assert sorted(tuple(r) for r in split.kept.collect()) == [("k", 0), ("other", 1)]
    assert {tuple(r) for r in split.rejected.collect()} == {("k", 0, 99), ("k", 1, 100), ("k", 2, 100)}


def test_a_wrong_clean_view_shows_in_the_retention(small_tables):
    tables = small_tables()
    right = profiling.retention(tables, "clean_sales").first()
    assert (right.CleanRowCount, right.StagingValidRowCount, right.RetentionRate) == (3, 3, 1.0)
    broken = small_tables(clean_sales=tables("clean_sales").filter("SalesID != '1'"))
    wrong = profiling.retention(broken, "clean_sales").first()
    assert (wrong.CleanRowCount, wrong.StagingValidRowCount) == (2, 3)
    counts = {r.TableName: r.DroppedRows for r in profiling.layer_row_counts(broken).collect()}
    assert counts["sales"] == 1


def test_rows_lost_in_lookups_are_a_warning(spark, workspace, small_tables):
    layers = Layers(workspace, small_tables(), utc_now())
    layers.load_warehouse()

    def lossy(name):
        return layers(name).filter("SalesID != '1'") if name == "fact_sales" else layers(name)

    rows = {r.check_id: r for r in gates.gate_warehouse(lossy).collect()}
    lost = rows["dw_rows_lost_sales"]
    assert (lost.bad_rows, lost.severity, lost.status) == (1, "warn", "WARN")
    assert rows["dw_rows_lost_routes"].status == "PASS"
    severe = gates.gate_warehouse(lossy, severities={"dw_rows_lost_sales": "fail"}).collect()
    assert {r.check_id: r.status for r in severe}["dw_rows_lost_sales"] == "FAIL"


def test_a_skipped_gate_asks_for_no_table(spark):
    def no_table(name):
        raise AssertionError(name)

    for report in (
        gates.gate_staging(no_table, AS_OF, enabled=False),
        gates.gate_clean(no_table, enabled=False),
        gates.gate_warehouse(no_table, enabled=False),
    ):
        assert {r.status for r in report.collect()} == {"SKIPPED"}


def test_failed_gate_keeps_readers_on_one_run(spark, tmp_path, feeds):  # noqa: F811
    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF)
    first = pipeline.run(feeds()).run_id
    with pytest.raises(GateFailed):
        pipeline.run(feeds(staging_sales=["7,99,2024-01-05,box,ne,1,30.00"]))
    layers = published(pipeline.snapshots, views=True)
    for name in ("staging_sales", "clean_sales", "fact_sales"):
        assert sorted(r.SalesID for r in layers(name).collect()) == ["1", "2"]
    assert all(first in path for path in layers.paths.values())
    assert spark.table("rpt_sales_summary").count() == 2


def test_a_load_leaves_published_tables_only(spark, tmp_path, feeds):  # noqa: F811
    root = str(tmp_path / "root")
    pipeline = Pipeline(spark, root, as_of=AS_OF, mode="quarantine")
    run = pipeline.run(feeds(staging_sales=["1,10,2024-01-05,box,ne,3,30.00"])).run_id
    (work,) = children(spark, f"{root}/runs/{run}")
    left = {name.rpartition("-")[0] for name in children(spark, f"{root}/runs/{run}/{work}")}
    assert left == {"rejects", *[table for _, table in audit.STORED]}
    assert pipeline.rejects().count() == 1
    assert published(pipeline.snapshots)("fact_sales").count() == 2


def test_old_runs_go_when_asked(spark, tmp_path, feeds):  # noqa: F811
    root = str(tmp_path / "root")
    first = Pipeline(spark, root, as_of=AS_OF).run(feeds()).run_id
    pipeline = Pipeline(spark, root, as_of=AS_OF, keep_runs=1)
    second = pipeline.run(feeds()).run_id
    assert children(spark, f"{root}/runs") == [second] and first != second
    assert published(pipeline.snapshots)("fact_sales").count() == 2
    with pytest.raises(ValueError):
        Pipeline(spark, root, keep_runs=0)


def test_a_failed_null_check_names_the_columns(spark, tmp_path, feeds, monkeypatch):  # noqa: F811
    from haulmart.plans import layers as module

    pipeline = Pipeline(spark, str(tmp_path / "root"), as_of=AS_OF)
    load = module.Layers._build

    def with_null(self, name):
        built = load(self, name)
        if name != "staging_routes":
            return built
        first = F.when(F.col("RouteID") != "R1", F.col("RouteID"))
        return self.workspace.materialize(built.withColumn("RouteID", first), "changed_routes")

    monkeypatch.setattr(module.Layers, "_build", with_null)
    with pytest.raises(GateFailed):
        pipeline.run(feeds())
    failed = pipeline.log.runs().filter("Status = 'FAILED'").first()
    detail = steps_of(pipeline, failed.RunID)["Nulls in staging_routes.RouteID"]
    assert detail.RowsProcessed == 1
